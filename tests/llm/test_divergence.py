"""Divergences of sources against a plain count."""

import random
import re
from collections import Counter

import pytest

from paperweave.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "lang string, source string, text string, term string, p string, g string, size string, doc_id long"
UNIT = 10**9


def _naive(rows, least, top):
    rows = [tuple(x or "" for x in r) for r in rows]
    words = [(lang, source, TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t))) for lang, source, t in rows]
    out = set()
    for lang in {r[0] for r in rows}:
        held = Counter(w for l, _, ws in words if l == lang for w in set(ws))
        kept = {w for w, n in held.items() if n >= least}
        groups = {s: Counter() for l, s, _ in rows if l == lang}
        for l, s, ws in words:
            if l == lang:
                groups[s].update(w for w in ws if w in kept)
        whole = sum(groups.values(), Counter())

        def share(counts):
            total = sum(counts.values()) + len(kept)
            return {w: 1 + UNIT * (counts[w] + 1) // total for w in kept}

        shares, all_ = {s: share(c) for s, c in groups.items()}, share(whole)
        for s, p in shares.items():
            pairs = [(-sum((p[w] - q[w]) ** 2 // q[w] for w in kept), o) for o, q in shares.items() if o != s]
            terms = [(-((p[w] - all_[w]) ** 2 // all_[w]), w) for w in kept if groups[s][w] and p[w] > all_[w]]
            for part, items in (("pair", pairs), ("term", sorted(terms, key=lambda x: (x[0], x[1].encode()))[:top])):
                items.sort(key=lambda x: (x[0], x[1].encode()))
                out |= {(lang, s, part, item, -v, k + 1) for k, (v, item) in enumerate(items)}
    return out


def _rows(n, seed):
    draw = random.Random(seed)
    words = ["the", "The", "a", "é", "É", "中文", "x1y", "don't", "ab_cd", "zz\x7fzz", "Ünder", *(f"w{chr(97 + i)}" for i in range(20))]
    made = [(draw.choice(["en", "de", None, "", "xx"]), draw.choice(["s1", "s2", "s3", "", None, "Ω", "s10"]),
             draw.choice([None, "", " ".join(draw.choices(words, k=draw.randrange(12)))])) for _ in range(n)]
    return made + [("one", "alone", "the the the"), ("two", "u", "a"), ("two", "v", None), *[("xx", "s1", "again again")] * 4]


@pytest.mark.parametrize("groups, terms, held", [(64, 4096, 300_000), (2, 3, 5), (1, 1, 1)])
def test_equals_plain_sums(spark, monkeypatch, groups, terms, held):
    monkeypatch.setattr(divergence, "HELD", held)
    rows = _rows(150, 2)
    docs = spark.createDataFrame([(*r, "", "", "", "", None) for r in rows], DOCS).repartition(4)
    found = divergence.divergences(docs, least_docs=3, top_terms=5, groups_in_block=groups, terms_in_block=terms).collect()
    assert len(found) == len(set(map(tuple, found)))
    assert set(map(tuple, found)) == _naive(rows, 3, 5)


def test_long_texts_in_slices(monkeypatch):
    monkeypatch.setattr(divergence, "SLICE", 7)
    text = "ab cdefghijklmnop é" + "中" * 30 + " x" * 50
    whole = [w for words in divergence._words(text.encode()) for w in words]
    assert [w.decode() for w in whole] == TERM.findall(text)


def test_large_counts_stay_exact(spark):
    n, total, size = 9_999_999_999_999, 20_000_000_000_007, 123_457
    row = spark.createDataFrame([(n, total, size)], "n long, own long, size long").select(divergence._share("n", "own", "size")).first()
    assert row[0] == 1 + UNIT * (n + 1) // (total + size)


def test_empty_table(spark):
    assert divergence.divergences(spark.createDataFrame([], DOCS)).collect() == []
