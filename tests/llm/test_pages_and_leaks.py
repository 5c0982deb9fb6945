"""Archives, benchmark passages and the pipeline."""

import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paperweave.llm import decontam, warc
from paperweave.session import scratch_path

PAGES = "page_id long, url string, html binary, record_type string"


@pytest.mark.parametrize("chunk", [37, 1 << 16])
def test_archive_round_trip(spark, chunk):
    draw = random.Random(6)
    tricky = "é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nx" * 9
    texts = [None, "", "short", "short", "y" * 100, "y" * 100, "z" * 99, "z" * 99, tricky, tricky, "\r\n\r\n", "WARC/1.1\r\n" * 20]
    texts += ["".join(draw.choices("<p>ab \r\nWARC/1.\0é", k=draw.randrange(3000))) for _ in range(30)]
    rows = [(i, f"http://a/\r\nX-Key: 9 {i}", None if t is None else t.encode(), "clash") for i, t in enumerate(texts)]
    rows += [(None, None, ("y" * 100).encode(), ""), (4, None, ("y" * 100).encode(), ""), (None, None, b"q" * 200, "")]
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    folder = scratch_path(spark, "warc")
    payload = F.coalesce("html", F.lit("").cast("binary"))
    warc.write_archive(warc.revisits(pages, "page_id", payload), folder, chunk=chunk)
    chunks = warc.read_chunks(spark, folder)
    assert chunks.filter(F.octet_length("body") > chunk).count() == 0
    want = []
    for i, _, html, _ in rows:
        data = html or b""
        ids = [r[0] for r in rows if r[0] is not None and (r[2] or b"") == data]
        first = min(ids) if len(data) >= 100 and ids and min(ids) != i else None
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "response" if first is None else "revisit", first))
    assert sorted(map(tuple, warc.payloads(chunks).collect()), key=str) == sorted(want, key=str)


def test_archive_of_nothing_and_broken_archive(spark):
    empty, folder = spark.createDataFrame([], PAGES), scratch_path(spark, "warc")
    warc.write_archive(warc.revisits(empty, "page_id", F.col("html")), folder)
    assert warc.payloads(warc.read_chunks(spark, folder)).collect() == []
    folder = scratch_path(spark, "warc")
    lines = warc._header({"WARC-Type": "response", "WARC-Record-ID": "<urn:record:1:1>", "Content-Length": 500}).decode() + "x"
    spark.createDataFrame([(lines,)], "value string").write.text(folder)
    with pytest.raises(Exception, match="another length"):
        warc.payloads(warc.read_chunks(spark, folder)).collect()


DOCS = "doc_id long, text string, lang string, item_ids string"


def _words(draw, n):
    return ["".join(draw.choices("abcdefgh", k=5)) for _ in range(n)]


def test_passages_are_found_with_changed_words(spark):
    draw = random.Random(11)
    items = [(k, " ".join(_words(draw, n))) for k, n in enumerate([30, 45, 60, 11, 9, 5])] + [(90, None), (None, "x " * 20), (91, "")]
    rows, want = [], {}

    def add(words, leaks):
        rows.append((len(rows), " ".join(words), "clash", ""))
        want[len(rows) - 1] = leaks

    for k, text in items[:6]:
        words = text.split()
        noise = _words(draw, 200)
        add([*noise, *words, *noise[:50]], [k] if len(words) >= 8 else [])
        add([w.upper() + "," for w in words], [k] if len(words) >= 8 else [])
        if len(words) >= 30:
            changed = [w if i % 7 else "other" for i, w in enumerate(words)]
            add([*noise, *changed], [k])
            add([*noise, *words[5:19]], [k])
            add([*noise, *words[5:15], *noise], [])
            add([*noise, *(w if i % 2 else "other" for i, w in enumerate(words))], [])
    add([*items[0][1].split(), *items[1][1].split()], [0, 1])
    add([], [])
    rows.append((None, None, "", ""))
    want[None] = []
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block_words in (250_000, 60):
        found = decontam.contamination(docs, bench, block_words=block_words).collect()
        assert {r.doc_id: r.item_ids for r in found} == want
        assert all(r.contaminated == bool(r.item_ids) for r in found)
        kept = decontam.clean(docs, bench, block_words=block_words)
        assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, x in want.items() if not x}
    places = decontam.overlaps(docs, bench).filter("doc_id = 0").collect()
    assert [(r.item_id, r.start, r.words, r.agreeing) for r in places] == [(0, 200, 30, 30)]


def _scan(same, share, least):
    """Most agreeing words of any segment that meets the rule, by trying all; 0 if none does."""
    agreed = [0]
    for x in same:
        agreed.append(agreed[-1] + x)
    found = [agreed[j] - agreed[i] for i in range(len(same)) for j in range(i + 1, len(same) + 1) if 5 * (agreed[j] - agreed[i]) >= share * (j - i)]
    return max((n for n in found if n >= least), default=0)


def test_every_overlap_on_a_hit_diagonal_counts():
    draw = random.Random(13)
    words = _words(draw, 60)
    item = " ".join(words).encode()
    index, cache = decontam.Index([(7, item)], 8), decontam.Hashes()
    changes = [{12, 13, 14, 15}] + [set(range(at, n, gap)) for n in (28, 40, 60) for gap in range(2, 9) for at in range(gap)]
    changes += [set(draw.sample(range(60), draw.randint(4, 40))) for _ in range(300)]
    met = 0
    for n, changed in [(28, changes[0]), *((60, c) for c in changes)]:
        same = [k not in changed for k in range(n)]
        doc = cache.of(" ".join(w if s else "other" for w, s in zip(words, same)).encode())
        want = _scan(same + [False] * (60 - n), 4, 13)
        found = index.overlaps(doc, 13, 0.8)
        if index.diagonals(doc):
            assert [f[3] for f in found] == [want] * bool(want), sorted(changed)
            met += bool(want)
        for _, start, size, agreeing in found:
            assert agreeing == sum(same[start : start + size]) and 5 * agreeing >= 4 * size and same[start] and same[start + size - 1]
    assert met > 100
    assert [f[1:] for f in index.overlaps(cache.of(" ".join([*words[:12], *"wxyz", *words[16:28]]).encode()), 13, 0.8)] == [(0, 28, 24)]
    assert [f[1:] for f in index.overlaps(cache.of(item), 13, 1.0)] == [(0, 60, 60)]


@pytest.mark.parametrize("words, changed", [(14, 1), (15, 2), (16, 3), (20, 4), (25, 5), (30, 6)])
def test_no_placement_of_changed_words_misses_all_masks(words, changed):
    places = np.fromiter(itertools.chain.from_iterable(itertools.combinations(range(words), changed)), np.int64).reshape(-1, changed)
    codes = (np.int64(1) << places).sum(1)
    hit = np.zeros(len(codes), bool)
    for mask in decontam.MASKS:
        bits = sum(1 << k for k, bit in enumerate(mask) if bit == "1")
        for at in range(words - len(mask) + 1):
            hit |= codes & (bits << at) == 0
    assert hit.all()


@pytest.mark.parametrize("words, changed", [(8, 1), (9, 1), (10, 2), (11, 2), (12, 2), (13, 2), (14, 2), (15, 3), (16, 3)])
def test_short_items_are_found_wherever_words_are_changed(words, changed):
    draw, cache = random.Random(words), decontam.Hashes()
    item = [f"w{k}" for k in range(words)]
    index = decontam.Index([(4, " ".join(item).encode())], 1)
    docs = []
    for places in itertools.combinations(range(words), changed):
        docs.append(["x", *("other" if k in places else w for k, w in enumerate(item)), *_words(draw, 20)])
    hashed = [cache.of(" ".join(d).encode()) for d in docs]
    found = index.batch_overlaps(hashed, 13, 0.8)
    assert [[(f[0], f[3]) for f in found.get(d, [])] for d in range(len(docs))] == [[(4, words - changed)]] * len(docs)
    more = [cache.of(" ".join("other" if k <= changed else w for k, w in enumerate(item)).encode())]
    assert index.batch_overlaps(more, 13, 0.8) == {}


def test_items_of_few_words_and_unspaced_scripts(spark):
    texts = ["say ab cd ef now", "say ab cd xx now", "我们今天去公园看花然后回家吃饭", "我们明天去公园看花然后回家吃饭", "公园 ab", "ab cd", None, ""]
    docs = spark.createDataFrame([(k, t, "", "") for k, t in enumerate(texts)], DOCS)
    bench = spark.createDataFrame([(1, "ab cd ef"), (2, "们今天去公园看花然后回家"), (3, ""), (4, "cd, now")], "item_id long, text string")
    found = {r.doc_id: r.item_ids for r in decontam.contamination(docs, bench, least=1).collect()}
    assert found == {0: [1], 1: [], 2: [2], 3: [2], 4: [], 5: [], 6: [], 7: []}
    assert {r.doc_id for r in decontam.clean(docs, bench, least=1).collect()} == {1, 4, 5, 6, 7}


def test_seeds_of_pieces_are_those_of_the_whole(monkeypatch):
    draw = random.Random(14)
    item = _words(draw, 40)
    doc = decontam.Hashes().of(" ".join([*_words(draw, 90), *item, *_words(draw, 70)]).encode())
    index = decontam.Index([(3, " ".join(item).encode())], 8)
    monkeypatch.setattr(decontam, "CHUNK", 7)
    pieces = decontam.Index([(3, " ".join(item).encode())], 8)
    assert (pieces.keys == index.keys).all() and pieces.diagonals(doc) == index.diagonals(doc) == [[0, 90]]


def test_no_benchmark_and_no_documents(spark):
    docs, bench = spark.createDataFrame([(1, "a b", "", "")], DOCS), spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in decontam.contamination(docs, bench).collect()] == [(1, False, [], 0)]
    assert decontam.contamination(docs.limit(0), bench).collect() == []


def test_repeated_words_do_not_multiply(spark):
    docs = spark.createDataFrame([(1, "a " * 3000, "", ""), (2, "b " * 40, "", "")], DOCS)
    bench = spark.createDataFrame([(5, "a " * 800)], "item_id long, text string")
    assert {r.doc_id: r.item_ids for r in decontam.contamination(docs, bench).collect()} == {1: [5], 2: []}


def test_pipeline_stages(spark, tmp_path):
    draw = random.Random(12)
    item = _words(draw, 40)
    texts = [" ".join(_words(draw, draw.randint(20, 90))) for _ in range(60)]
    texts += [texts[0].upper(), texts[1], " ".join(texts[2].split()[:-1] + ["changed"]) if len(texts[2].split()) > 60 else texts[2]]
    texts += [" ".join([*_words(draw, 30), *item]), *(" ".join(w + "&&&" for w in _words(draw, 30)) for _ in range(40)), None, ""]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int("&&&" not in (t or ""))) for i, t in enumerate(texts)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, left = docs.columns, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)), "stage")
        assert docs.columns == columns
        left.append({r.doc_id for r in docs.collect()})
    quality, exact, near, clean = left
    assert not any("&&&" in (texts[i] or "") for i in quality) and len(quality) >= 64
    lower = {}
    for i in quality:
        lower.setdefault((texts[i] or "").lower(), []).append(i)
    assert exact == {max(ids) for ids in lower.values()}
    assert near <= exact and clean == {i for i in near if " ".join(item) not in (texts[i] or "")}
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in found} == clean
