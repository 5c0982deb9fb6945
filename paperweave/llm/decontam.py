"""Benchmark decontamination by spaced-seed hashing.

Fixed masks pick some words of a window and skip the others, so a window still gives the same
hash when skipped words were changed. Hashes of the benchmark meet those of every document window; around a
hit document and item are compared word by word on the same diagonal, and an overlap counts
when enough words agree.
"""

from __future__ import annotations

import math
import re
from fractions import Fraction

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, ship, sliced, stored

# Fixed values. Every overlap of 13 agreeing words and a share of 0.8 holds one of at most 31 words, and
# each placement of changed words in these is passed by a mask; the last two pass those the first four don't.
MASKS = ("11101001011", "11010011101", "11001110011", "10110101101", "1011111", "1111101")
# Fixed values. With these, items of 8 to 16 words are found wherever their changed words stand, while
# 13 words or a share of 0.8 agree, whichever is less.
SHORT_MASKS = ("110111", "1110011", "1010111")
WHOLE, SHORT = 8, 17  # words; below the first all words must agree, below the second the short masks look too
CHUNK = 1 << 16  # words hashed at once
# Thai, Lao, Burmese, Khmer, kana, Chinese: written without blanks, so each sign counts as a word.
UNSPACED = "\u0e01-\u0e4e\u0e81-\u0ece\u1000-\u1049\u1780-\u17d3\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003134f"
WORD = re.compile(rf"[^\W{UNSPACED}]+|[{UNSPACED}]")
FACTORS = np.random.default_rng(5).integers(1, 2**62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
HITS = 1 << 18  # seed hits looked at together


class Hashes(dict):
    def __missing__(self, word: str) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, text: bytes | None) -> np.ndarray:
        if len(self) > 200_000:
            self.clear()
        words = WORD.findall(text.decode("utf-8", "replace").lower()) if text else []
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _seeds(words: np.ndarray, masks: list[str]):
    """``(number of the mask, first word, seeds)`` of all masks over all windows, piece by piece."""
    span = max(map(len, masks))
    for start in range(0, len(words), CHUNK):
        part = words[start : start + CHUNK + span - 1]
        products = [part * FACTORS[k] for k in range(span)]
        for number, mask in enumerate(masks):
            n = min(CHUNK, len(part) - len(mask) + 1)
            if n <= 0:
                continue
            total = np.full(n, (number + 1) * int(FACTORS[-1]) % 2**64, np.uint64)
            for k, bit in enumerate(mask):
                if bit == "1":
                    total += products[k][k : k + n]
            yield number, start, total


class Index:
    """Seeds of one block of benchmark items."""

    def __init__(self, items: list[tuple[int, bytes]], least: int):
        cache = Hashes()
        listed = [(i, w) for i, w in ((i, cache.of(t)) for i, t in items) if len(w) >= least]
        self.ids = [i for i, _ in listed]
        self.words = [w for _, w in listed]
        lengths = sorted({len(w) for w in self.words})
        short = SHORT_MASKS if any(WHOLE <= n < SHORT for n in lengths) else ()
        self.masks = [*MASKS, *short, *("1" * n for n in lengths if n < WHOLE)]
        keys, item, place = [], [], []
        for k, words in enumerate(self.words):
            for number, start, found in _seeds(words, self.masks):
                if len(words) >= WHOLE and (number < len(MASKS) or number < len(MASKS) + len(short) and len(words) < SHORT) or len(words) == len(self.masks[number]) < WHOLE:
                    keys.append(found)
                    item.append(np.full(len(found), k))
                    place.append(start + np.arange(len(found)))
        join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        keys = join(keys, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.item, self.place = keys[order], join(item, np.int64)[order], join(place, np.int64)[order]
        self.shift = np.uint64(64 - max(16, int(len(keys) * 8).bit_length()))
        self.bits = np.zeros(1 << int(64 - int(self.shift)), bool)
        self.bits[self.keys >> self.shift] = True

    def batch_diagonals(self, docs: list[np.ndarray]) -> dict[int, list[list[int]]]:
        """Distinct (item, document place - item place) of all seed hits, by the number of the document.

        All documents are gone through as one array, less windows across an end; hits a block at a time, as words that repeat hit often.
        """
        if not len(self.keys) or not docs:
            return {}
        ends = np.cumsum([len(words) for words in docs])
        words = np.concatenate(docs)
        hits = []
        for number, start, seeds in _seeds(words, self.masks):
            at = np.flatnonzero(self.bits[seeds >> self.shift])
            low = np.searchsorted(self.keys, seeds[at])
            known = self.keys[np.minimum(low, len(self.keys) - 1)] == seeds[at]
            at, low = at[known], low[known]
            doc = np.searchsorted(ends, start + at, "right")
            inside = start + at + len(self.masks[number]) <= ends[doc]
            at, low, doc = at[inside], low[inside], doc[inside]
            if not len(at):
                continue
            n = np.searchsorted(self.keys, seeds[at], "right") - low
            place = start + at - ends[doc] + [len(docs[d]) for d in doc.tolist()]
            blocks = np.flatnonzero(np.diff(np.cumsum(n) // HITS, prepend=0)) if n.sum() > HITS else []
            for own, of, first, many in zip(*(np.split(x, blocks) for x in (place, doc, low, n))):
                entry = np.repeat(first + many - np.cumsum(many), many) + np.arange(many.sum())
                found = np.stack([np.repeat(of, many), self.item[entry], np.repeat(own, many) - self.place[entry]], axis=1)
                hits.append(found if len(blocks) == 0 else np.unique(found, axis=0))
        by_doc: dict[int, list[list[int]]] = {}
        for d, k, shift in np.unique(np.concatenate(hits), axis=0).tolist() if hits else []:
            by_doc.setdefault(d, []).append([k, shift])
        return by_doc

    def diagonals(self, words: np.ndarray) -> list[list[int]]:
        return self.batch_diagonals([words]).get(0, [])

    def overlaps(self, words: np.ndarray, overlap: int, share: float) -> list[tuple[int, int, int, int]]:
        return self.batch_overlaps([words], overlap, share).get(0, [])

    def batch_overlaps(self, docs: list[np.ndarray], overlap: int, share: float) -> dict[int, list[tuple[int, int, int, int]]]:
        """By the number of the document ``(item id, first word, words, agreeing words)``: the best overlap with each item that has one."""
        return {
            d: found
            for d, diagonals in self.batch_diagonals(docs).items()
            if (found := self._verified(docs[d], diagonals, overlap, share))
        }

    def _verified(self, words: np.ndarray, diagonals: list[list[int]], overlap: int, share: float):
        """The best overlaps of one document on its diagonals.

        On each diagonal every segment counts of which at least ``share`` agrees; the best has most agreeing words.
        """
        best: dict[int, tuple[int, int, int]] = {}
        exact = Fraction(share).limit_denominator(1_000_000)
        reward, penalty = exact.denominator - exact.numerator, exact.numerator
        for k, shift in diagonals:
            item = self.words[k]
            start, end = max(0, shift), min(len(words), shift + len(item))
            same = words[start:end] == item[start - shift : end - shift]
            least = max(_needed(len(item), overlap, exact), best.get(k, (0, 0, 0))[2] + 1)
            if np.count_nonzero(same) < least:
                continue
            first, last, agreeing = _most_agreeing(same, reward, penalty)
            if agreeing >= least:
                best[k] = start + first, last - first, agreeing
        return [(self.ids[k], *v) for k, v in sorted(best.items())]


def _needed(words: int, overlap: int, share: Fraction) -> int:
    """Agreeing words that an overlap with an item of so many words must have."""
    return min(overlap, words if words < WHOLE else math.ceil(share * words))


def _parts(hashed):
    """Documents in lists of about ``CHUNK`` words; a longer one ends its list."""
    part, held = [], 0
    for identity, words in hashed:
        part.append((identity, words))
        held += len(words)
        if held >= CHUNK or len(part) >= CHUNK:
            yield part
            part, held = [], 0
    if part:
        yield part


def _most_agreeing(same: np.ndarray, reward: int, penalty: int) -> tuple[int, int, int]:
    """``(first, last, agreeing)`` of the segment with most agreeing words among those of non-negative sum.

    A segment ends best with the earliest start whose prefix sum is not above its own; of equal ones the
    shortest without changed words at its ends, then the first, is taken.
    """
    sums = np.concatenate([[0], np.cumsum(np.where(same, reward, -penalty))])
    agreed = np.concatenate([[0], np.cumsum(same)])
    starts = np.searchsorted(-np.minimum.accumulate(sums), -sums)
    gained = agreed - agreed[starts]
    most = int(gained.max())
    if not most:
        return 0, 0, 0
    ends = np.flatnonzero(gained == most)
    places = np.flatnonzero(same)
    first, last = places[agreed[starts[ends]]], places[agreed[ends] - 1] + 1
    k = int((last - first).argmin())
    return int(first[k]), int(last[k]), most


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    overlap: int = 13,
    share: float = 0.8,
    least: int = 8,
    block_words: int = 250_000,
) -> DataFrame:
    """``(doc_id, item_id, start, words, agreeing)`` of all verified overlaps; places count words.

    An overlap has at least ``overlap`` agreeing words, or a ``share`` of the item's where that is less (all of an item of
    fewer than 8 words), and at least ``share`` of its words agree. In scripts without blanks each sign counts as a word. Items of fewer
    than ``least`` words are not looked for. The benchmark goes over the documents in blocks of about ``block_words`` words (an item is never
    cut), so what a task holds is bounded whatever the benchmark's size. Null
    and empty texts overlap with nothing; an empty benchmark gives no row.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    schema = "id long, item long, start int, words int, agreeing int"
    found = docs.sparkSession.createDataFrame([], schema)
    for shared in _blocks(benchmark, item_col, item_text_col, least, block_words):

        def scan(rows, shared=shared):
            cache, index = Hashes(), shared.value
            for part in _parts((identity, cache.of(text)) for identity, text in rows):
                for d, matches in index.batch_overlaps([words for _, words in part], overlap, share).items():
                    for match in matches:
                        yield part[d][0], *match

        found = found.union(map_rows(texts, scan, schema))
    return found.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "start", "words", "agreeing")


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, least: int, block_words: int):
    """The benchmark's index, block by block, as broadcasts of bounded size."""
    items = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(text_col).alias("t")).dropna()
    words = F.size(F.split("t", r"\s+")) + F.regexp_count("t", F.lit(f"[{UNSPACED}]"))
    total = items.agg(F.sum(words)).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block).orderBy("i", "t")
        listed = [(i, t.encode()) for i, t in part.collect()]  # about block_words words
        yield benchmark.sparkSession.sparkContext.broadcast(Index(listed, least))


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    overlap: int = 13,
    share: float = 0.8,
    least: int = 8,
    block_words: int = 250_000,
) -> DataFrame:
    """The rows of ``docs``, with all columns, that overlap with no item (see ``overlaps``); nothing is moved.

    Rows without a text stay; repeated rows are judged alike; columns may have any name besides ``text_col``.
    """
    ship(docs.sparkSession)
    for shared in _blocks(benchmark, item_col, item_text_col, least, block_words):

        def passed(batches, shared=shared):
            import pyarrow as pa

            cache, index = Hashes(), shared.value
            for batch in sliced(batches):
                texts = batch.column(batch.schema.get_field_index(text_col)).cast(pa.binary()).to_pylist()
                passing = []
                for part in _parts((None, cache.of(t)) for t in texts):
                    found = index.batch_overlaps([words for _, words in part], overlap, share)
                    passing += [d not in found for d in range(len(part))]
                yield batch.filter(pa.array(passing, pa.bool_()))

        docs = docs.mapInArrow(passed, docs.schema)
    return docs


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``(doc_id, contaminated, item_ids, agreeing)`` for every row of ``docs``.

    Rows with the same id are judged together; rows without an id as one document.
    """
    found = overlaps(docs, benchmark, id_col=id_col, **options)
    item = options.get("item_col", "item_id")
    per_doc = found.groupBy(F.col(id_col).alias("of")).agg(
        F.sort_array(F.collect_set(item)).alias("item_ids"), F.max("agreeing").alias("agreeing")
    )
    per_doc = stored(per_doc, "overlaps")
    ids = docs.select(F.col(id_col).cast("long").alias("id"))
    return ids.join(per_doc, F.col("id").eqNullSafe(F.col("of")), "left").select(
        F.col("id").alias(id_col),
        F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"),
        F.coalesce("agreeing", F.lit(0)).alias("agreeing"),
    )
