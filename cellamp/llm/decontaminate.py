"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of words.

A test item has leaked into a document if the best local alignment of its words with the document scores at least ``min_score`` of
a perfect one (a match scores 1, a mismatch or a gap -1). With the default of 0.6, copies in which up to a fifth of the words were
changed or dropped, or two fifths inserted, are found.

Seeds: an alignment at the threshold can break only a bounded number of an item's n-grams, so at least ``s`` of its ``t`` distinct
n-grams survive; any ``t - s + 1`` of them contain a survivor. The rarest ones, by document frequency over the whole corpus,
are taken. Rarity is relative to the item: an item whose every n-gram is frequent still has its seeds, and nothing is lost.

The items are joined to the documents in blocks of a bounded number of words, each block by two passes over the documents: one that
counts, one that seeks and aligns. Documents never move; a document that holds many items or many copies is work for its own task
only.

Words are runs of letters and digits of the lower-cased text. Null and empty texts hold no item; null, empty and wordless items are in
no document. Items with equal texts are reported each. Repeated documents are reported each.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

MIN_SCORE = 0.6
# Words of items in a block; the words of a block are what a task holds of the benchmark.
BLOCK_WORDS = 200_000
# An alignment looks at stretches of at most about this many words at a time; they overlap by more than an item can span.
STRETCH = 4_096
_BLANKS = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))
_ODD = re.compile(r"[^\w]+")


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words of letters and digits."""
    if not text:
        return []
    text = text.lower()
    if not text.isascii():
        text = _ODD.sub(" ", text)
    return text.encode("utf-8", "replace").translate(_BLANKS).split()


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best local score of two sequences of word numbers, and the end of the alignment in the passage."""
    gaps = np.arange(len(passage) + 1)
    row, best, end = np.zeros(len(passage) + 1, np.int64), 0, 0
    for word in item.tolist():
        step = np.zeros_like(row)
        np.maximum(row[:-1] + np.where(passage == word, 1, -1), row[1:] - 1, out=step[1:])
        np.maximum(step, 0, out=step)
        # A gap in the item costs one per word of the passage: a running maximum of score plus position.
        row = np.maximum.accumulate(step + gaps) - gaps
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at
    return best, end


def gram_length(words: list[bytes], budget: int) -> tuple[int, int]:
    """Longest n-gram (3 at most) of which one is sure to survive ``budget`` points of damage, and how many do."""
    for n in (3, 2, 1):
        distinct = len({tuple(words[k : k + n]) for k in range(len(words) - n + 1)})
        # An inserted word breaks n - 1 grams for one point, a changed or dropped one n grams for two points, and one cut from
        # an end a gram for one point.
        sure = distinct - max(budget * (n - 1), budget * n // 2, budget)
        if sure >= 1 or n == 1:
            return n, max(1, sure)
    raise AssertionError


class Items:
    """A block of test items with their words as numbers."""

    def __init__(self, ids: list, words: list[list[bytes]], min_score: float):
        self.ids, self.min_score = ids, min_score
        self.number = {w: k for k, w in enumerate(dict.fromkeys(w for item in words for w in item), 1)}
        self.words = [np.array([self.number[w] for w in item], np.int64) for item in words]
        base = len(self.number) + 1
        self.lengths, self.sure, self.grams = [], [], []
        for item, numbers in zip(words, self.words, strict=True):
            n, sure = gram_length(item, self.budget(len(item)))
            self.lengths.append(n)
            self.sure.append(sure)
            self.grams.append(self.codes(numbers, n, base))
        self.base = base
        self.known = np.unique(np.concatenate([g[0] for g in self.grams]))

    def budget(self, n_words: int) -> int:
        return int((1 - self.min_score) * n_words + 1e-9)

    @staticmethod
    def codes(numbers: np.ndarray, n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the n-grams of known words and their positions."""
        count = max(0, len(numbers) - n + 1)
        code, whole = np.full(count, n, np.int64), np.ones(count, bool)
        for k in range(n):
            word = numbers[k : k + count]
            code = code * base + word
            whole &= word > 0
        at = np.nonzero(whole)[0]
        return code[at], at

    def read(self, text: str | None) -> np.ndarray:
        listed = words_of(text)
        return np.fromiter(map(self.number.get, listed, [0] * len(listed)), np.int64, len(listed))

    def hits(self, numbers: np.ndarray, among: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions of a document's n-grams in the sorted codes ``among``, and in the document."""
        for n in sorted(set(self.lengths)):
            codes, at = self.codes(numbers, n, self.base)
            spot = np.minimum(np.searchsorted(among, codes), len(among) - 1)
            found = among[spot] == codes
            yield spot[found], at[found]

    def choose_seeds(self, frequency: np.ndarray) -> None:
        """Keep the rarest n-grams of every item; equal frequencies by code."""
        holders = defaultdict(list)
        for item, (codes, at) in enumerate(self.grams):
            distinct, first = np.unique(codes, return_index=True)
            rare = np.lexsort((distinct, frequency[np.searchsorted(self.known, distinct)]))
            for k in rare[: len(distinct) - self.sure[item] + 1].tolist():
                # Every place of the n-gram in the item puts the item elsewhere in the document.
                for place in at[codes == distinct[k]].tolist():
                    holders[int(distinct[k])].append((item, place))
        self.seeds = np.array(sorted(holders), np.int64)
        self.holders = [holders[code] for code in self.seeds.tolist()]

    def leaks(self, text: str | None) -> list[tuple[int, float, int, int]]:
        """(item, score, first word, end word) for every item the text holds."""
        numbers = self.read(text)
        reach: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for seeds, places in self.hits(numbers, self.seeds):
            for seed, place in zip(seeds.tolist(), places.tolist(), strict=True):
                for item, offset in self.holders[seed]:
                    size = len(self.words[item])
                    slack = self.budget(size) + 1
                    reach[item].append((max(0, place - offset - slack), place - offset + size + slack))
        found = []
        for item, spans in sorted(reach.items()):
            score, start, end = max(
                (self._align(item, numbers, lo, hi) for lo, hi in joined(spans, 2 * len(self.words[item]))),
                key=lambda x: (x[0], -x[1]),
            )
            if score >= self.min_score - 1e-9:
                found.append((item, score, start, end))
        return found

    def _align(self, item: int, numbers: np.ndarray, lo: int, hi: int) -> tuple[float, int, int]:
        words, passage = self.words[item], numbers[lo:hi]
        score, end = align(words, passage)
        if score < self.min_score * len(words) - 1e-9:
            return score / len(words), lo, lo + end
        # The same alignment read backwards ends where it starts.
        _, back = align(words[::-1], passage[:end][::-1])
        return score / len(words), lo + end - back, lo + end


def joined(spans: list[tuple[int, int]], overlap: int) -> Iterator[tuple[int, int]]:
    """Overlapping spans as one; a long one in stretches that overlap by ``overlap`` words."""
    merged: list[list[int]] = []
    for lo, hi in sorted(spans):
        if merged and lo <= merged[-1][1]:
            merged[-1][1] = max(hi, merged[-1][1])
        else:
            merged.append([lo, hi])
    for lo, hi in merged:
        step = max(STRETCH, 2 * overlap)
        for at in range(lo, max(lo + 1, hi - overlap), step):
            yield at, min(hi, at + step + overlap)


def blocks(items: DataFrame, item_id: str, text: str, min_score: float) -> Iterator[Items]:
    """The items in blocks of bounded size, one at a time on the driver."""
    ids, words, held = [], [], 0
    for row in items.select(F.col(item_id), F.col(text)).toLocalIterator():
        listed = words_of(row[1])
        if not listed:
            continue
        ids.append(row[0])
        words.append(listed)
        held += len(listed)
        if held >= BLOCK_WORDS:
            yield Items(ids, words, min_score)
            ids, words, held = [], [], 0
    if ids:
        yield Items(ids, words, min_score)


def with_seeds(docs: DataFrame, block: Items, text: str) -> Items:
    """Count the document frequency of every n-gram of the block and choose the seeds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(len(block.known), np.int64)
        for batch in batches:
            for body in batch.column(0):
                for spots, _ in block.hits(block.read(body.as_py()), block.known):
                    totals[np.unique(spots)] += 1
        at = np.nonzero(totals)[0]
        yield pa.record_batch([pa.array(at.astype(np.int64)), pa.array(totals[at])], ["gram", "n"])

    counted = docs.select(text).mapInArrow(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    frequency = np.zeros(len(block.known), np.int64)
    for row in counted.collect():  # at most the n-grams of the block
        frequency[row.gram] = row.n
    block.choose_seeds(frequency)
    return block


def find_leaks(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", min_score: float = MIN_SCORE,
) -> DataFrame:
    """Leaks as rows (doc_id, item_id, score, first_word, end_word): the best alignment of each item in each document."""
    id_type, item_type = docs.schema[doc_id].dataType, items.schema[item_id].dataType.simpleString()
    schema = f"doc_id {id_type.simpleString()}, item_id {item_type}, score double, first_word bigint, end_word bigint"
    found = docs.sparkSession.createDataFrame([], schema)
    arrow_type = to_arrow_type(items.schema[item_id].dataType)
    for block in blocks(items, item_id, item_text, min_score):
        finder = with_seeds(docs, block, text)

        def seek(batches: Iterator[pa.RecordBatch], finder=finder) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, leaks = [], []
                for row, body in enumerate(batch.column(1)):
                    for leak in finder.leaks(body.as_py()):
                        rows.append(row)
                        leaks.append(leak)
                if rows:
                    item, score, first, end = zip(*leaks, strict=True)
                    yield pa.record_batch(
                        [batch.column(0).take(pa.array(rows)), pa.array([finder.ids[k] for k in item], arrow_type),
                         pa.array(score, pa.float64()), pa.array(first, pa.int64()), pa.array(end, pa.int64())],
                        ["doc_id", "item_id", "score", "first_word", "end_word"],
                    )

        found = found.union(docs.select(doc_id, text).mapInArrow(seek, schema))
    return found


def holds_leak(docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text", min_score: float = MIN_SCORE) -> Column:
    """Whether a row's text holds any of the items; needs no id, no join and no shuffle."""
    flag = F.lit(False)
    keyed = items.select(F.col(item_text).alias("text"), F.lit(0).alias("item_id"))
    for block in blocks(keyed, "item_id", "text", min_score):
        flag = flag | _leaky(with_seeds(docs, block, text))(F.col(text))
    return flag


def _leaky(finder: Items):
    @F.pandas_udf("boolean")
    def leaky(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([bool(finder.leaks(body)) for body in batch], dtype=bool)

    return leaky
