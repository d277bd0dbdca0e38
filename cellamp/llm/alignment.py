"""Alignment of two tokenizers over a corpus: which tokens of one cover the same bytes as which tokens of the other, and how often.

A text is encoded by A (byte-level BPE, of a space and the text) and by B (sentencepiece, which puts the space there itself).
Byte offsets at which tokens of both end cut the tokens into groups. An A token and a B token are linked where their byte ranges
overlap; two segmentations of one line have exactly one link per stretch between neighbouring ends of either.

Counts of the linked id pairs: (1) the distinct pairs of the corpus are dealt into shards by hash, and each shard gets a minimal perfect
hash function; (2) every task counts its links in dense vectors indexed by that hash, one per shard, which are summed as a tree,
FAN vectors at a time; (3) a second pass aligns the documents again and looks every link's pair up, comparing the stored key.
A B id's highest count is a vector as long as B's vocabulary.

Tokens are kept in a stored table, so texts are encoded once. The hash functions, keys and counts of up to ``block`` pairs are sent to all tasks
(about 20 bytes a pair); a corpus with more distinct pairs is passed over once per block, and the blocks' sums are added per text.

Texts that are null or empty, or that either tokenizer does not give back byte by byte, have no tokens: zeros, and '' for the groups.
Repeated rows each get a row, a missing doc_id stays missing, an empty table has no rows, extra columns are ignored. Texts of any
length are aligned whole.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellamp.llm.perfect_hash import Lookup, build, shard_of
from cellamp.session import store

# Pairs per perfect hash function, about.
SHARD = 16_384
# Pairs whose functions and counts are sent to all tasks at once (some 40 MB).
BLOCK = 2_000_000
FAN = 16
# A tokens a task aligns at a time, and bytes of text it encodes at a time, unless one text has more.
SLICE = 100_000
PART = 1_000_000
# Distinct pairs a task holds before it hands them on.
HELD = 1_000_000
_A_BITS = 32

# Fixed value: how byte-level BPE cuts a text before its merges.
BYTE_LEVEL_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteLevel:
    """Ids of a byte-level BPE vocabulary; strings of special tokens are plain text."""

    def __init__(self, vocabulary: str):
        import tiktoken

        content = json.loads(vocabulary)
        letters, model = byte_letters(), content["model"]
        special = {t["content"] for t in content.get("added_tokens", [])}
        spelled = {bytes(letters[c] for c in v): k for v, k in model["vocab"].items() if v not in special}
        size = max(model["vocab"].values()) + 1
        self.bytes = [b""] * size
        for raw, k in spelled.items():
            self.bytes[k] = raw
        self.vocabulary = vocabulary
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        ranked = all(a < b for a, b in zip(merged, merged[1:], strict=False)) and all(bytes([b]) in spelled for b in range(256))
        # Where ids rise with the rank of their merges, as they do in vocabularies of this kind, ids serve as ranks.
        self.fast = tiktoken.Encoding("ranked", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=spelled, special_tokens={}) if ranked else None
        # The fast encoder's pattern cannot look ahead over very long runs.
        self.long_run = re.compile(r"\s{2000}")

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(self.vocabulary)
        library.encode_special_tokens = True
        return library

    def encode(self, text: str) -> list[int]:
        if self.fast is None or self.long_run.search(text):
            return self.library.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class Pieces:
    """Ids of a sentencepiece model and the bytes they stand for."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=model)
        names = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(v[3:5], 16)]) if self.model.is_byte(k) else v.replace("▁", " ").encode() for k, v in enumerate(names)
        ]

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


@dataclass(frozen=True)
class Tokenizers:
    """The contents of the two files, and the lengths in bytes of their tokens."""

    vocabulary: str
    model: bytes

    def open(self) -> tuple[ByteLevel, Pieces]:
        return ByteLevel(self.vocabulary), Pieces(self.model)

    def lengths(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.array([len(b) for b in side.bytes], np.int32) for side in self.open())


def id_type(size: int) -> str:
    """How ids of a vocabulary of this size are stored."""
    return "<u2" if size <= 1 << 16 else "<u4"


def encode_texts(docs: DataFrame, tokenizers: Tokenizers, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, a, b): token ids as little-endian numbers of 16 or 32 bits, nothing for texts without tokens."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        byte_level, pieces = tokenizers.open()
        spell_a, spell_b = byte_level.bytes.__getitem__, pieces.bytes.__getitem__
        type_a, type_b = id_type(len(byte_level.bytes)), id_type(len(pieces.bytes))
        for batch in batches:
            for part in _bounded(batch, 1, PART):
                ids_a, ids_b = [], []
                for value in part.column(1):
                    body = value.as_py()
                    a = byte_level.encode(" " + body) if body else []
                    b = pieces.encode(body) if body else []
                    raw = b" " + body.encode() if body else b""
                    if b"".join(map(spell_a, a)) != raw or b"".join(map(spell_b, b)) != raw:
                        a, b = [], []
                    ids_a.append(np.array(a, type_a).tobytes())
                    ids_b.append(np.array(b, type_b).tobytes())
                yield pa.record_batch([part.column(0), pa.array(ids_a, pa.binary()), pa.array(ids_b, pa.binary())], ["doc_id", "a", "b"])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(encode, "doc_id bigint, a binary, b binary")


def _bounded(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose values in a column have about ``limit`` bytes, at least one row each."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // limit
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(edges, edges[1:], strict=False):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def slices(tokens: pa.RecordBatch, lengths: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
    return _bounded(tokens, 1, SLICE * np.dtype(id_type(len(lengths[0]))).itemsize)


class Aligned:
    """The tokens of several texts, one after the other. Every text ends in a token end of both, so groups never span two texts."""

    def __init__(self, batch: pa.RecordBatch, lengths: tuple[np.ndarray, np.ndarray]):
        types = [np.dtype(id_type(len(side))) for side in lengths]
        sides = [c.to_pylist() for c in batch.columns[1:3]]
        self.a, self.b = (np.frombuffer(b"".join(side), kind).astype(np.int64) for side, kind in zip(sides, types, strict=True))
        self.n_a, self.n_b = (np.array([len(v) // kind.itemsize for v in side], np.int64) for side, kind in zip(sides, types, strict=True))
        end_a, end_b = np.cumsum(lengths[0][self.a]), np.cumsum(lengths[1][self.b])
        upto = int(end_a[-1]) + 1 if len(end_a) else 1
        is_a, is_b = np.zeros(upto, bool), np.zeros(upto, bool)
        is_a[end_a], is_b[end_b] = True, True
        ends = np.flatnonzero(is_a | is_b)
        # A stretch up to an end lies in the token that ends there or next.
        self.at_a = (np.cumsum(is_a, dtype=np.int32) - is_a)[ends]
        self.at_b = (np.cumsum(is_b, dtype=np.int32) - is_b)[ends]
        both = is_a & is_b
        # Group of each token: the common ends before its own end.
        passed = np.cumsum(both, dtype=np.int32) - both
        self.group_a, self.group_b = passed[end_a], passed[end_b]
        self.keys = (self.b[self.at_b] << _A_BITS) | self.a[self.at_a]

    def per_text(self, at: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Sums per text of values that belong to A tokens at the given places, which ascend."""
        upto = np.concatenate([[0], np.cumsum(values)])[np.searchsorted(at, np.cumsum(self.n_a))]
        return np.diff(upto, prepend=0)

    def group_lines(self, table: list[bytes], size_a: int) -> list[str]:
        """SHA-256 of every text's groups, written as ``a1,a2|b1;a3|b2,b3``."""
        n_groups = int(self.group_a[-1]) + 1 if len(self.group_a) else 0
        per_a, per_b = np.bincount(self.group_a, minlength=n_groups), np.bincount(self.group_b, minlength=n_groups)
        before_a, before_b = np.cumsum(per_a), np.cumsum(per_b) - per_b
        line = np.empty(len(self.a) + len(self.b), np.int64)
        last_a = np.append(self.group_a[1:] != self.group_a[:-1], True)[: len(self.a)]
        last_b = np.append(self.group_b[1:] != self.group_b[:-1], True)[: len(self.b)]
        line[np.arange(len(self.a)) + before_b[self.group_a]] = self.a * 2 + last_a
        line[np.arange(len(self.b)) + before_a[self.group_b]] = (self.b + size_a) * 2 + last_b
        out, at = [], 0
        for n in (self.n_a + self.n_b).tolist():
            written = b"".join(map(table.__getitem__, line[at : at + n].tolist()))
            out.append(hashlib.sha256(written[:-1]).hexdigest() if n else "")
            at += n
        return out


def written_ids(size_a: int, size_b: int) -> list[bytes]:
    """Every id with what follows it: a comma, or the sign after the last one of its side of a group."""
    sides = ((size_a, b"|"), (size_b, b";"))
    return [b"%d%s" % (k, sign) for size, last in sides for k in range(size) for sign in (b",", last)]


def distinct_pairs(tokens: DataFrame, lengths: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """All linked pairs (key), once each: the B id in the upper half, the A id in the lower."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.int64)
        for batch in batches:
            for part in slices(batch, lengths):
                held = np.union1d(held, Aligned(part, lengths).keys)
                if len(held) > HELD:
                    yield pa.record_batch([pa.array(held)], ["key"])
                    held = np.zeros(0, np.int64)
        yield pa.record_batch([pa.array(held)], ["key"])

    return tokens.mapInArrow(pairs, "key bigint").distinct()


def hash_functions(keys: DataFrame, shard: int = SHARD) -> tuple[DataFrame, int]:
    """(shard, n, sizes, bits, keys), a stored row per shard, and the number of shards. ``keys`` is a stored table."""
    shards = max(1, -(-keys.count() // shard))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy()
            yield pa.record_batch([pa.array(shard_of(values, shards)), batch.column(0)], ["shard", "key"])

    def hashed(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        sizes, bits, ordered = build(np.sort(group["key"].to_numpy(np.int64)))
        return pd.DataFrame({"shard": [key[0]], "n": [len(ordered)], "sizes": [sizes], "bits": [bits], "keys": [ordered.tobytes()]})

    dealt = keys.mapInArrow(deal, "shard int, key bigint")
    return store(dealt.groupBy("shard").applyInPandas(hashed, "shard int, n bigint, sizes array<int>, bits binary, keys binary")), shards


def blocks(functions: DataFrame, block: int) -> list[list[int]]:
    """Shards in runs of about ``block`` pairs."""
    listed = sorted((r.shard, r.n) for r in functions.select("shard", "n").collect())
    out: list[list[int]] = []
    held = 0
    for number, n in listed:
        if not out or held + n > block:
            out.append([])
            held = 0
        out[-1].append(number)
        held += n
    return out or [[]]


def _lookup(rows: list, shards: int) -> Lookup:
    keys = np.frombuffer(b"".join(bytes(r.keys) for r in rows), np.int64)
    return Lookup(shards, [r.shard for r in rows], [r.sizes for r in rows], [bytes(r.bits) for r in rows], keys)


def _rows(table: DataFrame, numbers: list[int]) -> list:
    return sorted(table.filter(F.col("shard").isin(numbers)).collect(), key=lambda r: r.shard)


def pair_counts(tokens: DataFrame, lengths: tuple, functions: DataFrame, shards: int, runs: list[list[int]]) -> DataFrame:
    """(shard, counts): how often each pair is linked in the corpus, as dense vectors in the order of the perfect hash."""
    spark = tokens.sparkSession
    found = None
    for numbers in runs:
        sent = spark.sparkContext.broadcast(_rows(functions, numbers))

        def count(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            lookup = _lookup(sent.value, shards)
            total = np.zeros(len(lookup.keys), np.int64)
            for batch in batches:
                for part in slices(batch, lengths):
                    keys, times = np.unique(Aligned(part, lengths).keys, return_counts=True)
                    index = lookup.index(keys)
                    total[index[index >= 0]] += times[index >= 0]
            edges = np.concatenate([[0], np.cumsum([r.n for r in sent.value])]).astype(int)
            for row, lo, hi in zip(sent.value, edges, edges[1:], strict=False):
                if total[lo:hi].any():
                    part = TaskContext.get().partitionId()
                    yield pa.record_batch([pa.array([row.shard], pa.int32()), pa.array([part], pa.int32()), pa.array([total[lo:hi].tobytes()])], ["shard", "part", "counts"])

        vectors = tokens.mapInArrow(count, "shard int, part int, counts binary")
        found = vectors if found is None else found.union(vectors)
    return tree_sum(store(found))


def tree_sum(vectors: DataFrame, fan: int = FAN) -> DataFrame:
    """(shard, counts) from a stored table (shard, part, counts): FAN vectors become one, level by level."""

    def summed(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(v, np.int64) for v in group["counts"]], axis=0)
        return pd.DataFrame({"shard": [key[0]], "part": [key[1]], "counts": [total.tobytes()]})

    while (vectors.agg(F.max("part")).first()[0] or 0) > 0:
        up = vectors.withColumn("part", F.floor(F.col("part") / fan).cast("int"))
        vectors = store(up.groupBy("shard", "part").applyInPandas(summed, "shard int, part int, counts binary"))
    return vectors.select("shard", "counts")


def best_counts(counted: DataFrame, size_b: int) -> np.ndarray:
    """Highest count of any pair of each B id; as long as B's vocabulary."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield pa.record_batch(
                    [pa.array((np.frombuffer(keys, np.int64) >> _A_BITS).astype(np.int32)), pa.array(np.frombuffer(counts, np.int64))], ["b", "n"]
                )

    out = np.zeros(size_b, np.int64)
    for row in counted.select("keys", "counts").mapInArrow(spread, "b int, n bigint").groupBy("b").agg(F.max("n").alias("n")).collect():
        out[row.b] = row.n
    return out


def align(
    docs: DataFrame, tokenizers: Tokenizers, doc_id: str = "doc_id", text: str = "text", shard: int = SHARD, block: int = BLOCK
) -> DataFrame:
    """Per row of ``docs``: (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256).

    ``count_sum`` adds the corpus-wide counts of the row's links; ``n_best`` is the number of links whose count is the highest of their
    B id.
    """
    spark = docs.sparkSession
    lengths = tokenizers.lengths()
    size_a, size_b = len(lengths[0]), len(lengths[1])
    tokens = store(encode_texts(docs, tokenizers, doc_id, text))
    functions, shards = hash_functions(store(distinct_pairs(tokens, lengths)), shard)
    runs = blocks(functions, block)
    counted = store(functions.join(pair_counts(tokens, lengths, functions, shards, runs), "shard"))
    best = best_counts(counted, size_b)
    results = []
    for numbers in runs:
        sent = spark.sparkContext.broadcast(_rows(counted, numbers))

        def look_up(batches: Iterator[pa.RecordBatch], sent=sent, first=not results) -> Iterator[pa.RecordBatch]:
            lookup = _lookup(sent.value, shards)
            counts = np.frombuffer(b"".join(bytes(r.counts) for r in sent.value), np.int64)
            is_best = counts == best[lookup.keys >> _A_BITS]
            table = written_ids(size_a, size_b) if first else []
            for batch in batches:
                for part in slices(batch, lengths):
                    lines = Aligned(part, lengths)
                    keys, inverse = np.unique(lines.keys, return_inverse=True)
                    index = lookup.index(keys)
                    held = index >= 0
                    if len(runs) == 1 and not held.all():
                        raise RuntimeError("a link's pair is not among the counted ones")
                    number, marked = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
                    number[held], marked[held] = counts[index[held]], is_best[index[held]]
                    n_best, count_sum = (lines.per_text(lines.at_a, v[inverse]) for v in (marked, number))
                    if first:
                        # A group ends with the last of its A tokens.
                        ends = np.append(np.diff(lines.group_a) != 0, True)[: len(lines.a)].astype(np.int64)
                        columns = [lines.n_a, lines.n_b, lines.per_text(np.arange(len(lines.a)), ends),
                                   lines.per_text(lines.at_a, np.ones(len(lines.at_a), np.int64))]
                        shas = lines.group_lines(table, size_a)
                    else:
                        columns, shas = [np.zeros(part.num_rows, np.int64)] * 4, [None] * part.num_rows
                    digests = [hashlib.sha256(a + b"|" + b).digest()[:16] for a, b in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)]
                    yield pa.record_batch(
                        [part.column(0), pa.array(digests, pa.binary()), *map(pa.array, columns), pa.array(n_best), pa.array(count_sum), pa.array(shas, pa.string())],
                        ["doc_id", "digest", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
                    )

        results.append(
            tokens.mapInArrow(
                look_up,
                "doc_id bigint, digest binary, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string",
            )
        )
    if len(results) == 1:
        return results[0].drop("digest")
    # Equal texts have equal sums, so a block's sums are kept once per text and added over the blocks.
    parts = [r.groupBy("digest").agg(F.first("n_best").alias("n_best"), F.first("count_sum").alias("count_sum")) for r in results]
    sums = parts[0]
    for part in parts[1:]:
        sums = sums.union(part)
    sums = store(sums.groupBy("digest").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    own = store(results[0].drop("n_best", "count_sum"))
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return own.join(sums, "digest").select(columns)
