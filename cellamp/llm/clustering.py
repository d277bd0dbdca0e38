"""Centroid clustering of integer vectors with subvector dictionaries.

Vectors are packed into chunks of up to ``CHUNK`` rows. In a chunk, the dimensions are cut into blocks, and every block is
encoded without loss as a dictionary of its distinct subvectors and one code per row. Blocks are as wide as pays: a block with more
distinct subvectors than a quarter of the rows is halved, down to single dimensions. So a chunk of copies is a few wide blocks, and a
chunk of unlike vectors one dictionary of values per dimension.

A round computes, once per dictionary entry, its exact squared distance to every centroid on the block's dimensions, and adds
these partial distances up by code. A cluster's sums are the dictionary entries times the number of rows with their code. Tasks return one
row of sums per cluster; chunks lie in a stored table and never move. Only the centroids (a stated number of vectors) reach the driver.

All arithmetic is in 64-bit integers, so results do not depend on partitions. Ties go to the smaller cluster number; empty clusters keep their centroid.

Vectors of another length, null vectors and vectors with a null, infinite or NaN component are left out. A component whose quantized value is
beyond ``LARGEST`` could overflow the distances: an error. Repeated rows each get a row. A missing id is kept, and starts
no cluster unless there are too few others. With fewer vectors than clusters, there are as many clusters as vectors; an empty table has no rows.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellamp.session import store

DIMENSIONS = 64
CLUSTERS = 40
ROUNDS = 5
SCALE = 256
SEED = 2
# Rows of a chunk (8 MB of values).
CHUNK = 16_384
# 64 squares of differences of such values stay below 2**63.
LARGEST = 1 << 27
_CHUNKS = "rows int, ids binary, missing binary, widths array<int>, entries array<binary>, codes array<binary>"


def quantized(vectors: DataFrame, vec_id: str, vector: str, dimensions: int, scale: int) -> DataFrame:
    """(vec_id, v): floor(scale * component) of the vectors that are whole."""
    values = F.col(vector).cast("array<double>")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.coalesce((F.size(values) == dimensions) & ~bad, F.lit(False))

    def whole_number(x):
        large = F.abs(x * scale) > LARGEST
        return F.when(large, F.raise_error(F.lit("a component is too large for exact distances"))).otherwise(F.floor(x * scale))

    return vectors.filter(whole).select(F.col(vec_id).cast("bigint").alias("vec_id"), F.transform(values, whole_number).cast("array<bigint>").alias("v"))


def encode(values: np.ndarray) -> tuple[list[int], list[bytes], list[bytes]]:
    """(width, dictionary, codes) per block of the columns of ``values``."""
    widths, entries, codes = [], [], []
    waiting = [(0, values.shape[1])]
    while waiting:
        lo, hi = waiting.pop()
        part = np.ascontiguousarray(values[:, lo:hi])
        # Rows are compared by their bytes; which order the dictionary has does not matter.
        _, first, code = np.unique(part.view(f"V{part.itemsize * (hi - lo)}").ravel(), return_index=True, return_inverse=True)
        if hi - lo > 1 and len(first) * 4 > len(values):
            middle = (lo + hi) // 2
            waiting += [(middle, hi), (lo, middle)]
            continue
        widths.append(hi - lo)
        entries.append(part[first].tobytes())
        codes.append(code.astype("<u2").tobytes())
    return widths, entries, codes


class Chunk:
    """A chunk read back."""

    def __init__(self, row: dict):
        self.rows = row["rows"]
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.missing = np.frombuffer(row["missing"], bool)
        self.blocks, at = [], 0
        for width, entries, code in zip(row["widths"], row["entries"], row["codes"], strict=True):
            self.blocks.append((at, np.frombuffer(entries, "<i8").reshape(-1, width), np.frombuffer(code, "<u2")))
            at += width

    def assign(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid of every row, and the squared distance."""
        total = np.zeros((self.rows, len(centroids)), np.int64)
        for at, entries, code in self.blocks:
            own = centroids[:, at : at + entries.shape[1]]
            # One column after the other, so that no more than entries x centroids numbers are held.
            partial = np.zeros((len(entries), len(own)), np.int64)
            for column in range(own.shape[1]):
                partial += (entries[:, column, None] - own[None, :, column]) ** 2
            total += partial[code]
        nearest = total.argmin(axis=1)
        return nearest, total[np.arange(self.rows), nearest]

    def sums(self, nearest: np.ndarray, clusters: int, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows per cluster and the sum of their vectors."""
        out = np.zeros((clusters, dimensions), np.int64)
        for at, entries, code in self.blocks:
            cells = np.bincount(nearest * len(entries) + code, minlength=clusters * len(entries))
            out[:, at : at + entries.shape[1]] = cells.reshape(clusters, -1) @ entries
        return np.bincount(nearest, minlength=clusters), out


def chunks(vectors: DataFrame, dimensions: int, chunk: int = CHUNK) -> DataFrame:
    """The encoded chunks of (vec_id, v)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= chunk:
                whole = pa.Table.from_batches(held).combine_chunks()
                yield packed(whole.slice(0, chunk))
                held = whole.slice(chunk).to_batches()
        if sum(b.num_rows for b in held):
            yield packed(pa.Table.from_batches(held).combine_chunks())

    def packed(table: pa.Table) -> pa.RecordBatch:
        ids = table.column(0).combine_chunks()
        flat = table.column(1).combine_chunks().flatten().to_numpy(zero_copy_only=False)
        widths, entries, codes = encode(flat.astype("<i8").reshape(-1, dimensions))
        missing = ids.is_null().to_numpy(zero_copy_only=False)
        row = {
            "rows": table.num_rows, "ids": ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(),
            "missing": missing.tobytes(), "widths": widths, "entries": entries, "codes": codes,
        }
        types = [("rows", pa.int32()), ("ids", pa.binary()), ("missing", pa.binary()), ("widths", pa.list_(pa.int32())),
                 ("entries", pa.list_(pa.binary())), ("codes", pa.list_(pa.binary()))]
        return pa.RecordBatch.from_pylist([row], pa.schema(types))

    return vectors.mapInArrow(pack, _CHUNKS)


def cluster_sums(packed: DataFrame, centroids: np.ndarray) -> list[tuple[int, int, list[int]]]:
    """(cluster, rows, sum of vectors) of the non-empty clusters: a row per cluster on the driver."""
    clusters, dimensions = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total = np.zeros(clusters, np.int64), np.zeros((clusters, dimensions), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row)
                more, sums = chunk.sums(chunk.assign(centroids)[0], clusters, dimensions)
                rows, total = rows + more, total + sums
        at = np.flatnonzero(rows)
        yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(rows[at]), pa.array(total[at].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "total"])

    sums = [F.sum(F.col("total")[k]).alias(f"_{k}") for k in range(dimensions)]
    added = packed.mapInArrow(add, "cluster int, n bigint, total array<bigint>").groupBy("cluster").agg(F.sum("n").alias("n"), *sums)
    return [(r[0], r[1], list(r[2:])) for r in added.collect()]


def assignments(packed: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row)
                cluster, distance = chunk.assign(centroids)
                yield pa.record_batch([pa.array(chunk.ids, mask=chunk.missing), pa.array(cluster.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return packed.mapInArrow(nearest, "vec_id bigint, cluster int, distance bigint")


def first_centroids(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors whose ids have the smallest hashes, in the order of the hashes; equal ids in the order of their vectors."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(digest.alias("digest"), "v").orderBy(F.col("digest").asc_nulls_last(), "v").limit(clusters).collect()
    return np.array([r.v for r in rows], np.int64)


def cluster(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED, chunk: int = CHUNK,
) -> DataFrame:
    """Per whole vector: (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256).

    A cluster's centroid is replaced ``rounds`` times by the floor of its vectors' mean; then vectors are assigned once more.
    """
    if not 1 <= chunk <= 1 << 16:
        raise ValueError("codes have 16 bits: a chunk has 1 to 65,536 rows")
    spark = vectors.sparkSession
    whole = quantized(vectors, vec_id, vector, dimensions, scale)
    packed = store(chunks(whole, dimensions, chunk))
    centroids = first_centroids(whole, clusters, seed).reshape(-1, dimensions)
    for _ in range(rounds):
        for number, n, total in cluster_sums(packed, centroids) if len(centroids) else ():
            centroids[number] = [t // n for t in total]
    assigned = store(assignments(packed, centroids)) if len(centroids) else assignments(packed.limit(0), centroids)
    # One row per cluster reaches the driver, and goes back to all tasks.
    inertia = {r.cluster: r.n for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}
    rows = [
        (k, inertia.get(k, 0), sum(inertia.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for k, c in enumerate(centroids.tolist())
    ]
    known = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
