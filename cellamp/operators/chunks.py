"""Seeded random chunks of reads."""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellamp.session import store

# Digits of the permutation's hash that deal reads to buckets: about BUCKETS buckets per chunk, a million at most.
BUCKETS = 16
MAX_DIGITS = 5


def chunk_reads(total: int, target: int) -> int:
    """Reads per chunk: when the last chunk would be less than 90 % full, the others take its reads."""
    rest = total % target
    if rest and rest * 10 < target * 9:
        whole = total // target
        return target + rest // whole + 1 if whole else max(total, 1)
    return target


def assign_chunks(
    reads: DataFrame, target_reads: int, seed: int = 0, total: int | None = None
) -> DataFrame:
    """Append ``chunk_id`` in the order of a seeded random permutation; every read gets one.

    The permutation orders reads by a hash of their id, so its leading digits cut the reads into even buckets. A bucket's chunk follows
    from the number of reads before it. Only in a bucket that a chunk ends in, ids and hashes are ranked, to find the read with which the next
    chunk begins. Reads meet the table of buckets, which is bounded, where they are; they are not moved. ``reads`` is read three times
    and must give the same rows.
    """
    total = reads.count() if total is None else total
    size = chunk_reads(total, target_reads)
    digits = min(MAX_DIGITS, max(1, ceil(log(max(1.0, total / size * BUCKETS), 16))))
    key = F.md5(F.concat_ws("_", F.lit(str(seed)), F.col("read_id").cast("string")))
    keyed = reads.withColumn("_key", key).withColumn("_bucket", F.substring("_key", 1, digits))
    counts = keyed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    buckets = store(counts.select("_bucket", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    first, last = F.floor(F.col("_before") / size), F.floor((F.col("_before") + F.col("_n") - 1) / size)
    ended = buckets.filter(first < last).select("_bucket", "_before")
    place = F.row_number().over(W.partitionBy("_bucket").orderBy("_key", "read_id")) - 1 + F.col("_before")
    ranked = keyed.select("_bucket", "_key", "read_id").join(F.broadcast(ended), "_bucket").withColumn("_rank", place)
    starts = ranked.filter((F.col("_rank") % size == 0) & (F.col("_rank") > F.col("_before")))
    cuts = starts.groupBy("_bucket").agg(F.collect_list(F.struct("_key", "read_id")).alias("_cuts"))
    table = store(buckets.select("_bucket", first.alias("_chunk")).join(cuts, "_bucket", "left"))
    passed = F.filter("_cuts", lambda cut: cut <= F.struct("_key", "read_id"))
    chunk = F.col("_chunk") + F.when(F.col("_cuts").isNull(), 0).otherwise(F.size(passed))
    placed = keyed.join(F.broadcast(table), "_bucket").withColumn("chunk_id", chunk.cast("int"))
    return placed.drop("_key", "_bucket", "_chunk", "_cuts")
