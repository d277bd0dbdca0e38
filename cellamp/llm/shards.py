"""Shards of bounded size by extendible hashing.

The directory is indexed by the leading bits of a hash of the key. A bucket that exceeds the byte limit is split on its next bit, and only
that one; the buckets that are left are the shards. The byte counts of all prefixes come from one aggregation of fine cells (a fixed number of
bits beyond what an even split needs); cells that are still too large are counted again on more bits.

A row that exceeds the limit by itself gets a shard of its own. Rows that agree on all bits (rows with one key, such as repeated
rows or rows without a key) cannot be told apart by bits; if they exceed the limit, they are dealt into numbered shards by a running
byte count, in an order that follows from their contents, so reruns and rows read again after a lost executor agree. Null texts have no bytes, a null key is a key of its own, and an empty table has no shards.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellamp.llm.tables import whole_text
from cellamp.session import store

LIMIT = 64 * 1024 * 1024
# Bits of the hash: fifteen hexadecimal digits.
BITS = 60
# Cells are this many bits finer than an even split would need.
FINER = 4
# Rows of a crowded key are dealt to groups of about this many shards each, so that no task gets all of them.
GROUP = 8


def key_bits(key: str) -> Column:
    """A 60-bit number from the key's digest."""
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("bigint")


def bit_string(prefix: Column, depth: Column) -> Column:
    """A prefix as its bits; the empty prefix is the root."""
    return F.when(depth == 0, F.lit("")).otherwise(F.lpad(F.bin(prefix), depth, "0"))


def _levels(cells: DataFrame, bits: int, limit: int) -> DataFrame:
    """Prefixes of the cells that have to be split: (depth, prefix)."""
    levels = cells.select(
        F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("depth"), "cell", "bytes", "n"
    ).withColumn("prefix", F.expr(f"shiftright(cell, {bits} - depth)"))
    sums = levels.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    return sums.filter((F.col("bytes") > limit) & (F.col("n") > 1)).select("depth", "prefix")


def directory(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(bits, cell, depth) from a stored table with the columns ``hash`` and ``bytes``.

    A row's shard is the leading ``depth`` bits of its hash; the entry is found by its leading ``bits`` bits. A depth above
    ``BITS`` marks a key that bits cannot split.
    """
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    bits = min(BITS, math.ceil(math.log2(max(1.0, total / limit))) + FINER)
    found, left = [], rows
    while True:
        cells = store(
            left.groupBy(F.shiftright("hash", BITS - bits).alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
        )
        full = store(_levels(cells, bits, limit))
        # A prefix that must be split lies below prefixes that must be split, so their number is the depth.
        ancestors = cells.select("cell", F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("depth")).withColumn(
            "prefix", F.expr(f"shiftright(cell, {bits} - depth)")
        )
        depths = ancestors.join(full, ["depth", "prefix"]).groupBy("cell").agg(F.count("*").cast("int").alias("depth"))
        entries = store(
            cells.select("cell").join(depths, "cell", "left").select(F.lit(bits).alias("bits"), "cell", F.coalesce("depth", F.lit(0)).alias("depth"))
        )
        open_cells = entries.filter(F.col("depth") > bits)
        if bits == BITS or open_cells.isEmpty():
            return found_union([*found, entries])
        found.append(entries.filter(F.col("depth") <= bits))
        at = F.shiftright("hash", BITS - bits)
        left = left.join(open_cells.select(F.col("cell").alias("open")), at == F.col("open"), "left_semi")
        bits = min(BITS, bits + 8)


def found_union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return store(whole)


def assign_shards(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``docs`` with (n_bytes, shard): the shard is named by its hash bits, and a crowded key's shards by a number after them.

    ``docs`` is read twice. The directory is small (a few entries per shard) and joined by the row's cell; whether it is sent to all
    tasks is for Spark to decide from its stored size. The hash spreads rows evenly, except for rows of one key.
    """
    sized = docs.withColumn("n_bytes", F.octet_length(whole_text(text)).cast("bigint")).withColumn("_hash", key_bits(key))
    rows = store(sized.select(F.col("_hash").alias("hash"), F.col("n_bytes").alias("bytes")))
    entries = directory(rows, limit)
    placed = None
    for bits in sorted(row.bits for row in entries.select("bits").distinct().collect()):
        level = entries.filter(F.col("bits") == bits).select(F.col("cell").alias("_cell"), F.col("depth").alias("_depth"))
        part = sized.withColumn("_cell", F.shiftright("_hash", BITS - bits)).join(level, "_cell")
        placed = part if placed is None else placed.union(part)
    if placed is None:
        return sized.drop("_hash").withColumn("shard", F.lit(None).cast("string"))
    depth = F.least(F.col("_depth"), F.lit(BITS))
    prefix = F.expr(f"shiftright(_hash, {BITS} - least(_depth, {BITS}))")
    placed = placed.withColumn("shard", bit_string(prefix, depth))
    crowded = entries.filter(F.col("depth") > BITS)
    if not crowded.isEmpty():
        plain = placed.filter(F.col("_depth") <= BITS)
        placed = plain.unionByName(_deal(placed.filter(F.col("_depth") > BITS), crowded, rows, limit))
    return placed.drop("_hash", "_cell", "_depth")


def _numbered(crowd: DataFrame) -> DataFrame:
    """Append ``_digest`` of a row's whole content and ``_rank`` among the rows of one key that are equal in all.

    Equal rows are counted by task and numbered within it, so thousands of copies never come to one task.
    """
    content = F.struct(*[F.col(f"`{c}`") for c in crowd.columns if c not in ("_hash", "_cell", "_depth")]).cast("string")
    stored = store(crowd.withColumn("_digest", F.md5(content.cast("binary"))).withColumn("_task", F.spark_partition_id()))
    same = ["_hash", "_digest"]
    counts = stored.groupBy(*same, "_task").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.partitionBy(*same).orderBy("_task").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select(*same, "_task", F.coalesce(before, F.lit(0)).alias("_before"))
    within = F.row_number().over(W.partitionBy(*same, "_task").orderBy("n_bytes"))
    return stored.withColumn("_within", within).join(offsets, [*same, "_task"]).withColumn(
        "_rank", F.col("_before") + F.col("_within")
    ).drop("_task", "_before", "_within")


def _deal(placed: DataFrame, crowded: DataFrame, rows: DataFrame, limit: int) -> DataFrame:
    """Shards for rows that share all bits: large rows alone, the others by half the limit, so that none exceeds it.

    Where a row goes follows from its content and its number among equal rows, whatever task it was read in.
    """
    sizes = rows.join(crowded.select(F.col("cell").alias("hash")), "hash").groupBy("hash").agg(F.sum("bytes").alias("_total"))
    groups = F.greatest(F.lit(1), F.floor(F.col("_total") / (limit * GROUP))).cast("bigint")
    keyed = _numbered(placed).join(store(sizes).withColumnRenamed("hash", "_hash"), "_hash").withColumn(
        "_group", F.pmod(F.xxhash64("_digest", "_rank"), groups)
    )
    large = F.col("n_bytes") * 2 > limit
    own = W.partitionBy("_hash", "_group", large).orderBy("n_bytes", "_digest", "_rank")
    running = F.sum("n_bytes").over(own.rowsBetween(W.unboundedPreceding, -1))
    place = F.when(large, F.row_number().over(own)).otherwise(F.floor(F.coalesce(running, F.lit(0)) * 2 / limit))
    name = F.concat_ws("-", "shard", F.col("_group").cast("string"), F.when(large, "L").otherwise("S"), place.cast("string"))
    return keyed.withColumn("shard", name).drop("_total", "_group", "_digest", "_rank")
