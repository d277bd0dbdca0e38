"""One row per cell holding the cell's rows as an array, in parts where a cell is very large."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellamp.operators.skew import mark
from cellamp.session import store

# A packed row holds at most this many UMIs; larger cells come in several rows.
MAX_PACKED = 100_000


def pack_cells(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    fields: list[str],
    totals: list[Column],
    max_packed: int | None = MAX_PACKED,
) -> DataFrame:
    """``items``: array of ``fields`` per cell, sorted by ``order`` (unique in a cell), next to cell totals.

    Row number r of a cell, counted from 0 in ``order``, stands in ``part`` r div ``max_packed``. The totals of
    a cell stand on each of its rows. ``rows`` must be stored, it is read for the sizes first; None leaves
    that out for cells already known to be small.
    """
    item = F.struct(*order, *[f for f in fields if f not in order])
    packed = F.array_sort(F.collect_list(item)).alias("items")
    whole_cells = rows.groupBy(*keys).agg(packed, *totals).withColumn("part", F.lit(0))
    if max_packed is None:
        return whole_cells
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    large = sizes.filter(F.col("_n") > max_packed)
    large_rows = large.agg(F.sum("_n")).first()[0]
    if not large_rows:
        return whole_cells

    marked = mark(rows, large, keys, sizes, "_n", order[-1])
    small = marked.filter("_n IS NULL").groupBy(*keys).agg(packed, *totals).withColumn("part", F.lit(0))
    big = marked.filter("_n IS NOT NULL")
    # A piece is work for a task: its size has nothing to do with that of a packed row, which may be a few UMIs.
    pieces = max(-(-large_rows // max(max_packed, MAX_PACKED)) * 2, rows.sparkSession.sparkContext.defaultParallelism)
    # Pieces rise with the order, so the place of a row is its place in its piece after the cell's earlier pieces.
    cut = store(big.repartitionByRange(pieces, *keys, *order).withColumn("_piece", F.spark_partition_id()))
    earlier = W.partitionBy(*keys).orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    offsets = cut.groupBy(*keys, "_piece").agg(F.count("*").alias("_rows"))
    offsets = offsets.select(*keys, "_piece", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(W.partitionBy(*keys, "_piece").orderBy(*order)) - 1
    placed = cut.withColumn("_inside", inside).join(offsets, [*keys, "_piece"])
    part = F.floor((F.col("_before") + F.col("_inside")) / max_packed).cast("int")
    parts = placed.withColumn("part", part).groupBy(*keys, "part").agg(packed)
    whole = big.groupBy(*keys).agg(*totals) if totals else big.select(*keys).distinct()
    return small.unionByName(parts.join(whole, keys).select(small.columns))


def packed_text(field: str, number: bool = False) -> Column:
    """A field of the packed items as ``;``-joined text; ``number`` writes doubles without an exponent."""

    def text(item):
        value = F.format_string("%.15f", item[field]) if number else item[field].cast("string")
        return F.coalesce(value, F.lit(""))

    return F.array_join(F.transform("items", text), ";")
