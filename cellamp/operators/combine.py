"""Combine chunk tables: unpack, sum per barcode and UMI, call, and pack per cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellamp.config import Params
from cellamp.functions.calls import lenient_int, pair_call
from cellamp.operators.packing import MAX_PACKED, pack_cells, packed_text
from cellamp.operators.skew import salted_lookup
from cellamp.session import store

PACKED = ("umi", "n_wt", "n_mut", "n_amb")


def unpack(tables: DataFrame, row_order: list[str]) -> DataFrame:
    """Explode the packed columns in lockstep; missing or non-numeric counts become 0.

    ``row_order`` names the columns that order the rows of all tables; with the place in the list they
    give ``first_seen``.
    """
    lists = F.arrays_zip(*[F.split(F.coalesce(c, F.lit("")), ";").alias(c) for c in PACKED])
    exploded = tables.select(
        F.get(F.split(F.coalesce("bc", F.lit("")), ";"), F.lit(0)).alias("bc"),
        *row_order,
        F.posexplode(lists).alias("pos", "item"),
    )
    return exploded.select(
        "bc",
        F.coalesce("item.umi", F.lit("")).alias("umi"),
        *[lenient_int(F.col(f"item.{c}")).alias(c) for c in PACKED[1:]],
        F.struct(*row_order, "pos").alias("first_seen"),
    )


def is_uneven() -> Column:
    """Whether the lists of a packed row differ in length."""
    sizes = F.array(*[F.size(F.split(F.coalesce(c, F.lit("")), ";")) for c in PACKED])
    return F.array_min(sizes) != F.array_max(sizes)


def uneven_rows(tables: DataFrame) -> DataFrame:
    """Packed rows whose lists differ in length."""
    return tables.filter(is_uneven())


def sum_pairs(rows: DataFrame, params: Params = Params()) -> DataFrame:
    """Counts per (barcode, UMI) over all chunks, with the call of the pair.

    Keeps the first appearance when the input carries ``first_seen``.
    """
    first = [F.min("first_seen").alias("first_seen")] if "first_seen" in rows.columns else []
    pairs = rows.groupBy("bc", "umi").agg(*[F.sum(c).alias(c) for c in PACKED[1:]], *first)
    return pairs.withColumn("call", pair_call(F.col("n_wt"), F.col("n_mut"), params.pcr_threshold))


def with_bc_first(pairs: DataFrame) -> DataFrame:
    """First appearance of the barcode on each of its pairs. ``pairs`` must be stored."""
    cells = store(pairs.groupBy("bc").agg(F.min("first_seen").alias("bc_first"), F.count("*").alias("_n")))
    return salted_lookup(pairs, cells.select("bc", "bc_first"), ["bc"], cells, "_n", "umi", "inner")


def ordered_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs in the order of the combined table. A range sort, for sinks."""
    return with_bc_first(pairs).orderBy("bc_first", "bc", "umi")


def concat_cells(pairs: DataFrame, max_packed: int = MAX_PACKED) -> DataFrame:
    """Packed lists per cell with the UMIs in lexicographic order. ``pairs`` must be stored."""
    first = [F.min("first_seen").alias("bc_first")] if "first_seen" in pairs.columns else []
    fields = [*PACKED, "call"]
    packed = pack_cells(pairs, ["bc"], ["umi"], fields, first, max_packed)
    return packed.select("bc", "part", *[packed_text(f).alias(f) for f in fields], *[c for c in packed.columns if c == "bc_first"])
