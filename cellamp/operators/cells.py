"""Summary per cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellamp.config import Params, RegionConfig
from cellamp.functions.calls import cell_call
from cellamp.operators.packing import MAX_PACKED, pack_cells, packed_text
from cellamp.operators.skew import salted_lookup
from cellamp.session import store


def cell_summary(
    merged: DataFrame, config: RegionConfig, params: Params = Params(), max_packed: int = MAX_PACKED
) -> DataFrame:
    """Packed columns and WT/MUT/amb counts per cell, for cells with at least ``dupcut`` reads.

    The UMIs of a cell stand in order of first appearance. ``merged`` must be stored.
    """
    keys = [*params.chunk_cols, "bc"]
    fields = [c for c in merged.columns if c not in (*params.chunk_cols, "first_seen")]
    call = cell_call(F.col("mm_wt"), F.col("mm_mut"), config.allowance("wt", params.mismatch_ratio))
    totals = [F.count_if(call == c).alias(f"{c.lower()}_calls") for c in ("WT", "MUT", "amb")]
    totals.append(F.sum(F.col("n_wt") + F.col("n_mut") + F.col("n_amb")).alias("_reads"))
    totals.append(F.min("first_seen").alias("first_seen"))
    rows = merged.withColumn("bc_", F.col("bc"))
    packed = pack_cells(rows, keys, ["first_seen"], [f if f != "bc" else "bc_" for f in fields], totals, max_packed)
    return packed.filter(F.col("_reads") >= params.dupcut).select(
        *keys,
        "part",
        *[packed_text("bc_" if f == "bc" else f, f.startswith("avg_")).alias(f"{f}_list") for f in fields],
        "wt_calls",
        "mut_calls",
        "amb_calls",
        "first_seen",
    )


def surviving_rows(merged: DataFrame, params: Params = Params()) -> DataFrame:
    """Rows of cells with at least ``dupcut`` reads, without packing them. ``merged`` must be stored."""
    if params.dupcut <= 1:
        return merged
    keys = [*params.chunk_cols, "bc"]
    reads = F.sum(F.col("n_wt") + F.col("n_mut") + F.col("n_amb"))
    sizes = store(merged.groupBy(*keys).agg(reads.alias("_reads"), F.count("*").alias("_n")))
    kept = sizes.filter(F.col("_reads") >= params.dupcut).select(*keys)
    return salted_lookup(merged, kept, keys, sizes, "_n", "umi", "inner")
