"""Region scoring of reads (`looked`), and the filters on it. No shuffle anywhere in this module."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellamp.config import Params, RegionConfig
from cellamp.functions.phred import ERR_SCALE, error_sum, error_units, packed_scores, score_sum
from cellamp.functions.region_scan import error_fields, mismatch_fields, scan_mismatches, scan_reads
from cellamp.operators.reads import cut_fields


def mismatches(reads: DataFrame, config: RegionConfig, params: Params = Params()) -> DataFrame:
    """Barcode, UMI, shift and mismatch counts; the read qualities are never touched."""
    fields = cut_fields(reads, params)
    scan = scan_mismatches(F.col("seq_r2"), config, params)
    return fields.select("read_id", *params.chunk_cols, "bc", "bc_qual", "umi", scan.alias("scan")).select(
        "read_id", *params.chunk_cols, "bc", "bc_qual", "umi", "scan.*"
    )


def looked(reads: DataFrame, config: RegionConfig, params: Params = Params()) -> DataFrame:
    """One row per read with all mismatch counts and error sums, bad reads included and marked.

    A read is bad when it is empty or when its whole or shared-region error sum is zero.
    """
    fields = cut_fields(reads, params)
    scan = scan_reads(F.col("seq_r2"), F.col("qual_r2"), F.col("bc_qual"), config, params)
    kept = ["read_id", *params.chunk_cols, "bc", "bc_qual", "umi"]
    scored = fields.select(*kept, F.length("seq_r2").alias("r2_len"), scan.alias("scan")).select(
        *kept, "r2_len", "scan.*"
    )
    bad = (F.col("r2_len") == 0) | (F.col("err_r2") == 0) | (F.col("err_shared") == 0)
    return scored.withColumn("is_bad", bad)


def good_reads(scored: DataFrame) -> DataFrame:
    return scored.filter(~F.col("is_bad")).drop("is_bad")


def bad_reads(scored: DataFrame) -> DataFrame:
    """The quarantine: reads that cannot be scored. The other reads are unaffected by them."""
    return scored.filter("is_bad").drop("is_bad")


def average_error(field: str, config: RegionConfig) -> Column:
    """Error sum over the length of the region's sequence (of the read for the whole read)."""
    length = F.col("r2_len") if field == "err_r2" else F.lit(len(config[field.removeprefix("err_")].seq))
    return F.col(field).cast("double") / ERR_SCALE / length


def looked_table(
    scored: DataFrame, config: RegionConfig, repeat_rv_wt: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """The fixed 12 (linear) or 20 (circular) columns of a `looked` table, after the read id.

    ``repeat_rv_wt`` puts the reverse wild-type average in the last circular column once more.
    """
    averages = [average_error(e, config).alias(e.replace("err_", "avg_err_", 1)) for e in error_fields(config)]
    if repeat_rv_wt and config.mode == "circ":
        averages[-1] = average_error("err_rv_wt", config).alias("avg_err_rv_mut")
    return scored.select(
        "read_id", "bc", packed_scores(F.col("bc_qual")).alias("bc_q"), "umi", *mismatch_fields(config), *averages,
        *keep,
    )


def is_primed(config: RegionConfig, params: Params = Params()) -> Column:
    """Primer and shared region within their allowance; for circular layouts also one allele of each PCR2 pair."""
    ratio, pcr2 = params.mismatch_ratio, params.pcr2_ratio
    keep = (F.col("mm_primer") <= config.allowance("primer", ratio)) & (
        F.col("mm_shared") <= config.allowance("shared", ratio)
    )
    if config.mode == "circ":
        for side in ("fw", "rv"):
            allowed = config.allowance(f"{side}_wt", pcr2)
            keep &= (F.col(f"mm_{side}_wt") <= allowed) | (F.col(f"mm_{side}_mut") <= allowed)
    return keep


def primed(scored: DataFrame, config: RegionConfig, params: Params = Params()) -> DataFrame:
    return scored.filter(is_primed(config, params))


# ---- the same numbers without Python, as a cross-check ------------------------------------------------


def _hof_mismatches(seq: Column, start: Column, ref: str) -> Column:
    bases = F.split(F.substring(seq, start, F.lit(len(ref))), "")
    expected = F.array(*[F.lit(b) for b in ref])
    return F.aggregate(
        F.zip_with(bases, expected, lambda a, b: F.when(a.eqNullSafe(b), 0).otherwise(1)), F.lit(0), lambda n, d: n + d
    )


def looked_native(reads: DataFrame, config: RegionConfig, params: Params = Params()) -> DataFrame:
    """:func:`looked` with higher-order functions only; slower, used to check the Arrow scan."""
    seq, primer = F.col("seq_r2"), config["primer"]
    allowed = config.allowance("primer", params.mismatch_ratio)
    tries = F.transform(
        F.sequence(F.lit(0), F.lit(params.max_shift)),
        lambda s: F.struct(s.alias("shift"), _hof_mismatches(seq, s + primer.start, primer.seq).alias("mm")),
    )
    first = F.get(F.filter(tries, lambda t: t["mm"] <= allowed), F.lit(0))
    none = F.struct(F.lit(0).alias("shift"), F.lit(len(primer.seq)).alias("mm"))
    out = cut_fields(reads, params).withColumn("hit", F.coalesce(first, none))
    units = error_units(F.col("qual_r2"))
    shift = F.col("hit.shift")

    def window(start, length):
        return F.aggregate(
            F.slice(units, start, F.lit(length)),
            F.lit(0).cast("bigint"),
            lambda acc, e: acc + F.coalesce(e, F.lit(0)).cast("bigint"),
        )

    rest = config.regions[1:]
    return out.select(
        "read_id", *params.chunk_cols, "bc", "bc_qual", "umi", F.length(seq).alias("r2_len"),
        shift.alias("shift"), F.col("hit.mm").alias("mm_primer"),
        *[_hof_mismatches(seq, shift + r.start, r.seq).alias(f"mm_{r.name}") for r in rest],
        error_sum(F.col("qual_r2")).alias("err_r2"),
        window(F.lit(1), len(primer.seq)).alias("err_primer"),
        *[window(shift + r.start, r.end - r.start + 1).alias(f"err_{r.name}") for r in rest],
        score_sum(F.col("bc_qual")).cast("bigint").alias("bc_q_sum"),
    )
