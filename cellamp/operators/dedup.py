"""Duplicate groups per barcode and UMI: counts, representative read, merge table."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellamp.config import Params, RegionConfig
from cellamp.functions.calls import barcode_umi, read_call
from cellamp.functions.phred import ERR_SCALE, score_sum
from cellamp.functions.region_scan import error_fields, mismatch_fields
from cellamp.operators.regions import average_error

# Read ids have up to 19 digits, quality sums up to 6, and error sums up to 10, which is a region of this many bases.
_READS = Decimal(10**19)
_SCORES = 10**6
_WIDEST = 90_000
# The error of a base is at most this.
ERROR_UNITS = int(ERR_SCALE)


def with_calls(reads: DataFrame, config: RegionConfig, params: Params = Params()) -> DataFrame:
    allowed = config.allowance("wt", params.mismatch_ratio)
    return reads.withColumn("call", read_call(F.col("mm_wt"), F.col("mm_mut"), allowed))


def _counts() -> list:
    return [F.count_if(F.col("call") == c).alias(f"n_{c.lower()}") for c in ("WT", "MUT", "amb")]


def duplicate_counts(reads: DataFrame, config: RegionConfig, params: Params = Params()) -> DataFrame:
    """WT, MUT and ambiguous reads per group. One hash aggregation with a partial step before the shuffle."""
    return (
        with_calls(reads, config, params)
        .groupBy(*params.chunk_cols, "bc", "umi")
        .agg(*_counts(), F.count("*").alias("total_dups"))
    )


def _place(part: Column, read_id: Column) -> Column:
    """Part and read id as one number of 20 digits."""
    return part.cast("decimal(1,0)") * F.lit(_READS) + read_id.cast("decimal(19,0)")


def _split(place: Column) -> list[Column]:
    read_id = place % F.lit(_READS)
    return [((place - read_id) / F.lit(_READS)).cast("int").alias("part"), read_id.cast("bigint").alias("read_id")]


def _rank(config: RegionConfig) -> Column:
    """One number that is smaller for the better representative: WT-region error, inverted quality sum, part, read id.

    A missing error or sum comes before all others.
    """
    if config["wt"].end - config["wt"].start >= _WIDEST:
        raise ValueError(f"the wt region may have {_WIDEST} bases at most")
    error = F.coalesce(F.col("err_wt").cast("bigint") + 1, F.lit(0))
    score = F.coalesce(F.lit(_SCORES - 1) - F.col("bc_q_sum"), F.lit(0))
    worth = (error * _SCORES + score).cast("decimal(17,0)")
    return worth * F.lit(Decimal(10**20)) + _place(F.col("part"), F.col("read_id"))


def _widths(config: RegionConfig) -> dict[str, int]:
    """Bits that a read's values need; one value more stands for a missing one."""
    tops = {"listed": 1, "r2_len": 2**31 - 1, "err_r2": ERROR_UNITS * 2**31}
    for region in config.regions:
        tops[f"mm_{region.name}"] = len(region.seq)
        tops[f"err_{region.name}"] = ERROR_UNITS * max(len(region.seq), region.end - region.start + 1)
    return {name: (top + 1).bit_length() for name, top in tops.items()}


def _words(config: RegionConfig) -> list[list[tuple[str, int, int]]]:
    """Values (name, first bit, bits) dealt to words of 63 bits, wide ones first."""
    words: list[list[tuple[str, int, int]]] = []
    for name, bits in sorted(_widths(config).items(), key=lambda item: (-item[1], item[0])):
        for word in words:
            used = sum(b for _, _, b in word)
            if used + bits <= 63:
                word.append((name, used, bits))
                break
        else:
            words.append([(name, 0, bits)])
    return words


def _pack(word: list[tuple[str, int, int]]) -> Column:
    parts = [F.shiftleft(F.coalesce(F.col(name).cast("bigint") + 1, F.lit(0)), first) for name, first, _ in word]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def group_winners(reads: DataFrame, config: RegionConfig, params: Params = Params()) -> DataFrame:
    """Per group its counts, its first appearance, and the numbers of its representative read.

    The representative has the lowest WT-region error, then the highest barcode quality sum, then comes
    first. Only in a group with a MUT majority the choice is limited to MUT reads; a WT majority is not
    limited to WT reads. Both choices are kept while aggregating, so the reads are shuffled once and
    partially aggregated before that, however large a group is. A read's numbers are packed into words of
    a fixed width, so this is a hash aggregation and nothing is sorted. Read ids are unique.
    """
    keys, words = [*params.chunk_cols, "bc", "umi"], _words(config)
    if "bc_q_sum" not in reads.columns:  # the scan of reads has it, tables of text do not
        reads = reads.withColumn("bc_q_sum", score_sum(F.col("bc_qual")))
    called = with_calls(reads, config, params).withColumn("listed", (F.col("whitelist") == "Y").cast("int"))
    ranked = called.select(
        *keys, "call", _rank(config).alias("_rank"), _place(F.col("part"), F.col("read_id")).alias("_place"),
        *[_pack(word).alias(f"_w{k}") for k, word in enumerate(words)],
    ).withColumn("_mut_rank", F.when(F.col("call") == "MUT", F.col("_rank")))
    groups = ranked.groupBy(*keys).agg(
        *_counts(),
        F.count("*").alias("total_dups"),
        F.min("_place").alias("_first"),
        F.min("_rank").alias("_best"),
        F.min("_mut_rank").alias("_best_mut"),
        *[F.min_by(f"_w{k}", "_rank").alias(f"_a{k}") for k in range(len(words))],
        *[F.min_by(f"_w{k}", "_mut_rank").alias(f"_m{k}") for k in range(len(words))],
    )
    mutant = F.col("n_wt") < F.col("n_mut")
    best = F.when(mutant, F.col("_best_mut")).otherwise(F.col("_best")) % F.lit(Decimal(10**20))
    chosen = groups.select(
        *keys, "n_wt", "n_mut", "n_amb", "total_dups", F.struct(*_split(F.col("_first"))).alias("first_seen"), *_split(best),
        *[F.when(mutant, F.col(f"_m{k}")).otherwise(F.col(f"_a{k}")).alias(f"_w{k}") for k in range(len(words))],
    )

    values = {}
    for k, word in enumerate(words):
        for name, first, bits in word:
            stored = F.shiftright(f"_w{k}", first).bitwiseAND(F.lit((1 << bits) - 1))
            values[name] = F.when(stored > 0, stored - 1).cast("bigint" if name.startswith("err_") else "int")
    winners = chosen.select(
        *keys, "n_wt", "n_mut", "n_amb", "total_dups", "first_seen", "part", "read_id",
        F.when(values["listed"].isNotNull(), F.when(values["listed"] == 1, "Y").otherwise("N")).alias("whitelist"),
        *[values[c].alias(c) for c in ("r2_len", *mismatch_fields(config), *error_fields(config))],
    )
    return with_calls(winners, config, params).withColumn("barcode_umi", barcode_umi(F.col("bc"), F.col("umi")))


def representatives(reads: DataFrame, config: RegionConfig, params: Params = Params()) -> DataFrame:
    """:func:`group_winners` with the barcode qualities, which are fetched for the chosen reads only."""
    keys = [*params.chunk_cols, "bc", "umi", "part", "read_id"]
    qualities = reads.select(*keys, "bc_qual")
    return group_winners(reads, config, params).join(qualities, keys).drop("part")


def merge_table(
    reps: DataFrame, config: RegionConfig, params: Params = Params(), total_dups_as_call: bool = False
) -> DataFrame:
    """The 16 (linear) or 20 (circular) columns per group, and the order of first appearance.

    ``total_dups_as_call`` puts the number of duplicates in place of the call.
    """
    averages = [average_error(e, config).alias(e.replace("err_", "avg_err_", 1)) for e in error_fields(config)[:5]]
    call = F.col("total_dups").cast("string") if total_dups_as_call else F.col("call")
    return reps.select(
        *params.chunk_cols, "bc", "whitelist", "umi", "n_wt", "n_mut", "n_amb", call.alias("call"), *averages,
        *mismatch_fields(config), "first_seen",
    )
