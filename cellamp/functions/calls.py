"""Genotype calls and the other small column functions of the pipeline."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def read_call(mm_wt: Column, mm_mut: Column, allowance: int) -> Column:
    """Call of one read. Both alleles are judged with the same allowance; both or neither is ambiguous."""
    wt, mut = mm_wt <= allowance, mm_mut <= allowance
    return F.when(wt & ~mut, "WT").when(mut & ~wt, "MUT").otherwise("amb")


def cell_call(mm_wt: Column, mm_mut: Column, allowance: int) -> Column:
    """Call used for the counts per cell: the mutant wins when both alleles match."""
    return F.when(mm_mut <= allowance, "MUT").when(mm_wt <= allowance, "WT").otherwise("amb")


def pair_call(wt: Column, mut: Column, threshold: float) -> Column:
    """Call of a (barcode, UMI) pair from its read counts; AMB without WT or MUT reads."""
    total = (wt + mut).cast("double")
    return (
        F.when(total == 0, "AMB")
        .when(wt / total > threshold, "WT")
        .when(mut / total > threshold, "MUT")
        .otherwise("AMB")
    )


def collapsed_call(wt: Column, mut: Column, threshold: float) -> Column:
    """Call of a collapsed UMI: the larger allele (MUT on a tie) when its share exceeds the threshold."""
    total = (wt + mut).cast("double")
    return (
        F.when(total == 0, "AMB")
        .when(F.greatest(wt, mut) / total > threshold, F.when(wt > mut, "WT").otherwise("MUT"))
        .otherwise("AMB")
    )


def distance_threshold(length: Column, distance: float) -> Column:
    """Allowed UMI distance: a fraction of the pattern length below 1, else an absolute number."""
    if distance < 1:
        return F.floor(length * F.lit(float(distance))).cast("int")
    return F.lit(int(distance))


def clean_field(text: Column) -> Column:
    """Null to empty, trim, and strip one pair of enclosing quotes."""
    return F.trim(F.regexp_replace(F.trim(F.coalesce(text, F.lit(""))), '^"(.*)"$', "$1"))


def lenient_int(text: Column) -> Column:
    """Text to bigint, 0 when it is not an integer."""
    return F.coalesce(F.trim(text).try_cast("bigint"), F.lit(0).cast("bigint"))


def barcode_umi(bc: Column, umi: Column) -> Column:
    return F.concat_ws("_", bc, umi)
