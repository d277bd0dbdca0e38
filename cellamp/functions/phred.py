"""Phred symbols, scores and error probabilities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Error probability of Q0..Q41 in units of 1e-5 (symbols '!' to 'J').
P_ERR_1E5 = (
    100000, 79433, 63096, 50119, 39811, 31623, 25119, 19953, 15849, 12589, 10000,
    7943, 6310, 5012, 3981, 3162, 2512, 1995, 1585, 1259, 1000,
    794, 631, 501, 398, 316, 251, 200, 158, 126, 100,
    79, 63, 50, 40, 32, 25, 20, 16, 13, 10, 8,
)
MAX_Q = len(P_ERR_1E5) - 1
OFFSET = 33
ERR_SCALE = 100000.0


def symbol_score(symbol: Column) -> Column:
    """Score of one phred symbol, null for a symbol outside Q0..Q41."""
    q = F.ascii(symbol) - OFFSET
    return F.when(q.between(0, MAX_Q), q)


def scores(quality: Column) -> Column:
    """Quality string to an array of scores; unknown symbols stay null."""
    return F.transform(F.split(quality, ""), symbol_score)


def error_units(quality: Column) -> Column:
    """Quality string to error probabilities per base, as integers of 1e-5; unknown symbols stay null."""
    table = F.expr(f"array({', '.join(map(str, P_ERR_1E5))})")
    return F.transform(F.split(quality, ""), lambda s: F.get(table, F.ascii(s) - OFFSET))


def error_sum(quality: Column) -> Column:
    """Summed error of a quality string in integer units of 1e-5."""
    return F.aggregate(
        error_units(quality), F.lit(0).cast("bigint"), lambda acc, e: acc + F.coalesce(e, F.lit(0)).cast("bigint")
    )


def unknown_symbols(quality: Column) -> Column:
    """Number of symbols outside Q0..Q41, which count as no score and no error."""
    return F.length(F.regexp_replace(quality, f"[{chr(OFFSET)}-{chr(OFFSET + MAX_Q)}]", ""))


def score_at(quality: Column, pos: Column) -> Column:
    """Score at a 0-based position; missing or unknown counts as 0."""
    return F.coalesce(symbol_score(F.substring(quality, pos + 1, F.lit(1))), F.lit(0))


def score_sum(quality: Column) -> Column:
    return F.aggregate(scores(quality), F.lit(0), lambda acc, q: acc + F.coalesce(q, F.lit(0)))


def packed_scores(quality: Column) -> Column:
    """The ``40;40;...;`` text form: every base followed by ``;``."""
    text = F.transform(scores(quality), lambda q: F.coalesce(q.cast("string"), F.lit("")))
    return F.when(F.length(quality) > 0, F.concat(F.array_join(text, ";"), F.lit(";"))).otherwise(F.lit(""))


def symbols_from_packed(packed: Column) -> Column:
    """Packed scores back to a quality string; an empty or non-numeric item becomes Q0."""
    items = F.split(F.regexp_replace(packed, ";$", ""), ";")
    return F.array_join(
        F.transform(
            items,
            lambda s: F.chr(F.greatest(F.lit(0), F.coalesce(F.trim(s).try_cast("double").cast("int"), F.lit(0))) + OFFSET),
        ),
        "",
    )
