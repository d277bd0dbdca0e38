"""Mixing sources to target weights by entropy balancing.

Targets: the sources in code-point order (a missing source last) weigh 5, 2, 1, 5, 2, 1, ... and share all words by weight. A target stops at
``MAX_COPIES`` times its source's size; the excess is shared again by weight among the others, until none is above.

Rates: among all document rates that meet every source's target, those closest in entropy to 1 are exponential in the document's
size, exp(tilt * size / scale), at most MAX_COPIES; ``scale`` is the source's mean size by word, so tilts are comparable. The tilts
solve a convex dual, one dimension per source: Newton steps, kept inside the interval that is known to hold the solution. Each step is one
aggregation by Spark over (source, size, number of documents), which is far smaller than the documents.

Copies: a rate's whole part is taken, and its fraction by a fixed hash of the document; the threshold that this hash is held
against is set per source so that the words of the copies meet the target. It is found on an aggregated histogram. Copies are a function
of a document's source, size and id, so reruns agree and no document is moved.

A null text has no words and is taken no times; null sources are one source. Repeated rows are treated alike. An empty table, or one without words,
has targets of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellamp.llm.tables import word_count
from cellamp.session import store

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
# Steps stop when every source is within this share of its target.
TOLERANCE = 1e-6
MAX_STEPS = 60
# Classes of the rounding threshold.
CLASSES = 8_192


def source_targets(cells: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, target, scale, docs) from cells (source, size, docs); one row per source.

    Shares after all rounds are weight times a level, cut at the cap: the sources are met in the order of cap per weight, and the
    level is what is left of the total by the weight that is left.
    """
    sizes = cells.groupBy("source").agg(
        F.sum(F.col("size") * F.col("docs")).alias("source_size"),
        F.sum(F.col("size").cast("double") * F.col("size") * F.col("docs")).alias("_square"),
    )
    by_name = W.orderBy(F.col("source").isNull(), F.col("source"))
    listed = F.array(*map(F.lit, weights))
    weighed = sizes.withColumn(
        "weight", F.element_at(listed, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    )
    everything = W.partitionBy()
    fill = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    filled, unfilled = fill.rowsBetween(W.unboundedPreceding, -1), fill.rowsBetween(W.currentRow, W.unboundedFollowing)
    level = (
        F.sum("source_size").over(everything) - cap * F.coalesce(F.sum("source_size").over(filled), F.lit(0))
    ) / F.sum("weight").over(unfilled)
    # The level of the first source in this order that it does not fill holds for all later ones.
    return (
        weighed.withColumn("_level", level)
        .withColumn("_open", F.col("_level") * F.col("weight") <= cap * F.col("source_size"))
        .withColumn("_final", F.min(F.when(F.col("_open"), F.struct(F.col("source_size") / F.col("weight"), "_level"))).over(everything))
        .select(
            "source",
            "source_size",
            F.least(F.col("_final._level") * F.col("weight"), cap * F.col("source_size").cast("double")).alias("target"),
            F.when(F.col("source_size") > 0, F.col("_square") / F.col("source_size")).otherwise(1.0).alias("scale"),
        )
    )


def rate(size: Column, tilt: Column, scale: Column, cap: int = MAX_COPIES) -> Column:
    # Exponents beyond the cap need no value of their own.
    return F.least(F.exp(F.least(tilt * size / scale, F.lit(10.0))), F.lit(float(cap)))


def solve_tilts(cells: DataFrame, targets: DataFrame, cap: int = MAX_COPIES) -> DataFrame:
    """Tilt per source. ``cells`` and ``targets`` are stored tables."""
    # A source whose target is its cap takes every document as often as allowed.
    full = F.col("target") >= cap * F.col("source_size") * (1 - 1e-12)
    state = store(
        targets.select(
            "source", "target", "scale", F.lit(0.0).alias("tilt"), F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"),
            full.alias("done"),
        )
    )
    finished = state.filter("done").withColumn("tilt", F.lit(float("inf")))
    state = state.filter("not done")
    for _ in range(MAX_STEPS):
        r = rate(F.col("size"), F.col("tilt"), F.col("scale"), cap)
        words = F.col("size") * F.col("docs") * r
        slope = F.when(r < cap, words * F.col("size") / F.col("scale")).otherwise(0.0)
        sums = (
            cells.join(state, cells["source"].eqNullSafe(state["source"]))
            .groupBy(state["source"], "target", "scale", "tilt", "low", "high")
            .agg(F.sum(words).alias("words"), F.sum(slope).alias("slope"))
        )
        gap = F.col("words") - F.col("target")
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - F.try_divide(gap, F.col("slope"))
        doubled = F.when(gap < 0, F.greatest(F.lit(1.0), F.col("tilt") * 2)).otherwise(F.least(F.lit(-1.0), F.col("tilt") * 2))
        inside = (newton > F.col("low")) & (newton < F.col("high")) & (F.abs(newton) < F.abs(F.col("tilt")) * 2 + 4)
        bounded = (F.col("low") > float("-inf")) & (F.col("high") < float("inf"))
        step = F.when(inside, newton).when(bounded, (F.col("low") + F.col("high")) / 2).otherwise(doubled)
        state = store(
            sums.withColumn("low", low).withColumn("high", high)
            .withColumn("done", F.abs(gap) <= TOLERANCE * F.greatest(F.col("target"), F.lit(1.0)))
            .select("source", "target", "scale", F.when(F.col("done"), F.col("tilt")).otherwise(step).alias("tilt"), "low", "high", "done")
        )
        if state.filter("not done").isEmpty():
            break
    columns = ["source", "tilt"]
    return finished.select(*columns).union(state.select(*columns))


def _choice(cap: int) -> tuple[Column, Column, Column]:
    """Rate of a document, and the class of its hash relative to the rate's fraction, from the columns doc_id, size, tilt and scale."""
    rates = rate(F.col("size"), F.col("tilt"), F.col("scale"), cap)
    uniform = F.shiftrightunsigned(F.xxhash64("doc_id", "size"), 11) / float(1 << 53)
    placed = F.floor((uniform - (rates - F.floor(rates)) + 1) / 2 * CLASSES)
    return rates, F.floor(rates), placed


def mixing_plan(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_COPIES) -> DataFrame:
    """One stored row per source: (source, source_size, target, scale, tilt, last_class).

    ``sized`` is a stored table (doc_id, source, size).
    """
    cells = store(sized.groupBy("source", "size").agg(F.count("*").alias("docs")))
    targets = store(source_targets(cells, weights, cap))
    tilts = solve_tilts(cells, targets, cap).withColumnRenamed("source", "_source")
    solved = store(targets.join(tilts, targets["source"].eqNullSafe(F.col("_source"))).drop("_source"))
    rates, whole, placed = _choice(cap)
    docs = sized.join(solved.withColumnRenamed("source", "_source"), sized["source"].eqNullSafe(F.col("_source")))
    classes = docs.groupBy("source", F.when(rates < cap, placed).otherwise(CLASSES).alias("class")).agg(
        F.sum("size").alias("words"), F.sum(whole * F.col("size")).alias("whole"), F.first("target").alias("target")
    )
    own = W.partitionBy("source")  # at most CLASSES rows per source
    rest = F.col("target") - F.sum("whole").over(own)
    upto = F.sum("words").over(own.orderBy("class").rowsBetween(W.unboundedPreceding, W.currentRow))
    taken = (F.col("class") < CLASSES) & (upto - F.col("words") / 2 <= rest)
    last = (
        classes.withColumn("_taken", taken)
        .groupBy(F.col("source").alias("_source"))
        .agg(F.coalesce(F.max(F.when(F.col("_taken"), F.col("class"))), F.lit(-1)).alias("last_class"))
    )
    return store(solved.join(last, solved["source"].eqNullSafe(F.col("_source"))).drop("_source"))


def with_copies(docs: DataFrame, plan: DataFrame, cap: int = MAX_COPIES) -> DataFrame:
    """``docs`` (with doc_id, source and size) with source_size, target and copies.

    The plan has a row per source; Spark sends it to all tasks while it is small, and splits the hot sources of a shuffled join otherwise.
    """
    rates, whole, placed = _choice(cap)
    joined = docs.join(plan.withColumnRenamed("source", "_source"), docs["source"].eqNullSafe(F.col("_source")))
    extra = F.when((rates < cap) & (placed <= F.col("last_class")), 1).otherwise(0)
    return joined.withColumn("copies", (whole + extra).cast("int")).drop("_source", "scale", "tilt", "last_class")


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """(doc_id, source, size, source_size, target, copies), one row per row of ``docs``; texts are read once."""
    sized = store(
        docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size"))
    )
    return with_copies(sized, mixing_plan(sized))
