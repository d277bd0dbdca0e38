"""Bayesian rescue of barcodes one substitution away from the whitelist.

Everything that depends only on the barcode is worked out once per distinct barcode; the reads meet that
small table in one salted join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellamp.config import Params
from cellamp.functions.phred import score_at
from cellamp.operators.skew import salted_lookup
from cellamp.operators.whitelist import flag_whitelisted, hamming1_candidates, listed_barcodes, observed_barcodes
from cellamp.session import store

RESCUED, NO_CANDIDATE, NOT_SIGNIFICANT, NO_PRIOR = "RESCUED", "No_Hamm_1", "Not_Sig", "NO_in_SAVED"
# Scores above this count as this in the posterior.
SCORE_CAP = 33


def prior_counts(observed: DataFrame, params: Params = Params()) -> DataFrame:
    """Primed reads per whitelisted barcode (per chunk when asked), from the flagged observed barcodes."""
    return observed.filter("listed").select(*params.chunk_cols, "bc", "n_reads")


def barcode_candidates(observed: DataFrame, whitelist: DataFrame, params: Params = Params()) -> DataFrame:
    """Per unlisted barcode its candidates in whitelist order, each with position and prior read count.

    A barcode has at most one candidate per place and letter, so the array is bounded by the barcode length.
    """
    keys = list(params.chunk_cols)
    unlisted = observed.filter("NOT listed").select(*keys, "bc")
    priors = prior_counts(observed, params)
    if keys:
        pairs = hamming1_candidates(unlisted.select("bc").distinct(), whitelist, params.bc_len)
        pairs = pairs.join(unlisted.withColumnRenamed("bc", "obs"), "obs").join(priors, [*keys, "bc"], "left")
    else:
        pairs = hamming1_candidates(unlisted, whitelist.join(priors, "bc", "left"), params.bc_len)
    candidate = F.struct("wl_idx", "bc", "pos", F.coalesce("n_reads", F.lit(0)).alias("n_reads"))
    grouped = pairs.groupBy(*keys, "obs").agg(F.array_sort(F.collect_list(candidate)).alias("candidates"))
    return grouped.withColumnRenamed("obs", "bc")


def _total(candidates: Column) -> Column:
    return F.aggregate(candidates, F.lit(0).cast("bigint"), lambda acc, c: acc + c["n_reads"])


def scored_candidates(candidates: Column, bc_qual: Column) -> Column:
    """Candidates with prior, edit probability and likelihood for the qualities of one read."""
    total = _total(candidates)

    def score(c):
        prior = F.when(total > 0, c["n_reads"] / total.cast("double")).otherwise(F.lit(0.0))
        q = F.when(c["n_reads"] > 0, F.least(F.lit(SCORE_CAP), score_at(bc_qual, c["pos"]))).otherwise(F.lit(0))
        edit = F.pow(F.lit(10.0), -(q / F.lit(10.0)))
        return F.struct(
            c["bc"].alias("bc"), c["n_reads"].alias("n_reads"), prior.alias("prior"), edit.alias("p_edit"),
            (prior * edit).alias("likelihood"),
        )

    return F.transform(candidates, score)


def with_posteriors(scored: Column) -> Column:
    total = F.aggregate(scored, F.lit(0.0), lambda acc, c: acc + c["likelihood"])
    return F.transform(
        scored,
        lambda c: c.withField("posterior", F.when(total > 0, c["likelihood"] / total).otherwise(F.lit(0.0))),
    )


def posteriors(unlisted: DataFrame) -> DataFrame:
    """One row per read and candidate: prior, edit probability, likelihood and posterior."""
    scored = unlisted.withColumn("scored", scored_candidates(F.col("candidates"), F.col("bc_qual")))
    post = scored.withColumn("scored", with_posteriors(F.col("scored")))
    return post.select("read_id", F.col("bc").alias("original_bc"), F.explode("scored").alias("c")).select(
        "read_id", "original_bc", F.col("c.bc").alias("candidate"), "c.n_reads", "c.prior", "c.p_edit",
        "c.likelihood", "c.posterior",
    )


def decide(unlisted: DataFrame, params: Params = Params()) -> DataFrame:
    """Append ``status`` and ``replaced_bc`` to reads that carry ``candidates`` and ``bc_qual``.

    With at most one candidate that has reads, the outcome does not depend on the qualities; the posterior is
    only computed for the other reads.
    """
    cand = F.col("candidates")
    backed = F.filter(cand, lambda c: c["n_reads"] > 0)
    n_backed = F.coalesce(F.size(backed), F.lit(0))
    zero_prior = F.lit(NOT_SIGNIFICANT if params.zero_prior_not_sig else NO_PRIOR)
    known = (
        F.when(cand.isNull(), F.struct(F.lit(NO_CANDIDATE).alias("status"), F.lit(None).cast("string").alias("bc")))
        .when((n_backed == 0) & (F.size(cand) > 1) & F.lit(not params.zero_prior_not_sig or params.posterior > 0),
              F.struct(zero_prior.alias("status"), F.lit(None).cast("string").alias("bc")))
        .when((n_backed == 0) & F.lit(params.posterior > 0),
              F.struct(F.lit(NOT_SIGNIFICANT).alias("status"), F.lit(None).cast("string").alias("bc")))
        .when((n_backed == 1) & F.lit(params.posterior <= 1),
              F.struct(F.lit(RESCUED).alias("status"), F.get(backed, F.lit(0))["bc"].alias("bc")))
    )
    step = unlisted.withColumn("_known", known)
    step = step.withColumn("_scored", scored_candidates(F.when(F.col("_known").isNull(), cand), F.col("bc_qual")))
    step = step.withColumn("_scored", with_posteriors(F.col("_scored")))
    step = step.withColumn("_top", F.array_max(F.transform("_scored", lambda c: c["posterior"])))
    step = step.withColumn("_best", F.filter("_scored", lambda c: c["posterior"] == F.col("_top")))
    tie_of_two = (F.size("_best") == 2) & (F.abs(F.col("_top") - 0.5) < 1e-12)
    weighed = F.when((F.col("_top") >= params.posterior) & ~tie_of_two, F.lit(RESCUED)).otherwise(NOT_SIGNIFICANT)
    status = F.coalesce(F.col("_known.status"), weighed)
    first = F.coalesce(F.col("_known.bc"), F.get("_best", F.lit(0))["bc"])
    return (
        step.withColumn("status", status)
        .withColumn("replaced_bc", F.when(F.col("status") == RESCUED, first))
        .drop("_known", "_scored", "_top", "_best", "candidates")
    )


def with_candidates(
    unlisted: DataFrame, observed: DataFrame, whitelist: DataFrame, params: Params = Params(), how: str = "left"
) -> DataFrame:
    """Reads outside the whitelist with the candidates of their barcode, hot barcodes salted.

    ``observed`` is the stored table of flagged barcodes with their read counts.
    """
    keys = [*params.chunk_cols, "bc"]
    candidates = barcode_candidates(observed, whitelist, params)
    return salted_lookup(unlisted, candidates, keys, observed, "n_reads", "read_id", how)


def _changed(
    primed: DataFrame, flagged: DataFrame, whitelist: DataFrame, params: Params, how: str
) -> DataFrame:
    observed = store(listed_barcodes(observed_barcodes(primed, params.chunk_cols), whitelist))
    unlisted = flagged.filter("whitelist = 'N'")
    return decide(with_candidates(unlisted, observed, whitelist, params, how), params)


def changed_reads(primed: DataFrame, whitelist: DataFrame, params: Params = Params()) -> DataFrame:
    """The reads outside the whitelist, each with its rescue status and replacement. ``primed`` must be stored."""
    return _changed(primed, flag_whitelisted(primed, whitelist), whitelist, params, "left")


def corrected_reads(primed: DataFrame, whitelist: DataFrame, params: Params = Params()) -> DataFrame:
    """Whitelisted reads (``part`` 0) and rescued reads under their new barcode (``part`` 1).

    ``primed`` must be stored: it is scanned for the counts and for each of the two parts. Reads without any
    candidate are left out by the join that brings the candidates.
    """
    flagged = flag_whitelisted(primed, whitelist)
    listed = flagged.filter("whitelist = 'Y'").withColumn("part", F.lit(0))
    rescued = _changed(primed, flagged, whitelist, params, "inner").filter(F.col("status") == RESCUED)
    rescued = rescued.withColumn("bc", F.col("replaced_bc")).withColumn("part", F.lit(1))
    return listed.unionByName(rescued.select(listed.columns))
