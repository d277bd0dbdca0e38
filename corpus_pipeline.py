"""The documents' way to training shards: language, near-duplicates, benchmark leaks, mixture, shards.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All stages but the last return the
columns of documents, also those whose names the operators use for results: a stage carries the row as one struct beside what it needs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellamp.llm import decontaminate, language, mixing, shards, simhash
from cellamp.llm.tables import table, word_count
from cellamp.session import shared_dir, store


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep texts with letters, unless they are long and no nearer to any learned language than noise is."""
    profiles = language.learn_profiles(docs.filter(~language.held_out()))
    found = docs.select(F.struct("*").alias("row"), "text", language.identify(F.col("text"), profiles).alias("found"))
    near = (F.col("found.score") > language.noise_level()) | language.is_short(F.col("text"))
    return found.filter((F.col("found.lang_pred") != language.UNKNOWN) & near).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of every SimHash group (four-word shingles, links at 4 bits or fewer): that with the smallest id.

    Rows without an id come last; a group that has only such rows keeps one of them. Of rows that share the kept id, the one with
    the smallest fingerprint stays, and of those with equal fingerprints the one with the smallest digest of its columns.
    """
    heads = simhash.near_duplicates(docs).filter("doc_id <=> component_id").groupBy("doc_id", "group")
    heads = store(heads.agg(F.min("print").alias("print"), F.count("*").alias("rows")))
    # An id is told apart from its repeats by more than its number; there are none in most tables.
    doubtful = store(heads.groupBy("doc_id").agg(F.sum("rows").alias("rows")).filter("rows > 1 or doc_id is null").select("doc_id"))
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "text")
    plain = rows.join(heads.join(doubtful, "doc_id", "left_anti").filter("doc_id is not null"), "doc_id", "left_semi").select("row.*")
    if doubtful.isEmpty():
        return plain
    repeated = rows.join(doubtful.withColumnRenamed("doc_id", "id"), F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    repeated = store(
        repeated.select("row", "doc_id", simhash.fingerprint(F.col("text")).alias("print"), F.sha2(F.to_json("row"), 256).alias("digest"))
    )
    chosen = heads.select(F.col("doc_id").alias("id"), F.col("print").alias("least"))
    own = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("print") == F.col("least"))
    first = store(repeated.join(chosen, own, "left_semi").groupBy("doc_id", "print").agg(F.min("digest").alias("digest")))
    first = first.select(F.col("doc_id").alias("id"), F.col("print").alias("least"), F.col("digest").alias("lowest"))
    stay = repeated.join(first, own & (F.col("digest") == F.col("lowest")), "left_semi").dropDuplicates(["doc_id", "print", "digest"])
    return plain.unionByName(stay.select("row.*"))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep texts that hold no benchmark item."""
    return docs.filter(~decontaminate.holds_leak(docs, table(spark, sf_dir, "benchmark")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take every document as often as the mixture says: a row per copy."""
    plan = mixing.mixing_plan(store(docs.select("doc_id", "source", word_count().alias("size"))))
    mixed = mixing.with_copies(docs.select(F.struct("*").alias("row"), "doc_id", "source", word_count().alias("size")), plan)
    copies = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return mixed.filter("copies > 0").select("row", copies.alias("copy")).select("row.*")


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every row goes: its id, source, bytes and shard."""
    return shards.assign_shards(docs.select("doc_id", "source", "text")).select("doc_id", "source", "n_bytes", "shard")


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("sharding", deal_shards),
]

# Hyperdimensional profiles, SimHash components and alignments have no SQL; a brute-force version checks run() instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written to the shared folder and read again by the next one."""
    docs = table(spark, sf_dir, "documents")
    root = f"{shared_dir(spark).rstrip('/')}/cellamp/{spark.sparkContext.applicationId}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{root}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
