"""One registered query per operator, over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellamp.llm import alignment, chat, clustering, decontaminate, extraction, language, licenses, mixing, shards, simhash, sketch, token_counts, warc
from cellamp.llm.tables import table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shards.assign_shards(docs).select("doc_id", "n_bytes", "shard")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        vocabulary = file.read()
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    turns = table(spark, sf_dir, "conversations").select(*columns)
    control = r"\### Assistant: </turn> ok"
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in turns.schema)
    extra = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], types)
    parts = turns.union(extra).withColumn("parts", chat.text_part(F.col("text")))
    return chat.read_back(chat.format_turns(parts))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language.held_out())
    profiles = language.learn_profiles(docs.filter("not held_out"))
    found = docs.withColumn("found", language.identify(F.col("text"), profiles))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(spark, archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.as_hex(F.col("print")).alias("fingerprint"), "component_id")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.compare_with_edits(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    taken = (F.col("copies") * F.col("size")).cast("bigint")
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table has no paths; its source and language serve as folders."""
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), F.col("doc_id").cast("string"))
    return licenses.scan_licenses(table(spark, sf_dir, "documents").withColumn("path", path))


def op11_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(table(spark, sf_dir, "embeddings"))


def op12_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        vocabulary = file.read()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        model = file.read()
    return alignment.align(table(spark, sf_dir, "documents"), alignment.Tokenizers(vocabulary, model))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontaminate, op2_shards, op3_token_counts, op4_chat, op5_language, op6_warc, op7_simhash, op8_fingerprints, op9_mixing,
        op10_licenses, op11_clustering, op12_extraction, op13_alignment,
    )
}


def shards_sql(limit: int = shards.LIMIT, levels: int = 24) -> str:
    """Sizes of all prefixes; a document's depth is the number of its prefixes that are too large."""
    return f"""
WITH keyed AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS hash
  FROM documents),
sizes AS (
  SELECT depth, hash >> (60 - depth) AS prefix, sum(n_bytes) AS bytes, count(*) AS n
  FROM keyed, range(0, {levels}) AS l(depth) GROUP BY ALL),
splits AS (SELECT depth, prefix FROM sizes WHERE bytes > {limit} AND n > 1),
placed AS (
  SELECT k.doc_id, k.n_bytes, k.hash, count(s.depth) AS depth
  FROM keyed k LEFT JOIN splits s ON s.prefix = k.hash >> (60 - s.depth) GROUP BY ALL)
SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(hash >> (60 - depth)), depth::INT, '0') END AS shard
FROM placed"""


CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(13 + length(regexp_replace(role, '([\\#<\n])', '..', 'g'))
              + length(regexp_replace(text, '([\\#<])', '..', 'g')))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id"""

WARC_SQL = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
named AS (
  SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS payload_digest,
         max(page_id) OVER (PARTITION BY payload) AS largest
  FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> largest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> largest THEN largest END AS refers_to
FROM named"""


def clustering_sql(clusters: int = clustering.CLUSTERS, rounds: int = clustering.ROUNDS, dimensions: int = clustering.DIMENSIONS) -> str:
    """Every round as two tables: the nearest centroid of each vector, and the new centroids."""
    parts = [f"""
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id::BIGINT AS vec_id,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v,
         sha256('{clustering.SEED}:' || vec_id::VARCHAR) AS hash
  FROM embeddings
  WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY hash NULLS LAST, v) - 1)::INTEGER AS cluster, v FROM vectors
  QUALIFY row_number() OVER (ORDER BY hash NULLS LAST, v) <= {clusters})"""]
    for k in range(rounds + 1):
        parts.append(f"""
d{k} AS (
  SELECT row, cluster, list_sum(list_transform(range(1, {dimensions + 1}), lambda i: (a.v[i] - c.v[i]) * (a.v[i] - c.v[i])))::BIGINT AS distance
  FROM vectors a, c{k} c),
a{k} AS MATERIALIZED (
  SELECT row, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance FROM d{k} GROUP BY row)""")
        if k < rounds:
            parts.append(f"""
m{k} AS (
  SELECT cluster, i, floor(sum(v.v[i]) / count(*))::BIGINT AS x
  FROM a{k} JOIN vectors v USING (row), range(1, {dimensions + 1}) AS r(i) GROUP BY cluster, i),
c{k + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(n.v, c.v) AS v
  FROM c{k} c LEFT JOIN (SELECT cluster, list(x ORDER BY i) AS v FROM m{k} GROUP BY cluster) n USING (cluster))""")
    return ",".join(parts) + f"""
SELECT vec_id, a.cluster, distance, (sum(distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN vectors USING (row) JOIN c{rounds} c ON c.cluster = a.cluster"""


def oracles() -> dict[str, str]:
    return {"op2_shards": shards_sql(), "op4_chat": CHAT_SQL, "op6_warc": WARC_SQL, "op11_clustering": clustering_sql()}
