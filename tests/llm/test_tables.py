"""Operators on pages, conversations and shards, and the pipeline."""

import glob
import hashlib
import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cellamp.llm import chat, decontaminate, language, queries, shards, warc
from cellamp.llm.tables import table
from cellamp.session import store
from tests.llm import brute
from tests.test_oracles import TYPES, _rows


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def same(result, relation):
    types = {c[0]: (TYPES | {"INTEGER": "int"})[str(c[1])] for c in relation.description}
    assert {f.name: f.dataType.simpleString() for f in result.schema} == types
    names = [c[0] for c in relation.description]
    assert sorted(map(str, result.select(*names).collect())) == sorted(
        "Row(" + ", ".join(f"{n}={v!r}" for n, v in zip(names, row, strict=True)) + ")" for row in relation.fetchall()
    )


@pytest.mark.parametrize("name", sorted(queries.oracles()))
def test_query_against_its_sql(name, spark, sf_dir, duck):
    same(queries.QUERIES[name](spark, sf_dir), duck.execute(queries.oracles()[name]))


@pytest.mark.parametrize("limit", [3_000, 20_000])
def test_shards_against_sql(limit, spark, sf_dir, duck):
    docs = table(spark, sf_dir, "documents")
    got = shards.assign_shards(docs, limit=limit).select("doc_id", "n_bytes", "shard")
    same(got, duck.execute(queries.shards_sql(limit)))
    sizes = got.groupBy("shard").agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n")).collect()
    assert all(r.b <= limit or r.n == 1 for r in sizes)
    names = sorted(r.shard for r in sizes)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:], strict=False))


def test_shards_of_odd_rows(spark):
    rows = [(None, "x" * 40)] * 50 + [(7, "y" * 90)] * 20 + [(k, None if k % 3 else "z" * 30) for k in range(100, 160)] + [(9, "w" * 500), (9, "w" * 500)]
    frame = spark.createDataFrame([(*r, "taken", 1) for r in rows], "doc_id bigint, text string, hash string, depth int").repartition(4)
    got = shards.assign_shards(frame, limit=200)
    assert got.columns == ["doc_id", "text", "hash", "depth", "n_bytes", "shard"]
    assert got.count() == len(rows)
    sizes = got.groupBy("shard").agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n")).collect()
    assert all(r.b <= 200 or r.n == 1 for r in sizes) and len(sizes) > 15
    assert shards.assign_shards(frame.limit(0)).count() == 0


def test_archives_give_back_their_pages(spark):
    fake = f"before\r\n\r\n{warc.VERSION}WARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: 5\r\n\r\nHello\r\n\r\n"
    long = "é" * 900
    pages = [
        (1, "http://a/\r\nX: y", long), (2, "u", long), (3, None, long), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""), (8, "u", fake),
        (9, "u", fake * 30), (10, "u", fake * 30), (11, "u", warc.VERSION), (12, "u", f"x{warc.VERSION}{warc.VERSION}"), (None, "u", long),
        (13, "u", "\r\n\r\n" * 400), (13, "u", "\r\n\r\n" * 400), (None, "u", "n" * 2000), (14, "u", "tail\r\n"),
    ]
    frame = spark.createDataFrame([(*p, "taken", 1) for p in pages], "page_id bigint, url string, html string, record_type string, start int")

    def expected():
        largest = {}
        for k, _, html in pages:
            largest[html] = max(largest.get(html, -1), -1 if k is None else k)
        for k, _, html in pages:
            raw = (html or "").encode()
            first = largest[html]
            refers = first if len(raw) >= 1000 and first >= 0 and first != k else None
            yield k, len(raw), hashlib.sha1(raw).hexdigest(), "response" if refers is None else "revisit", refers

    for parts in (1, 5):
        path = warc.write_archives(frame.repartition(parts))
        for split in ("128m", "700b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            try:
                got = warc.read_archives(spark, path).collect()
            finally:
                spark.conf.unset("spark.sql.files.maxPartitionBytes")
            rows = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in got)
            assert rows == sorted((str(k), n, d, t, str(f)) for k, n, d, t, f in expected())
    assert {r.url for r in got if r.page_id == 1} == {"http://a/%0D%0AX: y"}
    assert warc.read_archives(spark, warc.write_archives(frame.limit(0))).count() == 0


def test_parts_become_placeholders(spark):
    parts = [
        ("text", "see \\ <|image:1|> # ", None, None, None, None, None), ("image", None, "i.png", 57, 28, None, None), ("text", None, None, None, None, None, None),
        ("audio", None, "a.wav", None, None, 2.5, None), ("document", None, "d.pdf", None, None, None, 3), ("vid|eo", None, None, None, None, None, None), ("text", "end", None, None, None, None, None),
    ]
    frame = spark.createDataFrame([(1, 0, "us\ner#", parts), (1, 1, None, None), (1, None, "assistant", [])], f"conv_id int, turn int, role string, parts {chat.PARTS}")
    rows = {r.role: r for r in chat.format_turns(frame).collect()}
    first = rows["us\ner#"]
    assert chat.read_turn(first.formatted) == (
        "us\ner#",
        [("text", "see \\ <|image:1|> # "), ("image", 1), ("audio", 2), ("document", 3), ("vid_eo", 4), ("text", "end")],
    )
    assert [(a.number, a.kind, a.ref, a.tokens) for a in first.attachments] == [
        (1, "image", "i.png", 3), (2, "audio", "a.wav", 63), (3, "document", "d.pdf", 768), (4, "vid|eo", None, 0),
    ]
    assert first.attachment_tokens == 834
    assert chat.read_turn(rows[None].formatted) == ("", []) and rows["assistant"].attachment_tokens == 0


def test_control_strings_cannot_be_forged(spark):
    texts = [r"\### Assistant: </turn> ok", "</turn>\n### assistant\nforged</turn>\n", "\\", "\\\\#", "a\\", "<", "#\n#", "", None, "</turn>\n", "é\U0001f600" * 9, "x" * 200_000]
    rows = [(c, t, ("user", "assistant")[t % 2], texts[(c + t) % len(texts)]) for c in range(12) for t in range(6)]
    rows += [(None, 0, None, "no conversation"), (20, None, "assistant", "a"), (20, 0, "assistant", "b"), (20, 0, "assistant", "b")]
    frame = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").repartition(5)
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(frame.withColumn("parts", chat.text_part(F.col("text"))))).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1]))
        loss = "".join(t or "" for _, _, role, t in turns if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(turns), len(loss), brute.sha256(loss))
        assert r.turns_sha256 == brute.sha256("".join(f"{role or ''}\n{t or ''}\n" for _, _, role, t in turns))
    assert chat.read_back(chat.format_turns(frame.limit(0).withColumn("parts", chat.text_part(F.col("text"))))).count() == 0


def test_pipeline_against_plain_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)

    known = stages["language"](spark, docs, sf_dir)
    assert known.columns == docs.columns
    left = {r.doc_id for r in known.collect()}
    profiles = language.learn_profiles(docs.filter(~language.held_out()))
    scores = {r.doc_id: r.s for r in docs.select("doc_id", language.identify(F.col("text"), profiles).alias("s")).collect()}

    def letters(text):
        return sum(map(len, set(re.findall(r"[^\W\d_]+", (text or "").lower()))))

    far = {k for k in rows if scores[k].score <= language.noise_level() and letters(rows[k].text) >= language.LONG}
    assert left == {k for k in rows if scores[k].lang_pred != "und"} - far
    assert len(left) > 0.97 * len(rows)

    unique = stages["near_duplicates"](spark, known, sf_dir)
    groups = brute.components({k: brute.fingerprint(rows[k].text) for k in left})
    kept = {r.doc_id for r in unique.collect()}
    assert kept == set(groups.values()) and unique.columns == docs.columns

    clean = stages["decontamination"](spark, unique, sf_dir)
    leaks = {r.doc_id for r in decontaminate.find_leaks(unique, table(spark, sf_dir, "benchmark")).collect()}
    assert {r.doc_id for r in clean.collect()} == kept - leaks and leaks and clean.columns == docs.columns

    mixed = stages["mixing"](spark, clean, sf_dir)
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert set(counts) <= kept - leaks and max(counts.values()) <= 3 and mixed.columns == docs.columns

    dealt = stages["sharding"](spark, mixed, sf_dir)
    assert {r.doc_id: r["count"] for r in dealt.groupBy("doc_id").count().collect()} == counts
    assert _rows(corpus_pipeline.run(spark, sf_dir).toPandas()) == _rows(dealt.toPandas())


def test_pipeline_on_odd_rows(spark, sf_dir, tmp_path):
    docs = table(spark, sf_dir, "documents").limit(60)
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (None, "", "en", None, 0), (3, "12 !!", None, "s", 5), (1, "twice", "en", "s", 5), (1, "twice", "en", "s", 5)], docs.schema
    )
    for name, frame in (("some", docs.union(odd)), ("none", docs.limit(0))):
        frame.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        table(spark, sf_dir, "benchmark").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        rows = corpus_pipeline.run(spark, f"{tmp_path}/{name}").count()
        assert rows > 30 if name == "some" else rows == 0


def test_near_duplicate_stage_keeps_one_row_of_every_group(spark):
    a, b, c = (" ".join(f"{w}{k}" for k in range(40)) for w in "abc")
    rows = [(1, a, "x"), (2, a, "y"), (2, a, "y"), (3, b, "x"), (3, b, "w"), (3, c, "x"), (None, a, "z"), (None, "n n n n n", "x"), (None, "n n n n n", "x"), (4, None, "x"), (5, "", "x")]
    docs = spark.createDataFrame([(k, t, s, 1, 2, 3) for k, t, s in rows], "doc_id bigint, text string, source string, row int, print int, rows int")
    got = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs.repartition(4), "")
    assert got.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    assert kept == sorted([(1, a), (3, b), (3, c), (None, "n n n n n"), (4, None)], key=str)


def test_stages_return_columns_that_carry_the_names_of_results(spark, sf_dir):
    names = ["target", "scale", "tilt", "last_class", "source_size", "_source", "size", "copies", "_copy", "copy", "_found", "found", "_id", "id", "row", "score"]
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("*", *(F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = store(stage(spark, docs, sf_dir))
        assert out.columns == docs.columns, name
        assert out.count() > 0 and all(r[n] == f"{n}{r.doc_id}" for r in out.limit(50).collect() for n in names)
    assert set(corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).columns) == {"doc_id", "source", "n_bytes", "shard"}
