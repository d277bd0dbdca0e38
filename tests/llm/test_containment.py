"""Sketches of unequal texts: complete ones, those below the threshold, and their unions."""

import random

import pytest
from pyspark.sql import functions as F

from cellamp.llm import sketch
from cellamp.llm.queries import QUERIES
from tests.llm import brute

SKETCHES = "a string, b string"


def pairs(spark, rows):
    frame = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], f"n int, {SKETCHES}")
    for name in ("a", "b"):
        frame = sketch.with_sketch(frame, name, f"s{name}")
    return frame


@pytest.fixture(scope="module")
def unequal():
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(10**6)}"
    rows = []
    for n in range(120):
        long = [word() for _ in range(600)]
        at, size = rng.randrange(500), 1 + n % 60
        rows.append((" ".join(long[at : at + max(5, size)]), " ".join(long)))
    return rows


def test_a_text_inside_a_longer_one_is_contained(spark, unequal):
    a, b = F.col("sa"), F.col("sb")
    at_hand = sketch.likeness_of_texts(a, b, F.col("a"), F.col("b"))
    turned = sketch.likeness_of_texts(b, a, F.col("b"), F.col("a"))
    got = pairs(spark, unequal).select(at_hand.alias("x"), turned.alias("y"), sketch.likeness(a, b).alias("alone")).collect()
    assert {r.x for r in got} == {r.y for r in got} == {1.0}
    # Sketches alone are right or say nothing.
    assert {r.alone for r in got} == {1.0, None}


def test_likeness_is_exact_for_short_texts_and_near_for_long_ones(spark):
    rng = random.Random(3)
    draw = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    rows = [(draw(rng.randrange(1, 40)), draw(rng.randrange(1, 200))) for _ in range(80)] + [("", ""), ("", "a b"), (None, " \n"), ("a", None)]
    near = sketch.likeness_of_texts(F.col("sa"), F.col("sb"), F.coalesce("a", F.lit("")), F.coalesce("b", F.lit("")))
    got = {r.n: r.near for r in pairs(spark, rows).select("n", near.alias("near")).collect()}
    for n, (a, b) in enumerate(rows):
        assert got[n] == pytest.approx(brute.likeness(a, b)), (a, b)


def test_a_sketch_is_the_plain_one_and_unions_are_sketches(spark):
    rng = random.Random(5)
    sizes = [0, 1, 4, 5, 60, 68, 69, 70, 200, 2000]
    rows = [(" ".join(f"w{rng.randrange(5000)}" for _ in range(s)), " ".join(f"w{rng.randrange(5000)}" for _ in range(t))) for s in sizes for t in sizes]
    # The union of two texts' shingles is the set of their joined shingles; one-word shingles make a joined text have just those.
    frame = spark.createDataFrame([(*r, " ".join(r).strip()) for r in rows], f"{SKETCHES}, both string")
    for name in ("a", "b", "both"):
        frame = sketch.with_sketch(frame, name, f"s{name}", words=1)
    frame = frame.withColumn("m", sketch.merged(F.col("sa"), F.col("sb")))
    hashes = frame.withColumn("plain", sketch.text_shingles(F.col("a"), 1))
    seen = set()
    for r in hashes.collect():
        assert r.m == r.sboth
        whole = sorted(set(r.plain))
        assert len(whole) == len(set(r.a.split()))
        assert r.sa.complete == (len(whole) <= sketch.COMPLETE)
        assert r.sa.hashes == (whole if r.sa.complete else [h for h in whole if 0 <= h < 2**64 // sketch.FRACTION])
        seen.add((r.sa.complete, r.sb.complete, r.m.complete))
    assert len(seen) == 5
    with pytest.raises(ValueError):
        sketch.with_sketch(frame, "a", "x", fraction=1)


def test_the_query_against_plain_sets(spark, sf_dir):
    """Every document: exact where a set is small, within a sampling error elsewhere, and no false zero."""
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    ids = sorted(rows)
    texts = [rows[k] for k in ids]
    edits = brute.edited(texts)
    got = {r.doc_id: r for r in QUERIES["op8_fingerprints"](spark, sf_dir).collect()}
    for n, k in enumerate(ids):
        for near, other in ((got[k].near_edited, edits[n]), (got[k].near_next, texts[(n + 1) % len(texts)])):
            want, size = brute.likeness(texts[n], other), min(len(brute.shingles(texts[n])), len(brute.shingles(other)))
            if size <= sketch.COMPLETE:
                assert near == pytest.approx(want)
            else:
                # Six standard deviations of a share of a sample of one in FRACTION; the smaller sketch may belong to the larger of like sets.
                assert abs(near - want) <= 6 * (0.25 * sketch.FRACTION / size) ** 0.5 + 0.02


def test_successors_across_blocks_and_for_repeated_rows(spark):
    rng = random.Random(2)
    for total in (1, 2, sketch.BLOCK, sketch.BLOCK + 1, 3 * sketch.BLOCK + 5):
        texts = [" ".join(rng.choice("abcdef") for _ in range(rng.randrange(30))) for _ in range(total)]
        rows = [(3 * k, t) for k, t in enumerate(texts)]
        frame = spark.createDataFrame(rows + rows[:3], "doc_id bigint, text string").repartition(4)
        got = sketch.compare_with_edits(frame).collect()
        want = {k: brute.sha256(e) for (k, _), e in zip(rows, brute.edited(texts), strict=True)}
        assert len(got) == len(rows) + len(rows[:3])
        assert {(r.doc_id, r.edited_sha256) for r in got} == set(want.items())
