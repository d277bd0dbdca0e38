"""Hamming joins by segments: all pairs at any number of segments, keys that suit the lists, bounded copies."""

import random

import pytest
from pyspark.sql import functions as F

from cellamp.operators import whitelist


def lists(spark, obs, wl):
    a = spark.createDataFrame([(b,) for b in obs], "bc string")
    return a, spark.createDataFrame(list(zip(wl, range(len(wl)))), "bc string, wl_idx bigint")


def parts(a, b):
    return a.select(F.col("bc").alias("obs"), F.col("bc").alias("_part")), b.select("bc", "wl_idx", F.col("bc").alias("_part"))


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_any_number_of_segments_gives_every_pair_once(distance, spark):
    rng = random.Random(distance)
    draw = lambda n: sorted({"".join(rng.choice("ACG") for _ in range(7)) for _ in range(n)})
    obs, wl = draw(60), draw(60)
    a, b = lists(spark, obs, wl)
    apart = lambda x, y: sum(p != q for p, q in zip(x, y))
    want = sorted((x, y, apart(x, y)) for x in obs for y in wl if apart(x, y) <= distance)
    for segments in (distance + 1, distance + 2, 7, 9):
        got = whitelist.near_prefixes(a, b, distance, 0, 7, segments).select("obs", "bc", "distance").collect()
        assert sorted(map(tuple, got)) == want


def test_a_spread_list_has_a_key_per_segment(spark):
    rng = random.Random(1)
    wl = sorted({"".join(rng.choice("ACGT") for _ in range(16)) for _ in range(2_000)})
    a, b = parts(*lists(spark, wl, wl))
    segments, pairs = whitelist.segment_count(a, b, 2, 16)
    assert segments == 3 and whitelist._cut(a, 3, 2).count() == 3 * len(wl)
    assert pairs <= whitelist.PAIRS_PER_KEY * 2 * 3 * len(wl)


def test_barcodes_that_share_most_letters_get_longer_keys(spark):
    """All barcodes agree in twelve of sixteen letters, so keys of a segment would pair them all."""
    wl = ["ACGT" * 3 + "".join("ACGT"[n >> 2 * k & 3] for k in range(4)) for n in range(256)]
    a, b = lists(spark, wl, wl)
    segments, pairs = whitelist.segment_count(*parts(a, b), 2, 16)
    assert segments > 3 and pairs < 3 * 256 * 256
    # Of four letters each: 1 + 4 * 3 + 6 * 9 barcodes within two places.
    assert whitelist.hamming_join(a, b, 2, 16).count() == 256 * 67


def test_lists_without_barcodes(spark):
    a, b = lists(spark, [], [])
    assert whitelist.hamming_join(a, b, 2, 16).count() == 0
    a, b = lists(spark, ["", "A"], ["", "C"])
    got = {(r.obs, r.bc, r.distance) for r in whitelist.hamming_join(a, b, 2, 16).collect()}
    assert got == {("", "", 0), ("", "C", 1), ("A", "", 1), ("A", "C", 1)}
