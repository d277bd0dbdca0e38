"""Joins with hot keys and ranks without a global sort."""

import random

import pytest
from pyspark.sql import functions as F

from cellamp.operators import ranking, skew
from cellamp.session import store


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_lookup_equals_a_plain_join(spark, how):
    """One key holds almost all rows, one hot key and some cold keys have no match."""
    rows = store(
        spark.range(9000).select(
            F.col("id").alias("read_id"),
            F.when(F.col("id") < 6000, "hot").when(F.col("id") < 8900, "lost").otherwise(F.concat(F.lit("k"), "id")).alias("bc"),
        )
    )
    sizes = store(rows.groupBy("bc").agg(F.count("*").alias("n")))
    assert {r.bc for r in skew.hot_keys(sizes, ["bc"], "n").collect()} == {"hot", "lost"}
    dim = store(sizes.filter("bc <> 'lost' AND bc NOT LIKE '%5'").select("bc", F.length("bc").alias("size")))
    salted = skew.salted_lookup(rows, dim, ["bc"], sizes, "n", "read_id", how)
    plain = rows.join(dim, "bc", how).select(salted.columns)
    assert salted.count() == plain.count() and salted.exceptAll(plain).isEmpty()


def test_hot_rows_are_spread(spark):
    rows = spark.range(20000).select(F.col("id").alias("read_id"), F.lit("hot").alias("bc"))
    sizes = store(rows.groupBy("bc").agg(F.count("*").alias("n")))
    dim = store(sizes.select("bc", F.lit(1).alias("x")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.salted_lookup(rows, dim, ["bc"], sizes, "n", "read_id")
        per_task = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(per_task) == 8 and max(r["count"] for r in per_task) < 20000 * 0.25


def test_size_check_and_marking(spark):
    few = spark.range(5).select(F.col("id").alias("bc"), F.lit(True).alias("flag"))
    assert skew.fits_broadcast(few, 5) and not skew.fits_broadcast(few, 4)


def test_bucketed_rank(spark):
    rng = random.Random(4)
    words = list({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))) for _ in range(500)})
    df = store(spark.createDataFrame([(w,) for w in words], "w string"))
    ranked = ranking.bucketed_rank(df, F.substring("w", 1, 2), [F.col("w")], "rank").collect()
    assert [r.w for r in sorted(ranked, key=lambda r: r["rank"])] == sorted(words)
    assert sorted(r["rank"] for r in ranked) == list(range(len(words)))


def test_broadcast_is_bound_by_rows_and_bytes(spark):
    """Rows without text count eight bytes a column; missing texts count none."""
    rows = spark.createDataFrame([("ab", 1), (None, 2)], "bc string, n bigint")
    assert skew.fits_broadcast(rows, 2, 34) and not skew.fits_broadcast(rows, 2, 33) and not skew.fits_broadcast(rows, 1)
    assert skew.fits_broadcast(rows.filter("false"), 0, 0)
