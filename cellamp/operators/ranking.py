"""Dense row numbers over a whole table without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def bucketed_rank(df: DataFrame, bucket: Column, order: list[Column], name: str) -> DataFrame:
    """Append the 0-based rank of every row in ``order`` as ``name``.

    ``bucket`` must be a non-decreasing function of the order with a bounded number of values: rows are
    ranked inside their bucket, and the number of rows in the buckets before is added. Only the table of
    bucket sizes is ever brought together. ``df`` is read twice and must give the same rows both times.
    """
    keyed = df.withColumn("_bucket", bucket)
    sizes = keyed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(W.partitionBy("_bucket").orderBy(*order)) - 1
    return (
        keyed.withColumn(name, inside)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(name, (F.col(name) + F.col("_offset")).cast("bigint"))
        .drop("_bucket", "_offset")
    )
