"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

# Whitelists of common kits have 0.7 to 3.7 million barcodes; longer ones take the shuffled way.
BROADCAST_ROWS = 4_000_000
BROADCAST_BYTES = 256 << 20
# A key with more than 1/HOT_SHARE of all rows is hot, so there are fewer than HOT_SHARE such keys.
HOT_SHARE = 1000
SALTS = 256


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure rows and bytes of a table in one aggregation: may it be broadcast? Should be a stored table."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, (StringType, BinaryType))]
    width = F.lit(8 * len(df.columns))
    for name in texts:
        width = width + F.coalesce(F.octet_length(f"`{name}`"), F.lit(0))
    size = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return size.rows <= max_rows and size.bytes <= max_bytes


def hot_keys(sizes: DataFrame, keys: list[str], size: str) -> DataFrame:
    """Keys holding more than 1/HOT_SHARE of all rows, from a stored table of rows per key."""
    total = sizes.agg(F.sum(size)).first()[0] or 0
    return sizes.filter(F.col(size) * HOT_SHARE > total).select(*keys)


def salted_lookup(
    rows: DataFrame, dim: DataFrame, keys: list[str], sizes: DataFrame, size: str, spread_by: str, how: str = "left"
) -> DataFrame:
    """Join ``rows`` to a table that is unique per key, spreading the rows of hot keys over many tasks.

    ``sizes`` is a stored table of row counts per key; ``spread_by`` is a column that varies inside a key. The dimension rows of hot keys (fewer than
    HOT_SHARE) are repeated once per salt; all other keys keep salt 0.
    """
    hot = F.broadcast(hot_keys(sizes, keys, size).withColumn("_hot", F.lit(True)))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).cast("int")).otherwise(0)
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    left = rows.join(hot, keys, "left").withColumn("_salt", salt).drop("_hot")
    right = dim.join(hot, keys, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def mark(rows: DataFrame, marked: DataFrame, keys: list[str], sizes: DataFrame, size: str, spread_by: str) -> DataFrame:
    """Left join to a table of few keys: broadcast when measured to be small, salted otherwise."""
    if fits_broadcast(marked):
        return rows.join(F.broadcast(marked), keys, "left")
    return salted_lookup(rows, marked, keys, sizes, size, spread_by)
