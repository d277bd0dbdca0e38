"""Access to the text tables and small expressions that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: a word is a run of characters other than the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_text(column: str | Column = "text") -> Column:
    """The text, a missing one as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def word_count(column: str | Column = "text") -> Column:
    return F.regexp_count(whole_text(column), F.lit(WORD)).cast("bigint")
