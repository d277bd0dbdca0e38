"""Combine chunk tables as they arrive.

A micro-batch adds the sums per table, barcode and UMI of the files that are new to a table below ``out``; a batch that is run again replaces what it
wrote before. The sums stay apart by file, so which file of a folder counts can be decided when they are read: a better one may arrive later.
Every ``COMPACT`` batches, all sums so far are written once more as one table, which then stands for them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cellamp.config import Params
from cellamp.functions.calls import clean_field
from cellamp.operators.combine import PACKED, sum_pairs, unpack
from cellamp.sources.tables import CHUNK_COLUMNS, chunk_table_files, one_table_per_folder

COMPACT = 64
_SUMS = "folder string, name string, bc string, umi string, n_wt bigint, n_mut bigint, n_amb bigint"


def combine_stream(
    spark: SparkSession, folder: str, out: str, checkpoint: str, header: list[str], pattern: str = "*.summTable.txt",
    compact: int = COMPACT, **trigger,
) -> StreamingQuery:
    """Add all chunk tables below ``folder`` that are new since the last run to the sums in ``out``.

    ``trigger`` is what the stream's trigger takes; by default all that is there is read and the stream ends.
    """
    schema = ", ".join(f"`{c}` string" for c in header)
    tables = (
        spark.readStream.schema(schema).option("sep", "\t").option("quote", "").option("header", True)
        .option("recursiveFileLookup", True).option("pathGlobFilter", pattern).csv(folder)
        # Combined tables hold the same counts once more.
        .filter(~F.col("_metadata.file_name").contains(".concat"))
        .select(
            F.element_at(F.split("_metadata.file_path", "/"), -2).alias("folder"), F.col("_metadata.file_name").alias("name"),
            *[clean_field(F.col(f"`{c}`")).alias(n) for c, n in CHUNK_COLUMNS.items()],
        )
    )

    def add(batch: DataFrame, batch_id: int) -> None:
        rows = unpack(batch.withColumn("file", F.struct("folder", "name")), ["file"])
        named = rows.select("first_seen.file.folder", "first_seen.file.name", "bc", "umi", *PACKED[1:])
        sums = named.groupBy("folder", "name", "bc", "umi").agg(*[F.sum(c).cast("bigint").alias(c) for c in PACKED[1:]])
        sums.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={batch_id}")
        if (batch_id + 1) % compact == 0:
            # The table is complete when Spark has committed it; until then the batches are read.
            arrived(spark, out, batch_id).write.mode("overwrite").parquet(f"{out.rstrip('/')}/upto={batch_id}")

    return tables.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def _numbers(spark: SparkSession, out: str, kind: str) -> list[int]:
    """Numbers of the complete tables of a kind below a folder."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    done = hadoop.Path(f"{out.rstrip('/')}/{kind}=*/_SUCCESS")
    found = done.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(done)
    return sorted(int(re.search(rf"{kind}=([0-9]+)/", f.getPath().toString())[1]) for f in found or [])


def arrived(spark: SparkSession, out: str, before: int | None = None) -> DataFrame:
    """(folder, name, bc, umi, counts) of all files so far: the last compacted table and the batches after it.

    ``before`` leaves out a compacted table of that batch, which may be a torn one.
    """
    whole = [n for n in _numbers(spark, out, "upto") if before is None or n < before]
    last = whole[-1] if whole else -1
    parts = [f"batch={n}" for n in _numbers(spark, out, "batch") if n > last]
    parts = ([f"upto={last}"] if whole else []) + parts
    if not parts:
        return spark.createDataFrame([], _SUMS)
    return spark.read.schema(_SUMS).parquet(*[f"{out.rstrip('/')}/{p}" for p in parts])


def combined_pairs(
    spark: SparkSession, out: str, params: Params = Params(), sample: str | None = None, folder: str | None = None
) -> DataFrame:
    """Pairs over everything that has arrived so far, from one table per folder, as the batch way chooses it.

    ``sample`` names the preferred table. The tables of ``folder``, where it is given, are what is chosen from; otherwise it is the tables that have
    rows. A folder with several tables, none of them preferred, counts nowhere.
    """
    sums = arrived(spark, out)
    if folder is None:
        files = sums.select("folder", "name").distinct().withColumn("length", F.lit(1))
    else:
        files = chunk_table_files(spark, folder).select("folder", "name", "length")
    chosen = one_table_per_folder(files, sample).select("folder", "name")
    return sum_pairs(sums.join(chosen, ["folder", "name"], "left_semi").drop("folder", "name"), params)
