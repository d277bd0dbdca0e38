"""Text files with exact line numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellamp.operators.skew import fits_broadcast

# Room for 2**40 lines or reads in a file and 2**23 files in one number.
ORDINAL_BITS = 40


def _status(spark: SparkSession, path: str):
    """The file's status, as its own file system gives it."""
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(name)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system; without one, it is on the default file system."""
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(name).toString()


def file_size(spark: SparkSession, path: str) -> int:
    return _status(spark, path).getLen()


def _files(spark: SparkSession, path: str) -> list[str]:
    """The file itself, or the files of a folder by name."""
    status = _status(spark, path)
    return sorted(spark.read.text(path).inputFiles()) if status.isDirectory() else [status.getPath().toUri().toString()]


def _one_slash(path: Column) -> Column:
    """Scheme and path with one slash between, since the forms ``file:/x`` and ``file:///x`` both occur."""
    return F.regexp_replace(path, "^([A-Za-z0-9]+):/+", "$1:/")


def indexed_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines of the files with ``file_no`` (place in the list) and 0-based ``line_no`` in the file.

    A folder stands for its files in the order of their names.

    The blocks of the files are counted first; each line then adds the lines of the earlier blocks of its
    file to its place in its own. Files are read in as many blocks as Spark makes of them.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    listed = list(enumerate(f for p in paths for f in _files(spark, p)))
    files = spark.createDataFrame(listed, "file_no int, path string").select("file_no", _one_slash(F.col("path")).alias("path"))
    lines = (
        spark.read.text(paths)
        .select(
            "value",
            _one_slash(F.col("_metadata.file_path")).alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("within"),
        )
        .join(F.broadcast(files), "path", "left")
    )
    unknown = F.raise_error(F.concat(F.lit("no number for file "), F.col("path")))
    lines = lines.withColumn("file_no", F.coalesce("file_no", unknown.cast("int")))
    blocks = lines.groupBy("file_no", "block").agg(F.count("*").alias("n"), F.min("within").alias("first"))
    before = W.partitionBy("file_no").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    offsets = blocks.select("file_no", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    offsets = F.broadcast(offsets) if fits_broadcast(offsets) else offsets
    # The scan of the offsets must have cut the files in the same places; a line it does not know is an error.
    lost = F.raise_error(F.lit("the blocks of the files differ between two scans")).cast("bigint")
    return lines.join(offsets, ["file_no", "block"], "left").select(
        "file_no", "value", F.coalesce(F.col("within") + F.col("shift"), lost).alias("line_no")
    )
