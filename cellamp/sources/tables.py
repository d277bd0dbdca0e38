"""Readers of region layouts, whitelists, scored reads and chunk tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellamp.config import CIRC_REGIONS, LINEAR_REGIONS, Region, RegionConfig
from cellamp.functions.calls import clean_field
from cellamp.functions.phred import symbols_from_packed
from cellamp.operators.whitelist import ordered_whitelist
from cellamp.sources.text import ORDINAL_BITS, indexed_lines

# Header names of a chunk table, and the names used here.
CHUNK_COLUMNS = {
    "BC": "bc", "UMI": "umi", "num.WT.in.dups": "n_wt", "num.MUT.in.dups": "n_mut", "num.amb.in.dups": "n_amb",
}


def _place() -> Column:
    """File and line as one number that orders lines."""
    return F.col("file_no").cast("bigint") * (1 << ORDINAL_BITS) + F.col("line_no")


def read_regions(spark: SparkSession, path: str, mode: str = "linear") -> RegionConfig:
    """Layout from a tab-separated file of sequence, start and end, one region per line in fixed order."""
    names = CIRC_REGIONS if mode == "circ" else LINEAR_REGIONS
    text = spark.read.text(path, wholetext=True).first()
    lines = [line.rstrip("\r").split("\t") for line in (text[0] if text else "").split("\n") if line.strip()]
    if len(lines) < len(names):
        raise ValueError(f"{path} has fewer than {len(names)} regions")
    return RegionConfig(tuple(Region(n, f[0], int(f[1]), int(f[2])) for n, f in zip(names, lines)))


def read_whitelist(spark: SparkSession, path: str) -> DataFrame:
    """Barcodes with their order in the file; blank lines are skipped and the first of equal lines counts."""
    lines = indexed_lines(spark, path).select(F.col("value").alias("bc"), _place().alias("position"))
    return ordered_whitelist(lines, F.floor(F.col("position") / 65536))


def looked_columns(mode: str = "linear") -> list[str]:
    """Columns of scored reads: 12 for a linear layout, 20 for a circular one."""
    names = CIRC_REGIONS if mode == "circ" else LINEAR_REGIONS
    return ["bc", "bc_q", "umi", *[f"mm_{n}" for n in names], "avg_err_r2", *[f"avg_err_{n}" for n in names]]


def read_looked(spark: SparkSession, path: str, mode: str = "linear") -> DataFrame:
    """Scored reads from tab-separated text, as input for the barcode rescue.

    Blank lines, a header, and lines with too few fields for the layout are skipped, as are reads whose primer or
    shared mismatch count is no integer. The averages stand in for the error sums: they order reads alike.
    """
    columns, fields = looked_columns(mode), F.split("value", "\t")
    rows = indexed_lines(spark, path).select(_place().alias("read_id"), fields.alias("f"))
    rows = rows.filter((F.size("f") >= len(columns)) & (F.col("f")[0] != "BC"))
    named = rows.select("read_id", *[F.col("f")[i].alias(n) for i, n in enumerate(columns)])
    typed = named.select(
        "read_id", "bc", symbols_from_packed(F.col("bc_q")).alias("bc_qual"), "umi",
        *[F.trim(n).try_cast("int").alias(n) for n in columns if n.startswith("mm_")],
        *[F.trim(n).try_cast("double").alias(n) for n in columns if n.startswith("avg_")],
    )
    return typed.filter("mm_primer IS NOT NULL AND mm_shared IS NOT NULL")


def with_error_sums(looked: DataFrame, config: RegionConfig) -> DataFrame:
    """Averages back to the integer sums the duplicate step compares; the read length becomes 1."""
    sums = [F.rint(F.col(f"avg_err_{r.name}") * len(r.seq) * 1e5).cast("bigint").alias(f"err_{r.name}") for r in config.regions]
    keep = [c for c in looked.columns if not c.startswith("avg_")]
    return looked.select(*keep, F.lit(1).alias("r2_len"), (F.col("avg_err_r2") * 1e5).alias("err_r2"), *sums)


def one_table_per_folder(files: DataFrame, sample: str | None) -> DataFrame:
    """Of files (folder, name, length): per folder ``<sample>.summTable.txt`` when not empty, else the only other table that
    is not a combined one, when not empty."""
    per_folder = W.partitionBy("folder")
    usable = (F.col("name") == F.lit(f"{sample}.summTable.txt")) & F.lit(sample is not None) & (F.col("length") > 0)
    other = ~F.col("name").contains(".concat")
    ranked = files.withColumn("_preferred", F.max(usable).over(per_folder)).withColumn("_others", F.count_if(other).over(per_folder))
    chosen = (F.col("_preferred") & usable) | (~F.col("_preferred") & other & (F.col("_others") == 1) & (F.col("length") > 0))
    return ranked.filter(chosen).drop("_preferred", "_others")


def chunk_table_files(spark: SparkSession, outdir: str) -> DataFrame:
    """(path, folder, name, length) of all tables in the folders of four or more digits below ``outdir``, empty files included; no content is read."""
    tables = spark._jvm.org.apache.hadoop.fs.Path(f"{outdir.rstrip('/')}/[0-9][0-9][0-9][0-9]*/*.summTable.txt")
    found = tables.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(tables) or []
    rows = [(f.getPath().toString(), f.getPath().getParent().getName(), f.getPath().getName(), f.getLen()) for f in found]
    rows = [row for row in rows if row[1].isdigit()]
    return spark.createDataFrame(rows, "path string, folder string, name string, length bigint")


def chunk_table_paths(spark: SparkSession, outdir: str, sample: str) -> list[str]:
    """Chunk tables below ``outdir``, one per folder, in the order of the folders' numbers."""
    chosen = one_table_per_folder(chunk_table_files(spark, outdir), sample).select("path", "folder").collect()
    return [r.path for r in sorted(chosen, key=lambda r: (int(r.folder), r.path))]


def table_header(spark: SparkSession, path: str) -> list[str]:
    first = spark.read.text(path).first()
    return first[0].split("\t") if first else []


def read_chunk_tables(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Barcode, UMI and count columns of chunk tables as text, nulls empty and quotes removed, with columns that order the rows.

    The schema is never inferred: a packed count column looks like an integer until its first long cell.
    """
    header = table_header(spark, paths[0])
    missing = [c for c in CHUNK_COLUMNS if c not in header]
    if missing:
        raise ValueError(f"{paths[0]} lacks columns {missing}")
    schema = ", ".join(f"`{c}` string" for c in header)
    table = (
        spark.read.schema(schema).option("sep", "\t").option("quote", "").option("header", True)
        .option("enforceSchema", False).csv(paths)
    )
    # Folders come in the order of their numbers, whatever their digits.
    padded = F.lpad(F.regexp_extract("_metadata.file_path", "/([0-9]{4,})/[^/]*$", 1), 19, "0")
    return table.select(
        *[clean_field(F.col(f"`{c}`")).alias(n) for c, n in CHUNK_COLUMNS.items()],
        F.concat(padded, F.col("_metadata.file_path")).alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("within"),
    )


ROW_ORDER = ["path", "block", "within"]


def paired_chunks(spark: SparkSession, folder: str) -> list[str]:
    """Chunk numbers of which both mates exist and the second is not empty, in order."""
    files = (
        spark.read.format("binaryFile")
        .load(f"{folder.rstrip('/')}/shuffled.R[12][0-9]*.fastq*")
        .select("length", F.regexp_extract("path", r"shuffled\.R([12])([0-9]+)\.fastq(\.gz)?$", 2).alias("chunk"),
                F.regexp_extract("path", r"shuffled\.R([12])([0-9]+)\.fastq(\.gz)?$", 1).alias("mate"))
        .filter("chunk <> ''")
    )
    first = files.filter("mate = '1'").select("chunk").distinct()
    second = files.filter("mate = '2' AND length > 0").select("chunk")
    return [r.chunk for r in first.join(second, "chunk", "left_semi").orderBy(F.col("chunk").cast("bigint")).collect()]
