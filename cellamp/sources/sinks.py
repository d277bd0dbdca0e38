"""Writers: partitioned parquet for further work, tab-separated text for exchange."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellamp.config import RegionConfig
from cellamp.operators.regions import looked_table
from cellamp.operators.skew import fits_broadcast
from cellamp.session import store
from cellamp.sources.chunk_writer import ChunkTableSink

# Column names of the text tables.
MERGE_HEADER = {
    "bc": "BC", "whitelist": "whitelist", "umi": "UMI", "n_wt": "num.WT.in.dups", "n_mut": "num.MUT.in.dups",
    "n_amb": "num.amb.in.dups", "call": "call.in.dups", "avg_err_r2": "avg.base_error.R2",
    "avg_err_primer": "avg.base_error.primer", "avg_err_shared": "avg.base_error.shared",
    "avg_err_wt": "avg.base_error.WT", "avg_err_mut": "avg.base_error.MUT", "mm_primer": "mismatch.primer",
    "mm_shared": "mismatch.shared", "mm_wt": "mismatch.WT", "mm_mut": "mismatch.MUT",
    "mm_fw_wt": "mismatchPCR2FW_WT", "mm_fw_mut": "mismatchPCR2FW_MUT", "mm_rv_wt": "mismatchPCR2RV_WT",
    "mm_rv_mut": "mismatchPCR2RV_MUT",
}
# Reads after which a chunk's FASTQ takes another file, and read ids that stay together.
FILE_READS = 1_000_000
CALL_HEADER = {"wt_calls": "WT.calls", "mut_calls": "MUT.calls", "amb_calls": "amb.calls"}


def _named(df: DataFrame, renames: dict[str, str], suffix: str = "", keep: Sequence[str] = ()) -> DataFrame:
    names = {f"{k}{suffix}": v for k, v in renames.items()} | CALL_HEADER
    return df.select(*keep, *[F.col(c).alias(n) for c, n in names.items() if c in df.columns])


def _tsv(writer: DataFrameWriter, header: bool = True) -> DataFrameWriter:
    options = {"sep": "\t", "quote": "", "emptyValue": "", "nullValue": ""}
    return writer.options(**options).option("header", header)


def write_tsv(df: DataFrame, path: str, header: bool = True, one_file: bool = False) -> None:
    """Tab-separated text without quotes; empty and null fields are written empty.

    ``one_file`` gathers the output in one task and is meant for small exports.
    """
    out = df.coalesce(1) if one_file else df
    _tsv(out.write, header).csv(path)


def write_looked(looked: DataFrame, path: str) -> None:
    """Scored reads in read order, without a header."""
    write_tsv(looked.orderBy("read_id").drop("read_id"), path, header=False)


def write_merge_table(merged: DataFrame, path: str, one_file: bool = False) -> None:
    write_tsv(_named(merged.orderBy("first_seen"), MERGE_HEADER), path, one_file=one_file)


def write_cell_summary(summary: DataFrame, path: str, one_file: bool = False) -> None:
    """Packed cells in order of first appearance. A cell in several parts keeps one line per part."""
    write_tsv(_named(summary.orderBy("first_seen", "part"), MERGE_HEADER, "_list"), path, one_file=one_file)


def write_chunk_tables(summary: DataFrame, outdir: str, sample: str) -> None:
    """Packed cells with ``chunk_id``: one ``<sample>.summTable.txt`` per chunk, below its folder of four digits or, from 10,000 on, more.

    The tasks write the tables under these names. Tables of the sample that are there already are an error; a job that fails takes its own away.
    """
    spark = summary.sparkSession
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    given = hadoop.Path(outdir.rstrip("/"))
    system = given.getFileSystem(conf)
    if system.globStatus(hadoop.Path(given, f"[0-9]*/{sample}.summTable.txt")):
        raise FileExistsError(f"{outdir} has tables of {sample}")
    ordered = summary.repartition("chunk_id").sortWithinPartitions("chunk_id", "first_seen", "part")
    table = _named(ordered, MERGE_HEADER, "_list", ["chunk_id"])
    as_text = [F.col(f"`{c}`").cast("string").alias(c) for c in table.columns if c != "chunk_id"]
    spark.dataSource.register(ChunkTableSink)
    sink = table.select(F.col("chunk_id").cast("bigint"), *as_text).write.format(ChunkTableSink.name()).mode("append")
    sink.option("sample", sample).save(system.makeQualified(given).toString())


def write_changed(changed: DataFrame, config: RegionConfig, path: str, one_file: bool = False) -> None:
    """Reads outside the whitelist: the `looked` columns, and the new barcode or the reason why there is none."""
    rows = changed.withColumn("outcome", F.coalesce("replaced_bc", "status"))
    table = looked_table(rows, config, keep=["whitelist", "outcome"]).orderBy("read_id").drop("read_id")
    names = ["original_BC", *[f"V{i}" for i in range(2, len(table.columns) - 1)], "whitelist", "replaced_BC"]
    write_tsv(table.toDF(*names), path, one_file=one_file)


def write_representatives(reps: DataFrame, config: RegionConfig, path: str, one_file: bool = False) -> None:
    """Representative reads with the counts of their group, in order of first appearance."""
    scores = looked_table(reps, config).columns[1:]
    named = {"mm_wt": "mismatch.WT", "mm_mut": "mismatch.MUT", "avg_err_wt": "BQ.in.WT", "avg_err_mut": "BQ.in.MUT"}
    extra = {
        "whitelist": "whitelist", "barcode_umi": "BARCODE_UMI", "call": "mismatch.call", "n_wt": "WT.inDups",
        "n_mut": "MUT.inDups", "n_amb": "amb.inDups",
    }
    table = looked_table(reps, config, keep=["first_seen", *extra]).orderBy("first_seen")
    columns = [F.col(c).alias(named.get(c, f"V{i + 1}")) for i, c in enumerate(scores)]
    write_tsv(table.select(*columns, *[F.col(c).alias(n) for c, n in extra.items()]), path, one_file=one_file)


def write_cells(cells: DataFrame, path: str, order: DataFrame | None = None, one_file: bool = False) -> None:
    """Combined or collapsed cells; ``order`` gives ``bc_first`` per barcode where the cells lack it."""
    if "bc_first" not in cells.columns and order is not None:
        cells = cells.join(order.select("bc", "bc_first"), "bc", "left")
    keys = [c for c in ("bc_first", "bc", "part") if c in cells.columns]
    write_tsv(_named(cells.orderBy(*keys), MERGE_HEADER), path, one_file=one_file)


def write_chunks(reads: DataFrame, path: str) -> None:
    """Reads with ``chunk_id`` as one folder per chunk."""
    reads.write.partitionBy("chunk_id").parquet(path)


def fastq_layout(reads: DataFrame) -> DataFrame:
    """Where a chunk's reads stand: (chunk_id, million, block, first), stored.

    Each million of read ids stands in a file ``block`` of its chunk, after ``first`` of the file's reads. A file takes further millions until it has
    that many reads, so that chunks drawn from all ids do not come in a file per million.
    """
    million = F.floor(F.col("read_id") / FILE_READS).alias("million")
    counts = reads.groupBy("chunk_id", million).agg(F.count("*").alias("_n"))
    earlier = W.partitionBy("chunk_id").orderBy("million").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    placed = counts.withColumn("_before", before).withColumn("block", F.floor(F.col("_before") / FILE_READS))
    first = F.col("_before") - F.min("_before").over(W.partitionBy("chunk_id", "block"))
    return store(placed.select("chunk_id", "million", "block", first.alias("first")))


def write_fastq_chunks(reads: DataFrame, path: str, mate: int, layout: DataFrame | None = None) -> None:
    """One mate of the reads as FASTQ text, in read order: a folder per chunk, and in it a folder and file per million reads or so.

    The files depend on chunks and read ids alone, so those of two mates hold the same reads in the same order. ``layout`` is that of ``fastq_layout``; without it, it is made from the
    reads, which are then read twice.
    """
    # A record always has four lines: a missing header or quality is an empty one.
    seq = F.coalesce(f"seq_r{mate}", F.raise_error(F.lit(f"a read without seq_r{mate} cannot be written")).cast("string"))
    header, qual = (F.coalesce(f"{c}_r{mate}", F.lit("")) for c in ("header", "qual"))
    record = F.concat_ws("\n", header, seq, F.lit("+"), qual)
    # Only chunks of more than a file have further blocks.
    further = (fastq_layout(reads) if layout is None else layout).filter("block > 0").select("chunk_id", "million", "block")
    if fits_broadcast(further):
        further = F.broadcast(further)
    (
        reads.withColumn("million", F.floor(F.col("read_id") / FILE_READS))
        .join(further, ["chunk_id", "million"], "left")
        .withColumn("block", F.coalesce("block", F.lit(0)))
        .repartition("chunk_id", "block")
        .sortWithinPartitions("chunk_id", "block", "read_id")
        .select(record.alias("value"), "chunk_id", "block")
        .write.partitionBy("chunk_id", "block")
        .text(path)
    )
