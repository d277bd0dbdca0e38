"""Registered queries that go through files: each writes below the shared folder and reads back what it wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellamp.config import RegionConfig
from cellamp.operators import chunks, combine
from cellamp.operators.ranking import bucketed_rank
from cellamp.operators.skew import fits_broadcast
from cellamp.plans import fixture
from cellamp.plans.queries import CHUNK_TARGET, _plain, _run, _summary_by_chunk
from cellamp.session import new_path, store
from cellamp.sources import fastq, ranges, sinks, tables
from cellamp.sources.text import ORDINAL_BITS
from cellamp.streaming.combine_stream import combine_stream, combined_pairs

SAMPLE = "sample"


def _fastq(spark, sf_dir, compress: bool = False, **options) -> DataFrame:
    reads = fixture.reads(spark, sf_dir)
    headers = {f"header_r{m}": F.concat(F.lit("@r"), F.col("read_id").cast("string"), F.lit(f"/{m}")) for m in (1, 2)}
    assigned = store(chunks.assign_chunks(reads.withColumns(headers), CHUNK_TARGET))
    folders = [new_path(spark, f"fastq-r{mate}-") for mate in (1, 2)]
    layout = sinks.fastq_layout(assigned)
    for mate, folder in enumerate(folders, 1):
        sinks.write_fastq_chunks(assigned, folder, mate, layout)
    if compress:
        folders = [_compressed(spark, folder) for folder in folders]
    # The place of a read among those of its chunk and million of ids: its place in the file after the file's earlier millions.
    million = F.floor(F.regexp_extract("header_r1", "^@r(-?[0-9]+)/", 1).cast("bigint") / sinks.FILE_READS)
    starts = layout.select("chunk_id", "million", "first")
    starts = F.broadcast(starts) if fits_broadcast(starts) else starts
    back = fastq.read_fastq_chunks(spark, *folders, **options).withColumn("million", million).join(starts, ["chunk_id", "million"], "left")
    place = (F.col("read_id").bitwiseAND((1 << ORDINAL_BITS) - 1) - F.col("first")).alias("place")
    fields = [f"{c}_r{m}" for m in (1, 2) for c in ("header", "seq", "qual")]
    return _plain(back.select("chunk_id", place, *fields))


def _compressed(spark, folder: str) -> str:
    """Block-compressed copies of a folder's chunks."""
    target = new_path(spark, "fastq-gz-")
    files = fastq.chunk_files(spark, folder)
    names = [f"{target}/chunk_id={c}/block={b}/reads.fastq.gz" for c, b in files]
    ranges.compress_blocks(spark, [path for path, _ in files.values()], names, sum(size for _, size in files.values()))
    return target


def fastq_lockstep(spark, sf_dir):
    """Chunks of reads as FASTQ, the mates of a file read in lockstep."""
    return _fastq(spark, sf_dir)


def fastq_blocks(spark, sf_dir):
    """The same files by byte ranges, both mates in one task."""
    return _fastq(spark, sf_dir, split_bytes=1 << 18)


def fastq_block_gzip(spark, sf_dir):
    """The same files block-compressed, several tasks per file."""
    return _fastq(spark, sf_dir, compress=True, split_bytes=1 << 16)


def _looked(spark, sf_dir, config: RegionConfig) -> DataFrame:
    """The layout and the scored reads as text; lines keep the order of the reads."""
    layout, scored = new_path(spark, "regions-"), new_path(spark, "looked-")
    rows = [(f"{r.seq}\t{r.start}\t{r.end}",) for r in config.regions]
    spark.createDataFrame(rows, "line string").coalesce(1).write.text(layout)
    config = tables.read_regions(spark, layout, config.mode)
    sinks.write_looked(_run(spark, sf_dir, config).looked, scored)
    back = store(tables.read_looked(spark, scored, config.mode))
    return _plain(bucketed_rank(back, F.floor(F.col("read_id") / 65_536), [F.col("read_id")], "line").drop("read_id"))


def looked_file_linear(spark, sf_dir):
    return _looked(spark, sf_dir, fixture.LINEAR)


def looked_file_circ(spark, sf_dir):
    return _looked(spark, sf_dir, fixture.CIRC)


def whitelist_file(spark, sf_dir):
    path = new_path(spark, "whitelist-")
    fixture.whitelist(spark, sf_dir).orderBy("wl_idx").select("bc").write.text(path)
    return _plain(tables.read_whitelist(spark, path))


def _table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("sep", "\t").option("quote", "").option("header", True).csv(path)


def changed_file(spark, sf_dir):
    """Reads outside the whitelist with their new barcode or the reason why there is none."""
    run, path = _run(spark, sf_dir), new_path(spark, "changed-")
    sinks.write_changed(run.changed, run.config, path)
    names = {"original_BC": "bc", "V2": "bc_q", "V3": "umi", "whitelist": "whitelist", "replaced_BC": "outcome"}
    numbers = {"V4": "mm_primer", "V7": "mm_mut"}
    return _table(spark, path).select(
        *[F.col(c).alias(n) for c, n in names.items()], *[F.col(c).cast("bigint").alias(n) for c, n in numbers.items()]
    )


def merge_file(spark, sf_dir):
    path = new_path(spark, "merge-")
    sinks.write_merge_table(_run(spark, sf_dir).merged, path)

    def typed(name: str) -> str:
        return "double" if name.startswith("avg_") else "bigint" if name.startswith(("n_", "mm_")) else "string"

    written = _table(spark, path)
    return _plain(
        written.select(
            *[F.col(f"`{c}`").cast(typed(n)).alias(n) for n, c in sinks.MERGE_HEADER.items() if c in written.columns]
        )
    )


def cells_file(spark, sf_dir):
    """Packed cells, read back as a chunk table."""
    path = new_path(spark, "cells-")
    pairs = store(combine.sum_pairs(_run(spark, sf_dir).merged))
    sinks.write_cells(combine.concat_cells(pairs), path)
    return tables.read_chunk_tables(spark, [path]).select("bc", *combine.PACKED)


def _chunk_folder(spark, sf_dir):
    summary, params = _summary_by_chunk(spark, sf_dir)
    folder = new_path(spark, "chunks-")
    sinks.write_chunk_tables(store(summary), folder, SAMPLE)
    return folder, tables.chunk_table_paths(spark, folder, SAMPLE), params


def chunk_table_files(spark, sf_dir):
    """Tables per chunk: written, found, read and summed."""
    _, paths, params = _chunk_folder(spark, sf_dir)
    rows = combine.unpack(tables.read_chunk_tables(spark, paths), tables.ROW_ORDER)
    return _plain(combine.sum_pairs(rows, params).drop("first_seen"))


def chunk_table_stream(spark, sf_dir):
    """The same tables as a stream of files."""
    folder, paths, params = _chunk_folder(spark, sf_dir)
    sums, state = new_path(spark, "sums-"), new_path(spark, "state-")
    combine_stream(spark, folder, sums, state, tables.table_header(spark, paths[0])).awaitTermination()
    return _plain(combined_pairs(spark, sums, params, SAMPLE))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        fastq_lockstep, fastq_blocks, fastq_block_gzip, looked_file_linear, looked_file_circ, whitelist_file, changed_file, merge_file,
        cells_file, chunk_table_files, chunk_table_stream,
    )
}
