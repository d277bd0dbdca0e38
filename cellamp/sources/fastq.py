"""FASTQ read pairs as a Spark data source, by byte ranges, and as splittable text.

``format("fastq_pair")`` reads the two mates of a file in lockstep, one task per pair of files; plain gzip cannot be split. Large files that
are not compressed, or block-compressed, are read by byte ranges (:mod:`cellamp.sources.ranges`). Files on file systems that only Spark can
open go through :func:`split_fastq_pairs`, which reads them in blocks and joins the mates on their place in the file.
"""

from __future__ import annotations

import gzip
import io
import itertools
import json
import re
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from cellamp.sources.ranges import RANGE_BYTES, READ_SCHEMA, kind_of, locate, read_ranges
from cellamp.sources.text import ORDINAL_BITS, file_size, indexed_lines, qualified

_BATCH = 20_000


@contextmanager
def _open(path: str):
    system, name = locate(path)
    with system.open_input_file(name) as file:
        yield io.TextIOWrapper(gzip.GzipFile(fileobj=file) if path.lower().endswith(".gz") else file, "utf-8")


def _records(path: str) -> Iterator[tuple[str, str, str]]:
    """Header, sequence and quality of each record."""
    with _open(path) as lines:
        stripped = (line.rstrip("\r\n") for line in lines)
        while head := list(itertools.islice(stripped, 4)):
            if len(head) < 4:
                if any(head):
                    raise ValueError(f"{path} ends inside a record")
                return
            yield head[0], head[1], head[3]


def _listed(value: str) -> list[str]:
    """Paths of an option: a JSON list, or one path."""
    return json.loads(value) if value.startswith('["') else [value] if value else []


class _FilePairs(InputPartition):
    def __init__(self, pairs: list[tuple[int, str, str]]):
        self.pairs = pairs


class FastqPairReader(DataSourceReader):
    def __init__(self, options: dict):
        first, second = _listed(options.get("r1", "")), _listed(options.get("r2", ""))
        if not first or len(first) != len(second):
            raise ValueError("options r1 and r2 must list the same number of files")
        self.truncate = options.get("unequal", "error") == "truncate"
        ids = options.get("file_ids")
        self.pairs = list(zip(map(int, ids.split(",")) if ids else range(len(first)), first, second))
        sizes = options.get("sizes")
        self.sizes = list(map(int, sizes.split(","))) if sizes else None
        self.task_bytes = int(options.get("task_bytes", "0"))

    def partitions(self):
        if self.sizes is None:
            return [_FilePairs([pair]) for pair in self.pairs]
        tasks, filled = [], self.task_bytes
        for pair, size in zip(self.pairs, self.sizes, strict=True):
            if not tasks or filled + size > self.task_bytes:
                tasks.append([])
                filled = 0
            tasks[-1].append(pair)
            filled += size
        return [_FilePairs(pairs) for pairs in tasks]

    def read(self, partition):
        for pair in partition.pairs:
            yield from self._read_pair(*pair)

    def _read_pair(self, file_id: int, r1: str, r2: str):
        names = ["read_id", "file_id", "header_r1", "seq_r1", "qual_r1", "header_r2", "seq_r2", "qual_r2"]
        schema = pa.schema([("read_id", pa.int64()), ("file_id", pa.int32()), *[(n, pa.string()) for n in names[2:]]])
        mates = enumerate(itertools.zip_longest(_records(r1), _records(r2)))
        while chunk := list(itertools.islice(mates, _BATCH)):
            rows = [(n, a, b) for n, (a, b) in chunk if a and b]
            if len(rows) < len(chunk) and not self.truncate:
                raise ValueError(f"{r1} and {r2} differ in their number of reads")
            base = file_id << ORDINAL_BITS
            columns = [[base + n for n, _, _ in rows], [file_id] * len(rows)]
            columns += [[a[i] for _, a, _ in rows] for i in range(3)] + [[b[i] for _, _, b in rows] for i in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


class FastqPairSource(DataSource):
    """Options ``r1`` and ``r2``: a path each, or JSON lists of equal length, on a file system that every executor can open.

    ``unequal``: ``error`` or ``truncate``. ``file_ids``: numbers of the pairs, by default 0, 1, ... ``sizes``: bytes of the pairs; a task then reads
    successive pairs of up to ``task_bytes`` together, or one that is larger.
    """

    @classmethod
    def name(cls):
        return "fastq_pair"

    def schema(self):
        return READ_SCHEMA

    def reader(self, schema):
        return FastqPairReader(self.options)


def read_fastq_pairs(
    spark: SparkSession, r1: list[str], r2: list[str], unequal: str = "error", split_bytes: int = 256 << 20
) -> DataFrame:
    """Read pairs of FASTQ files, plain or gzip; ``read_id`` orders the reads by pair and place.

    Files larger than ``split_bytes`` that are not compressed, or block-compressed, are read by byte ranges, so that one large file does not
    become one large task. When plain gzip files are few or one of them holds much more than its share, their reads are spread over the
    cluster as soon as they are decompressed.
    """
    if not r1 or len(r1) != len(r2):
        raise ValueError("r1 and r2 must list the same number of files")
    r1, r2 = [qualified(spark, p) for p in r1], [qualified(spark, p) for p in r2]
    return _read_pairs(spark, r1, r2, {p: file_size(spark, p) for p in {*r1, *r2}}, unequal, split_bytes)


def _read_pairs(spark: SparkSession, r1: list[str], r2: list[str], lengths: dict[str, int], unequal: str, split_bytes: int) -> DataFrame:
    """Read pairs of files by full paths, whose bytes are known."""
    sizes = [lengths[a] + lengths[b] for a, b in zip(r1, r2)]
    kinds = [(kind_of(a), kind_of(b)) for a, b in zip(r1, r2)]
    text = [i for i, k in enumerate(kinds) if None in k]
    cut = [i for i, k in enumerate(kinds) if None not in k and "gzip" not in k and sizes[i] > split_bytes]
    whole = [i for i in range(len(r1)) if i not in {*text, *cut}]
    parts = []
    if whole:
        spark.dataSource.register(FastqPairSource)
        total, largest = sum(sizes[i] for i in whole), max(sizes[i] for i in whole)
        cores = spark.sparkContext.defaultParallelism
        # Small files are read many in a task, large ones alone.
        options = {
            "r1": json.dumps([r1[i] for i in whole]), "r2": json.dumps([r2[i] for i in whole]),
            "file_ids": ",".join(map(str, whole)), "unequal": unequal,
            "sizes": ",".join(str(sizes[i]) for i in whole), "task_bytes": str(min(RANGE_BYTES, total // (4 * cores))),
        }
        reads = spark.read.format("fastq_pair").options(**options).load()
        uneven = largest * len(whole) > 4 * total or len(whole) < cores
        if largest > split_bytes and uneven:
            reads = reads.repartition(max(cores, total // (32 << 20)), "read_id")
        parts.append(reads)
    if cut:
        files = [(i, r1[i], kinds[i][0], r2[i], kinds[i][1]) for i in cut]
        parts.append(read_ranges(spark, files, unequal, max(1 << 12, min(RANGE_BYTES, split_bytes or RANGE_BYTES)), lengths))
    if text:
        parts.append(split_fastq_pairs(spark, [r1[i] for i in text], [r2[i] for i in text], text, unequal))
    return reduce(DataFrame.unionByName, parts)


def chunk_files(spark: SparkSession, folder: str) -> dict[tuple[int, int], tuple[str, int]]:
    """Chunk and block to the file that holds them, and its bytes."""
    files = spark.read.format("binaryFile").load(f"{folder.rstrip('/')}/chunk_id=*/block=*/*.{{txt,gz}}").select("path", "length")
    found = [(re.search(r"chunk_id=(-?\d+)/block=(-?\d+)/", row.path), row) for row in files.collect()]
    return {(int(m[1]), int(m[2])): (row.path, row.length) for m, row in found}


def read_fastq_chunks(spark: SparkSession, r1: str, r2: str, unequal: str = "error", split_bytes: int = 256 << 20) -> DataFrame:
    """Read back what ``write_fastq_chunks`` has written for both mates, with ``chunk_id``.

    ``file_id`` numbers the files by chunk and block.
    """
    first, second = chunk_files(spark, r1), chunk_files(spark, r2)
    if first.keys() != second.keys():
        raise ValueError(f"{r1} and {r2} hold different chunks")
    places = sorted(first)
    if not places:
        raise ValueError(f"{r1} and {r2} hold no chunks")
    lengths = {path: size for files in (first, second) for path, size in files.values()}
    reads = _read_pairs(spark, [first[p][0] for p in places], [second[p][0] for p in places], lengths, unequal, split_bytes)
    chunks = spark.createDataFrame([(no, chunk) for no, (chunk, _) in enumerate(places)], "file_id int, chunk_id int")
    return reads.join(F.broadcast(chunks), "file_id", "left").select(*reads.columns, "chunk_id")


def _split_records(spark: SparkSession, paths: list[str], mate: int) -> DataFrame:
    lines = indexed_lines(spark, paths)
    place = F.col("line_no") % 4
    fields = ((0, f"header_r{mate}"), (1, f"seq_r{mate}"), (3, f"qual_r{mate}"))
    records = lines.groupBy("file_no", F.floor(F.col("line_no") / 4).alias("ordinal")).agg(
        *[F.max(F.when(place == i, F.col("value"))).alias(name) for i, name in fields],
        F.count("*").alias("_lines"),
        F.max(F.length("value")).alias("_longest"),
    )
    # Fewer than four lines are blank lines at the end of the file, or a record that is cut off.
    message = F.concat(F.lit(f"file {mate} of pair "), F.col("file_no").cast("string"), F.lit(" ends inside a record"))
    whole = F.when(F.col("_lines") == 4, True).when(F.col("_longest") == 0, False).otherwise(F.raise_error(message).cast("boolean"))
    return records.filter(whole).drop("_lines", "_longest")


def split_fastq_pairs(
    spark: SparkSession, r1: list[str], r2: list[str], file_ids: list[int] | None = None, unequal: str = "error"
) -> DataFrame:
    """Pairs of large files, read in blocks by many tasks and joined on file and record number."""
    first, second = _split_records(spark, r1, 1), _split_records(spark, r2, 2)
    place = ["file_no", "ordinal"]
    if unequal == "error":
        pairs = first.join(second, place, "full")
        whole = F.col("qual_r1").isNotNull() & F.col("qual_r2").isNotNull()
        message = F.concat(F.lit("the mates of pair "), F.col("file_no").cast("string"), F.lit(" differ in their number of reads"))
        pairs = pairs.withColumn("ordinal", F.when(whole, F.col("ordinal")).otherwise(F.raise_error(message)))
    else:
        pairs = first.join(second, place)
    numbers = F.expr(f"array({', '.join(map(str, file_ids or range(len(r1))))})")
    pairs = pairs.withColumn("file_id", F.get(numbers, F.col("file_no")))
    return pairs.select(
        (F.col("file_id").cast("bigint") * (1 << ORDINAL_BITS) + F.col("ordinal")).alias("read_id"),
        "file_id", "header_r1", "seq_r1", "qual_r1", "header_r2", "seq_r2", "qual_r2",
    )
