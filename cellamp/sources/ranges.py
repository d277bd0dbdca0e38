"""FASTQ pairs read by byte ranges: both mates of a record reach the same task without moving any text.

A first pass counts the lines that begin in every range of every file. From these counts follows which records begin in a range of the first
mate, and from which range of the second mate they can be reached. The second pass opens both files at these places and reads the records in
lockstep. Only the counts, a few numbers per range, are shuffled.

Ranges of plain files start anywhere. Block-compressed gzip (members of at most 64 kB that state their size) is cut at members; a member is
recognized by its header, and by another one or the end of the file where it says it ends. Workers open files through pyarrow.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellamp.session import store
from cellamp.sources.text import ORDINAL_BITS, file_size

READ_SCHEMA = (
    "read_id bigint, file_id int, header_r1 string, seq_r1 string, qual_r1 string, header_r2 string, seq_r2 string, qual_r2 string"
)
RANGE_BYTES = 32 << 20
_PIECE = 1 << 20
_BATCH = 20_000
# The first bytes of a gzip member with an extra field, and the largest member of block-compressed gzip.
_MEMBER = b"\x1f\x8b\x08\x04"
_LARGEST_MEMBER = 1 << 16
# Text per member that is written.
_MEMBER_TEXT = 0xFF00


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """The file system that pyarrow has for a path, and the path on it."""
    local = re.sub("^file:/*(?=/)", "", path)
    if "://" not in local:
        return fs.LocalFileSystem(), os.path.abspath(local)
    return fs.FileSystem.from_uri(quote(path, safe=":/@"))


def kind_of(path: str) -> str | None:
    """``plain``, ``block`` (block-compressed gzip), ``gzip``, or None for files that pyarrow cannot open."""
    try:
        system, name = locate(path)
        with system.open_input_file(name) as file:
            start = file.read(1 << 10)
    except (OSError, NotImplementedError, pa.ArrowException):
        return None
    if not path.lower().endswith(".gz"):
        return "plain"
    return "block" if member_size(start, 0) else "gzip"


def member_size(data: bytes, at: int) -> int | None:
    """Bytes of the gzip member that starts at a place, if it states its size."""
    if data[at : at + 4] != _MEMBER or len(data) < at + 12:
        return None
    (extra,) = struct.unpack_from("<H", data, at + 10)
    field, end = at + 12, at + 12 + extra
    while field + 6 <= min(end, len(data)):
        size = struct.unpack_from("<H", data, field + 2)[0]
        if data[field : field + 2] == b"BC" and size == 2:
            return struct.unpack_from("<H", data, field + 4)[0] + 1
        field += 4 + size
    return None


def first_member(file, start: int, size: int) -> int:
    """Where the first member at or after ``start`` begins; the file's size if there is none."""
    file.seek(start)
    data = file.read(3 * _LARGEST_MEMBER)
    at = data.find(_MEMBER)
    while at >= 0:
        length = member_size(data, at)
        after = start + at + (length or 0)
        if length and (after == size or member_size(data, at + length)):
            return start + at
        at = data.find(_MEMBER, at + 1)
    return size


def pieces(file, kind: str, start: int, end: int, size: int) -> Iterator[bytes]:
    """The text of a range, piece by piece; members that begin in it are read whole."""
    if kind == "plain":
        file.seek(start)
        left = end - start
        while left > 0 and (data := file.read(min(_PIECE, left))):
            left -= len(data)
            yield data
        return
    at, data, base = first_member(file, start, size), b"", 0
    while at < end:
        if not base <= at <= base + len(data) - _LARGEST_MEMBER and base + len(data) < size:
            file.seek(at)
            base, data = at, file.read(16 * _LARGEST_MEMBER)
        length = member_size(data, at - base)
        if not length:
            raise ValueError("a member of a block-compressed file does not state its size")
        yield zlib.decompress(data[at - base : at - base + length], 31)
        at += length


def lines_from(path: str, kind: str, start: int, skip: int) -> Iterator[bytes]:
    """Lines after ``skip`` line ends, counted from a place in the file."""
    system, name = locate(path)
    size = system.get_file_info(name).size
    with system.open_input_file(name) as file:
        left = b""
        for piece in pieces(file, kind, start, size, size):
            listed = (left + piece).split(b"\n")
            left = listed.pop()
            if skip >= len(listed):
                skip -= len(listed)
                continue
            yield from listed[skip:]
            skip = 0
        if left and not skip:
            yield left


def _counted(ranges: DataFrame) -> DataFrame:
    """(file_no, mate, start, ends, open): line ends per range, and whether text follows the last of them (null without text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                system, name = locate(r["path"])
                ends, last = 0, b""
                with system.open_input_file(name) as file:
                    for piece in pieces(file, r["kind"], r["start"], min(r["size"], r["start"] + r["step"]), r["size"]):
                        ends += piece.count(b"\n")
                        last = piece[-1:] or last
                rows.append({"file_no": r["file_no"], "mate": r["mate"], "start": r["start"], "ends": ends, "open": last != b"\n" if last else None})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("file_no", pa.int32()), ("mate", pa.int32()), ("start", pa.int64()), ("ends", pa.int64()), ("open", pa.bool_())]))

    return ranges.mapInArrow(count, "file_no int, mate int, start bigint, ends bigint, open boolean")


def _plan(counts: DataFrame, unequal: str) -> DataFrame:
    """Where to read: (file_no, first, n, start_1, skip_1, start_2, skip_2); rows with n = 0 look at what follows a mate's last record."""
    own = W.partitionBy("file_no", "mate").orderBy("start")
    counts = counts.withColumn("before", F.coalesce(F.sum("ends").over(own.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    lines = F.sum("ends") + F.max_by("open", F.when(F.col("open").isNotNull(), F.col("start"))).cast("int")
    totals = counts.groupBy("file_no", "mate").agg(F.coalesce(lines, F.lit(0)).alias("lines"))
    each = totals.groupBy("file_no").agg(*[F.max(F.when(F.col("mate") == m, F.floor(F.col("lines") / 4))).alias(f"records_{m}") for m in (1, 2)])
    message = F.concat(F.lit("the mates of pair "), F.col("file_no").cast("string"), F.lit(" differ in their number of reads"))
    fewest = F.least("records_1", "records_2")
    if unequal == "error":
        fewest = F.when(F.col("records_1") == F.col("records_2"), fewest).otherwise(F.raise_error(message).cast("bigint"))
    # Record k begins in the range in which line 4k begins: after line end 4k, or at the start of the file.
    first = F.when(F.col("start") == 0, F.lit(0)).otherwise(F.floor(F.col("before") / 4) + 1)
    last = F.least(F.floor((F.col("before") + F.col("ends")) / 4), F.col("records") - 1)
    wanted = (
        counts.filter("mate = 1")
        .join(each.select("file_no", fewest.alias("records")), "file_no")
        .select("file_no", first.alias("first"), (last - first + 1).alias("n"), F.col("start").alias("start_1"), "before")
        .filter("n > 0")
        .select("file_no", "first", "n", "start_1", (F.col("first") * 4 - F.col("before")).alias("skip_1"), (F.col("first") * 4).alias("line"), F.lit(2).alias("mate"))
    )
    tails = totals.filter("lines % 4 > 0").select(
        "file_no", F.floor(F.col("lines") / 4).alias("first"), F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("bigint").alias("start_1"),
        F.lit(None).cast("bigint").alias("skip_1"), (F.floor(F.col("lines") / 4) * 4).alias("line"), "mate",
    )
    # A line is reached from the last range that has fewer line ends before it.
    nothing = [F.lit(None).cast("bigint").alias(c) for c in ("first", "n", "start_1", "skip_1")]
    places = counts.select("file_no", *nothing, F.col("before").alias("line"), "mate", F.struct("start", "before").alias("place"))
    sought = wanted.unionByName(tails).withColumn("place", F.lit(None).cast("struct<start:bigint,before:bigint>"))
    upto = W.partitionBy("file_no", "mate").orderBy("line", F.col("n").isNull(), "place.start").rowsBetween(W.unboundedPreceding, 0)
    found = sought.unionByName(places).withColumn("place", F.last("place", ignorenulls=True).over(upto)).filter("n is not null")
    return found.select(
        "file_no", "first", "n", "mate", "start_1", "skip_1", F.coalesce("place.start", F.lit(0)).alias("start_2"),
        (F.col("line") - F.coalesce("place.before", F.lit(0))).alias("skip_2"),
    )


def read_ranges(
    spark: SparkSession, files: list[tuple[int, str, str, str, str]], unequal: str = "error", step: int = RANGE_BYTES, lengths: dict[str, int] | None = None
) -> DataFrame:
    """Read pairs (file_id, path_1, kind_1, path_2, kind_2) of plain or block-compressed files by ranges of ``step`` bytes.

    A file that ends in blank lines ends before them; one that ends inside a record, or mates of unequal number (unless ``unequal`` is
    ``truncate``), are an error. The files are told to the workers as a table of few bytes per file.
    ``lengths``: the bytes of the files where they are known. A task takes several ranges when these are small.
    """
    lengths = {path: file_size(spark, path) for f in files for path in (f[1], f[3])} if lengths is None else lengths
    listed = [(no, mate, path, kind, lengths[path]) for no, f in enumerate(files) for mate, path, kind in ((1, *f[1:3]), (2, *f[3:5]))]
    table = spark.createDataFrame(listed, "file_no int, mate int, path string, kind string, size bigint")
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(step).cast("bigint")))
    ranges = table.select("*", starts.alias("start"), F.lit(step).cast("bigint").alias("step"))
    n = sum(max(1, -(-size // step)) for *_, size in listed)
    tasks = max(1, min(n, 100_000, _tasks(spark, sum(size for *_, size in listed))))
    plan = store(_plan(store(_counted(ranges.repartition(tasks))), unequal))
    names = {m: table.filter(F.col("mate") == m).select("file_no", F.col("path").alias(f"path_{m}"), F.col("kind").alias(f"kind_{m}")) for m in (1, 2)}
    ids = spark.createDataFrame([(no, f[0]) for no, f in enumerate(files)], "file_no int, file_id int")
    work = plan.join(names[1], "file_no").join(names[2], "file_no").join(ids, "file_no")

    def records(path: str, kind: str, start: int, skip: int, n: int) -> Iterator[tuple[bytes, bytes, bytes]]:
        lines = (line.removesuffix(b"\r") for line in lines_from(path, kind, start, skip))
        for _ in range(n):
            head, seq, _, qual = (next(lines) for _ in range(4))
            yield head, seq, qual

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                if r["n"] == 0:
                    path = r[f"path_{r['mate']}"]
                    if any(line.strip(b"\r") for line in lines_from(path, r[f"kind_{r['mate']}"], r["start_2"], r["skip_2"])):
                        raise ValueError(f"{path} ends inside a record")
                    continue
                mates = [records(r[f"path_{m}"], r[f"kind_{m}"], r[f"start_{m}"], r[f"skip_{m}"], r["n"]) for m in (1, 2)]
                for at in range(0, r["n"], _BATCH):
                    size = min(_BATCH, r["n"] - at)
                    rows = [(*next(mates[0]), *next(mates[1])) for _ in range(size)]
                    base = (r["file_id"] << ORDINAL_BITS) + r["first"] + at
                    text = [pa.array(column, pa.binary()).cast(pa.string()) for column in zip(*rows, strict=True)]
                    yield pa.record_batch(
                        [pa.array(range(base, base + size), pa.int64()), pa.array([r["file_id"]] * size, pa.int32()), *text],
                        ["read_id", "file_id", "header_r1", "seq_r1", "qual_r1", "header_r2", "seq_r2", "qual_r2"],
                    )

    return work.repartition(tasks).mapInArrow(read, READ_SCHEMA)


def _tasks(spark: SparkSession, size: int) -> int:
    """Tasks for ranges or files of that many bytes together: some for each core, and more where a task would have over RANGE_BYTES."""
    return max(4 * spark.sparkContext.defaultParallelism, -(-size // RANGE_BYTES))


def compress_blocks(spark: SparkSession, sources: list[str], targets: list[str], size: int | None = None) -> None:
    """Block-compressed copies of files, a task per file or, when their ``size`` together is given, for several small ones; a copy appears under its name when it is whole."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                (system, name), (out, target) = locate(r["source"]), locate(r["target"])
                out.create_dir(os.path.dirname(target))
                part = f"{target}.{TaskContext.get().taskAttemptId()}.part"
                with system.open_input_file(name) as file, out.open_output_stream(part, compression=None) as to:
                    while data := file.read(_MEMBER_TEXT):
                        to.write(member(data))
                    to.write(member(b""))
                out.move(part, target)
            yield batch

    pairs = spark.createDataFrame(list(zip(sources, targets, strict=True)), "source string, target string")
    tasks = len(sources) if size is None else min(len(sources), _tasks(spark, size))
    pairs.repartition(max(1, tasks)).mapInArrow(write, "source string, target string").foreach(lambda row: None)


def member(data: bytes) -> bytes:
    """A gzip member that states its size."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    extra = struct.pack("<2sHH", b"BC", 2, len(body) + 25)
    return _MEMBER + struct.pack("<LBBH", 0, 0, 255, len(extra)) + extra + body + struct.pack("<LL", zlib.crc32(data), len(data))
