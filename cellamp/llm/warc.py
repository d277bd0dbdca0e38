"""WARC archives: writing with revisit records, and reading with verified record boundaries.

Writing: one record per page. Of records with equal payloads of ``REVISIT_BYTES`` or more, the one with the largest page_id is
a response and the others are revisits that refer to it; smaller payloads are always responses. Files are written by Spark's text
writer, whose line separator is the two empty lines that end a record, so a lost task is written again.

Reading: Spark cuts the files at the version line that starts a record, wherever it occurs, also inside a payload. Every piece is a
candidate record, and its header says where its successor would start. Within one stretch of a file a task follows these
links to where they leave the stretch; from the start of the file, pointer jumping over stretches keeps the candidates that are reachable. All
others are part of the payload in which they lie. Pieces are joined to records only where a payload holds such a line.

A null html is an empty payload, a null url an empty target. Pages without page_id are written with an empty id and read back as null;
they are responses only if no page with an id has the same payload. Repeated rows give a record each. Line breaks in a url are
percent-encoded. Header fields of other writers are kept out of the way: unknown fields are ignored, records without the fields of
this module give nulls. Archives are read uncompressed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellamp.session import shared_dir, store

# The format's version line, line ends, and the end of a record.
VERSION = "WARC/1.1\r\n"
MARK = "WARC/1."
VERSIONS = ("0\r\n", "1\r\n")
BREAK = "\r\n"
END = "\r\n\r\n"
REVISIT_BYTES = 1000
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "


def payloads(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    body = F.coalesce(F.col(html), F.lit(""))
    target = F.coalesce(F.col(url), F.lit(""))
    return pages.select(
        F.col(page_id).alias("page_id"),
        F.regexp_replace(F.regexp_replace(target, "\r", "%0D"), "\n", "%0A").alias("url"),
        body.alias("payload"),
        F.octet_length(body).cast("bigint").alias("payload_bytes"),
        F.sha1(body.cast("binary")).alias("payload_digest"),
    )


def with_originals(pages: DataFrame) -> DataFrame:
    """Append refers_to: the page that holds the payload, null for responses.

    Only ids and digests move. The rows that become revisits are joined back to the pages, by way of all tasks while Spark finds them small.
    """
    narrow = store(pages.filter(F.col("payload_bytes") >= REVISIT_BYTES).select("page_id", "payload_digest"))
    groups = store(
        narrow.groupBy("payload_digest").agg(F.count("*").alias("n"), F.max("page_id").alias("refers_to"))
        .filter("n > 1 and refers_to is not null").drop("n")
    )
    moved = narrow.join(groups, "payload_digest").filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    revisits = store(moved.select(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest"), "refers_to").distinct())
    same = F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("payload_digest") == F.col("_digest"))
    return pages.join(revisits, same, "left").drop("_id", "_digest")


def record() -> Column:
    """The text of a record without its end, from the columns of ``with_originals``."""
    http = F.concat(F.lit(HTTP), F.col("payload_bytes").cast("string"), F.lit(END))
    block = F.when(F.col("refers_to").isNull(), F.concat(http, "payload")).otherwise(http)

    def field(name: str, value: Column | str) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(BREAK))

    def page(column: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(">"))

    revisit = F.col("refers_to").isNotNull()
    return F.concat(
        F.lit(VERSION),
        field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", page("page_id")),
        F.when(revisit, field("WARC-Refers-To", page("refers_to"))).otherwise(""),
        field("WARC-Target-URI", F.col("url")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        field("X-Payload-Bytes", F.col("payload_bytes").cast("string")),
        field("Content-Type", F.lit("application/http;msgtype=response")),
        field("Content-Length", F.octet_length(block).cast("string")),
        F.lit(BREAK),
        block,
    )


def write_archives(pages: DataFrame, path: str | None = None, **columns: str) -> str:
    """Write the pages as archives into a folder and return it."""
    spark = pages.sparkSession
    if path is None:
        path = f"{shared_dir(spark).rstrip('/')}/cellamp/{spark.sparkContext.applicationId}/warc-{uuid.uuid4().hex}"
    records = with_originals(payloads(pages, **columns)).select(record().alias("value"))
    records.write.option("lineSep", END).text(path)
    return path


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Pieces of the archives with their places: (file, stretch, start, piece, head_bytes, next).

    ``start`` counts bytes from the first piece of the stretch; ``next`` is where the successor would start, null where the piece has no
    complete header.
    """
    lines = spark.read.option("lineSep", MARK).text(path)
    cut = lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("stretch"), F.col("value").alias("piece")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        here, at = None, 0
        for batch in batches:
            starts, sizes = [], pc.binary_length(batch.column(2)).to_pylist()
            for file, stretch, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), sizes, strict=True):
                if (file, stretch) != here:
                    # The first piece of a file is what precedes the first version line.
                    here, at = (file, stretch), -len(MARK) if stretch == 0 else 0
                starts.append(at)
                at += len(MARK) + size
            yield pa.record_batch([*batch.columns, pa.array(starts, pa.int64())], ["file", "stretch", "piece", "start"])

    placed = cut.mapInArrow(place, "file string, stretch bigint, piece string, start bigint")
    # A piece begins with the rest of its version line, which counts as a part of the header.
    versioned = F.substring("piece", 1, 3).isin(*VERSIONS) & (F.instr("piece", END) > 0)
    header = F.when(versioned, F.substring_index("piece", END, 1))
    length = F.regexp_extract(F.concat(F.lit(BREAK), header), r"(?i)\r\nContent-Length: *([0-9]{1,15})(?:\r|$)", 1)
    head_bytes = F.octet_length(header) + len(END)
    return placed.withColumn("header", header).withColumn("head_bytes", head_bytes.cast("bigint")).withColumn(
        "length", F.when(length != "", length.cast("bigint"))
    ).withColumn("next", F.col("start") + len(MARK) + F.col("head_bytes") + F.col("length") + len(END))


def _field(name: str, pattern: str = r"([^\r]*)") -> Column:
    found = F.regexp_extract(F.concat(F.lit(BREAK), "header"), rf"(?i)\r\n{name}: *{pattern}", 1)
    return F.when(found != "", found)


def parsed(pieces: DataFrame) -> DataFrame:
    """Fields of the record that a piece would be; ``complete`` tells whether the piece holds all of its bytes."""
    rest = F.expr("substring(piece, length(header) + 5, greatest(0, length(piece) - length(header) - 8))")
    payload = F.when(F.instr(rest, END) > 0, F.expr("substring(_rest, instr(_rest, '\\r\\n\\r\\n') + 4)")).otherwise(rest)
    size = F.octet_length("piece")
    revisit = F.lower(_field("WARC-Type")) == "revisit"
    return (
        pieces.withColumn("size", size.cast("bigint"))
        .withColumn("complete", F.coalesce(F.col("head_bytes") + F.col("length") + len(END) == F.col("size"), F.lit(False)))
        .withColumn("_rest", F.when(F.col("complete"), rest))
        .withColumn("_payload", payload)
        .withColumns(
            {
                "page_id": _field("WARC-Record-ID", "<urn:page:(-?[0-9]+)>").cast("bigint"),
                "record_type": F.lower(_field("WARC-Type")),
                "refers_to": _field("WARC-Refers-To", "<urn:page:(-?[0-9]+)>").cast("bigint"),
                "url": _field("WARC-Target-URI"),
                "payload_bytes": F.when(revisit, _field("X-Payload-Bytes").cast("bigint")).otherwise(F.octet_length("_payload")),
                "payload_digest": F.when(revisit, _field("WARC-Payload-Digest", "sha1:([0-9a-f]+)")).otherwise(
                    F.sha1(F.col("_payload").cast("binary"))
                ),
            }
        )
    )


FIELDS = ("page_id", "record_type", "refers_to", "url", "payload_bytes", "payload_digest")


def contract(group: pd.DataFrame) -> pd.DataFrame:
    """Follow the links of one stretch: where the chain from each candidate leaves it, if it does."""
    group = group.sort_values("at")
    at, to, stop = group["at"].tolist(), group["to"].tolist(), int(group["stop"].iloc[0])
    leaves: dict[int, int | None] = {}
    for here, there in zip(reversed(at), reversed(to), strict=True):
        leaves[here] = None if there < 0 else there if there >= stop else leaves.get(there)
    group["leave"] = [leaves[here] if leaves[here] is not None else -1 for here in at]
    return group[["file", "stretch", "at", "leave"]]


def walk(group: pd.DataFrame) -> pd.DataFrame:
    """Candidates of one stretch on the chain from its entry."""
    links = dict(zip(group["at"].tolist(), group["to"].tolist(), strict=True))
    chain, here = [], int(group["entry"].iloc[0])
    while here in links:
        chain.append(here)
        here = links[here]
    return group[group["at"].isin(chain)][["file", "stretch", "start"]]


def reachable(links: DataFrame) -> DataFrame:
    """(file, stretch, start) of the candidates on the chain from the start of their file.

    ``links`` is a stored table (file, stretch, start, at, to, stop) of places in the file; -1 stands for no successor.
    """
    leaves = store(
        links.groupBy("file", "stretch").applyInPandas(contract, "file string, stretch bigint, at bigint, leave bigint")
    )
    # Chains of a stretch run together, so only a few candidates are entered from another stretch.
    entered = leaves.select("file", F.col("leave").alias("at")).filter("at >= 0").union(leaves.select("file", F.lit(0).cast("bigint").alias("at")))
    jumps = store(leaves.join(entered.distinct(), ["file", "at"]))
    reached = store(jumps.filter("at = 0").select("file", "at"))
    while True:
        ahead = jumps.select("file", "at", "leave").join(reached, ["file", "at"]).select("file", F.col("leave").alias("at"))
        more = store(ahead.join(jumps.select("file", "at"), ["file", "at"]).union(reached).distinct())
        if more.count() == reached.count():
            break
        reached = more
        further = jumps.select("file", F.col("at").alias("leave"), F.col("leave").alias("then"))
        jumps = store(
            jumps.join(further, ["file", "leave"], "left").select("file", "at", "stretch", F.coalesce("then", F.lit(-1)).cast("bigint").alias("leave"))
        )
    entries = jumps.join(reached, ["file", "at"]).select("file", "stretch", F.col("at").alias("entry"))
    return links.join(store(entries), ["file", "stretch"]).groupBy("file", "stretch").applyInPandas(walk, "file string, stretch bigint, start bigint")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives in a folder, with the columns FIELDS. A file that starts with no record is an error.

    Payloads are measured where they are read; from then on only places and fields move.
    """
    pieces = candidates(spark, path)
    parts = store(parsed(pieces).select("file", "stretch", "start", "size", "next", "complete", *FIELDS))
    foreign = parts.filter("stretch = 0 and ((start < 0 and size > 0) or (start = 0 and next is null))").select("file").first()
    if foreign:
        raise ValueError(f"{foreign.file} does not start with a record of a known version")
    spans = parts.groupBy("file", "stretch").agg(F.max(F.col("start") + len(MARK) + F.col("size")).alias("span"))
    before = F.sum("span").over(W.partitionBy("file").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1))
    bases = store(spans.withColumn("base", F.coalesce(before, F.lit(0))))  # one row per stretch
    links = store(
        parts.filter("start >= 0").join(bases, ["file", "stretch"]).select(
            "file", "stretch", "start", (F.col("base") + F.col("start")).alias("at"),
            F.coalesce(F.col("base") + F.col("next"), F.lit(-1)).alias("to"), (F.col("base") + F.col("span")).alias("stop"),
        )
    )
    records = store(parts.join(reachable(links), ["file", "stretch", "start"]))
    whole = records.filter("complete").select(*FIELDS)
    torn = records.filter("not complete")
    if torn.isEmpty():
        return whole
    return whole.union(_mended(pieces, links, torn).select(*FIELDS))


def _mended(pieces: DataFrame, links: DataFrame, torn: DataFrame) -> DataFrame:
    """Records whose payload holds version lines, put together from their pieces."""
    key = ["file", "stretch", "start"]
    heads = links.join(torn.select(*key), key).select("file", F.col("at").alias("head"), F.col("to").alias("end"))
    # Ranges do not overlap, so the last head before a piece is the only one that can hold it.
    marks = links.select(*key, "at").join(heads.select("file").distinct(), "file").join(
        heads.withColumnRenamed("head", "at"), ["file", "at"], "left"
    )
    last = W.partitionBy("file").orderBy("at").rowsBetween(W.unboundedPreceding, W.currentRow)
    holder = F.last(F.when(F.col("end").isNotNull(), F.struct(F.col("at").alias("head"), "end")), ignorenulls=True).over(last)
    held = store(
        marks.withColumn("holder", holder).filter("at < holder.end").select(*key, "at", F.col("holder.head").alias("head"))
    )
    texts = pieces.join(held, key).groupBy("file", "head").agg(F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("all"))
    # What is collected is the text of one record. This scan must have cut the files where the first one did.
    lost = F.raise_error(F.lit("the pieces of the archives differ between two scans")).cast("string")
    wanted = held.groupBy("file", "head").agg(F.count("*").alias("n")).join(texts, ["file", "head"], "left")
    whole = F.when(F.size("all") == F.col("n"), F.array_join(F.transform("all", lambda p: p["piece"]), MARK)).otherwise(lost)
    joined = wanted.select("file", whole.alias("piece"))
    header = F.substring_index("piece", END, 1)
    again = joined.withColumn("header", header).withColumn("head_bytes", (F.octet_length("header") + len(END)).cast("bigint"))
    length = F.regexp_extract(F.concat(F.lit(BREAK), "header"), r"(?i)\r\nContent-Length: *([0-9]{1,15})", 1)
    return parsed(again.withColumn("length", length.cast("bigint")))
