"""Chunk tables under their final names: more than four digits, none of the driver's doing, failures and tables that are there."""

import os

import pytest
from pyspark.sql import functions as F

from cellamp.operators import combine
from cellamp.sources import sinks, tables

FIELDS = ("umi", "n_wt", "n_mut", "n_amb", "call", "whitelist")


def summary(spark, chunks):
    rows = [(c, n, 0, f"CELL{n}", *([f"U{c};V", f"{n};1", "0;2", "0;0", "WT;MUT", "Y"])) for c in chunks for n in range(3)]
    names = ["chunk_id", "first_seen", "part", "bc_list", *[f"{f}_list" for f in FIELDS]]
    return spark.createDataFrame(rows, ", ".join(f"{n} {'bigint' if k < 3 else 'string'}" for k, n in enumerate(names))).repartition(3)


def listed(root):
    return sorted(os.path.join(folder, f)[len(str(root)) + 1 :] for folder, _, files in os.walk(root) for f in files if not f.endswith(".crc"))


def test_folders_of_any_number(spark, tmp_path):
    chunks = [0, 7, 9_999, 10_000, 123_456]
    sinks.write_chunk_tables(summary(spark, chunks), str(tmp_path), "s")
    assert listed(tmp_path) == sorted(["_SUCCESS", *[f"{c:04d}/s.summTable.txt" for c in chunks]])
    paths = tables.chunk_table_paths(spark, str(tmp_path), "s")
    assert [int(p.split("/")[-2]) for p in paths] == chunks
    with open(tmp_path / "0007/s.summTable.txt") as table:
        lines = table.read().split("\n")
    assert lines[0].split("\t")[:2] == ["BC", "whitelist"] and len(lines) == 5 and lines[1].split("\t")[2] == "U7;V"
    read = combine.unpack(tables.read_chunk_tables(spark, paths), tables.ROW_ORDER)
    pairs = combine.sum_pairs(read)
    assert {(r.bc, r.umi): r.n_wt for r in pairs.collect()}[("CELL2", "U10000")] == 2
    # First appearances follow the numbers of the folders.
    assert [r.umi for r in pairs.filter("bc = 'CELL0' AND umi <> 'V'").orderBy("first_seen").collect()] == [f"U{c}" for c in chunks]


def test_tables_that_are_there_are_an_error(spark, tmp_path):
    sinks.write_chunk_tables(summary(spark, [1]), str(tmp_path), "s")
    with pytest.raises(FileExistsError):
        sinks.write_chunk_tables(summary(spark, [2]), str(tmp_path), "s")
    sinks.write_chunk_tables(summary(spark, [1]), str(tmp_path), "other")
    assert len(listed(tmp_path)) == 3


def test_a_job_that_fails_leaves_no_table(spark, tmp_path):
    broken = summary(spark, range(40)).withColumn(
        "umi_list", F.when(F.col("chunk_id") == 33, F.raise_error(F.lit("damaged")).cast("string")).otherwise(F.col("umi_list"))
    )
    with pytest.raises(Exception, match="damaged"):
        sinks.write_chunk_tables(broken, str(tmp_path), "s")
    assert listed(tmp_path) == []


def test_no_rows(spark, tmp_path):
    sinks.write_chunk_tables(summary(spark, [1]).limit(0), str(tmp_path), "s")
    assert listed(tmp_path) == ["_SUCCESS"] and tables.chunk_table_paths(spark, str(tmp_path), "s") == []
