"""Ranks of numbers, short barcodes, and records with missing fields."""

import pytest

from cellamp.operators import whitelist
from cellamp.sources import sinks


def test_numbers_are_ranked_as_numbers(spark):
    rows = [(f"B{k:02d}", k * 40_000) for k in range(13)]
    got = whitelist.ordered_whitelist(spark.createDataFrame(rows, "bc string, position bigint")).collect()
    assert {r.bc: r.wl_idx for r in got} == {b: k for k, (b, _) in enumerate(rows)}


@pytest.mark.parametrize("rows", [4_000_000, 0])
def test_short_barcodes_have_candidates(spark, rows):
    observed = spark.createDataFrame([("AAC",), ("AAAC",), ("",)], "bc string")
    listed = spark.createDataFrame([("AAA", 0), ("AAAA", 1), ("AGAC", 2)], "bc string, wl_idx bigint")
    got = whitelist.hamming1_candidates(observed, listed, 4, broadcast_rows=rows).collect()
    assert {(r.obs, r.bc, r.pos) for r in got} == {("AAC", "AAA", 2), ("AAAC", "AAAA", 3), ("AAAC", "AGAC", 1)}


def test_records_have_four_lines(spark, tmp_path):
    schema = "read_id bigint, chunk_id int, header_r1 string, seq_r1 string, qual_r1 string"
    sinks.write_fastq_chunks(spark.createDataFrame([(1, 0, None, "ACGT", None)], schema), f"{tmp_path}/a", 1)
    assert [r.value for r in spark.read.text(f"{tmp_path}/a").collect()] == ["", "ACGT", "+", ""]
    with pytest.raises(Exception, match="without seq_r1"):
        sinks.write_fastq_chunks(spark.createDataFrame([(1, 0, "@h", None, "I")], schema), f"{tmp_path}/b", 1)
