import random

import pytest
from pyspark.sql import functions as F

from cellamp.config import Params, Region, RegionConfig, allowed_mismatches
from cellamp.functions import calls, distance, phred
from cellamp.operators import regions
from cellamp.operators.chunks import chunk_reads
from cellamp.plans import fixture
from tests import brute


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_allowances_round_half_to_even():
    assert [allowed_mismatches(n, 0.5) for n in (1, 3, 5, 7)] == [0, 2, 2, 4]
    assert [fixture.LINEAR.allowance(r, 0.2) for r in ("primer", "shared", "wt")] == [4, 1, 2]


def test_region_config_rejects_other_layouts():
    with pytest.raises(ValueError):
        RegionConfig((Region("primer", "A", 1, 1),))
    with pytest.raises(ValueError):
        Region("primer", "", 1, 1)


def test_phred(spark):
    assert one(spark, phred.packed_scores(F.lit("!IJK+"))) == "0;40;41;;10;"
    assert one(spark, phred.packed_scores(F.lit(""))) == ""
    assert one(spark, phred.error_sum(F.lit("!IK"))) == 100010
    assert one(spark, phred.score_sum(F.lit("I~J"))) == 81
    assert [one(spark, phred.score_at(F.lit("5I~"), F.lit(i))) for i in (0, 1, 2, 3)] == [20, 40, 0, 0]
    assert one(spark, phred.unknown_symbols(F.lit("!~IJKé"))) == 3
    assert one(spark, phred.symbols_from_packed(F.lit("40;;x;20;"))) == "I!!5"


def test_calls(spark):
    reads = spark.createDataFrame([(0, 0), (0, 9), (9, 0), (9, 9)], "w int, m int")
    both = reads.select(calls.read_call(F.col("w"), F.col("m"), 2), calls.cell_call(F.col("w"), F.col("m"), 2))
    assert [tuple(r) for r in both.collect()] == [("amb", "MUT"), ("WT", "WT"), ("MUT", "MUT"), ("amb", "amb")]
    pairs = spark.createDataFrame([(0, 0), (3, 1), (4, 1), (1, 4), (1, 1)], "w bigint, m bigint")
    called = pairs.select(calls.pair_call(F.col("w"), F.col("m"), 0.75), calls.collapsed_call(F.col("w"), F.col("m"), 0.75))
    assert [tuple(r) for r in called.collect()] == [("AMB",) * 2, ("AMB",) * 2, ("WT",) * 2, ("MUT",) * 2, ("AMB",) * 2]
    tie = pairs.filter("w = 1 AND m = 1").select(calls.collapsed_call(F.col("w"), F.col("m"), 0.4)).first()[0]
    assert tie == "MUT"


def test_thresholds_and_cleaning(spark):
    assert [one(spark, calls.distance_threshold(F.lit(n), 0.2)) for n in (4, 5, 10, 12, 15)] == [0, 1, 2, 2, 3]
    assert one(spark, calls.distance_threshold(F.lit(12), 3)) == 3
    texts = spark.createDataFrame([(None,), ('""',), (' "a b" ',), ('"',), ("x",)], "t string")
    assert [r[0] for r in texts.select(calls.clean_field(F.col("t"))).collect()] == ["", "", "a b", '"', "x"]
    numbers = spark.createDataFrame([(None,), ("",), ("7",), ("x",), (" 8 ",)], "t string")
    assert [r[0] for r in numbers.select(calls.lenient_int(F.col("t"))).collect()] == [0, 0, 7, 0, 8]


def test_distance_against_loops(spark):
    rng = random.Random(5)
    word = lambda sizes: "".join(rng.choice("ACGT") for _ in range(rng.choice(sizes)))
    pairs = [(word((0, 1, 5, 12)), word((0, 1, 6, 12))) for _ in range(2000)]
    left, right = [a for a, _ in pairs], [b for _, b in pairs]
    expected = [brute.substring_distance(a, b) for a, b in pairs]
    assert distance.distances(left, right).tolist() == expected
    assert distance.distances(left, right, "levenshtein").tolist() == [brute.levenshtein(a, b) for a, b in pairs]
    frame = spark.createDataFrame(pairs, "a string, b string")
    capped = frame.select("a", "b", distance.capped_distance(F.col("a"), F.col("b"), F.lit(2)).alias("d"),
                          distance.levenshtein_bound(F.col("a"), F.col("b"), F.lit(2)).alias("near")).collect()
    for row, d in zip(capped, expected):
        assert row.d == min(d, 3)
        assert row.near or d > 2


def test_distance_is_directed():
    assert distance.distances(["AXBC", "ABCD"], ["ABCD", "AXBC"]).tolist() == [1, 2]


def test_arrow_scan_equals_native_functions(spark, sf_dir):
    reads = fixture.damaged_reads(spark, sf_dir)
    arrow = regions.looked(reads, fixture.CIRC).drop("is_bad")
    native = regions.looked_native(reads, fixture.CIRC)
    assert arrow.exceptAll(native).isEmpty() and native.exceptAll(arrow).isEmpty()


def test_scan_edge_cases(spark):
    config = RegionConfig((Region("primer", "ACGTA", 1, 5), Region("shared", "CC", 6, 7), Region("wt", "GG", 8, 9),
                           Region("mut", "GT", 8, 9)))
    rows = [(1, "ACGTACCGG", "IIIIIIIII"), (2, "", ""), (3, "TACGTACCGG", "~IIIIIIIII"), (4, "ACGTA", "IIIII"),
            (5, None, None), (6, "ACGTACCGG", "~~~~~~~~~")]
    reads = spark.createDataFrame([(i, "A" * 28, "I" * 28, s, q) for i, s, q in rows],
                                  "read_id bigint, seq_r1 string, qual_r1 string, seq_r2 string, qual_r2 string")
    got = {r.read_id: r for r in regions.looked(reads, config, Params(mismatch_ratio=0.0)).collect()}
    assert (got[1].shift, got[1].mm_primer, got[1].mm_shared, got[1].mm_wt, got[1].mm_mut) == (0, 0, 0, 0, 1)
    assert (got[3].shift, got[3].mm_primer, got[3].mm_shared) == (1, 0, 0)
    assert got[3].err_r2 == 90 and got[3].err_primer == 40
    assert (got[2].mm_primer, got[2].mm_shared, got[2].is_bad) == (5, 2, True)
    assert [got[i].is_bad for i in (1, 3, 4, 6)] == [False, False, True, True]


def test_chunk_sizes():
    assert chunk_reads(10_000, 3000) == 3334
    assert chunk_reads(9_000, 3000) == 3000
    assert chunk_reads(8_800, 3000) == 3000
    assert chunk_reads(100, 3000) == 100
    assert chunk_reads(2_900, 3000) == 3000
