"""What a run counts of damaged input, on the pass that does its work."""

import pytest

from cellamp.functions import phred
from cellamp.operators import regions
from cellamp.plans import fixture
from cellamp.plans.genotype import CombineRun, GenotypeRun


def test_damaged_reads_are_counted_without_another_scan(spark, sf_dir):
    reads = fixture.damaged_reads(spark, sf_dir)
    run = GenotypeRun(reads, fixture.whitelist(spark, sf_dir), fixture.LINEAR)
    run.primed.count()
    spark.sparkContext.setJobGroup("counts", "counts of a run")
    counts = run.counts
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("counts")) == []
    spark.sparkContext.setJobGroup("other", "")
    rows = reads.collect()
    unknown = lambda text: sum(not 0 <= ord(s) - phred.OFFSET <= phred.MAX_Q for s in text)
    assert counts == {
        "reads": len(rows),
        "unknown_symbols": sum(unknown(r.qual_r1) + unknown(r.qual_r2) for r in rows),
        "bad_reads": run.bad_reads.count(),
    }
    assert min(counts.values()) > 0
    # Being counted changes nothing.
    assert run.primed.count() == regions.primed(regions.good_reads(run.scored), fixture.LINEAR).count()


def test_no_reads_and_missing_qualities(spark):
    schema = "read_id bigint, seq_r1 string, qual_r1 string, seq_r2 string, qual_r2 string"
    listed = spark.createDataFrame([("ACGT", 0)], "bc string, wl_idx bigint")
    empty = GenotypeRun(spark.createDataFrame([], schema), listed, fixture.LINEAR)
    assert empty.counts == {"reads": 0, "unknown_symbols": 0, "bad_reads": 0}
    odd = GenotypeRun(spark.createDataFrame([(1, "AC", "\x7f ", "", ""), (2, "", None, "", "")], schema), listed, fixture.LINEAR)
    assert odd.counts == {"reads": 2, "unknown_symbols": 2, "bad_reads": 2}


def test_uneven_lists_are_counted_while_tables_are_read(spark):
    rows = [("A", "U;V", "1;2", "0;0", "0;0"), ("B;B", "U;V", "1", "0;0", "0;0"), ("C", "U", "x", "0", None), ("D", None, "", "", "")]
    tables = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "at int, bc string, umi string, n_wt string, n_mut string, n_amb string")
    run = CombineRun(tables, ["at"])
    assert run.counts == {"packed_rows": 4, "uneven_rows": 1}
    assert {(r.bc, r.umi): r.n_wt for r in run.pairs.collect()} == {("A", "U"): 1, ("A", "V"): 2, ("B", "U"): 1, ("B", "V"): 0, ("C", "U"): 0, ("D", ""): 0}
    assert CombineRun(tables.limit(0), ["at"]).counts == {"packed_rows": 0, "uneven_rows": 0}


def test_a_run_that_was_given_its_table_has_no_counts(spark):
    run = GenotypeRun(None, None, fixture.LINEAR)
    run.primed = spark.range(1)
    with pytest.raises(RuntimeError):
        _ = run.counts
