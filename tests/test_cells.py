"""Rescue, duplicates, packing and collapse against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from cellamp.config import Params
from cellamp.operators import cells, combine, dedup, packing, rescue, umi_collapse, umi_graph, whitelist
from cellamp.plans import queries
from cellamp.session import store
from tests import brute

BASES = "ACGT"


@pytest.fixture(scope="module")
def run(spark, sf_dir, shared_runs):
    return queries._run(spark, sf_dir)


def _mutate(rng, text, n):
    out = list(text)
    for _ in range(n):
        out[rng.randrange(len(out))] = rng.choice(BASES)
    return "".join(out)


def test_hamming_join(spark):
    rng = random.Random(1)
    wl = sorted({"".join(rng.choice("AC") for _ in range(6)) for _ in range(30)})
    obs = sorted({"".join(rng.choice("ACN") for _ in range(6)) for _ in range(60)})
    a = spark.createDataFrame([(b,) for b in obs], "bc string")
    b = spark.createDataFrame(list(zip(wl, range(len(wl)))), "bc string, wl_idx bigint")
    got = {(r.obs, r.bc, r.distance) for r in whitelist.hamming_join(a, b, 2, 6).collect()}
    dist = lambda x, y: sum(p != q for p, q in zip(x, y))
    assert got == {(x, y, dist(x, y)) for x in obs for y in wl if dist(x, y) <= 2}


def test_candidates_only_from_the_letters(spark):
    obs = spark.createDataFrame([("AAAA",)], "bc string")
    wl = spark.createDataFrame([("AAAN", 1), ("XAAA", 0), ("AACA", 2), ("AA", 3)], "bc string, wl_idx bigint")
    for limit in (10, 0):
        got = whitelist.hamming1_candidates(obs, wl, 4, broadcast_rows=limit).collect()
        assert {(r.bc, r.pos) for r in got} == {("AAAN", 3), ("AACA", 2)}


def test_both_whitelist_joins_agree(run):
    small = run.primed.select("read_id", "bc")
    one = whitelist.flag_whitelisted(small, run.stored_whitelist)
    other = whitelist.flag_whitelisted(small, run.stored_whitelist, broadcast_rows=0)
    assert one.exceptAll(other).isEmpty() and one.count() == other.count()


@pytest.mark.parametrize("options", [{}, {"posterior": 0.4}, {"posterior": 0.0}, {"zero_prior_not_sig": True}])
def test_decisions(spark, options):
    rng = random.Random(7)
    listed = ["AAAA", "AAAC", "AAGA", "CAAA", "TTTT", "TTTG", "GGGG"]
    priors = {"AAAA": 5, "AAAC": 5, "AAGA": 1, "TTTT": 0, "TTTG": 3}
    seen = sorted({_mutate(rng, rng.choice(listed), 1) for _ in range(60)} - set(listed))
    observed = [(b, 1, False) for b in seen] + [(b, n, True) for b, n in priors.items() if n]
    reads = [(i, rng.choice(seen), "".join(rng.choice("+5?IJ") for _ in range(4))) for i in range(300)]
    params = Params(bc_len=4, **options)
    wl = spark.createDataFrame(list(zip(listed, range(9))), "bc string, wl_idx bigint")
    frame = spark.createDataFrame(reads, "read_id bigint, bc string, bc_qual string")
    obs = store(spark.createDataFrame(observed, "bc string, n_reads bigint, listed boolean"))
    got = rescue.decide(rescue.with_candidates(frame, obs, wl, params), params).collect()
    by_id = {i: (b, [ord(c) - 33 for c in q]) for i, b, q in reads}
    assert len(got) == len(reads)
    for r in got:
        status, bc = brute.rescue(*by_id[r.read_id], listed, priors, params.posterior)
        if status == "NO_in_SAVED" and params.zero_prior_not_sig:
            status = "Not_Sig"
        assert (r.status, r.replaced_bc) == (status, bc)


def test_tie_of_two_is_not_significant(spark):
    wl = spark.createDataFrame([("AC", 0), ("CA", 1)], "bc string, wl_idx bigint")
    obs = store(spark.createDataFrame([("AA", 1, False), ("AC", 2, True), ("CA", 2, True)], "bc string, n_reads bigint, listed boolean"))
    reads = spark.createDataFrame([(1, "AA", "II")], "read_id bigint, bc string, bc_qual string")
    for cutoff in (0.99, 0.5, 0.3):
        params = Params(bc_len=2, posterior=cutoff)
        got = rescue.decide(rescue.with_candidates(reads, obs, wl, params), params).first()
        assert (got.status, got.replaced_bc) == ("Not_Sig", None)


def test_representatives(run):
    config = run.config
    groups = {}
    for r in run.corrected.collect():
        groups.setdefault((r.bc, r.umi), []).append(r)
    call = lambda r: {(True, False): "WT", (False, True): "MUT"}.get((r.mm_wt <= 2, r.mm_mut <= 2), "amb")
    got = dedup.representatives(run.corrected, config).collect()
    assert len(got) == len(groups)
    for g in got:
        rows = sorted(groups[g.bc, g.umi], key=lambda r: (r.part, r.read_id))
        wt, mut = (sum(call(r) == c for r in rows) for c in ("WT", "MUT"))
        pool = [r for r in rows if call(r) == "MUT"] if wt < mut else rows
        low = [r for r in pool if r.err_wt == min(p.err_wt for p in pool)]
        best = max(low, key=lambda r: sum(ord(c) - 33 for c in r.bc_qual))
        assert (g.read_id, g.n_wt, g.n_mut, g.total_dups) == (best.read_id, wt, mut, len(rows))
        assert (g.first_seen.part, g.first_seen.read_id) == (rows[0].part, rows[0].read_id)


def test_parts_of_large_cells(run):
    whole = cells.cell_summary(run.merged, run.config)
    parts = cells.cell_summary(run.merged, run.config, max_packed=4)
    assert parts.count() > whole.count()
    joined = {}
    for r in parts.orderBy("bc", "part").collect():
        joined.setdefault(r.bc, []).append(r)
    for r in whole.collect():
        pieces = joined[r.bc]
        umis = r.umi_list.split(";")
        assert [p.umi_list.split(";") for p in pieces] == [umis[k : k + 4] for k in range(0, len(umis), 4)]
        assert [p.part for p in pieces] == list(range(len(pieces)))
        assert all(p.wt_calls == r.wt_calls and p.first_seen == r.first_seen for p in pieces)


def test_cell_cut(run):
    params = Params(dupcut=40)
    kept = {r.bc for r in cells.cell_summary(run.merged, run.config, params).collect()}
    assert {r.bc for r in cells.surviving_rows(run.merged, params).collect()} == kept
    assert 0 < len(kept) < run.merged.select("bc").distinct().count()


def test_unpack_uneven_lists(spark):
    tables = spark.createDataFrame(
        [("B;B", "u1;u2", "1;x", "2", "", 0), ("C", "u3", "4", "5", "6", 1)],
        "bc string, umi string, n_wt string, n_mut string, n_amb string, row int",
    )
    got = {(r.bc, r.umi): (r.n_wt, r.n_mut, r.n_amb) for r in combine.unpack(tables, ["row"]).collect()}
    assert got == {("B", "u1"): (1, 2, 0), ("B", "u2"): (0, 0, 0), ("C", "u3"): (4, 5, 6)}
    assert [r.bc for r in combine.uneven_rows(tables).collect()] == ["B;B"]


def test_one_chunk_equals_no_chunks(run):
    params = Params(chunk_cols=("chunk_id",))
    one = run.primed.withColumn("chunk_id", F.lit(0))
    chunked = dedup.duplicate_counts(rescue.corrected_reads(store(one), run.stored_whitelist, params), run.config, params)
    plain = dedup.duplicate_counts(run.corrected, run.config)
    assert chunked.drop("chunk_id").exceptAll(plain).isEmpty() and chunked.count() == plain.count()


def _random_cells(seed, sizes, lengths=(12,)):
    rng = random.Random(seed)
    rows = []
    for c, size in enumerate(sizes):
        roots = ["".join(rng.choice(BASES) for _ in range(rng.choice(lengths))) for _ in range(max(1, size // 5))]
        umis = set()
        while len(umis) < size:
            umi = _mutate(rng, rng.choice(roots), rng.choice((0, 1, 2)))
            shift = rng.choice((0, 0, 0, 1))
            umis.add((umi[shift:] + "".join(rng.choice(BASES) for _ in range(shift)))[: rng.choice(lengths)])
        for umi in umis:
            wt, mut, amb = (rng.choice((0, 0, 1, 2, 7)) for _ in range(3))
            rows.append((f"cell{c}", umi, wt, mut, amb, brute.recall(wt, mut, 0.75)))
    return rows


SCHEMA = "bc string, umi string, n_wt bigint, n_mut bigint, n_amb bigint, call string"


@pytest.mark.parametrize("metric", ["unanchored", "levenshtein"])
@pytest.mark.parametrize("distance,lengths", [(0.2, (12,)), (0.2, (6, 9, 12)), (4, (12,)), (1, (3, 12))])
def test_edges(spark, metric, distance, lengths):
    rows = _random_cells(3, (25, 1, 12), lengths)
    pairs = store(spark.createDataFrame(rows, SCHEMA))
    params = Params(umi_distance=distance, umi_metric=metric)
    found = [umi_graph.umi_edges(pairs, params, limit).collect() for limit in (2000, 15, 0)]
    fn = brute.levenshtein if metric == "levenshtein" else brute.substring_distance
    expected = {(bc, a, b) for bc, cell in brute.cells_of([dict(zip(("bc", "umi", "n_wt", "n_mut", "n_amb", "call"), r)) for r in rows]).items()
                for a, b in brute.edges(cell, distance, fn)}
    for edges in found:
        assert len(edges) == len(expected) and {(r.bc, r.src, r.dst) for r in edges} == expected


@pytest.mark.parametrize("limits", [{}, {"max_cell": 3}, {"max_cell": 3, "max_component": 6}, {"max_cell": 20, "max_component": 0}])
def test_collapse(spark, limits):
    rows = _random_cells(11, (40, 1, 15, 8), (12, 12, 12, 11))
    pairs = store(spark.createDataFrame(rows, SCHEMA))
    params = Params()
    got = brute.cells_of(umi_collapse.collapse_umis(pairs, params, **limits).collect())
    names = ("bc", "umi", "n_wt", "n_mut", "n_amb", "call")
    expected = {}
    for bc, cell in brute.cells_of([dict(zip(names, r)) for r in rows]).items():
        links = brute.edges(cell, params.umi_distance)
        expected[bc] = brute.collapse(cell, links, params.pcr_threshold)
    assert dict(got) == expected
    assert len(expected["cell0"]) < 40


def test_collapse_of_asymmetric_chains(spark):
    """Directed edges make nodes that point into a closure and stay behind."""
    rng = random.Random(2)
    for _ in range(300):
        n = rng.randrange(1, 9)
        near = [[j for j in range(n) if j != i and rng.random() < 0.25] for i in range(n)]
        counts = [(rng.randrange(4), rng.randrange(4), rng.randrange(4)) for _ in range(n)]
        names = [f"u{i}" for i in range(n)]
        cell = {u: (*c, "-") for u, c in zip(names, counts)}
        expected = brute.collapse(cell, {(names[i], names[j]) for i in range(n) for j in near[i]}, 0.75)
        alive, summed, _ = umi_collapse.greedy_collapse(near, umi_collapse.np.array(counts))
        assert {names[i]: tuple(summed[i]) for i in range(n) if alive[i]} == {u: v[:3] for u, v in expected.items()}


def test_collapse_keeps_reads_and_lists_emptied_cells(spark):
    rows = [("a", "AAAACCCCGGGG", 1, 0, 3, "WT"), ("b", "AAAACCCCGGGG", 5, 0, 0, "WT"), ("b", "AAAACCCCGGGT", 0, 1, 0, "MUT")]
    pairs = store(spark.createDataFrame(rows, SCHEMA))
    survivors = store(umi_collapse.collapse_umis(pairs))
    assert survivors.agg(F.sum(F.col("n_wt") + F.col("n_mut") + F.col("n_amb"))).first()[0] == 10
    got = {r.bc: r for r in umi_collapse.collapsed_cells(survivors).collect()}
    assert (got["a"].umi, got["a"].wt_calls) == ("", 0)
    assert (got["b"].umi, got["b"].n_wt, got["b"].call, got["b"].wt_calls) == ("AAAACCCCGGGG", "5", "WT", 1)
    kinds = {r.genotype: r.n_cells for r in umi_collapse.cell_genotypes(umi_collapse.collapsed_cells(survivors)).collect()}
    assert kinds == {"none": 1, "WT": 1}


def test_plans_have_no_cross_join(run, spark, sf_dir):
    for frame in (run.corrected, run.merged, umi_graph.umi_edges(run.pairs), packing.pack_cells(run.pairs, ["bc"], ["umi"], ["umi"], [])):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
