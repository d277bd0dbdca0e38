"""Joins and rounds that large cells take: candidates per UMI, hot keys, rounds on long chains."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellamp.config import Params
from cellamp.operators import chunks, components, packing, umi_collapse, umi_graph
from cellamp.session import store
from tests import brute


def _umis(n, lengths, seed):
    rng = np.random.default_rng(seed)
    drawn = rng.choice(list("ACGT"), (n, max(lengths)))
    return sorted({"".join(row[: lengths[k % len(lengths)]]) for k, row in enumerate(drawn)})


@pytest.mark.parametrize("lengths,distance", [((8, 11, 14), 0.2), ((26, 28, 30), 0.2), ((20, 24), 7)])
def test_joined_edges_of_mixed_and_long_umis(spark, lengths, distance):
    """Plain loops over UMIs that are edits of each other; long ones go by parts."""
    rng = random.Random(5)
    base = _umis(12, lengths, 3)
    umis = set(base)
    for umi in base:
        for _ in range(6):
            edited = list(umi)
            for _ in range(rng.randrange(1, 7)):
                at = rng.randrange(len(edited))
                edited[at : at + 1] = rng.choice(([], [rng.choice("ACGT")], [edited[at], rng.choice("ACGT")]))
            umis.add("".join(edited)[: max(lengths) + 3])
    rows = [("cell", u, 1, 0, 0, "WT") for u in sorted(umis)]
    nodes = store(spark.createDataFrame(rows, "bc string, umi string, n_wt bigint, n_mut bigint, n_amb bigint, call string"))
    params = Params(umi_distance=distance)
    cell = {r[1]: r[2:] for r in rows}
    expected = {("cell", a, b) for a, b in brute.edges(cell, distance, brute.substring_distance)}
    got = umi_graph.umi_edges(nodes, params, max_cell=0).collect()
    assert len(got) == len(expected) and {tuple(r) for r in got} == expected and len(expected) > 50


@pytest.mark.parametrize("lengths,distance", [((8, 11, 14), 0.2), ((5, 9), 3), ((2, 3, 7), 3)])
def test_parts_and_subsequences_give_the_same_edges(spark, lengths, distance):
    """Joined on unchanged parts and on subsequences, and by plain loops; some patterns may lose every character."""
    cells = {"a": _umis(60, lengths, 1), "b": sorted({u[1:] + "A" for u in _umis(60, lengths, 1)}), "one": ["ACGTACGT"]}
    nodes = store(spark.createDataFrame([(bc, u) for bc, umis in cells.items() for u in umis], "bc string, umi string"))
    params = Params(umi_distance=distance)
    expected = {
        (bc, a, b) for bc, umis in cells.items() for a, b in brute.edges({u: (1, 0, 0, "WT") for u in umis}, distance, brute.substring_distance)
    }
    for part_cell in (0, 40, 1000):
        got = umi_graph.candidate_pairs(nodes, params, part_cell).distinct()
        near = got.filter(umi_graph.unanchored_distance(F.col("src"), F.col("dst")) <= umi_graph.distance_threshold(F.length("src"), distance))
        assert {tuple(r) for r in near.collect()} == expected and len(expected) > 5


def test_keys_of_bounded_cells_are_few_and_dealt_to_all_tasks(spark):
    """A stored table of one file is not expanded in one task, and a UMI makes tens of keys, not hundreds."""
    umis = _umis(300, (12,), 1)
    nodes = store(spark.createDataFrame([(f"c{k % 30}", u) for k, u in enumerate(umis)], "bc string, umi string").coalesce(1))
    plan = umi_graph.candidate_pairs(nodes)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 2 and plan.count("RepartitionByExpression") == 2 and len(plan) < 5000


def test_components_are_collapsed_many_in_a_call(spark, monkeypatch):
    """Components of two cells in one batch, equal UMIs in both; a call per component would be thousands of calls."""
    monkeypatch.setattr(umi_collapse, "task_number", lambda spark: 1)
    cell = {"AAAA": (1, 0, 0), "AAAC": (2, 0, 0), "CCCC": (0, 3, 0), "CCCG": (0, 0, 1), "GGGG": (5, 0, 0)}
    nodes = [(bc, u, *n, "WT", comp) for bc in "xy" for u, n in cell.items() for comp in [{"A": "AAAA", "C": "CCCC", "G": "GGGG"}[u[0]]] if u != "GGGG"]
    nodes = store(spark.createDataFrame(nodes, "bc string, umi string, n_wt bigint, n_mut bigint, n_amb bigint, call string, comp string"))
    links = [("x", "AAAA", "AAAC"), ("x", "AAAC", "AAAA"), ("x", "CCCG", "CCCC"), ("y", "AAAC", "AAAA"), ("y", "CCCC", "CCCG"), ("y", "CCCG", "CCCC")]
    edges = store(spark.createDataFrame([(bc, "AAAA" if s[0] == "A" else "CCCC", s, d) for bc, s, d in links], "bc string, comp string, src string, dst string"))
    small = umi_collapse._collapse_bounded(nodes, edges, len(links))
    assert small.select("bc", "umi", "n_wt", "n_mut", "n_amb", "call").rdd.getNumPartitions() == 1
    assert sorted(tuple(r) for r in small.collect()) == [
        ("x", "AAAA", 3, 0, 0, None), ("x", "CCCG", 0, 3, 1, None), ("y", "AAAC", 3, 0, 0, None), ("y", "CCCC", 0, 3, 1, None)
    ]


def test_candidates_per_umi_stay_bounded_in_a_cell_of_50000(spark):
    umis = _umis(50_000, (11, 12, 13), 1)
    nodes = store(spark.createDataFrame([("cell", u) for u in umis], "bc string, umi string").repartition(16))
    pairs = umi_graph.candidate_pairs(nodes)
    assert pairs.count() < 1000 * len(umis)


def test_hot_keys_are_dealt_out_without_losing_pairs(spark):
    left = store(spark.createDataFrame([("c", "hot", f"a{k}") for k in range(300)] + [("c", "cold", "x"), ("c", "left", "y")], "bc string, key string, src string"))
    right = store(spark.createDataFrame([("c", "hot", f"b{k}") for k in range(200)] + [("c", "cold", "z")], "bc string, key string, dst string"))
    whole = umi_graph.paired(left, right, ["bc", "key"], "src")
    dealt = umi_graph.paired(left, right, ["bc", "key"], "src", most=1000)
    assert sorted(dealt.collect()) == sorted(whole.collect()) and whole.count() == 300 * 200 + 1


def _rounds(monkeypatch, *modules):
    """Stored tables from here on, by module."""
    made = []
    for module in modules:
        monkeypatch.setattr(module, "store", lambda df, kept=module.store: made.append(1) or kept(df))
    return made


@pytest.mark.parametrize("order", ["sorted", "random"])
def test_components_of_a_long_chain_take_logarithmic_rounds(spark, monkeypatch, order):
    n = 10_000
    names = [f"u{k:05d}" for k in range(n)]
    if order == "random":
        random.Random(1).shuffle(names)
    edges = [("a", x, y) for x, y in zip(names, names[1:])] + [("b", "p", "q"), ("b", "r", "s"), ("b", "s", "r"), ("c", "u00000", "u00001")]
    made = _rounds(monkeypatch, components)
    got = {(r.bc, r.umi): r.comp for r in components.components(spark.createDataFrame(edges, "bc string, src string, dst string")).collect()}
    assert got == {("a", u): "u00000" for u in names} | {("b", k): v for k, v in zip("pqrs", "pprr")} | {("c", "u00000"): "u00000", ("c", "u00001"): "u00000"}
    assert len(made) <= 6 * math.log2(n)


def test_takeover_of_a_long_chain_takes_logarithmic_rounds(spark, monkeypatch):
    n = 10_000
    names = [f"u{k:05d}" for k in range(n)]
    nodes = store(spark.createDataFrame([("a", u, 1, 0, 2, "WT") for u in names], "bc string, umi string, n_wt bigint, n_mut bigint, n_amb bigint, call string"))
    links = list(zip(names, names[1:]))
    # A side branch that only points into the chain stays; one that the chain points to is taken over.
    links = links + [(y, x) for x, y in links] + [("into", "u00005"), ("u09000", "from"), ("from", "end")]
    nodes = store(nodes.unionByName(spark.createDataFrame([("a", u, 0, 1, 0, "MUT") for u in ("into", "from", "end")], nodes.schema)))
    edges = store(spark.createDataFrame([("a", "comp", x, y) for x, y in links], "bc string, comp string, src string, dst string"))
    made = _rounds(monkeypatch, components, umi_collapse)
    kept, left = umi_collapse._greedy_round(nodes, edges)
    assert sorted(tuple(r)[1:5] for r in kept.collect()) == [("into", 0, 1, 0), ("u09000", n, 2, 2 * n)]
    assert left.count() == 0 and len(made) <= 6 * math.log2(n)


def test_frontiers_along_one_way_edges(spark):
    """More steps than tables are kept apart, and a search that comes back."""
    names = [f"u{k:02d}" for k in range(30)]
    links = list(zip(names, names[1:])) + [("u20", "u03"), ("u29", "u00")] + [("u00", f"leaf{k}") for k in range(3)]
    edges = store(spark.createDataFrame([("a", "comp", x, y) for x, y in links], "bc string, comp string, src string, dst string"))
    keepers = store(spark.createDataFrame([("a", "comp", "u00")], "bc string, comp string, umi string"))
    reached = umi_collapse._reached(keepers, edges, umi_graph.mutual_components(edges))
    assert sorted(r.umi for r in reached.collect()) == sorted([*names, "leaf0", "leaf1", "leaf2"])
    assert reached.groupBy("umi").count().filter(F.col("count") > 1).isEmpty()


@pytest.mark.parametrize("target,buckets", [(7, 1), (100, 16), (1000, 16), (5000, 16), (1, 4)])
def test_chunks_without_moving_reads(spark, monkeypatch, target, buckets):
    """Chunks are runs of the seeded order, also where several end in one bucket; reads are joined where they are."""
    monkeypatch.setattr(chunks, "BUCKETS", buckets)
    reads = spark.createDataFrame([(k * 3, "ACGT") for k in range(2003)], "read_id bigint, seq_r1 string").repartition(3)
    got = chunks.assign_chunks(reads, target, seed=4)
    assert got.columns == ["read_id", "seq_r1", "chunk_id"]
    order = sorted((hashlib.md5(f"4_{k * 3}".encode()).hexdigest(), k * 3) for k in range(2003))
    size = chunks.chunk_reads(2003, target)
    assert {r.read_id: r.chunk_id for r in got.collect()} == {k: n // size for n, (_, k) in enumerate(order)}
    plan = store(reads).transform(lambda stored: chunks.assign_chunks(stored, target))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Exchange SinglePartition" not in plan


def test_pieces_do_not_grow_with_the_number_of_packed_rows(spark, monkeypatch):
    """Thousands of packed rows of two UMIs are cut into a few pieces, and come out whole and in order."""
    rows = [(f"c{k % 3}", f"u{k:05d}") for k in range(6000)] + [("small", "u")]
    stored = store(spark.createDataFrame(rows, "bc string, umi string"))
    cut = []
    monkeypatch.setattr(packing, "store", lambda df: cut.append(df.rdd.getNumPartitions()) or store(df))
    got = packing.pack_cells(stored, ["bc"], ["umi"], ["umi"], [F.count("*").alias("n")], 2).collect()
    assert cut and max(cut) <= max(2, spark.sparkContext.defaultParallelism)
    assert {(r.bc, r.part): [i.umi for i in r["items"]] for r in got} == {
        (f"c{c}", p): [f"u{k:05d}" for k in (c + 6 * p, c + 6 * p + 3)] for c in range(3) for p in range(1000)
    } | {("small", 0): ["u"]}
    assert {r.n for r in got if r.bc != "small"} == {2000}
