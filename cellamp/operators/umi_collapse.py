"""Greedy collapse of near-identical UMIs, cell by cell.

The first UMI with the most neighbours takes over everything that can be reached from it along directed
edges; this repeats until no two remaining UMIs are neighbours. Parts of a cell without an edge between
them do not influence each other, which is what lets very large cells be worked on in pieces.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellamp.config import Params
from cellamp.functions.calls import collapsed_call
from cellamp.functions.distance import neighbour_lists
from cellamp.operators.packing import MAX_PACKED, pack_cells, packed_text
from cellamp.operators.skew import mark
from cellamp.operators.umi_graph import MAX_CELL, _threshold, mutual_components, split_cells, umi_edges, weak_components
from cellamp.session import by_cell, store, task_number

FIELDS = ("umi", "n_wt", "n_mut", "n_amb", "call")
# Components of large cells up to this many edges are collapsed inside one task.
MAX_COMPONENT = 200_000
# Batches of smaller components have 1/BATCH_SHARE of that on average.
BATCH_SHARE = 4
# Tables of a search that are kept apart before they are put together.
SEEN_TABLES = 8
_NODE = "umi string, n_wt bigint, n_mut bigint, n_amb bigint"


def greedy_collapse(neighbours: list[list[int]], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Survivors, their summed counts, and which of them took over others (masks and counts by position)."""
    n = len(neighbours)
    pointing: list[list[int]] = [[] for _ in range(n)]
    for i, near in enumerate(neighbours):
        for j in near:
            pointing[j].append(i)
    degree = np.array([len(near) for near in neighbours], np.int64)
    alive, merged, counts = np.ones(n, bool), np.zeros(n, bool), counts.copy()
    while n and degree.max() > 0:
        keeper = int(degree.argmax())
        reached, stack = {keeper}, [keeper]
        while stack:
            fresh = [j for j in neighbours[stack.pop()] if alive[j] and j not in reached]
            reached.update(fresh)
            stack.extend(fresh)
        counts[keeper] = counts[sorted(reached)].sum(axis=0)
        merged[keeper] = True
        reached.discard(keeper)
        for j in reached:
            alive[j] = False
            degree[pointing[j]] -= 1
        degree[~alive] = 0
    return alive, counts, merged


def _collapse_cells(items: pa.Array, params: Params) -> pa.Array:
    """Survivors of each packed cell, in UMI order; a null call is one to be made anew."""
    offsets, flat = items.offsets.to_numpy(), items.values
    umis, calls = flat.field("umi").to_pylist(), flat.field("call").to_pylist()
    counts = np.stack([flat.field(c).to_numpy(zero_copy_only=False) for c in FIELDS[1:4]], axis=1)
    kept, sizes = [], [0]
    for lo, hi in zip(offsets, offsets[1:]):
        cell = umis[lo:hi]
        limits = [_threshold(len(u), params.umi_distance) for u in cell]
        near = neighbour_lists(cell, limits, params.umi_metric) if hi - lo > 1 else [[]] * len(cell)
        alive, counts[lo:hi], merged = greedy_collapse(near, counts[lo:hi])
        for i in np.flatnonzero(merged):
            calls[lo + i] = None
        kept.append(lo + np.flatnonzero(alive))
        sizes.append(sizes[-1] + int(alive.sum()))
    take = np.concatenate([*kept, np.zeros(0, np.int64)]).astype(np.int64)
    fields = [pa.array([umis[i] for i in take], pa.string()), *[pa.array(counts[take, c]) for c in range(3)],
              pa.array([calls[i] for i in take], pa.string())]
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.StructArray.from_arrays(fields, list(FIELDS)))


def _collapse_small(packed: DataFrame, params: Params) -> DataFrame:
    """Cells packed as ``items`` to one row per surviving UMI."""

    @F.arrow_udf(f"array<struct<{_NODE.replace(' ', ':').replace(',:', ',')},call:string>>")
    def collapse_umis(items: pa.Array) -> pa.Array:
        return _collapse_cells(items, params)

    return packed.select("bc", F.inline(collapse_umis("items")))


def _collapse_components(nodes: pa.Table, edges: pa.Table) -> pa.Table:
    """Nodes and edges of a batch of whole components to their survivors."""
    nodes = nodes.sort_by([("bc", "ascending"), ("comp", "ascending"), ("umi", "ascending")])
    cells, umis, comps, calls = (nodes.column(c).to_pylist() for c in ("bc", "umi", "comp", "call"))
    counts = np.stack([nodes.column(c).to_numpy() for c in FIELDS[1:4]], axis=1).astype(np.int64)
    place = {node: i for i, node in enumerate(zip(cells, umis))}
    near: list[list[int]] = [[] for _ in umis]
    for bc, s, d in zip(*(edges.column(c).to_pylist() for c in ("bc", "src", "dst"))):
        near[place[bc, s]].append(place[bc, d])
    kept = np.ones(len(umis), bool)
    labels = list(zip(cells, comps))
    ends = [i for i in range(1, len(labels)) if labels[i] != labels[i - 1]]
    for lo, hi in zip([0, *ends], [*ends, len(labels)]):
        own = [[j - lo for j in listed] for listed in near[lo:hi]]
        kept[lo:hi], counts[lo:hi], merged = greedy_collapse(own, counts[lo:hi])
        for i in np.flatnonzero(merged):
            calls[lo + i] = None
    columns = [nodes.column("bc"), nodes.column("umi"), *[pa.array(counts[:, c]) for c in range(3)], pa.array(calls, pa.string())]
    return pa.table(columns, ["bc", *FIELDS]).filter(pa.array(kept))


def _batched(components: DataFrame, batches: int) -> DataFrame:
    """Rows of components by batch: whole components, in as many tasks as were asked for."""
    batch = F.pmod(F.xxhash64("bc", "comp"), F.lit(batches)).cast("int").alias("_batch")
    return components.select("*", batch).repartition(min(batches, task_number(components.sparkSession)), "_batch")


def _collapse_bounded(nodes: DataFrame, edges: DataFrame, n_edges: int) -> DataFrame:
    """Components of bounded size (all rows carry ``comp``), many of them in one call; a batch has about MAX_COMPONENT edges at most."""
    batches = max(-(-n_edges * BATCH_SHARE // MAX_COMPONENT), task_number(nodes.sparkSession))
    nodes = _batched(nodes.select("bc", "comp", *FIELDS), batches)
    edges = _batched(edges.select("bc", "comp", "src", "dst"), batches)
    pairs = nodes.groupBy("_batch").cogroup(edges.groupBy("_batch"))
    return pairs.applyInArrow(_collapse_components, f"bc string, {_NODE}, call string")


def _reached(keepers: DataFrame, edges: DataFrame, knots: DataFrame) -> DataFrame:
    """(bc, comp, umi) that the keepers reach along edges, themselves included; all arguments are stored.

    UMIs that reach each other along edges that run both ways are one knot, and the search goes from knot to knot along the others. With edges that
    all run both ways it ends after one step, whatever the diameter of a component.
    """
    src = knots.select("bc", F.col("umi").alias("src"), F.col("knot").alias("_from"))
    dst = knots.select("bc", F.col("umi").alias("dst"), F.col("knot").alias("_to"))
    lines = edges.join(src, ["bc", "src"], "left").join(dst, ["bc", "dst"], "left").select(
        "bc", F.coalesce("_from", "src").alias("knot"), F.coalesce("_to", "dst").alias("to")
    )
    lines = store(lines.filter("knot <> to").distinct())
    own = knots.select("bc", "umi", "knot")
    frontier = store(keepers.join(own, ["bc", "umi"], "left").select("bc", "comp", F.coalesce("knot", "umi").alias("knot")))
    seen = [frontier]
    while True:
        step = lines.join(frontier, ["bc", "knot"]).select("bc", "comp", F.col("to").alias("knot")).distinct()
        for before in seen:
            step = step.join(before.select("bc", "knot"), ["bc", "knot"], "left_anti")
        frontier = store(step)
        if frontier.isEmpty():
            break
        seen.append(frontier)
        if len(seen) == SEEN_TABLES:
            seen = [store(reduce(DataFrame.unionByName, seen))]
    reached = store(reduce(DataFrame.unionByName, seen))
    members = reached.join(own, ["bc", "knot"]).select("bc", "comp", "umi")
    single = reached.withColumnRenamed("knot", "umi").join(own.select("bc", "umi"), ["bc", "umi"], "left_anti")
    return store(members.unionByName(single.select("bc", "comp", "umi")))


def _greedy_round(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One takeover in every component at once. ``edges`` carry their component; both are stored."""
    degrees = edges.groupBy("bc", "comp", "src").agg(F.count("*").alias("n"))
    keepers = store(
        degrees.groupBy("bc", "comp").agg(F.min_by("src", F.struct((-F.col("n")).alias("n"), "src")).alias("umi"))
    )
    reached = _reached(keepers, edges, mutual_components(edges))
    sums = (
        nodes.join(reached, ["bc", "umi"])
        .groupBy("bc", "comp")
        .agg(*[F.sum(c).alias(c) for c in FIELDS[1:4]])
        .join(keepers, ["bc", "comp"])
        .select("bc", "umi", *FIELDS[1:4], F.lit(None).cast("string").alias("call"))
    )
    gone = store(reached.select("bc", "umi").join(keepers.select("bc", "umi"), ["bc", "umi"], "left_anti"))
    kept = nodes.join(reached.select("bc", "umi"), ["bc", "umi"], "left_anti").unionByName(sums)
    left = (
        edges.drop("comp")
        .join(gone.withColumnRenamed("umi", "src"), ["bc", "src"], "left_anti")
        .join(gone.withColumnRenamed("umi", "dst"), ["bc", "dst"], "left_anti")
        .select("bc", "src", "dst")
    )
    return store(kept), store(left)


def _collapse_large(nodes: DataFrame, params: Params, max_component: int) -> DataFrame:
    """Cells too large for one task, as joins over their UMIs and edges.

    Components of a bounded size are finished in one task each; the others take one takeover per round,
    after which they may have fallen apart into smaller ones.
    """
    edges = store(umi_edges(nodes, params, max_cell=0))
    while not edges.isEmpty():
        comps = weak_components(edges)
        labelled = store(edges.join(comps.withColumnRenamed("umi", "src"), ["bc", "src"]))
        sizes = store(labelled.groupBy("bc", "comp").agg(F.count("*").alias("_edges")))
        huge = sizes.filter(F.col("_edges") > max_component).select("bc", "comp", F.lit(True).alias("_huge"))
        keys = ["bc", "comp"]
        marked_edges = store(mark(labelled, huge, keys, sizes, "_edges", "src"))
        marked_nodes = store(mark(nodes.join(comps, ["bc", "umi"], "left"), huge, keys, sizes, "_edges", "umi"))
        free = marked_nodes.filter("comp IS NULL").select("bc", *FIELDS)
        n_edges = sizes.filter(F.col("_edges") <= max_component).agg(F.sum("_edges")).first()[0] or 0
        bounded = marked_nodes.filter("comp IS NOT NULL AND _huge IS NULL")
        small = _collapse_bounded(bounded, marked_edges.filter("_huge IS NULL"), n_edges)
        settled = free.unionByName(small)
        if huge.isEmpty():
            return settled
        open_nodes = store(marked_nodes.filter("_huge").select("bc", *FIELDS))
        open_edges = store(marked_edges.filter("_huge").select("bc", "comp", "src", "dst"))
        rest, edges = _greedy_round(open_nodes, open_edges)
        nodes = store(settled.unionByName(rest))
    return nodes


def collapse_umis(
    pairs: DataFrame, params: Params = Params(), max_cell: int = MAX_CELL, max_component: int = MAX_COMPONENT
) -> DataFrame:
    """One row per surviving UMI of a cell with summed counts and its call. ``pairs`` must be stored."""
    small, large = split_cells(pairs.select("bc", *FIELDS), max_cell)
    out = _collapse_small(pack_cells(by_cell(small), ["bc"], ["umi"], list(FIELDS), [], None), params)
    if large is not None:
        out = out.unionByName(_collapse_large(large, params, max_component))
    again = collapsed_call(F.col("n_wt"), F.col("n_mut"), params.pcr_threshold)
    return out.select("bc", *FIELDS[:4], F.coalesce("call", again).alias("call"))


def collapsed_cells(survivors: DataFrame, params: Params = Params(), max_packed: int = MAX_PACKED) -> DataFrame:
    """Packed lists per cell, most reads first, and its calls.

    UMIs with fewer than ``umi_dupcut`` WT and MUT reads are left out of the lists and calls; their cell is
    listed even when nothing remains. ``survivors`` must be stored.
    """
    enough = F.col("n_wt") + F.col("n_mut") >= params.umi_dupcut
    rank = (-(F.col("n_wt") + F.col("n_mut") + F.col("n_amb"))).alias("rank")
    rows = survivors.select("bc", rank, *FIELDS, enough.alias("enough"))
    calls = [
        F.count_if(enough & (F.col("call") == c)).alias(f"{c.lower()}_calls") for c in ("WT", "MUT", "AMB")
    ]
    packed = pack_cells(rows, ["bc"], ["rank", "umi"], [*FIELDS, "enough"], calls, max_packed)
    packed = packed.withColumn("items", F.filter("items", lambda i: i["enough"]))
    return packed.select(
        "bc", "part", *[packed_text(f).alias(f) for f in FIELDS], "wt_calls", "mut_calls", "amb_calls"
    )


def cell_genotypes(cells: DataFrame) -> DataFrame:
    """Number of cells whose kept UMIs are called WT only, MUT only, both, or neither."""
    whole = cells.groupBy("bc").agg(F.max("wt_calls").alias("wt"), F.max("mut_calls").alias("mut"))
    wt, mut = F.col("wt") > 0, F.col("mut") > 0
    kind = F.when(wt & mut, "mixed").when(wt, "WT").when(mut, "MUT").otherwise("none")
    return whole.groupBy(kind.alias("genotype")).agg(F.count("*").alias("n_cells"))
