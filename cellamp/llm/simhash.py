"""Near-duplicates by SimHash fingerprints, searched with vantage-point trees.

Fingerprint: a bit is set if it is set in over half of the hashes of a text's word shingles. Two documents are linked if their
fingerprints differ in at most ``max_bits`` bits, and grouped with everything reachable over links.

Search: a fingerprint of 64 bits is cut into ``parts`` stretches. Two fingerprints within ``max_bits`` are within
``max_bits // parts`` on at least one stretch, so there is one vantage-point tree per stretch, whose metric is the Hamming
distance on that stretch. A node sends the fingerprints near its vantage point inward and the others outward; by the
triangle inequality one that is further than the radius from the cut needs to be sought on its own side only, and one closer to the cut
is also sent as a query to the other side. The upper levels of a tree deal the fingerprints out to shards; inside a shard the same
splitting goes on down to small leaves, where fingerprints are compared on all bits. The result is exact.

Rows with equal fingerprints are one point of the search. A shard reports a spanning forest of the links it found and not the
links, so a dense group of n near copies makes at most n rows per shard.

Null and blank texts have fingerprint zero and are linked like any other. A missing doc_id counts in no group's smallest id.
Repeated rows each get a row. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellamp.llm.components import components
from cellamp.llm.tables import whole_text
from cellamp.session import store

MAX_BITS = 4
PARTS = 3
SHINGLE = 4
SEED = 42
# Fingerprints at home in a shard, about.
SHARD = 2_048
# Tree nodes are chosen from so many fingerprints per shard, and at most MAX_SAMPLE (2 MB); all fingerprints are searched.
SAMPLE_PER_SHARD = 32
MAX_SAMPLE = 262_144
# A shard that cannot be split by distance is cut into cells of about this size, which all meet each other.
CELL = 16_384
LEAF = 64
_BLOCK = 65_536


def fingerprint(text: Column, words: int = SHINGLE) -> Column:
    """SimHash of the ASCII-lower-cased words of a text, as a signed 64-bit number."""

    @F.pandas_udf("bigint")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from xxhash import xxh64_intdigest

        for batch in batches:
            out = np.zeros(len(batch), np.int64)
            for k, raw in enumerate(batch):
                listed = raw.lower().split()  # both touch ASCII only
                if not listed:
                    continue
                line = b" ".join(listed)
                ends = np.cumsum(np.fromiter(map(len, listed), np.int64, len(listed)) + 1) - 1
                starts = np.concatenate([[0], ends[:-1] + 1])
                n = max(1, len(listed) - words + 1)
                counts = np.zeros(64, np.int64)
                for at in range(0, n, _BLOCK):
                    upto = min(n, at + _BLOCK)
                    first = starts[at:upto].tolist()
                    last = ends[np.minimum(np.arange(at, upto) + words, len(listed)) - 1].tolist()
                    hashes = np.array([xxh64_intdigest(line[a:b], SEED) for a, b in zip(first, last, strict=True)], "<u8")
                    bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
                    counts += bits.sum(axis=0, dtype=np.uint32)
                out[k] = np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0]
            yield pd.Series(out)

    return prints(whole_text(text).cast("binary"))


def stretches(parts: int) -> list[np.uint64]:
    """Masks that cut 64 bits into neighbouring stretches of nearly equal length."""
    edges = [64 * k // parts for k in range(parts + 1)]
    return [np.uint64(sum(1 << b for b in range(lo, hi))) for lo, hi in zip(edges, edges[1:], strict=False)]


def distance(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage)


def best_split(points: np.ndarray, radius: int) -> tuple[np.uint64, int] | None:
    """Vantage point and cut distance with the least expected comparisons; None if no cut separates the points."""
    best, least = None, float(len(points)) ** 2
    for vantage in points[:: max(1, len(points) // 8)][:8]:
        held = np.bincount(distance(points, vantage), minlength=66)
        upto = np.cumsum(held)
        for cut in range(65):
            inner = int(upto[cut])
            if 0 < inner < len(points):
                # Those inside but close to the cut are also compared with the outer side.
                close = inner - (int(upto[cut - radius]) if cut >= radius else 0)
                outer = len(points) - inner
                cost = inner * inner + outer * (outer + close)
                if cost < least:
                    best, least = (vantage, cut), cost
    return best


def send(points: np.ndarray, home: np.ndarray, vantage: np.uint64, cut: int, radius: int):
    """Masks of the points that go inward and outward, and of those at home there.

    A pair is found where its later member is at home, so a point at home outside is not sent inward as a query.
    """
    far = distance(points, vantage)
    inside = far <= cut
    inward = np.where(home, inside, far <= cut + radius)
    outward = far > cut - radius
    return inward, home & inside, outward, home & ~inside


class Tree:
    """Upper levels of a vantage-point tree over one stretch of the fingerprints."""

    def __init__(self, sample: np.ndarray, mask: np.uint64, radius: int, shards: int, total: int):
        self.mask, self.radius = mask, radius
        self.cells: list[int] = []
        share = total / max(1, len(sample))
        self.root = self._grow(sample & mask, max(1, len(sample) // shards), share)

    def _grow(self, points: np.ndarray, enough: int, share: float):
        split = best_split(points, self.radius) if len(points) > enough else None
        if split is None:
            self.cells.append(max(1, int(np.ceil(len(points) * share / CELL))))
            return len(self.cells) - 1
        inside = distance(points, split[0]) <= split[1]
        return (*split, self._grow(points[inside], enough, share), self._grow(points[~inside], enough, share))

    def route(self, prints: np.ndarray, at_home: bool = True) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(shard, cell, positions, at home) for every place where some of the fingerprints belong, or are only sought."""
        masked = prints & self.mask
        stack = [(self.root, np.arange(len(prints)), np.full(len(prints), at_home))]
        while stack:
            node, at, home = stack.pop()
            if not len(at):
                continue
            if isinstance(node, int):
                yield from self._cells(node, prints, at, home)
                continue
            vantage, cut, inner, outer = node
            inward, home_in, outward, home_out = send(masked[at], home, vantage, cut, self.radius)
            stack.append((inner, at[inward], home_in[inward]))
            stack.append((outer, at[outward], home_out[outward]))

    def _cells(self, shard: int, prints: np.ndarray, at: np.ndarray, home: np.ndarray):
        cells = self.cells[shard]
        own = (prints[at] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(cells)
        for cell in range(cells):
            # Pairs of two cells are found in the later one.
            here = ~home | (own <= cell)
            yield shard, cell, at[here], home[here] & (own[here] == cell)


def leaf_links(points: np.ndarray, home: np.ndarray, guest: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between members of a small leaf and everything in it."""
    everyone = np.concatenate([home, guest])
    near = np.bitwise_count(points[home][:, None] ^ points[everyone][None, :]) <= max_bits
    a, b = np.nonzero(near)
    keep = home[a] != everyone[b]
    return home[a[keep]], everyone[b[keep]]


def crowd_links(points: np.ndarray, home: np.ndarray, guest: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links in a leaf that no cut separates, walking from each point to unvisited ones only."""
    left_home, left_guest, found = home, guest, ([], [])
    waiting: list[tuple[int, bool]] = []
    while waiting or len(left_home):
        if not waiting:
            waiting.append((int(left_home[0]), True))
            left_home = left_home[1:]
        point, at_home = waiting.pop()
        near = np.bitwise_count(points[left_home] ^ points[point]) <= max_bits
        reached = [(left_home[near], True)]
        left_home = left_home[~near]
        if at_home:
            near = np.bitwise_count(points[left_guest] ^ points[point]) <= max_bits
            reached.append((left_guest[near], False))
            left_guest = left_guest[~near]
        for members, is_home in reached:
            found[0].append(np.full(len(members), point))
            found[1].append(members)
            waiting.extend((int(m), is_home) for m in members)
    return np.concatenate([*found[0], home[:0]]), np.concatenate([*found[1], home[:0]])


def smallest_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each position's component under the links a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        if np.array_equal(before, label):
            break
    return label


def shard_forest(points: np.ndarray, home: np.ndarray, mask: np.uint64, radius: int, max_bits: int) -> np.ndarray:
    """For sorted distinct points, the position of the smallest point each is linked to within the shard."""
    masked = points & mask
    stack = [(np.nonzero(home)[0], np.nonzero(~home)[0])]
    label = np.arange(len(points))
    ends: tuple[list, list] = ([], [])
    held = 0
    while stack:
        own, guest = stack.pop()
        if len(own) == 0 or len(own) + len(guest) < 2:
            continue
        if len(own) > LEAF:
            split = best_split(masked[own[:: max(1, len(own) // 256)]], radius)
            if split is not None:
                far = distance(masked[guest], split[0])
                mine = distance(masked[own], split[0])
                inside, close = mine <= split[1], mine > split[1] - radius
                stack.append((own[inside], guest[far <= split[1] + radius]))
                stack.append((own[~inside], np.concatenate([guest[far > split[1] - radius], own[inside & close]])))
                continue
            links = crowd_links(points, own, guest, max_bits)
        else:
            links = leaf_links(points, own, guest, max_bits)
        for side, more in zip(ends, links, strict=True):
            side.append(more)
        held += len(links[0])
        if held > 1_000_000:
            # What is known so far is kept as one link per point.
            label = smallest_labels(len(points), np.concatenate([*ends[0], np.arange(len(points))]), np.concatenate([*ends[1], label]))
            ends, held = ([], []), 0
    return smallest_labels(
        len(points), np.concatenate([*ends[0], np.arange(len(points))]), np.concatenate([*ends[1], label])
    )


def linked(prints: DataFrame, max_bits: int = MAX_BITS, parts: int = PARTS, shard: int = SHARD) -> DataFrame:
    """Links (node, root) whose components are those of all pairs within ``max_bits``.

    ``prints`` is a stored table of distinct fingerprints ``print``.
    """
    total = prints.count()
    shards = max(1, -(-total // shard))
    wanted = min(MAX_SAMPLE, max(1024, SAMPLE_PER_SHARD * shards))
    rows = prints.orderBy(F.xxhash64("print"), "print").limit(wanted).collect()
    sample = np.array([r[0] for r in rows], np.int64).view(np.uint64)
    radius, masks = max_bits // parts, stretches(parts)
    trees = [Tree(sample, mask, radius, shards, total) for mask in masks]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for part, tree in enumerate(trees):
                for place, cell, at, home in tree.route(values):
                    n = len(at)
                    yield pa.record_batch(
                        [pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, place, np.int32)),
                         pa.array(np.full(n, cell, np.int32)), pa.array(values[at].view(np.int64)), pa.array(home)],
                        ["part", "shard", "cell", "print", "home"],
                    )

    def search(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        if not group["home"].any():
            return pd.DataFrame({"node": [], "root": []}, dtype="int64")
        group = group.sort_values("print", kind="stable")
        values = group["print"].to_numpy(np.int64)
        root = shard_forest(values.view(np.uint64), group["home"].to_numpy(bool), masks[int(key[0])], radius, max_bits)
        moved = root != np.arange(len(root))
        return pd.DataFrame({"node": values[moved], "root": values[root[moved]]})

    routed = prints.select("print").mapInArrow(route, "part int, shard int, cell int, print bigint, home boolean")
    return routed.groupBy("part", "shard", "cell").applyInPandas(search, "node bigint, root bigint")


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", max_bits: int = MAX_BITS, words: int = SHINGLE
) -> DataFrame:
    """One row per row of ``docs``: (doc_id, print, component_id, group); ``group`` is a fingerprint that names the component.

    Texts are read once. From then on only ids and fingerprints move, and the ids of a group are never brought together:
    a group's smallest id is an aggregate, handed back by joins of stored tables that adaptive execution splits where a
    group is large.
    """
    every = store(docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text), words).alias("print")))
    distinct = store(every.groupBy("print").agg(F.min("doc_id").alias("first_id")))
    roots = store(components(linked(distinct.select("print"), max_bits)).withColumnRenamed("node", "print"))
    members = store(distinct.join(roots, "print"))
    smallest = store(members.groupBy("root").agg(F.min("first_id").alias("component_id")))
    grouped = members.join(smallest, "root").select("print", "component_id", F.col("root").alias("group"))
    alone = distinct.join(roots.select("print"), "print", "left_anti")
    owners = store(grouped.union(alone.select("print", F.col("first_id").alias("component_id"), F.col("print").alias("group"))))
    return every.join(owners, "print").select("doc_id", "print", "component_id", "group")


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
