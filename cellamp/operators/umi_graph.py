"""Directed neighbour graph of the UMIs of a cell.

Cells of bounded size are compared where they are. In larger ones no step pairs up all UMIs. A pattern of L characters that matches within
cost t keeps L - t characters that occur in this order in a window of L characters of the text: errors lengthen the window by one each, and
every extra character of the text leaves one kept character to spare, which may be dropped at an end. So patterns are joined with
texts of any length on the subsequences that are left when t characters are dropped, of the pattern and of every window of the text.

Long patterns would have too many such subsequences. They are cut into parts, one of which has no more than its share of the
errors, and each part is joined by its own subsequences with the windows that lie where the part may be found.

A subsequence of a whole pattern is shared by a bounded number of UMIs. One of a part may be common, as in a family of UMIs with equal halves: keys
are counted first, and one with too many pairs is dealt out to several tasks.

The smaller a cell, the shorter a key may be. In cells in which no key can have too many pairs, patterns are cut into one part more than errors, so that one
part is found unchanged in the text: a few keys per UMI instead of hundreds, and one window of a text serves the parts of patterns of any length.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import comb, isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellamp.config import Params
from cellamp.functions.calls import distance_threshold
from cellamp.functions.distance import METRICS, levenshtein_bound, unanchored_distance
from cellamp.operators.packing import pack_cells
from cellamp.operators.components import components
from cellamp.operators.skew import fits_broadcast, mark
from cellamp.session import by_cell, by_umi, store

# Subsequences per pattern; longer patterns are cut into parts.
MAX_VARIANTS = 1000
# Pairs a key may make in one place of a join.
KEY_PAIRS = 1_000_000
# Cells up to this many UMIs are handled as one row; larger ones go through joins.
MAX_CELL = 2000
# Cells up to this many UMIs are joined on unchanged parts; a key of such a cell makes no more than KEY_PAIRS pairs.
PART_CELL = isqrt(KEY_PAIRS)


def _threshold(length: int, distance: float) -> int:
    return int(length * distance) if distance < 1 else int(distance)


def _parts(length: int, threshold: int, most: int = MAX_VARIANTS) -> tuple[list[tuple[int, int]], int]:
    """(start, size) of the parts of a pattern, starts from 1, and the characters to drop from each."""
    for n in range(1, length + 1):
        dropped = min(threshold // n, length // n)
        if n * comb(-(-length // n), dropped) <= most or n == length:
            cuts = [length * k // n for k in range(n + 1)]
            return [(a + 1, b - a) for a, b in zip(cuts, cuts[1:])], dropped
    return [(1, length)], 0


def _subsequences(text: Column, length: int, dropped: int, name: int) -> Column:
    """What is left of a text of the given length without ``dropped`` of its characters, in every way, marked with the part's number."""
    masks = []
    for mask in combinations(range(length), dropped):
        cuts = [-1, *mask, length]
        runs = [f"array({a + 2}, {b - a - 1})" for a, b in zip(cuts, cuts[1:]) if b - a > 1]
        masks.append(f"array({', '.join(runs)})" if runs else "cast(array() as array<array<int>>)")
    left = F.transform(
        F.expr(f"array({', '.join(masks)})"),
        lambda runs: F.array_join(F.transform(runs, lambda r: F.substring(text, r[0], r[1])), ""),
    )
    return F.transform(left, lambda key: F.concat(F.lit(f"{name}:"), key))


def _pattern_keys(length: int, threshold: int) -> Column:
    parts, dropped = _parts(length, threshold)
    keys = [_subsequences(F.substring("umi", start, size), size, min(dropped, size), k) for k, (start, size) in enumerate(parts)]
    return F.array_distinct(F.concat(*keys))


def _window_keys(size: int, dropped: int, name: int):
    return lambda at: _subsequences(F.substring("umi", at, F.lit(size)), size, dropped, name)


def _text_keys(length: int, threshold: int) -> Column:
    """Keys under which a text of any length meets the patterns of one length."""
    parts, dropped = _parts(length, threshold)
    own = F.length("umi")
    keys = []
    for k, (start, size) in enumerate(parts):
        drop = min(dropped, size)
        last = own - size + 1
        lo = F.greatest(F.lit(1), F.least(last, F.lit(start - threshold)))
        hi = F.greatest(lo, F.least(last, own + (start + drop + threshold - length)))
        windows = F.transform(F.sequence(lo, hi), _window_keys(size, drop, k))
        # Texts shorter than the window have already lost the characters that are missing.
        found = F.when(own >= size, F.flatten(windows))
        for short in range(max(0, size - drop), size):
            found = found.when(own == short, _subsequences(F.col("umi"), short, short - (size - drop), k))
        keys.append(F.coalesce(found, F.expr("cast(array() as array<string>)")))
    return F.array_distinct(F.concat(*keys))


def paired(left: DataFrame, right: DataFrame, keys: list[str], spread_by: str, most: int = KEY_PAIRS) -> DataFrame:
    """Inner join in which no key makes more than about ``most`` pairs in one place.

    Rows per key are counted on both sides. The left rows of a key with more pairs are dealt out, and its right rows go to each place.
    """
    sizes = left.groupBy(*keys).agg(F.count("*").alias("_l")).join(right.groupBy(*keys).agg(F.count("*").alias("_r")), keys)
    over = store(sizes.filter(F.col("_l") * F.col("_r") > most).select(*keys, F.ceil(F.col("_l") * F.col("_r") / most).cast("int").alias("_places")))
    if over.isEmpty():
        return left.join(right.hint("merge"), keys)
    if fits_broadcast(over):
        over = F.broadcast(over)
    places = F.coalesce(F.col("_places"), F.lit(1))
    left = left.join(over, keys, "left").withColumn("_place", F.pmod(F.xxhash64(spread_by), places).cast("int")).drop("_places")
    right = right.join(over, keys, "left").withColumn("_place", F.explode(F.sequence(F.lit(0), places - 1))).drop("_places")
    return left.join(right.hint("merge"), [*keys, "_place"]).drop("_place")


def _unchanged_parts(length: int, threshold: int) -> list[tuple[int, int]]:
    """(start, size) of parts of a pattern, one more than its errors, or the empty part where every character may be an error."""
    if threshold >= length:
        return [(1, 0)]
    cuts = [length * k // (threshold + 1) for k in range(threshold + 2)]
    return [(a + 1, b - a) for a, b in zip(cuts, cuts[1:])]


def _windows(size: int) -> Column:
    """Every window of a text, unmarked."""
    if not size:
        return F.array(F.lit(""))
    last = F.length("umi") - size + 1
    found = F.transform(F.sequence(F.lit(1), last), lambda at: F.substring("umi", at, F.lit(size)))
    return F.when(last > 0, found).otherwise(F.expr("cast(array() as array<string>)"))


def _part_pairs(nodes: DataFrame, limits: dict[int, int]) -> DataFrame:
    """Pairs of cells of bounded size: a pattern (by length in ``limits``, with its errors) and each text that holds one of its parts."""
    own, parts = F.length("umi"), {length: _unchanged_parts(length, t) for length, t in limits.items()}
    sizes = sorted({size for cut in parts.values() for _, size in cut})
    keys = None
    for length, cut in parts.items():
        own_parts = F.array(*[F.substring("umi", start, size) for start, size in cut])
        keys = F.when(own == length, own_parts) if keys is None else keys.when(own == length, own_parts)
    windows = [_windows(size) for size in sizes]
    spread = by_cell(nodes.select("bc", "umi"))
    patterns = spread.select("bc", F.col("umi").alias("src"), F.explode(F.array_distinct(keys)).alias("key"))
    texts = spread.select("bc", F.col("umi").alias("dst"), F.explode(F.array_distinct(F.concat(*windows))).alias("key"))
    return patterns.join(texts.hint("merge"), ["bc", "key"]).filter("src <> dst").select("bc", "src", "dst")


def _subsequence_pairs(nodes: DataFrame, limits: dict[int, int]) -> list[DataFrame]:
    """Pairs of cells of any size, by pattern length."""
    found = []
    for length, t in limits.items():
        patterns = nodes.filter(F.length("umi") == length)
        patterns = patterns.select("bc", F.col("umi").alias("src"), F.explode(_pattern_keys(length, t)).alias("key"))
        texts = nodes.filter(F.length("umi") >= length - t)
        texts = texts.select("bc", F.col("umi").alias("dst"), F.explode(_text_keys(length, t)).alias("key"))
        found.append(paired(patterns, texts, ["bc", "key"], "src").filter("src <> dst").select("bc", "src", "dst"))
    return found


def candidate_pairs(nodes: DataFrame, params: Params = Params(), part_cell: int = PART_CELL) -> DataFrame:
    """Every pair within the distance and some more (bc, src, dst), src being the pattern. A pair may occur more than once.

    Cells up to ``part_cell`` UMIs are joined on unchanged parts, larger ones on subsequences. ``nodes`` must be stored.
    """
    lengths = sorted(r[0] for r in nodes.select(F.length("umi")).distinct().collect())
    limits = {length: t for length in lengths if (t := _threshold(length, params.umi_distance)) > 0}
    if not limits:
        return nodes.select("bc", F.col("umi").alias("src"), F.col("umi").alias("dst")).filter(F.lit(False))
    small, large = split_cells(nodes.select("bc", "umi"), part_cell)
    found = [_part_pairs(small, limits)]
    if large is not None:
        found += _subsequence_pairs(store(by_umi(large)), limits)
    return reduce(DataFrame.unionByName, found)


def _near_pairs(packed: DataFrame, params: Params) -> DataFrame:
    """Pairs of each packed cell that pass the native bound; one row of a cell yields only its close pairs."""

    def near(a, b):
        threshold = distance_threshold(F.length(a), params.umi_distance)
        close = F.levenshtein(a, b) <= threshold
        if params.umi_metric == "unanchored":
            close = (threshold > 0) & levenshtein_bound(a, b, threshold)
        return (a != b) & close

    def neighbours(a):
        found = F.filter("umis", lambda b: near(a, b))
        return F.transform(found, lambda b: F.struct(a.alias("src"), b.alias("dst")))

    umis = packed.select("bc", F.transform("items", lambda i: i["umi"]).alias("umis"))
    return umis.select("bc", F.inline(F.flatten(F.transform("umis", neighbours))))


def umi_edges(nodes: DataFrame, params: Params = Params(), max_cell: int = MAX_CELL) -> DataFrame:
    """Directed non-self edges (bc, src, dst) of UMIs within the distance of their cell's other UMIs.

    ``nodes`` holds unique (bc, umi) and must be stored. Every UMI is its own neighbour as well; those
    edges are left out. Cells up to ``max_cell`` UMIs are brought together once and compared where they are;
    larger ones go through the join of candidates.
    """
    if params.umi_metric not in METRICS:
        raise ValueError(f"umi_metric must be one of {METRICS}")
    src, dst = F.col("src"), F.col("dst")
    threshold = distance_threshold(F.length(src), params.umi_distance)
    small, large = split_cells(nodes.select("bc", "umi"), max_cell)
    pairs = _near_pairs(pack_cells(by_cell(small), ["bc"], ["umi"], ["umi"], [], None), params)
    if large is not None:
        joined = candidate_pairs(large, params)
        bound = levenshtein_bound(src, dst, threshold)
        close = F.levenshtein(src, dst) <= threshold if params.umi_metric == "levenshtein" else bound
        # Most candidates fail the native bound, so they are compared before repeated ones are dropped.
        pairs = pairs.unionByName(joined.filter(close).distinct())
    if params.umi_metric == "levenshtein":
        return pairs
    return pairs.filter(unanchored_distance(src, dst) <= threshold)


def split_cells(nodes: DataFrame, max_cell: int) -> tuple[DataFrame, DataFrame | None]:
    """Nodes of cells with at most ``max_cell`` UMIs, and of larger cells where there are any."""
    sizes = nodes.groupBy("bc").agg(F.count("*").alias("_n"))
    over = sizes.filter(F.col("_n") > max_cell)
    if over.isEmpty():
        return nodes, None
    marked = mark(nodes, over, ["bc"], sizes, "_n", "umi")
    return store(marked.filter("_n IS NULL").drop("_n")), store(marked.filter("_n IS NOT NULL").drop("_n"))


def umi_degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Neighbours per UMI, itself included."""
    counted = edges.groupBy("bc", F.col("src").alias("umi")).agg(F.count("*").alias("_n"))
    return nodes.select("bc", "umi").join(counted, ["bc", "umi"], "left").select(
        "bc", "umi", (F.coalesce("_n", F.lit(0)) + 1).alias("degree")
    )


def weak_components(edges: DataFrame) -> DataFrame:
    """Smallest UMI reachable along edges in either direction: (bc, umi, comp), for UMIs with an edge."""
    return components(edges.select("bc", "src", "dst"))


def mutual_components(edges: DataFrame) -> DataFrame:
    """(bc, umi, knot): UMIs that reach each other along edges that run both ways, by their smallest member.

    UMIs without such an edge are not listed. ``edges`` must be stored.
    """
    back = edges.select("bc", F.col("src").alias("dst"), F.col("dst").alias("src"))
    both = edges.select("bc", "src", "dst").join(back, ["bc", "src", "dst"], "left_semi").filter("src < dst")
    return components(both).withColumnRenamed("comp", "knot")
