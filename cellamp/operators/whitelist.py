"""Ordered whitelist, membership flags, and the joins of near-identical barcodes."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cellamp.operators.ranking import bucketed_rank
from cellamp.operators.skew import BROADCAST_ROWS, fits_broadcast, salted_lookup
from cellamp.session import store

CHARSET = "ACGTN"
# Candidate pairs that a key may give per keyed row before the Hamming join takes longer keys.
PAIRS_PER_KEY = 8


def ordered_whitelist(barcodes: DataFrame, bucket: Column | None = None) -> DataFrame:
    """``(bc, position)`` to unique barcodes with a dense 0-based ``wl_idx`` in order of first occurrence.

    ``bucket`` is a coarse non-decreasing function of ``position``, by default the first 8 characters of
    a text and the multiple of 65,536 below a number.
    """
    first = (
        barcodes.filter(F.trim("bc") != "").groupBy(F.trim("bc").alias("bc")).agg(F.min("position").alias("position"))
    )
    if bucket is None:
        is_text = isinstance(first.schema["position"].dataType, StringType)
        bucket = F.substring("position", 1, 8) if is_text else F.floor(F.col("position") / 65_536)
    return bucketed_rank(first, bucket, [F.col("position")], "wl_idx").select("bc", "wl_idx")


def observed_barcodes(reads: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Reads per distinct barcode (per chunk when asked), the small table most later steps start from."""
    return reads.groupBy(*extra_keys, "bc").agg(F.count("*").alias("n_reads"))


def listed_barcodes(observed: DataFrame, whitelist: DataFrame) -> DataFrame:
    """Distinct barcodes with ``listed``; both sides are unique per barcode, so no key is hot."""
    flag = whitelist.select("bc", F.lit(True).alias("listed"))
    return observed.join(flag, "bc", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))


def flag_whitelisted(
    reads: DataFrame, whitelist: DataFrame, spread_by: str = "read_id", broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Append ``whitelist`` Y/N. The reads are not shuffled while the whitelist is of broadcast size.

    A longer list is first reduced to barcodes that occur, then joined with the hot barcodes salted.
    """
    if fits_broadcast(whitelist, broadcast_rows):
        joined = reads.join(F.broadcast(whitelist.select("bc", F.lit(True).alias("_in"))), "bc", "left")
    else:
        sizes = store(observed_barcodes(reads))
        present = whitelist.join(sizes.select("bc"), "bc", "left_semi").select("bc", F.lit(True).alias("_in"))
        joined = salted_lookup(reads, present, ["bc"], sizes, "n_reads", spread_by)
    return joined.withColumn("whitelist", F.when(F.col("_in"), "Y").otherwise("N")).drop("_in")


def in_whitelist(reads: DataFrame, whitelist: DataFrame, **options) -> DataFrame:
    return flag_whitelisted(reads, whitelist, **options).filter("whitelist = 'Y'").drop("whitelist")


def not_in_whitelist(reads: DataFrame, whitelist: DataFrame, **options) -> DataFrame:
    return flag_whitelisted(reads, whitelist, **options).filter("whitelist = 'N'").drop("whitelist")


def _masked(df: DataFrame, bc: str, positions: list[tuple[int, ...]]) -> DataFrame:
    """One row per choice of positions: the characters there, and the barcode without them."""
    spots = F.explode(F.expr(f"array({', '.join(f'array({", ".join(map(str, mask))})' for mask in positions)})"))
    places = [F.get("_mask", F.lit(i)) for i in range(len(positions[0]))]
    picked = F.concat(*[F.substring(bc, p + 1, F.lit(1)) for p in places])
    ends = [F.lit(-1), *places]
    pieces = [
        F.substring(bc, ends[i] + 2, (ends[i + 1] if i + 1 < len(ends) else F.length(bc)) - ends[i] - 1)
        for i in range(len(ends))
    ]
    return df.withColumn("_mask", spots).select("*", picked.alias("_picked"), F.concat_ws("~", *pieces).alias("_rest"))


def hamming_pairs(observed: DataFrame, whitelist: DataFrame, distance: int, length: int) -> DataFrame:
    """Pairs of barcodes of ``length`` letters that differ in exactly ``distance`` places: (obs, bc, wl_idx, positions).

    Both sides are expanded once per choice of the differing places and joined on the rest. ``observed``
    and ``whitelist`` hold unique barcodes, so a join key meets at most as many whitelist rows as there are
    ways to fill the open places, and each pair is found exactly once. The work is linear in both tables
    whatever prefixes or suffixes the barcodes share.
    """
    obs = observed.select(F.col("bc").alias("obs")).filter(F.length("obs") == length)
    wl = whitelist.select("bc", "wl_idx").filter(F.length("bc") == length)
    if distance == 0:
        return obs.join(wl, obs.obs == wl.bc).withColumn("positions", F.array().cast("array<int>"))
    masks = list(combinations(range(length), distance))
    left = _masked(obs, "obs", masks).withColumnRenamed("_picked", "_was")
    # Expanding multiplies the rows behind the optimizer's size estimate, so neither side may be broadcast.
    right = _masked(wl, "bc", masks).hint("merge")
    differs = reduce(
        lambda a, b: a & b,
        [F.substring("_was", i + 1, 1) != F.substring("_picked", i + 1, 1) for i in range(distance)],
    )
    return (
        left.join(right, ["_mask", "_rest"])
        .filter(differs)
        .select("obs", "bc", "wl_idx", F.col("_mask").alias("positions"))
    )


def _cut(df: DataFrame, segments: int, dropped: int) -> DataFrame:
    """One row per choice of segments that are left out of ``_part``: what is kept (``_rest``), and the last kept segment.

    Segments are of equal length as far as the letters go; short parts have empty ones.
    """
    size = F.length("_part")
    ends = [F.floor(size * i / segments).cast("int") for i in range(segments + 1)]
    pieces = [F.substring("_part", ends[i] + 1, ends[i + 1] - ends[i]) for i in range(segments)]
    kept = list(combinations(range(segments), segments - dropped))
    keys = [
        F.struct(F.concat_ws("~", F.lit(n), size, *[pieces[i] for i in k]).alias("_rest"), F.lit(k[-1]).alias("_last"))
        for n, k in enumerate(kept)
    ]
    cut = df.withColumn("_pieces", F.array(*pieces)).withColumn("_key", F.explode(F.array(*keys)))
    return cut.select("*", "_key._rest", "_key._last").drop("_key")


def segment_count(obs: DataFrame, wl: DataFrame, distance: int, longest: int) -> tuple[int, int]:
    """The fewest segments whose keys give at most PAIRS_PER_KEY pairs per keyed row, and those pairs.

    One segment more than the distance is the least: a barcode then has distance + 1 keys, each a segment. Long lists, and lists
    whose barcodes share segments, need longer keys. Segments of one letter are the last choice; then a key's
    barcodes are no more than the ways to fill the open places.
    """
    # Joins of lists with few letters, or within distances as long as a barcode, keep nothing.
    for segments in range(distance + 1, max(distance + 1, longest) + 1):
        left, right = (_cut(df, segments, distance).groupBy("_rest").agg(F.count("*").alias(n)) for df, n in ((obs, "_a"), (wl, "_b")))
        sums = left.join(right, "_rest", "full").agg(
            F.sum(F.coalesce(F.col("_a") * F.col("_b"), F.lit(0))), F.sum(F.coalesce("_a", F.lit(0)) + F.coalesce("_b", F.lit(0)))
        )
        pairs, keyed = (n or 0 for n in sums.first())
        if pairs <= PAIRS_PER_KEY * keyed:
            break
    return segments, pairs


def near_prefixes(
    observed: DataFrame, whitelist: DataFrame, distance: int, excess: int, longest: int, segments: int | None = None
) -> DataFrame:
    """Pairs whose whitelist barcode is ``excess`` letters longer (shorter if negative): (obs, bc, wl_idx, distance).

    Their common part, up to the shorter one's end and ``longest`` letters at most, differs in ``distance`` places or fewer. Parts that do
    so agree in all but ``distance`` segments; they are joined on each choice of the others and compared letter by letter. A pair
    comes from the first choice that it agrees in only. The number of segments follows from the measured pairs per key.
    """
    over, under = max(excess, 0), max(-excess, 0)
    obs = observed.select(F.col("bc").alias("obs")).filter(F.length("obs") >= under)
    wl = whitelist.select("bc", "wl_idx").filter(F.length("bc") >= over)
    obs = obs.withColumn("_part", F.expr(f"substring(obs, 1, length(obs) - {under})"))
    wl = wl.withColumn("_part", F.expr(f"substring(bc, 1, length(bc) - {over})"))
    if distance == 0:
        return obs.join(wl, "_part").select("obs", "bc", "wl_idx", F.lit(0).alias("distance"))
    segments = segments or segment_count(obs, wl, distance, longest)[0]
    left = _cut(obs, segments, distance).withColumnsRenamed({"_part": "_was", "_pieces": "_had"}).drop("_last")
    # Expanding multiplies the rows behind the optimizer's size estimate, so neither side may be broadcast.
    right = _cut(wl, segments, distance).hint("merge")
    agree = sum(((F.col("_last") > i) & (F.get("_had", F.lit(i)) == F.get("_pieces", F.lit(i)))).cast("int") for i in range(segments))
    differ = sum((F.substring("_was", i, 1) != F.substring("_part", i, 1)).cast("int") for i in range(1, longest + 1))
    return (
        left.join(right, "_rest")
        .filter(agree == segments - distance - 1)
        .select("obs", "bc", "wl_idx", differ.alias("distance") if longest else F.lit(0).alias("distance"))
        .filter(F.col("distance") <= distance)
    )


def hamming_join(observed: DataFrame, whitelist: DataFrame, distance: int, length: int) -> DataFrame:
    """All pairs within a Hamming distance, with the distance; letters that only the longer barcode has are mismatches.

    ``length`` is the usual length of a barcode; others are joined as they occur.
    """
    sides = [{length, *(r[0] for r in df.select(F.length("bc")).distinct().collect() if r[0] is not None)} for df in (observed, whitelist)]
    common = {}
    for a in sides[0]:
        for b in sides[1]:
            if abs(b - a) <= distance:
                common[b - a] = max(common.get(b - a, 0), min(a, b))
    parts = [
        near_prefixes(observed, whitelist, distance - abs(excess), excess, longest).withColumn(
            "distance", F.col("distance") + abs(excess)
        )
        for excess, longest in sorted(common.items())
    ]
    if not parts:
        parts = [hamming_pairs(observed, whitelist, 0, length).select("obs", "bc", "wl_idx", F.lit(0).alias("distance"))]
    return reduce(DataFrame.unionByName, parts)


def hamming1_candidates(
    observed: DataFrame, whitelist: DataFrame, length: int, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Whitelist barcodes one substitution away: (obs, bc, wl_idx, pos) and any other whitelist column.

    Only the letters of CHARSET can be put into a barcode. Against a whitelist of broadcast size every
    neighbour of an observed barcode is looked up where it is, without a shuffle; a longer whitelist is
    joined on the barcodes without the place in question.
    """
    extra = [c for c in whitelist.columns if c not in ("bc", "wl_idx")]
    columns = ["obs", "bc", "wl_idx", "pos", *extra]
    if fits_broadcast(whitelist, broadcast_rows):
        obs = observed.select(F.col("bc").alias("obs")).filter(F.length("obs") > 0)
        places = obs.select("obs", F.explode(F.expr("sequence(0, length(obs) - 1)")).alias("pos"))
        spots = places.select("obs", "pos", F.explode(F.array(*map(F.lit, CHARSET))).alias("letter"))
        spots = spots.filter(F.substring("obs", F.col("pos") + 1, F.lit(1)) != F.col("letter"))
        before = F.substring("obs", F.lit(1), F.col("pos"))
        after = F.substring("obs", F.col("pos") + 2, F.length("obs"))
        neighbours = spots.select("obs", "pos", F.concat(before, "letter", after).alias("bc"))
        return neighbours.join(F.broadcast(whitelist), "bc").select(*columns)
    # Barcodes have few lengths: the usual one, and shorter ones of reads that end early.
    lengths = {length, *(r[0] for r in observed.select(F.length("bc")).distinct().collect() if r[0])}
    pairs = reduce(DataFrame.unionByName, [hamming_pairs(observed, whitelist, 1, n) for n in sorted(lengths)])
    pairs = pairs.withColumn("pos", F.get("positions", F.lit(0)))
    letter = F.substring("bc", F.col("pos") + 1, F.lit(1))
    pairs = pairs.filter(letter.isin(*CHARSET)).select("obs", "bc", "wl_idx", "pos")
    return pairs.join(whitelist.drop("wl_idx"), "bc").select(*columns) if extra else pairs
