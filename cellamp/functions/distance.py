"""Edit distance of UMIs: the distance of a pattern to the best-matching substring of a text.

The relation is directed. Spark's ``levenshtein`` compares whole strings and is used as it is for the other
metric and as a bound: an unanchored match of cost s leaves at most len(text) - len(pattern) + s characters
of the text free.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("unanchored", "levenshtein")


def _codes(strings: list[str]) -> np.ndarray:
    return np.ascontiguousarray(np.array([[ord(c) for c in s] for s in strings], np.uint16).reshape(len(strings), -1).T)


def _equal_length_distance(patterns: np.ndarray, texts: np.ndarray, anchored: bool) -> np.ndarray:
    """Distances of pairs whose patterns have one length and whose texts have one length.

    Arguments are characters by pair; every step works on all pairs at once.
    """
    pairs = np.broadcast_shapes(patterns.shape[1:], texts.shape[1:])
    start = range(len(texts) + 1) if anchored else [0] * (len(texts) + 1)
    small = np.int8 if len(patterns) + len(texts) < 100 else np.int32
    row = [np.full(pairs, cost, small) for cost in start]
    for i, symbol in enumerate(patterns):
        above, row = row, [np.full(pairs, i + 1, small)]
        for j, other in enumerate(texts):
            substituted = above[j] + (symbol != other).view(np.int8)
            row.append(np.minimum(substituted, np.minimum(above[j + 1], row[j]) + small(1)))
    return row[-1] if anchored else np.minimum.reduce(row)


def distances(patterns: list[str], texts: list[str], metric: str = "unanchored") -> np.ndarray:
    """Distance of every pattern to the text at the same place."""
    out = np.zeros(len(patterns), np.int32)
    lengths = np.array([(len(p), len(t)) for p, t in zip(patterns, texts)]).reshape(-1, 2)
    for size in {tuple(pair) for pair in lengths.tolist()}:
        at = np.flatnonzero((lengths == size).all(axis=1))
        p, t = _codes([patterns[i] for i in at]), _codes([texts[i] for i in at])
        out[at] = _equal_length_distance(p, t, metric == "levenshtein")
    return out


def unanchored_distance(pattern: Column, text: Column) -> Column:
    """Column form of the directed distance, for candidate pairs."""

    @F.pandas_udf("int")
    def substring_distance(pattern: pd.Series, text: pd.Series) -> pd.Series:
        return pd.Series(distances(pattern.tolist(), text.tolist()))

    return substring_distance(pattern, text)


def capped_distance(pattern: Column, text: Column, cutoff: Column) -> Column:
    """The distance, or cutoff + 1 above the cutoff; a negative cutoff never matches."""
    exact = unanchored_distance(pattern, text)
    return F.when(cutoff < 0, cutoff + 1).otherwise(F.least(exact, cutoff + 1))


def levenshtein_bound(pattern: Column, text: Column, threshold: Column) -> Column:
    """True for every pair within the directed distance, and for few others."""
    bound = 2 * threshold + F.greatest(F.lit(0), F.length(text) - F.length(pattern))
    return F.levenshtein(pattern, text) <= bound


def neighbour_lists(umis: list[str], thresholds: list[int], metric: str, block: int = 1 << 16) -> list[list[int]]:
    """Directed neighbours (positions, self left out) of each UMI of one small cell."""
    out: list[list[int]] = [[] for _ in umis]
    by_length: dict[int, list[int]] = {}
    for i, umi in enumerate(umis):
        by_length.setdefault(len(umi), []).append(i)
    for rows in by_length.values():
        if thresholds[rows[0]] <= 0:
            continue
        patterns = _codes([umis[i] for i in rows])
        for cols in by_length.values():
            texts = _codes([umis[j] for j in cols])
            step = max(1, block // len(cols))
            for lo in range(0, len(rows), step):
                dist = _equal_length_distance(
                    patterns[:, lo : lo + step, None], texts[:, None, :], metric == "levenshtein"
                )
                for r, c in zip(*np.nonzero(dist <= thresholds[rows[0]])):
                    if rows[lo + r] != cols[c]:
                        out[rows[lo + r]].append(cols[c])
    return out
