"""Arrow functions that score reads against the regions, one batch at a time.

The primer shift decides where every other region starts, so the fields of one read are produced by one
call. Written as generated column expressions the shift is inlined into each region and the code outgrows
what the JVM compiles; as higher-order functions it takes about twice as long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from cellamp.config import Params, RegionConfig
from cellamp.functions.phred import OFFSET, P_ERR_1E5


def _bytes_and_offsets(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    col = col.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _matrix(data: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """Reads as rows of bytes, padded with zero so that a missing base never equals a reference base."""
    idx = offsets[:-1, None] + np.arange(width)
    inside = idx < offsets[1:, None]
    padded = np.append(data, np.uint8(0))
    return padded[np.where(inside, idx, len(data))]


def _mismatches(reads: np.ndarray, start: np.ndarray, seq: str) -> np.ndarray:
    ref = np.frombuffer(seq.encode(), np.uint8)
    idx = start[:, None] + np.arange(len(ref))
    return (np.take_along_axis(reads, idx, axis=1) != ref).sum(axis=1, dtype=np.int32)


def _scan_mismatches(seq: pa.Array, config: RegionConfig, params: Params) -> dict[str, np.ndarray]:
    data, offsets = _bytes_and_offsets(seq)
    width = max(r.start - 1 + len(r.seq) for r in config.regions) + params.max_shift
    reads = _matrix(data, offsets, width)
    primer = config["primer"]
    allowed = config.allowance("primer", params.mismatch_ratio)
    shift = np.zeros(len(seq), np.int64)
    mm_primer = np.full(len(seq), len(primer.seq), np.int32)
    open_reads = np.ones(len(seq), bool)
    for loc in range(params.max_shift + 1):
        mm = _mismatches(reads, np.full(len(seq), primer.start - 1 + loc), primer.seq)
        hit = open_reads & (mm <= allowed)
        shift[hit], mm_primer[hit] = loc, mm[hit]
        open_reads &= ~hit
    out = {"shift": shift.astype(np.int32), "mm_primer": mm_primer}
    for region in config.regions[1:]:
        out[f"mm_{region.name}"] = _mismatches(reads, shift + region.start - 1, region.seq)
    return out


def _scan_errors(qual: pa.Array, shift: np.ndarray, config: RegionConfig) -> dict[str, np.ndarray]:
    table = np.zeros(256, np.int64)
    table[OFFSET : OFFSET + len(P_ERR_1E5)] = P_ERR_1E5
    data, offsets = _bytes_and_offsets(qual)
    running = np.concatenate([[0], np.cumsum(table[data])])
    begin, end = offsets[:-1], offsets[1:]

    def window(first, last):
        return running[np.minimum(begin + last, end)] - running[np.minimum(begin + first, end)]

    out = {"err_r2": running[end] - running[begin], "err_primer": window(0, len(config["primer"].seq))}
    for region in config.regions[1:]:
        out[f"err_{region.name}"] = window(shift + region.start - 1, shift + region.end)
    return out


def _score_sums(qual: pa.Array) -> pa.Array:
    table = np.zeros(256, np.int64)
    table[OFFSET : OFFSET + len(P_ERR_1E5)] = np.arange(len(P_ERR_1E5))
    data, offsets = _bytes_and_offsets(qual)
    running = np.concatenate([[0], np.cumsum(table[data])])
    return pa.array(running[offsets[1:]] - running[offsets[:-1]], mask=np.asarray(qual.is_null()))


def mismatch_fields(config: RegionConfig) -> list[str]:
    return [f"mm_{r.name}" for r in config.regions]


def error_fields(config: RegionConfig) -> list[str]:
    return ["err_r2"] + [f"err_{r.name}" for r in config.regions]


def scan_mismatches(seq: Column, config: RegionConfig, params: Params) -> Column:
    """Struct of the primer shift and the mismatch count of every region (int each)."""
    names = ["shift"] + mismatch_fields(config)

    @F.arrow_udf(", ".join(f"{n} int" for n in names))
    def region_mismatches(seq: pa.Array) -> pa.Array:
        found = _scan_mismatches(seq, config, params)
        return pa.StructArray.from_arrays([pa.array(found[n]) for n in names], names)

    return region_mismatches.asNondeterministic()(seq)


def scan_reads(seq: Column, qual: Column, bc_qual: Column, config: RegionConfig, params: Params) -> Column:
    """As :func:`scan_mismatches`, the summed error of the read and of every region (bigint, 1e-5 units), and the barcode's summed score.

    The primer sum covers the first bases of the read, whatever the shift and the primer's start.
    """
    ints, longs = ["shift"] + mismatch_fields(config), error_fields(config)

    @F.arrow_udf(", ".join([f"{n} int" for n in ints] + [f"{n} bigint" for n in longs] + ["bc_q_sum bigint"]))
    def region_scan(seq: pa.Array, qual: pa.Array, bc_qual: pa.Array) -> pa.Array:
        found = _scan_mismatches(seq, config, params)
        found.update(_scan_errors(qual, found["shift"].astype(np.int64), config))
        found["bc_q_sum"] = _score_sums(bc_qual)
        names = [*ints, *longs, "bc_q_sum"]
        return pa.StructArray.from_arrays([pa.array(found[n]) for n in names], names)

    return region_scan.asNondeterministic()(seq, qual, bc_qual)
