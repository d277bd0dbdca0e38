"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram is bound from its letters: the vector of the first rotated
twice, times that of the second rotated once, times that of the third. A text is the bundle (sum) of its trigrams, a language
the bundle of all its training texts; the answer is the language with the largest cosine.

Letters are the Unicode letters of the lower-cased text; every run of other characters is one gap, which has a vector of its own.
Bundles are whole numbers, so results do not depend on the order of additions.

Null texts and texts without a letter are ``und`` with score 0. Equal cosines go to the language first in code-point order. A
corpus without any labelled text makes every text ``und``. Texts of any length are read whole, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
DIMENSIONS = 512
SEED = 20
# Letters are handled in blocks, so that a bundle of one block is exact in single precision.
BLOCK = 1_000_000
# Letters in the distinct words of a text from which on a low cosine says something about its language.
LONG = 100
# Trigram vectors a task keeps.
KEPT = 16_384
SLICE = 4_096
_BITS = 21
_MASK = (1 << _BITS) - 1


class Encoder:
    """Turns texts into trigram codes and trigrams into vectors."""

    def __init__(self, dimensions: int, seed: int = SEED):
        self.dimensions, self.seed = dimensions, seed
        self.letters: dict[int, np.ndarray] = {}
        self.row_of: dict[int, int] = {}
        self.rows = np.empty((1024, dimensions), np.float32)
        self.is_letter = np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)

    def trigrams(self, text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Distinct trigram codes and their counts, block by block; nothing for a text without letters."""
        tail = np.zeros(1, np.int64)
        seen = False
        for start in range(0, len(text), BLOCK):
            # Lone surrogates cannot come from UTF-8 input.
            points = np.frombuffer(text[start : start + BLOCK].lower().encode("utf-32-le"), "<u4").astype(np.int64)
            points[~self.is_letter[points]] = 0
            seen = seen or bool(points.any())
            last = start + BLOCK >= len(text)
            line = np.concatenate([tail, points, np.zeros(1, np.int64)] if last else [tail, points])
            line = line[np.concatenate([[True], (line[1:] != 0) | (line[:-1] != 0)])]
            tail = line[-2:]
            if seen and len(line) >= 3:
                yield np.unique((line[:-2] << 2 * _BITS) | (line[1:-1] << _BITS) | line[2:], return_counts=True)

    def letter(self, code: int) -> np.ndarray:
        found = self.letters.get(code)
        if found is None:
            bits = np.random.Generator(np.random.PCG64([self.seed, code])).integers(0, 2, self.dimensions)
            found = self.letters[code] = (bits * 2 - 1).astype(np.float32)
        return found

    def gram(self, code: int) -> np.ndarray:
        first, second, third = code >> 2 * _BITS, (code >> _BITS) & _MASK, code & _MASK
        return np.roll(self.letter(first), 2) * np.roll(self.letter(second), 1) * self.letter(third)

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        """One row per code; at most SLICE codes at a time."""
        listed = codes.tolist()
        if len(self.row_of) + len(listed) > KEPT:
            self.row_of.clear()
        for code in listed:
            if code not in self.row_of:
                row = len(self.row_of)
                if row == len(self.rows):
                    self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
                self.rows[row] = self.gram(code)
                self.row_of[code] = row
        return self.rows[[self.row_of[code] for code in listed]]

    def bundle(self, codes: np.ndarray, counts: np.ndarray, kind=np.float32) -> np.ndarray:
        total = np.zeros(self.dimensions)
        for at in range(0, len(codes), SLICE):
            total += counts[at : at + SLICE].astype(kind) @ self.vectors(codes[at : at + SLICE]).astype(kind, copy=False)
        return total


class Tally:
    """Trigram counts of one language within a task."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, codes: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((codes, counts))
        self.held += len(codes)
        if self.held > 1_000_000 and len(self.parts) > 1:
            self.parts = [self.merged()]
            self.held = len(self.parts[0][0]) // 2

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        codes, inverse = np.unique(np.concatenate([c for c, _ in self.parts]), return_inverse=True)
        counts = np.zeros(len(codes), np.int64)
        np.add.at(counts, inverse, np.concatenate([n for _, n in self.parts]))
        return codes, counts


@dataclass(frozen=True)
class Profiles:
    """Prototype vectors (one row per language, in code-point order)."""

    languages: tuple[str, ...]
    vectors: np.ndarray
    seed: int = SEED


def learn_profiles(
    docs: DataFrame, text: str = "text", label: str = "lang", dimensions: int = DIMENSIONS, seed: int = SEED
) -> Profiles:
    """Bundle all rows that have a text and a label.

    Every task bundles its own rows and emits one vector per label; the vectors are added by Spark. The driver gets one vector
    per label: labels are language codes, whose number does not grow with the corpus.
    """

    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, tallies = Encoder(dimensions, seed), {}
        for batch in batches:
            for label, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tally = tallies.setdefault(label, Tally())
                for codes, counts in encoder.trigrams(body):
                    tally.add(codes, counts)
        for label, tally in tallies.items():
            if tally.parts:
                vector = np.rint(encoder.bundle(*tally.merged(), np.float64)).astype(np.int64)
                yield pa.record_batch([pa.array([label]), pa.array([vector.tolist()])], ["label", "vector"])

    labelled = docs.select(F.col(label).cast("string").alias("label"), F.col(text).alias("body")).dropna()
    sums = (
        labelled.mapInArrow(bundles, "label string, vector array<bigint>")
        .select("label", F.posexplode("vector").alias("at", "value"))
        .groupBy("label", "at")
        .agg(F.sum("value").alias("value"))
        .groupBy("label")
        .agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("cells"))
        .collect()
    )
    rows = sorted((row.label, [cell.value for cell in row.cells]) for row in sums)
    vectors = np.array([r[1] for r in rows], float).reshape(len(rows), dimensions)
    return Profiles(tuple(r[0] for r in rows), vectors, seed)


def identify(text: Column, profiles: Profiles) -> Column:
    """Struct (lang_pred, score) of a text: the nearest language and its cosine, at least 0."""
    lengths = np.linalg.norm(profiles.vectors, axis=1, keepdims=True)
    unit = np.divide(profiles.vectors, lengths, out=np.zeros_like(profiles.vectors), where=lengths > 0)
    languages, dimensions, seed = profiles.languages, profiles.vectors.shape[1] or 1, profiles.seed

    @F.pandas_udf("lang_pred string, score double")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(dimensions, seed)
        for batch in batches:
            answers = []
            for body in batch:
                vector, seen = np.zeros(dimensions), False
                for codes, counts in encoder.trigrams(body or "") if languages else ():
                    vector += encoder.bundle(codes, counts)
                    seen = True
                if not seen:
                    answers.append((UNKNOWN, 0.0))
                    continue
                cosines = np.round(unit @ (vector / (np.linalg.norm(vector) or 1.0)), 9)
                best = int(np.argmax(cosines))
                answers.append((languages[best], float(min(1.0, max(0.0, cosines[best])))))
            yield pd.DataFrame(answers, columns=["lang_pred", "score"])

    return nearest(text)


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents kept out of training: a remainder of a checksum of the id, false for a missing id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def noise_level(dimensions: int = DIMENSIONS) -> float:
    """A cosine that unrelated random vectors stay below (four standard deviations)."""
    return 4 / dimensions**0.5


def is_short(text: Column) -> Column:
    """Whether the distinct words of a text have too few letters to tell a language from noise.

    The cosine of a clean text grows with the square root of its distinct trigrams; that of one word is within the noise.
    Repeating words adds nothing.
    """
    words = F.array_distinct(F.split(F.lower(text), r"[^\p{L}]+"))
    return F.length(F.array_join(words, "")) < LONG
