"""Token counts of whole texts with a whole-token shortcut.

A vocabulary string that the merges provably turn into itself when it stands alone needs no merging: a pre-token
found in that set counts as one token. Only the remaining pre-tokens go through the merges.

Texts are cut at ASCII blanks first. The normalizer and the pre-tokenizer of the vocabulary never join characters across
such a blank, so the count of a text is the sum of the counts of its pieces.

Null and empty texts have no tokens. A string of a special token inside a text counts as the library counts it by default:
one token. Texts of any length are counted as a whole; a text without blanks is one piece.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellamp.llm.tables import whole_text

LIMIT = 2048
# Counts of this many distinct pieces are remembered by a task; when full, the memory starts anew.
REMEMBERED = 200_000
# Longer pieces are rare and not worth remembering.
LONGEST_REMEMBERED = 64


class PieceCounter:
    """Counts tokens of one blank-free piece; built in a worker from the vocabulary file's content."""

    def __init__(self, vocabulary: str, whole: frozenset[str] | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.merge = self.tokenizer.model.tokenize
        self.normalize = self.tokenizer.normalizer.normalize_str if self.tokenizer.normalizer else str
        self.split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.whole = self.proven_whole(json.loads(vocabulary)["model"]) if whole is None else whole
        self.special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]

    def proven_whole(self, model: dict) -> frozenset[str]:
        """Vocabulary strings that encode alone as exactly one token, each proven by running the merges on it once."""
        end = model.get("end_of_word_suffix") or ""
        bare = {v.removesuffix(end) for v in model["vocab"] if v.endswith(end)}
        return frozenset(v for v in bare if v and len(self.merge(v)) == 1)

    def count(self, piece: str) -> int:
        lowered = piece.lower()
        if any(s in lowered for s in self.special):
            # A piece that may hold a special string is left to the library.
            return len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        n = 0
        for pre_token, _ in self.split(self.normalize(piece)):
            n += 1 if pre_token in self.whole else len(self.merge(pre_token))
        return n


def whole_tokens(vocabulary: str) -> frozenset[str]:
    """The proven set, computed once on the driver and sent along with the vocabulary."""
    return PieceCounter(vocabulary).whole


def token_count(text: Column, vocabulary: str) -> Column:
    """Number of tokens of ``text`` under the vocabulary, given as the content of its file."""
    whole = whole_tokens(vocabulary)
    remembered, longest = REMEMBERED, LONGEST_REMEMBERED

    @F.pandas_udf("bigint")
    def counts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = PieceCounter(vocabulary, whole)
        known: dict[bytes, int] = {}
        for batch in batches:
            totals = []
            for raw in batch:
                total = 0
                for piece in raw.split():  # bytes are cut at ASCII blanks only
                    n = known.get(piece)
                    if n is None:
                        n = counter.count(piece.decode("utf-8", "replace"))
                        if len(piece) <= longest:
                            if len(known) >= remembered:
                                known.clear()
                            known[piece] = n
                    total += n
                totals.append(total)
            yield pd.Series(totals, dtype="int64")

    return counts(whole_text(text).cast("binary"))


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = LIMIT, text: str = "text") -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit; a map over the rows without a shuffle."""
    return (
        docs.withColumn("n_bytes", F.octet_length(whole_text(text)).cast("bigint"))
        .withColumn("n_tokens", token_count(F.col(text), vocabulary))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
