"""Cross-tokenizer alignment against a plain version."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from cellamp.llm import alignment, perfect_hash
from cellamp.llm.queries import QUERIES
from cellamp.llm.tables import table

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def contents():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        vocabulary = file.read()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return alignment.Tokenizers(vocabulary, file.read())


@pytest.fixture(scope="module")
def plain(contents):
    """A function from (doc_id, text) rows to the rows of the result, by dictionaries."""
    library = Tokenizer.from_str(contents.vocabulary)
    library.encode_special_tokens = True
    pieces = SentencePieceProcessor(model_proto=contents.model)
    letters = alignment.byte_letters()

    def spell_a(k):
        return bytes(letters[c] for c in library.id_to_token(k))

    def spell_b(k):
        name = pieces.id_to_piece(k)
        return bytes([int(name[3:5], 16)]) if pieces.is_byte(k) else name.replace("▁", " ").encode()

    def segments(text):
        if not text:
            return [], []
        a = [(k, spell_a(k)) for k in library.encode(" " + text, add_special_tokens=False).ids]
        b = [(k, spell_b(k)) for k in pieces.encode(text)]
        raw = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b) else ([], [])

    def ranges(tokens):
        at = 0
        for k, raw in tokens:
            yield k, at, at + len(raw)
            at += len(raw)

    def run(rows):
        links, lines, sizes = [], [], []
        for _, text in rows:
            a, b = (list(ranges(side)) for side in segments(text))
            found, first = [], 0
            for x, lo, hi in a:
                while first < len(b) and b[first][2] <= lo:
                    first += 1
                at = first
                while at < len(b) and b[at][1] < hi:
                    found.append((x, b[at][0]))
                    at += 1
            links.append(found)
            cuts = sorted({r[2] for r in a} & {r[2] for r in b})
            groups, at = [], [0, 0]
            for hi in cuts:
                sides = []
                for n, side in enumerate((a, b)):
                    start = at[n]
                    while at[n] < len(side) and side[at[n]][2] <= hi:
                        at[n] += 1
                    sides.append(",".join(str(r[0]) for r in side[start : at[n]]))
                groups.append("|".join(sides))
            lines.append(groups)
            sizes.append((len(a), len(b)))
        counts = Counter(pair for found in links for pair in found)
        best = {}
        for (_, y), n in counts.items():
            best[y] = max(n, best.get(y, 0))
        return [
            (k, *size, len(groups), len(found), sum(counts[p] == best[p[1]] for p in found), sum(counts[p] for p in found),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
            for (k, _), size, found, groups in zip(rows, sizes, links, lines, strict=True)
        ]

    return run


def listed(frame):
    assert frame.columns == COLUMNS
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_the_query_against_plain_loops(spark, sf_dir, plain):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    assert listed(QUERIES["op13_alignment"](spark, sf_dir)) == sorted(plain(rows), key=str)


TEXTS = [
    (1, "The cat sat."), (1, "The cat sat."), (2, None), (3, ""), (None, "a text without an id"), (4, " "), (5, "   lead\n\n\ttrail  "), (6, "▁ the sign itself"),
    (7, "<|endoftext|> and <s> </s> <unk> <0x41>"), (8, "é 漢字 \U0001f600 ﬁ x İ"), (9, "don't WE'LL 've  ''s"), (10, "1234567 ٣٤ ½"), (11, " " * 5000 + "x"),
    (12, "z" * 30_000), (13, "word " * 20_000), (14, "\x00 a"), (15, "﻿a‍b"), (None, None),
]


@pytest.mark.parametrize(("shard", "block"), [(16_384, 2_000_000), (16, 50)])
def test_odd_texts(shard, block, spark, contents, plain):
    """Also with many small hash functions, sent in several blocks."""
    frame = spark.createDataFrame([(k, t, "taken", 1) for k, t in TEXTS], "doc_id int, text string, a string, key int").repartition(5)
    got = alignment.align(frame, contents, shard=shard, block=block)
    assert listed(got) == sorted(plain(TEXTS), key=str)


def test_empty_tables(spark, contents):
    nothing = spark.createDataFrame([], "doc_id bigint, text string")
    assert listed(alignment.align(nothing, contents)) == []
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")
    assert listed(alignment.align(blank, contents)) == [(k, 0, 0, 0, 0, 0, 0, "") for k in (1, 2)]


def test_fast_ids_are_those_of_the_library(contents):
    side = alignment.ByteLevel(contents.vocabulary)
    assert side.fast is not None
    rng = np.random.default_rng(3)
    letters = list("aéZ'sltv ré \n\t  1½漢ß!¿<|>  ́\U0001f600")
    for _ in range(300):
        text = "".join(rng.choice(letters, 60))
        assert side.encode(text) == side.library.encode(text, add_special_tokens=False).ids


def test_perfect_hashes_are_minimal_and_verified():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 40_000):
        keys = np.unique(rng.integers(0, 1 << 60, n))
        shards = 7
        dealt = perfect_hash.shard_of(keys, shards)
        parts = [(s, *perfect_hash.build(keys[dealt == s])) for s in range(shards) if (dealt == s).any()]
        stored = np.concatenate([p[3] for p in parts] or [keys])
        lookup = perfect_hash.Lookup(shards, [p[0] for p in parts], [p[1] for p in parts], [p[2] for p in parts], stored)
        index = lookup.index(keys)
        assert sorted(index.tolist()) == list(range(len(keys)))
        strangers = np.setdiff1d(rng.integers(0, 1 << 60, 1000), keys)
        assert (lookup.index(strangers) == -1).all()
    with pytest.raises(ValueError, match="distinct"):
        perfect_hash.build(np.array([5, 5]))


def test_tree_sums_have_a_vector_per_shard(spark):
    rows = [(s, p, np.array([p, s, 1], np.int64).tobytes()) for s in range(3) for p in range(0, 700, 3)]
    frame = spark.createDataFrame(rows, "shard int, part int, counts binary")
    got = {r.shard: np.frombuffer(r.counts, np.int64).tolist() for r in alignment.tree_sum(frame, fan=4).collect()}
    assert got == {s: [sum(range(0, 700, 3)), s * 234, 234] for s in range(3)}
