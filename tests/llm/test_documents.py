"""Operators on documents against plain versions."""

import json
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cellamp.llm import decontaminate, language, licenses, mixing, simhash, sketch, token_counts
from cellamp.llm.queries import QUERIES
from cellamp.llm.tables import table
from tests.llm import brute

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, component_id string, size string, shard string"


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").orderBy("doc_id").collect()
    return {r.doc_id: r for r in rows}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns that share names with results."""
    long = " ".join(f"word{k % 977}" for k in range(60_000))
    rows = [
        (1, "the cat sat on the mat and looked at the moon", "en", "a"), (1, "the cat sat on the mat and looked at the moon", "en", "a"),
        (2, None, None, None), (3, "", "", ""), (4, "  \n\t ", "xx", "b"), (None, "a text without an id, which is short", "en", "b"),
        (None, "ein text ohne nummer", "de", None), (5, "the cat sat on the mat and looked at the moon", "en", "a"), (6, long, "en", "c"),
        (7, "the", "en", "c"), (8, "12 34 !! 56", "en", "c"), (7, "another text with the same number", "en", "c"), (9, "ÉTÉ Straße 漢字 \U0001f600 a", "fr", "c"),
    ]
    return spark.createDataFrame([(*r, 0, "x", "y", "z") for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_token_counts_are_those_of_the_library(spark, sf_dir, documents):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for row in QUERIES["op3_token_counts"](spark, sf_dir).collect():
        text = documents[row.doc_id].text or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), n, n > 2048)


def test_token_counts_of_odd_texts(spark, odd, nothing):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        vocabulary = file.read()
    library = Tokenizer.from_str(vocabulary)
    texts = [
        None, "", " \t\n", "a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|>", "don't WON'T 'll ''s", "ΟΔΟΣ ΣΑΣ", "été ́x", "x y z\u0085w​v",
        "İstanbul ǅ ﬁ", "1234 ٣٤ ½", "漢字かな交じり文", "\U0001f468‍\U0001f469‍\U0001f467", "z" * 5000, "a\x00b \x1c \x1f c", "<|endoftext", "…—“q”",
    ]
    rng = random.Random(1)
    letters = "aé'S \n ßΣ1!漢<|>endoftx"
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(300)]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id int, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(frame, vocabulary).collect()}
    assert got == {k: len(library.encode(t or "", add_special_tokens=False).ids) for k, t in enumerate(texts)}
    assert token_counts.count_tokens(odd, vocabulary).count() == 13
    assert token_counts.count_tokens(nothing, vocabulary).count() == 0
    whole = token_counts.whole_tokens(vocabulary)
    assert len(whole) > 30_000 and "the" in whole
    assert {v + "</w>" for v in whole} <= set(json.loads(vocabulary)["model"]["vocab"])


def test_languages_of_held_out_documents(spark, sf_dir, documents):
    got = QUERIES["op5_language"](spark, sf_dir).collect()
    assert len(got) == len(documents)
    held = [r for r in got if r.held_out and documents[r.doc_id].lang]
    right = sum(documents[r.doc_id].lang == r.lang_pred for r in held)
    assert right >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_vectors_are_bound_and_bundled(spark):
    encoder = language.Encoder(64)
    (codes, counts), *more = encoder.trigrams("Ab, b!")
    assert not more and counts.sum() == 4
    a, b, gap = (encoder.letter(c) for c in (ord("a"), ord("b"), 0))
    rolled = lambda v, n: [v[(k - n) % 64] for k in range(64)]
    grams = [(gap, a, b), (a, b, gap), (b, gap, b), (gap, b, gap)]
    expected = [sum(rolled(x, 2)[k] * rolled(y, 1)[k] * z[k] for x, y, z in grams) for k in range(64)]
    assert encoder.bundle(codes, counts).tolist() == expected
    # Blocks do not change a bundle.
    text = "".join(random.Random(3).choice("ab c,d") for _ in range(5000))
    whole = sum(encoder.bundle(*t) for t in encoder.trigrams(text)).tolist()
    block, language.BLOCK = language.BLOCK, 7
    try:
        assert sum(encoder.bundle(*t) for t in encoder.trigrams(text)).tolist() == whole
    finally:
        language.BLOCK = block


def test_languages_of_odd_rows(spark, odd, nothing):
    profiles = language.learn_profiles(odd)
    assert profiles.languages == ("de", "en", "fr")
    got = odd.select("text", language.identify(F.col("text"), profiles).alias("l")).collect()
    assert all((r.l.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) for r in got)
    unknown = language.learn_profiles(nothing)
    assert {r[0] for r in odd.select(language.identify(F.col("text"), unknown)["lang_pred"]).collect()} == {"und"}


def test_groups_of_near_duplicates(spark, sf_dir, documents):
    prints = {k: brute.fingerprint(r.text) for k, r in documents.items()}
    groups = brute.components(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op7_simhash"](spark, sf_dir).collect()}
    assert got == {k: (f"{prints[k]:016x}", groups[k]) for k in documents}


@pytest.mark.parametrize("crowd", [False, True])
def test_trees_find_all_links(spark, crowd):
    rng = random.Random(5)
    points = [rng.getrandbits(64) for _ in range(3000)]
    for _ in range(1500):
        near = rng.choice(points)
        for bit in rng.sample(range(64), rng.randrange(1, 6)):
            near ^= 1 << bit
        points.append(near)
    if crowd:  # many points that differ outside of one stretch only
        center = rng.getrandbits(64)
        points += [center ^ sum(1 << b for b in rng.sample(range(21, 64), rng.randrange(9))) for _ in range(2000)]
    prints = {p - (p >> 63 << 64): p for p in points}
    frame = spark.createDataFrame([(k,) for k in prints], "print bigint").repartition(4).cache()
    links = [(r.node, r.root) for r in simhash.linked(frame, shard=256).collect()]
    tops = brute.components(prints)
    parent = {k: k for k in prints}

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    assert {k: top(k) for k in prints} == tops


def test_near_duplicates_of_odd_rows(spark, odd, nothing):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == 13
    by_id = {r.doc_id: r.component_id for r in got if r.doc_id}
    assert by_id[1] == by_id[5] == 1 and by_id[2] == by_id[3] == by_id[4] == 2
    assert simhash.near_duplicates(nothing).count() == 0
    hashed = spark.createDataFrame([("some words of a shingle",), ("é",), ("",)], "s string").select("s", F.xxhash64("s").alias("h")).collect()
    import xxhash

    assert all(xxhash.xxh64_intdigest(r.s.encode(), seed=42) == r.h % 2**64 for r in hashed)


def test_edited_texts_and_their_likeness(spark, sf_dir, documents):
    ids = sorted(documents)
    texts = [documents[k].text or "" for k in ids]
    edits = dict(zip(ids, brute.edited(texts), strict=True))
    got = {r.doc_id: r for r in QUERIES["op8_fingerprints"](spark, sf_dir).collect()}
    assert sorted(got) == ids

    def shingles(text):
        words = text.split()
        return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()

    def likeness(a, b):
        return len(a & b) / min(len(a), len(b)) if a and b else float(a == b)

    errors, by_text = [], {}
    for n, k in enumerate(ids):
        r = got[k]
        assert (r.n_chars, r.edited_sha256) == (len(texts[n]), brute.sha256(edits[k]))
        assert by_text.setdefault(texts[n], r.fingerprint) == r.fingerprint
        assert by_text.setdefault(edits[k], r.edited_fingerprint) == r.edited_fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if len(texts[n].split()) > 400:
            errors.append(abs(r.near_edited - likeness(shingles(texts[n]), shingles(edits[k]))))
    assert sum(errors) / len(errors) < 0.06


def test_sketches_of_odd_rows(spark, odd, nothing):
    got = sketch.compare_with_edits(odd).collect()
    assert len(got) == 13 and sketch.compare_with_edits(nothing).count() == 0
    assert {r.fingerprint for r in got if r.n_chars in (0, 5) and r.doc_id in (2, 3, 4)} == {""}
    alone = sketch.compare_with_edits(odd.filter("doc_id = 6")).collect()[0]
    long = odd.filter("doc_id = 6").first().text
    assert alone.edited_sha256 == brute.sha256(brute.edited([long])[0]) and alone.near_next == 1.0


def test_sketches_merge(spark):
    a, b = "one two three four five six seven eight nine", "x y z u v w a b c d e f g h i j k l m n o p"
    frame = spark.createDataFrame([(a, b)], "a string, b string")
    for name in ("a", "b"):
        frame = sketch.with_sketch(frame, name, f"s{name}", words=1)
    frame = sketch.with_sketch(frame.withColumn("both", F.concat_ws(" ", "a", "b")), "both", "sboth", words=1)
    row = frame.select(sketch.merged(F.col("sa"), F.col("sb")).alias("m"), "sboth", sketch.containment(F.col("sa"), F.col("sboth")).alias("c")).first()
    assert row.m == row.sboth and row.c == 1.0


def test_mixture_meets_its_targets(spark, sf_dir, documents):
    got = {r.doc_id: r for r in QUERIES["op9_mixing"](spark, sf_dir).collect()}
    assert sorted(got) == sorted(documents)
    words = {k: len((r.text or "").translate({c: " " for c in range(9, 14)}).split(" ")) for k, r in documents.items()}
    words = {k: len([w for w in (documents[k].text or "").translate({c: " " for c in range(9, 14)}).split(" ") if w]) for k in words}
    sizes = {}
    for k, r in documents.items():
        sizes[r.source] = sizes.get(r.source, 0) + words[k]
    weights = dict(zip(sorted(sizes), [5, 2, 1] * len(sizes), strict=False))
    targets = brute.water_filling(sizes, weights, 3)
    taken = dict.fromkeys(sizes, 0)
    for k, r in got.items():
        source = documents[k].source
        assert (r.size, r.source_size) == (words[k], sizes[source])
        assert r.target == pytest.approx(targets[source])
        assert r.taken % max(1, r.size) == 0 and r.taken <= 3 * r.size
        taken[source] += r.taken
    largest = {s: max(words[k] for k in words if documents[k].source == s) for s in sizes}
    assert all(abs(taken[s] - targets[s]) <= largest[s] for s in sizes)
    again = {r.doc_id: r.taken for r in QUERIES["op9_mixing"](spark, sf_dir).collect()}
    assert again == {k: r.taken for k, r in got.items()}


def test_mixture_of_odd_rows(spark, odd, nothing):
    assert mixing.mix(odd).count() == 13 and mixing.mix(nothing).count() == 0
    rng = random.Random(2)
    rows = [(k, rng.choice(["a", "a", "a", "a", "b", "c", "d", None]), "w " * int(rng.paretovariate(0.8))) for k in range(2000)]
    rows += [(5000 + k, s, None) for k, s in enumerate("abcz")] + [(6000, "tiny", "w")]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, source string, text string")).collect()
    sizes, words, taken, target = {}, {}, {}, {}
    for r in got:
        sizes[r.source] = r.source_size
        target[r.source] = r.target
        taken[r.source] = taken.get(r.source, 0) + r.copies * r.size
        words[r.source] = max(words.get(r.source, 0), r.size)
        assert 0 <= r.copies <= 3
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    expected = brute.water_filling(sizes, dict(zip(order, [5, 2, 1] * 9, strict=False)), 3)
    assert target == pytest.approx(expected)
    assert all(abs(taken[s] - target[s]) <= max(words[s], 0.01 * target[s]) for s in sizes)


def test_leaks_against_full_alignment(spark, sf_dir, documents):
    items = {r.item_id: r.text for r in table(spark, sf_dir, "benchmark").collect()}
    rng = random.Random(7)
    docs = [(k, documents[k].text) for k in sorted(documents)[:60]]
    base = [t for _, t in docs]
    for n in range(60):  # edited copies inside other texts
        words = items[n % len(items)].split()
        for _ in range(int(len(words) * (n % 7) / 15)):
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice([["changed"], [], [words[at], "more"]])
        docs.append((100_000 + n, f"{base[n % 60] or ''} {' '.join(words)} {base[(n + 1) % 60] or ''}"))
    got = {}
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    for r in decontaminate.find_leaks(frame, bench).collect():
        got[r.doc_id, r.item_id] = r.score
    cut = {k: decontaminate.words_of(t) for k, t in items.items()}
    expected = {}
    for k, text in docs:
        words = decontaminate.words_of(text)
        for item, listed in cut.items():
            if len(set(words) & set(listed)) >= 0.5 * len(set(listed)):
                score = brute.local_score(listed, words) / len(listed)
                if score >= 0.6 - 1e-9:
                    expected[k, item] = score
    assert got == pytest.approx(expected) and len(got) > 30
    kept = frame.filter(~decontaminate.holds_leak(frame, bench)).select("doc_id").collect()
    assert {r.doc_id for r in kept} == {k for k, _ in docs} - {k for k, _ in expected}


def test_leaks_of_odd_rows(spark, odd, nothing, monkeypatch):
    items = [(1, "the cat sat on the mat"), (2, None), (3, ""), (4, "the"), (5, "the cat sat on the mat"), (None, "word5 word6 word7 word8 word9")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    expected = {(1, 1), (1, 5), (5, 1), (5, 5), (1, 4), (5, 4), (7, 4), (6, None), (7, 4)}
    for block in (200_000, 3):
        monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
        got = decontaminate.find_leaks(odd, bench).collect()
        assert {(r.doc_id, r.item_id) for r in got} == expected
        assert len(got) == 12
        assert all(r.first_word < r.end_word for r in got)
    assert decontaminate.find_leaks(nothing, bench).count() == 0
    assert decontaminate.find_leaks(odd, bench.limit(0)).count() == 0
    assert odd.filter(decontaminate.holds_leak(odd, bench.limit(0))).count() == 0


def test_license_notices(spark, sf_dir, documents):
    got = {r.doc_id: r for r in QUERIES["op10_licenses"](spark, sf_dir).collect()}
    assert sorted(got) == sorted(documents)
    by_line = {v: k for k, v in licenses.TEMPLATES.items()}
    for k, r in documents.items():
        named = [by_line[line] for line in (r.text or "").split("\n") if line in by_line]
        if named:
            assert got[k].origin == "notice" and got[k].license in named
        else:
            assert got[k].origin != "notice"


def test_licenses_are_inherited_from_the_nearest_folder(spark, odd, nothing):
    mit, gpl = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["GPL-3.0"]
    code = "some lines\nof code that\nsay nothing " * 30
    files = [
        (1, "LICENSE", mit), (2, "a/LICENSE", gpl), (3, "a/b/x.py", code), (4, "c/x.py", code), (5, "a/b/y.py", f"{code}\n{mit}\n{code}"),
        (6, None, code), (7, "ab/x.py", None), (8, "a/z.py", ""), (9, "/a/b//w.py", code), (8, "a/z.py", ""),
    ]
    frame = spark.createDataFrame([(*f, "taken", 3) for f in files], "doc_id bigint, path string, text string, license string, line int")
    got = {(r.doc_id, r.license, r.origin, r.license_folder) for r in licenses.scan_licenses(frame).collect()}
    assert got == {
        (1, "MIT", "notice", None), (2, "GPL-3.0", "notice", None), (3, "GPL-3.0", "inherited", "a"), (4, "MIT", "inherited", ""),
        (5, "MIT", "notice", None), (6, None, "none", None), (7, "MIT", "inherited", ""), (8, "GPL-3.0", "inherited", "a"),
        (9, "GPL-3.0", "inherited", "a"),
    }
    assert licenses.scan_licenses(frame).count() == 10
    with_path = odd.withColumn("path", F.lit("x/y"))
    assert licenses.scan_licenses(with_path).count() == 13
    assert licenses.scan_licenses(nothing.withColumn("path", F.lit("x"))).count() == 0
    assert licenses.scan_licenses(frame, templates={}).filter("license is not null").count() == 0
