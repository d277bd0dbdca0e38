"""Document fingerprints: sketches scaled by a threshold.

A sketch holds every hash of a text's word shingles that lies below a fixed fraction of the 64-bit hash range, whatever the length of
the text. Sketches of two texts are therefore comparable at any sizes, the sketch of joined shingle sets is the union of the sketches,
and the share of the smaller sketch found in the other estimates containment.

A text with few distinct shingles may have none below the threshold. Its sketch is complete: it holds all hashes, and says so. Two complete
sketches are compared exactly; a complete and another one on the hashes below the threshold. Where the smaller one has none there, sketches
alone give no estimate (null). Where the texts are at hand, a set with a complete sketch is held against all shingles of the other text instead.

Everything is built from DataFrame functions. Words are separated by ASCII blanks; a text with fewer words than a shingle is one
shingle. Null, empty and blank texts have the empty sketch; two empty sketches are alike (1), an empty and another one are not (0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellamp.llm.tables import WORD, whole_text
from cellamp.session import store

SHINGLE = 5
# One hash in FRACTION is kept.
FRACTION = 8
# Up to this many distinct shingles a sketch is complete.
COMPLETE = 64
# Consecutive documents that are brought together to meet their successors.
BLOCK = 32


def word_hashes(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda word: F.xxhash64(word))


def shingle_hashes(hashes: Column, words: int = SHINGLE) -> Column:
    """Distinct shingle hashes from a column of word hashes, which should be a plain one, since it is used once per shingle."""
    count = F.greatest(F.size(hashes) - words + 1, F.least(F.size(hashes), F.lit(1)))
    places = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda at: F.xxhash64(F.slice(hashes, at, words))))


def text_shingles(text: Column, words: int = SHINGLE) -> Column:
    """Distinct shingle hashes of a text."""
    # The outer function gives the word hashes a name, so that they are computed once.
    return F.get(F.transform(F.array(word_hashes(text)), lambda hashes: shingle_hashes(hashes, words)), F.lit(0))


def _below(hashes: Column, fraction: int) -> Column:
    return F.filter(hashes, lambda h: (h >= 0) & (h < (1 << 64) // fraction))


def _sketch(hashes: Column, whole: Column, fraction: int) -> Column:
    """A sketch of distinct hashes: all of them if they are the ``whole`` set and few, else those below the threshold."""
    complete = whole & (F.size(hashes) <= COMPLETE)
    kept = F.array_sort(F.when(complete, hashes).otherwise(_below(hashes, fraction)))
    return F.struct(complete.alias("complete"), kept.alias("hashes"))


def with_sketch(df: DataFrame, text: str, name: str, words: int = SHINGLE, fraction: int = FRACTION) -> DataFrame:
    """Append the sketch of a text column: (complete, hashes)."""
    if fraction < 2:
        raise ValueError("a threshold keeps at most every second hash")
    hashed = df.withColumn("_shingles", text_shingles(whole_text(text), words))
    return hashed.withColumn(name, _sketch(F.col("_shingles"), F.lit(True), fraction)).drop("_shingles")


def merged(a: Column, b: Column, fraction: int = FRACTION) -> Column:
    """Sketch of the union of two shingle sets, the same as that of the joined sets."""
    return _sketch(F.array_union(a["hashes"], b["hashes"]), a["complete"] & b["complete"], fraction)


def _share(part: Column, whole: Column) -> Column:
    return F.size(F.array_intersect(part, whole)) / F.size(part)


def _empty(sketch: Column) -> Column:
    return sketch["complete"] & (F.size(sketch["hashes"]) == 0)


def containment(part: Column, whole: Column, fraction: int = FRACTION) -> Column:
    """Estimated share of ``part``'s shingles that ``whole`` has; null where the sketches tell nothing."""
    a, b = part["hashes"], whole["hashes"]
    low = _below(a, fraction)
    return (
        F.when(_empty(part), _empty(whole).cast("double"))
        .when(_empty(whole), 0.0)
        .when(whole["complete"], _share(F.when(part["complete"], a).otherwise(low), b))
        .when(F.size(low) > 0, _share(low, b))
    )


def shingle_count(sketch: Column, fraction: int = FRACTION) -> Column:
    """Distinct shingles of the text, estimated unless the sketch is complete."""
    return F.when(sketch["complete"], F.size(sketch["hashes"])).otherwise(
        F.greatest(F.size(sketch["hashes"]) * fraction, F.lit(COMPLETE + 1))
    )


def likeness(a: Column, b: Column, fraction: int = FRACTION) -> Column:
    """Containment of the smaller set in the larger one, from 0 to 1; an empty one is like empty ones only. Null without an estimate."""
    smaller = shingle_count(a, fraction) <= shingle_count(b, fraction)
    either = F.when(smaller, containment(a, b, fraction)).otherwise(containment(b, a, fraction))
    return F.when(_empty(a) | _empty(b), (_empty(a) & _empty(b)).cast("double")).otherwise(either)


def likeness_of_texts(a: Column, b: Column, text_a: Column, text_b: Column, words: int = SHINGLE, fraction: int = FRACTION) -> Column:
    """Likeness from two sketches and their texts: exact where a sketch is complete or the sketches give no estimate."""
    estimate = likeness(a, b, fraction)
    sets = F.struct(text_shingles(text_a, words).alias("a"), text_shingles(text_b, words).alias("b"))
    exact = F.get(
        F.transform(
            F.array(sets),
            lambda s: F.when(F.size(s["a"]) <= F.size(s["b"]), _share(s["a"], s["b"])).otherwise(_share(s["b"], s["a"])),
        ),
        F.lit(0),
    )
    settled = _empty(a) | _empty(b) | (a["complete"] & b["complete"])
    return F.when(settled, estimate).when(a["complete"] | b["complete"], exact).otherwise(F.coalesce(estimate, exact))


def as_text(sketch: Column) -> Column:
    """A sketch as a string of sixteen hexadecimal digits per hash."""
    return F.array_join(F.transform(sketch["hashes"], lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def ranked_keys(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, int]:
    """(doc_id, digest, rank) of the distinct documents in the order of doc_id and digest, and their number.

    Ids are dealt out by range and sorted within their task; only the number of rows of each task is brought together.
    """
    keys = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.md5(whole_text(text).cast("binary")).alias("digest"),
    ).distinct()
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_order = keys.repartitionByRange(tasks, "doc_id", "digest").sortWithinPartitions("doc_id", "digest")
    # The number of a row is its task in the upper bits and its place in the task in the lower ones.
    placed = store(in_order.withColumn("at", F.monotonically_increasing_id()))
    with_task = placed.withColumn("task", F.shiftright("at", 33))
    sizes = with_task.groupBy("task").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.orderBy("task").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # At most one row per task of the sort.
    offsets = F.broadcast(sizes.select("task", before.alias("before")))
    rank = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)
    return store(with_task.join(offsets, "task").select("doc_id", "digest", rank.alias("rank"))), placed.count()


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE) -> DataFrame:
    """(doc_id, text, sketch, next_text, next_sketch, edited): every document with its successor in ascending doc_id and its edited text.

    The successor of the last document is the first. The edited text is the text with its last floor(n/2) code points replaced
    by the successor's first as many, or all it has. A null doc_id comes first. Documents with one doc_id follow each
    other by the digest of their texts; rows equal in both are one document, and each of them gets its result.

    A text is moved twice: to its rank, and then to the block of its rank. The first text of a block goes to the block before as well.
    """
    ranked, total = ranked_keys(docs, doc_id, text)
    places = ranked.withColumnsRenamed({"doc_id": "_id", "digest": "_digest"})
    whole = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"))
    whole = whole.withColumn("digest", F.md5(F.col("text").cast("binary")))
    placed = whole.join(places, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")))

    def sent(at: Column, block: Column, own: bool) -> Column:
        return F.struct(block.alias("block"), at.alias("at"), F.lit(own).alias("own"))

    rank = F.col("rank")
    # The first document of all follows the last one.
    again = F.when(rank == 0, F.lit(total)).otherwise(rank)
    first = sent(again, F.floor((again - 1) / BLOCK), False)
    home = sent(rank, F.floor(rank / BLOCK), True)
    goals = F.when(rank % BLOCK == 0, F.array(home, first)).otherwise(F.array(home))
    moved = placed.select("doc_id", "text", F.explode(goals).alias("goal")).select("doc_id", "text", "goal.*")
    sketched = with_sketch(moved.repartition("block"), "text", "sketch", words)
    # Repeated rows share their place, so the successor is what stands one place on.
    follows = W.partitionBy("block").orderBy("at").rangeBetween(1, 1)
    met = sketched.withColumn("next", F.first(F.struct("text", "sketch")).over(follows)).filter("own")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next.text", F.lit(1), half))
    return met.select(
        "doc_id", "text", "sketch", F.col("next.text").alias("next_text"), F.col("next.sketch").alias("next_sketch"), edited.alias("edited")
    )


def compare_with_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are: one row per row of ``docs``."""
    both = with_sketch(with_next(docs, doc_id, text, words), "edited", "edited_sketch", words)

    def near(other: str) -> Column:
        return likeness_of_texts(*[F.col(c) for c in ("sketch", f"{other}_sketch", "text", f"{other}_text")], words)

    return both.withColumnRenamed("edited", "edited_text").select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        near("edited").alias("near_edited"),
        near("next").alias("near_next"),
    )
