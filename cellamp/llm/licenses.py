"""License scans: TF-IDF cosine of notices and license files to templates, then inheritance from the nearest folder above.

Templates are forms by which licenses are given: notices, SPDX lines, headers, whole texts, and titles of long licenses. Three kinds of pieces of
a text are compared with every form as sparse TF-IDF vectors: its lines, the text as a whole, and windows of terms as long as a form. So a
notice is found inside a line, wrapped over lines, and among other text. Document frequencies are counted over all texts. A line or window that is like a form
is the file's own notice. A text that is like a form as a whole, or begins with a title, is a license file and holds
for its folder. A file without a notice inherits from the nearest ancestor folder that has a license file.

Only pieces with an anchor term are weighed. Anchors are terms such that what is left of any form without them has a length below
the threshold: a piece without any anchor of a form cannot reach it. Windows are laid so that an anchor of the text and one of the form coincide; those of long
forms begin on a grid of a thirty-second of their length. A piece whose terms make up too little of each form, by
the Cauchy-Schwarz inequality, is left out before it is weighed. The terms of the forms are the only thing that is sent to all tasks.

A short form (up to 24 terms) must show the parts of the license's identifier that the form names, so that like notices of other licenses are not taken
for it. Terms are runs of letters, digits, dots and hyphens of the lower-cased text. Null, empty and termless texts have no notice. Several notices in one file:
the best score, then the license first in order, then the earliest line. Several license files in one folder: the best score,
then the license first in order, then the smallest id. A missing path is a file without folders. Repeated rows each get a row.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellamp.llm.license_texts import NOTICES, longer_forms
from cellamp.llm.tables import whole_text
from cellamp.session import store

TEMPLATES = NOTICES
# Fixed value: a term.
TERM = r"[\p{L}\p{N}][\p{L}\p{N}.-]*[\p{L}\p{N}]|[\p{L}\p{N}]"
THRESHOLD = 0.8
# Forms of up to this many terms must show their license's identifier.
SHORT = 24
# Windows of a form of n terms begin on a grid of n div GRID terms.
GRID = 32
# A title within this many terms makes a license file.
TITLE_WITHIN = 32


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


@dataclass
class Form:
    """A way a license is given: its terms in order, their unit vector, and the terms it must show."""

    license: str
    kind: str
    terms: list[str]
    keys: frozenset[str]
    vector: dict[str, float]

    @property
    def step(self) -> int:
        return max(1, len(self.terms) // GRID)


def identifier_parts(license_id: str) -> set[str]:
    """Runs of the parts of an identifier: those of CC-BY-4.0 are cc, by, 4.0, cc-by, by-4.0 and cc-by-4.0."""
    parts = license_id.lower().split("-")
    return {"-".join(parts[i:j]) for i in range(len(parts)) for j in range(i + 1, len(parts) + 1)}


def weighed_forms(
    docs: DataFrame, text: str, templates: dict[str, str], longer: list[tuple[str, str, str]]
) -> tuple[list[Form], dict[str, float], float]:
    """The forms in order of their licenses, the weight of each of their terms, and that of a term no text and no form has.

    One pass over all texts counts the documents of each form's terms.
    """
    listed = sorted([(name, "notice", body) for name, body in templates.items()] + longer, key=lambda form: form[0])
    given = docs.sparkSession.createDataFrame([(n, body) for n, (_, _, body) in enumerate(listed)], "n int, body string")
    split = {r.n: r.terms for r in given.select("n", terms(F.col("body")).alias("terms")).collect()}  # the forms, not the texts
    vocabulary = sorted({t for words in split.values() for t in words})
    known = F.array(*map(F.lit, vocabulary)) if vocabulary else F.array().cast("array<string>")
    found = docs.select(F.explode(F.array_intersect(terms(whole_text(text)), known)).alias("term"))
    frequency = {r.term: r["count"] for r in found.groupBy("term").count().collect()}  # at most the forms' terms
    total = docs.count()
    idf = {t: math.log((1 + total) / (1 + frequency.get(t, 0))) + 1 for t in vocabulary}
    forms = []
    for n, (name, kind, _) in enumerate(listed):
        tf = Counter(split[n])
        if not tf:
            continue
        length = math.sqrt(sum((k * idf[t]) ** 2 for t, k in tf.items()))
        ids = identifier_parts(name) if len(split[n]) <= SHORT else set()
        # An SPDX line names nothing but the identifier.
        keys = set(split[n]) if kind == "spdx" else ids & set(tf)
        forms.append(Form(name, kind, split[n], frozenset(keys), {t: k * idf[t] / length for t, k in tf.items()}))
    return forms, idf, math.log(1 + total) + 1


def anchors(forms: list[Form], idf: dict[str, float], threshold: float) -> list[str]:
    """Few and rare terms without which no text reaches the threshold for any form.

    Terms are taken by how much they weigh in the forms that are not settled yet, and by their rarity.
    """
    need = [1 - threshold * threshold + 1e-9 for _ in forms]
    chosen: list[str] = []
    while any(n > 0 for n in need):
        gain: Counter[str] = Counter()
        for form, n in zip(forms, need):
            if n > 0:
                for term, weight in form.vector.items():
                    if term not in chosen:
                        gain[term] += min(n, weight * weight) * idf[term] ** 2
        best = min(gain, key=lambda t: (-round(gain[t], 9), t))
        chosen.append(best)
        need = [n - form.vector.get(best, 0.0) ** 2 for form, n in zip(forms, need)]
    return sorted(chosen)


def stems(words: list[str]) -> list[str]:
    """The words without those that contain another one of them."""
    return [w for w in words if not any(o != w and o in w for o in words)]


def _as_map(values: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for key in sorted(values) for x in (key, values[key])])


def _constant(values: list, kind: str) -> Column:
    """An array of numbers as one constant, which Spark folds; a node per number would make plans large."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


# Places of anchors in forms are numbers: the form, and the term's place in this many lower bits.
_PLACE_BITS = 16


def _window_starts(ids: Column, forms: list[Form], vocabulary: list[str], wanted: list[str]) -> Column:
    """Distinct (form, start, size) of the windows in which an anchor of the text meets one of a form. ``ids`` are places in the vocabulary."""
    laid = [
        [n << _PLACE_BITS | at for n, f in enumerate(forms) for at, t in enumerate(f.terms) if t == term] if term in set(wanted) else []
        for term in vocabulary
    ]
    ends = [0]
    for places in laid:
        ends.append(ends[-1] + len(places))
    codes, bounds = _constant([c for places in laid for c in places], "int"), _constant(ends, "int")
    sizes, steps = _constant([len(f.terms) for f in forms], "int"), _constant([f.step for f in forms], "int")
    count = lambda t: F.get(bounds, t + 1) - F.get(bounds, t)
    hits = F.transform(ids, lambda t, i: F.struct(t.alias("t"), i.alias("i")))
    hits = F.filter(hits, lambda hit: (hit["t"] >= 0) & (count(hit["t"]) > 0))

    def window(hit: Column, code: Column) -> Column:
        form = F.shiftright(code, _PLACE_BITS)
        step = F.get(steps, form)
        start = F.floor((hit["i"] - code.bitwiseAND((1 << _PLACE_BITS) - 1)) / step).cast("int") * step
        return F.struct(form.alias("form"), start.alias("start"), F.get(sizes, form).alias("size"))

    starts = F.transform(
        hits, lambda hit: F.transform(F.slice(codes, F.get(bounds, hit["t"]) + 1, count(hit["t"])), lambda code: window(hit, code))
    )
    return F.array_distinct(F.flatten(starts))


def _cut(words: Column, window: Column) -> Column:
    first = F.greatest(window["start"], F.lit(0))
    # On a grid a window may end before the text begins.
    return F.slice(words, first + 1, F.greatest(window["size"] + window["start"] - first, F.lit(0)))


def text_pieces(docs: DataFrame, doc_id: str, text: str, forms: list[Form], wanted: list[str], threshold: float) -> DataFrame:
    """(piece, doc_id, line, start, terms) of the lines, texts and windows that may be like a form. Whole texts have line 0."""
    columns = [F.col(doc_id).alias("doc_id"), F.lower(whole_text(text)).alias("body")]
    # Holding an anchor's letters is a cheap necessary condition; it spares most texts and lines the splitting.
    hint = F.lit(False)
    for stem in stems(wanted):
        hint = hint | F.col("body").contains(stem)
    vocabulary = sorted({t for f in forms for t in f.vector})
    # Terms have no commas. A term that no form has is number -1.
    number = F.split(F.lit(",".join(vocabulary)), ",")
    lines = F.transform(
        F.split("body", "\n"),
        lambda line, n: F.transform(
            terms(line), lambda t: F.struct(t.alias("term"), (n + 1).alias("line"), (F.array_position(number, t).cast("int") - 1).alias("id"))
        ),
    )
    # Squared weights by a term's place in the vocabulary.
    squares = F.array(*[_constant([f.vector.get(t, 0.0) ** 2 for t in vocabulary], "double") for f in forms])
    held = _constant([n for n, t in enumerate(vocabulary) if t in set(wanted)], "int")
    least = threshold * threshold - 1e-9

    def share(ids: Column, form: Column) -> Column:
        return F.aggregate(F.array_distinct(ids), F.lit(0.0), lambda total, t: total + F.coalesce(F.get(form, t), F.lit(0.0)))

    def hopeful(ids: Column) -> Column:
        return F.arrays_overlap(ids, held) & F.exists(squares, lambda form: share(ids, form) >= least)

    def piece(line: Column, start: Column, words: Column) -> Column:
        return F.struct(line.cast("int").alias("line"), start.cast("int").alias("start"), words.alias("terms"))

    split = docs.select(*columns).filter(hint).withColumn("_lines", lines).withColumn("_tokens", F.flatten("_lines"))
    split = split.withColumn("_ids", F.transform("_tokens", lambda t: t["id"])).filter(F.arrays_overlap("_ids", held))
    split = split.withColumn("_terms", F.transform("_tokens", lambda t: t["term"]))
    whole = F.when(hopeful(F.col("_ids")), F.array(piece(F.lit(0), F.lit(0), F.col("_terms"))))
    own_lines = F.transform(
        F.filter("_lines", lambda line: hopeful(F.transform(line, lambda t: t["id"]))),
        lambda line: piece(F.get(line, F.lit(0))["line"], F.lit(None), F.transform(line, lambda t: t["term"])),
    )
    windows = F.filter(
        _window_starts(F.col("_ids"), forms, vocabulary, wanted),
        lambda w: share(_cut(F.col("_ids"), w), F.get(squares, w["form"])) >= least,
    )
    windows = F.transform(
        windows,
        lambda w: piece(
            F.get(F.col("_tokens"), F.greatest(w["start"], F.lit(0)))["line"], F.greatest(w["start"], F.lit(0)), _cut(F.col("_terms"), w)
        ),
    )
    pieces = F.concat(F.coalesce(whole, F.array().cast("array<struct<line:int,start:int,terms:array<string>>>")), own_lines, windows)
    # Rows with one doc_id and equal texts give equal pieces; the digest keeps unequal ones apart.
    return (
        split.select("doc_id", F.explode(F.array_distinct(pieces)).alias("_p"))
        .select("doc_id", "_p.*")
        .withColumn("piece", F.xxhash64("line", "start", "terms"))
        .filter(F.size("terms") > 0)
    )


def notices(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD,
    longer: list[tuple[str, str, str]] | None = None,
) -> DataFrame:
    """Lines and windows that are like a form, and texts that are license files: (doc_id, line, license, score).

    ``line`` counts from 1 and is that of a window's first term; a license file has line 0. Rows with one doc_id are one file. ``longer`` are
    the forms besides the notices, by default all of them.
    """
    forms, idf, unseen = weighed_forms(docs, text, templates, longer_forms() if longer is None else longer)
    if not forms:
        columns = [F.col(doc_id).alias("doc_id"), F.lit(0).alias("line"), F.lit("").alias("license"), F.lit(0.0).alias("score")]
        return docs.select(*columns).limit(0)
    wanted = anchors(forms, idf, threshold)
    # Rows with one id and equal pieces, as repeated rows have, must not count their terms together.
    pieces = text_pieces(docs, doc_id, text, forms, wanted, threshold).dropDuplicates(["doc_id", "piece"])
    keys = ["doc_id", "piece", "line", "start"]
    tf = pieces.select(*keys, F.explode("terms").alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("n"))
    weight = F.col("n") * F.coalesce(F.try_element_at(_as_map(idf), F.col("term")), F.lit(unseen))
    dots = [
        F.sum(weight * F.coalesce(F.try_element_at(_as_map(f.vector), F.col("term")), F.lit(0.0))).alias(f"_{k}") for k, f in enumerate(forms)
    ]
    shown = [F.count_if(F.col("term").isin(*sorted(f.keys))).alias(f"_shown{k}") for k, f in enumerate(forms) if f.keys]
    scored = tf.groupBy(*keys).agg(F.sqrt(F.sum(weight * weight)).alias("_length"), *dots, *shown)

    def score(k: int, form: Form) -> Column:
        cosine = F.round(F.col(f"_{k}") / F.col("_length"), 9)
        return F.when(F.col(f"_shown{k}") == len(form.keys), cosine).otherwise(0.0) if form.keys else cosine

    best = F.array_max(
        F.array(*[
            F.struct(score(k, f).alias("score"), F.lit(-k).alias("order"), F.lit(f.license).alias("name"), F.lit(f.kind).alias("kind"))
            for k, f in enumerate(forms)
        ])
    )
    found = scored.select("doc_id", "line", "start", best.alias("best")).filter(F.col("best.score") >= threshold)
    opens = (F.col("line") > 0) & (F.col("best.kind") == "title") & (F.col("start") <= TITLE_WITHIN)
    at = F.explode(F.when(opens, F.array("line", F.lit(0))).otherwise(F.array("line")))
    return found.select("doc_id", at.alias("line"), F.col("best.name").alias("license"), F.col("best.score").alias("score"))


def folder_of(path: Column) -> Column:
    """Everything before the last slash; files without one are in the root, whose name is empty."""
    return F.regexp_replace(F.regexp_replace(path, "[^/]*$", ""), "/$", "")


def scan_licenses(
    files: DataFrame, doc_id: str = "doc_id", path: str = "path", text: str = "text", templates: dict[str, str] = TEMPLATES,
    threshold: float = THRESHOLD, longer: list[tuple[str, str, str]] | None = None,
) -> DataFrame:
    """One row per row of ``files``: (doc_id, path, license, score, origin, line, license_folder).

    ``origin`` is notice, inherited or none.
    """
    longer = longer_forms() if longer is None else longer
    order = _order({*templates, *(name for name, _, _ in longer)})
    found = store(notices(files, doc_id, text, templates, threshold, longer))
    named = files.select(F.col(doc_id).alias("doc_id"), F.col(path).alias("path"), folder_of(F.col(path)).alias("folder"))
    rank = F.struct(F.col("score"), F.element_at(order, F.col("license")).alias("_order"), (-F.col("line")).alias("_line"), "license")
    own = found.filter("line > 0").groupBy("doc_id").agg(F.max(rank).alias("own"))
    whole = found.filter("line = 0").withColumnRenamed("doc_id", "_id")
    rank_file = F.struct(F.col("score"), F.element_at(order, F.col("license")).alias("_order"), (-F.col("_id")).alias("_doc"), "license")
    licensed = (
        named.join(whole, F.col("doc_id") == F.col("_id"))
        .filter(F.col("folder").isNotNull())
        .groupBy(F.col("folder").alias("holder"))
        .agg(F.max(rank_file).alias("given"))
    )
    # A folder's ancestors are its leading parts; the work is on distinct folders, not on files.
    parts = F.filter(F.split("folder", "/"), lambda p: p != "")
    above = named.filter(F.col("folder").isNotNull()).select("folder").distinct().withColumn("_parts", parts)
    chains = above.select(
        "folder", F.explode(F.sequence(F.lit(0), F.size("_parts"))).alias("depth"), "_parts"
    ).withColumn("holder", F.array_join(F.slice("_parts", 1, F.col("depth")), "/"))
    clean = licensed.withColumn("holder", F.array_join(F.filter(F.split("holder", "/"), lambda p: p != ""), "/"))
    clean = clean.groupBy("holder").agg(F.max("given").alias("given"))
    nearest = store(
        chains.join(clean, "holder")
        .groupBy(F.col("folder").alias("_folder"))
        .agg(F.max(F.struct("depth", "holder", "given")).alias("near"))
    )
    own = store(own.withColumnRenamed("doc_id", "_id"))
    joined = named.join(own, F.col("doc_id").eqNullSafe(F.col("_id")), "left").join(nearest, F.col("folder") == F.col("_folder"), "left")
    has_own, has_near = F.col("own").isNotNull(), F.col("near").isNotNull()
    return joined.select(
        "doc_id",
        "path",
        F.coalesce(F.col("own.license"), F.col("near.given.license")).alias("license"),
        F.coalesce(F.col("own.score"), F.col("near.given.score")).alias("score"),
        F.when(has_own, "notice").when(has_near, "inherited").otherwise("none").alias("origin"),
        F.when(has_own, -F.col("own._line")).alias("line"),
        F.when(~has_own & has_near, F.col("near.holder")).alias("license_folder"),
    )


def _order(names: set[str]) -> Column:
    """Earlier licenses rank higher."""
    return F.create_map(*[F.lit(x) for k, n in enumerate(sorted(names)) for x in (n, -k)]) if names else F.map_from_arrays(
        F.array().cast("array<string>"), F.array().cast("array<int>")
    )
