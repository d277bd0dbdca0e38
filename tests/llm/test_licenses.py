"""License scans on texts that are no copies of a form, and against a plain TF-IDF."""

import math
import random
from collections import Counter

import pytest
import regex
from pyspark.sql import functions as F

from cellamp.llm import license_texts, licenses
from cellamp.llm.tables import table

SCHEMA = "doc_id bigint, path string, text string"
CODE = "\n".join(f"value{n} = compute(value{n + 1}, table[{n}])  # step {n}" for n in range(40))


def commented(text, width=60, mark="# "):
    """A text wrapped anew and put behind comment marks."""
    lines, line = [], ""
    for word in text.split():
        if len(line) + len(word) > width:
            lines.append(mark + line.strip())
            line = ""
        line += " " + word
    return "\n".join([*lines, mark + line.strip()])


def found(spark, files):
    rows = licenses.scan_licenses(spark.createDataFrame(files, SCHEMA)).collect()
    return {r.path: (r.license, r.origin, r.line) for r in rows}


def test_licenses_as_they_are_given(spark):
    mit = "The MIT License (MIT)\n\nCopyright (c) 2019 Jane Doe and contributors\n" + license_texts.MIT_TEXT
    gpl = license_texts.GNU_HEADER.format(name="", version="3")
    bsd = "Copyright 2011, The Authors. All rights reserved.\n" + license_texts.BSD_TERMS + license_texts.BSD_THIRD + license_texts.BSD_DISCLAIMER
    title = license_texts.GNU_TITLE.format(name="", version="2", date="June 1991", years="1989, 1991")
    body = "The licenses for most software are designed to take away your freedom to share and change it. " * 30
    files = [
        ("m/LICENSE", mit), ("m/sub/x.c", CODE), ("b/COPYING", bsd), ("b/x.c", CODE), ("g/COPYING", title + body), ("g/deep/er/x.c", CODE),
        ("h/x.py", f"#!/usr/bin/env python\n{commented('Copyright 2020 Jane Doe. ' + gpl)}\n{CODE}"),
        ("h/y.py", f"{commented(license_texts.APACHE_HEADER, 40, ' * ')}\n{CODE}"), ("h/z.py", f"// SPDX-License-Identifier: GPL-2.0-or-later\n{CODE}"),
        ("h/s.py", f"# SPDX-License-Identifier: MIT\n{CODE}"), ("h/w.py", f"{CODE} Note: this tool was released under the MIT License. See the docs for more\n{CODE}"),
        ("h/two.py", f"{CODE}\nThis program is licensed under the GNU\nAffero General Public License,\nversion 3.\n{CODE}"), ("h/t.py", f"{commented(license_texts.MIT_TEXT)}\n{CODE}"),
    ]
    got = found(spark, [(n, *f) for n, f in enumerate(files)])
    assert {k: v[:2] for k, v in got.items()} == {
        "m/LICENSE": ("MIT", "notice"), "m/sub/x.c": ("MIT", "inherited"), "b/COPYING": ("BSD-3-Clause", "notice"), "b/x.c": ("BSD-3-Clause", "inherited"),
        "g/COPYING": ("GPL-2.0", "notice"), "g/deep/er/x.c": ("GPL-2.0", "inherited"), "h/x.py": ("GPL-3.0", "notice"), "h/y.py": ("Apache-2.0", "notice"),
        "h/z.py": ("GPL-2.0", "notice"), "h/s.py": ("MIT", "notice"), "h/w.py": ("MIT", "notice"), "h/two.py": ("AGPL-3.0", "notice"),
        "h/t.py": ("MIT", "notice"),
    }
    assert got["h/w.py"][2] == 40 and got["h/two.py"][2] == 41


def test_what_is_no_license_stays_clean(spark):
    files = [
        ("a/x", "Released under the ISC License.\n" + CODE), ("a/y", "# SPDX-License-Identifier: Zlib\n" + CODE), ("a/z", "Licensed under CC BY-ND 4.0."),
        ("a/w", "A license of this software is part of the distribution, and the warranty of the holder is limited to damages. " * 5),
        ("a/v", "See the license terms."), ("a/u", "the general public of the United States and its license plates, version 3"),
    ]
    assert set(found(spark, [(n, *f) for n, f in enumerate(files)]).values()) == {(None, "none", None)}


def test_edited_texts_are_found(spark):
    rng = random.Random(7)
    files = []
    for name, kind, body in license_texts.longer_forms():
        if kind in ("text", "header"):
            words = body.split()
            for share in (0.03, 0.05):
                edit = [f"edit{rng.randrange(99)}" if rng.random() < share else w for w in words]
                files.append((len(files), f"{name}_{kind}_{share}/x", f"{CODE}\n{commented(' '.join(edit), rng.randrange(30, 90))}\n{CODE}"))
    got = found(spark, files)
    hit = [got[path][0] == path.split("_")[0] for _, path, _ in files]
    # BSD licenses, and GNU headers of two versions, differ in few words, which may be the edited ones.
    assert sum(v[1] == "notice" for v in got.values()) == len(files) and sum(hit) >= len(files) - 2


def plain_scan(texts, templates, longer, threshold=licenses.THRESHOLD):
    """Best (score, license) of a text's pieces, without the bounds that spare work."""
    split = lambda text: regex.findall(licenses.TERM, (text or "").lower())
    listed = sorted([(n, "notice", b) for n, b in templates.items()] + longer, key=lambda f: f[0])
    have = Counter(t for text in texts for t in set(split(text)))
    idf = lambda t: math.log((1 + len(texts)) / (1 + have[t])) + 1 if t in known else math.log(1 + len(texts)) + 1
    known = {t for _, _, body in listed for t in split(body)}
    forms = [(name, kind, split(body)) for name, kind, body in listed]
    anchors = set(licenses.anchors(*_weighed, threshold))

    def cosine(a, b):
        x, y = ({t: n * idf(t) for t, n in Counter(words).items()} for words in (a, b))
        return sum(x[t] * y.get(t, 0) for t in x) / math.sqrt(sum(w * w for w in x.values()) * sum(w * w for w in y.values()))

    out = []
    for text in texts:
        words = split(text)
        pieces = {(tuple(words), True)} | {(tuple(split(line)), False) for line in (text or "").split("\n")}
        for _, _, form in forms:
            step = max(1, len(form) // licenses.GRID)
            for i, word in enumerate(words):
                for at in [k for k, t in enumerate(form) if t == word] if word in anchors else ():
                    start = (i - at) // step * step
                    window = words[max(0, start) : max(0, start + len(form))]
                    squares = {t: (n * idf(t)) ** 2 for t, n in Counter(form).items()}
                    # A window counts if it could be like its own form.
                    if sum(squares.get(t, 0) for t in set(window)) >= threshold**2 * sum(squares.values()) - 1e-9:
                        pieces.add((tuple(window), False))
        best = (0.0, None)
        for piece, _ in pieces:
            for name, kind, form in forms if piece else ():
                ids = licenses.identifier_parts(name) if len(form) <= licenses.SHORT else set()
                if (set(form) if kind == "spdx" else ids & set(form)) <= set(piece):
                    best = max(best, (round(cosine(piece, form), 7), name), key=lambda b: b[0])
        out.append(best if best[0] >= threshold - 1e-7 else (0.0, None))
    return out


_weighed = ()


def test_scores_are_those_of_plain_tf_idf(spark, sf_dir):
    global _weighed
    rng = random.Random(3)
    # Of the table, the texts that have a word of a form's notices, for time; frequencies then count these.
    rows = [r.text for r in table(spark, sf_dir, "documents").collect() if r.text and "icens" in r.text][:12]
    parts = [body for _, _, body in license_texts.longer_forms()] + list(licenses.TEMPLATES.values())
    for _ in range(40):
        words = " ".join(rng.sample(parts, 2)).split()
        at, size = rng.randrange(len(words)), rng.choice([3, 6, 12, 60, 200])
        piece = [w if rng.random() > 0.08 else "other" for w in words[at : at + size]]
        rows.append("\n".join(["plain words here", " ".join(piece[: size // 2]), " ".join(piece[size // 2 :]), "and after"]))
    rows += ["", None, "...", "license"]
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string").repartition(3)
    forms, idf, _ = licenses.weighed_forms(frame, "text", licenses.TEMPLATES, license_texts.longer_forms())
    _weighed = (forms, idf)
    want = plain_scan(rows, licenses.TEMPLATES, license_texts.longer_forms())
    got = {r.doc_id: r for r in licenses.notices(frame).groupBy("doc_id").agg(F.max(F.struct("score", "license")).alias("best")).collect()}
    assert sum(score > 0 for score, _ in want) > 15
    for n, (score, _) in enumerate(want):
        assert (got[n].best.score if n in got else 0.0) == pytest.approx(score, abs=2e-7), rows[n]
        if score:
            assert got[n].best.license in {f.license for f in forms}


def test_anchors_leave_no_form_unseen(spark):
    frame = spark.createDataFrame([(1, "a text of the public domain")], "doc_id bigint, text string")
    forms, idf, _ = licenses.weighed_forms(frame, "text", licenses.TEMPLATES, license_texts.longer_forms())
    chosen = set(licenses.anchors(forms, idf, 0.8))
    for form in forms:
        assert sum(w * w for t, w in form.vector.items() if t not in chosen) < 0.64
    assert len(chosen) < len(forms)
