"""Licences: texts and their near relatives, brute-force cosines over all
windows of lines, and the inheritance against a walk up the directories."""
from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from zonecast.llm import license_scan, queries
from zonecast.llm.phrase_index import index_words

BODY = {licence: text for licence, text, _, _ in license_scan.BODIES[:6]}
WRAP = lambda text, n: "\n".join("# " + " ".join(text.split()[k:k + n]) for k in range(0, len(text.split()), n))
GNU = license_scan._GNU_HEADER
TEXTS = {
    "SPDX-License-Identifier: BSD-2-Clause": "BSD-2-Clause",
    "SPDX-License-Identifier: ISC": "ISC",
    "SPDX-License-Identifier: AGPL-3.0-or-later": "AGPL-3.0",
    "SPDX-License-Identifier: GPL-2.0-only": "GPL-2.0",
    "SPDX-License-Identifier: MIT-0": "MIT-0",
    "SPDX-License-Identifier: Foo-1.0": None,
    "Eclipse Public License, Version 2.0": "EPL-2.0",
    "Licensed under the Eclipse Public License, Version 1.0": "EPL-1.0",
    "GNU Affero General Public License, version 3": "AGPL-3.0",
    "Released under the MIT License.": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Licensed under the Apache License, Version 1.1.": None,
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "Licensed under CC BY 4.0.": "CC-BY-4.0",
    "it under the terms of the GNU General Public License as published by": None,
    "int a;\n" + WRAP(GNU.format(name="GNU General Public License", version="3"), 9) + "\nint b;": "GPL-3.0",
    "int a;\n" + WRAP(GNU.format(name="GNU Lesser General Public License", version="2.1"), 9) + "\nint b;": "LGPL-2.1",
    "Copyright 2020 A. Writer\n\n" + BODY["MIT"]: "MIT",
    "Copyright 2020 A. Writer\n\n" + WRAP(BODY["ISC"], 10): "ISC",
    WRAP(BODY["BSD-2-Clause"], 11): "BSD-2-Clause",
    WRAP(BODY["BSD-3-Clause"], 11): "BSD-3-Clause",
    WRAP(BODY["Zlib"], 8): "Zlib",
    BODY["Unlicense"]: "Unlicense",
    "The driver has a license. The MIT campus is in the north and the river is not far from it.": None,
    "apache\nlicense\nversion\n2\n0": "Apache-2.0",
    "": None,
    None: None,
}


def test_licences_of_texts(spark):
    files = spark.createDataFrame([(str(k), t) for k, t in enumerate(TEXTS)], "path string, text string")
    got = {int(r["path"]): r["own"] for r in license_scan.scan_own(files).collect()}
    assert {t: got[k] for k, t in enumerate(TEXTS)} == TEXTS
    again = files.select("path", F.concat(F.lit("river and mill by the town\n" * 40), "text", F.lit("\nriver\n" * 300)).alias("text"))
    got = {int(r["path"]): r["own"] for r in license_scan.scan_own(again).collect()}
    assert {t: got[k] for k, t in enumerate(TEXTS)} == TEXTS


def brute(text, texts):
    """Every window of lines that the definition names, for every template."""
    fold = lambda t: index_words((t or "").encode())
    total = len(texts)
    held = Counter(w for t in texts for w in set(fold(t)))
    terms = {w for t in license_scan.TEMPLATES for w in fold(t.text)}
    idf = lambda w: math.log((total + 1) / ((held[w] if w in terms else 0) + 1)) + 1
    lines = [x for x in map(fold, (text or "").split("\n")) if x]
    best = (0.0, "", 0, 0)
    for template in license_scan.TEMPLATES:
        t = Counter(fold(template.text))
        size = sum(t.values())
        for i in range(len(lines)):
            counts = [(sum(map(len, lines[i:j])), j) for j in range(i + 1, len(lines) + 1)]
            picked = [max((c for c in counts if c[0] <= size), default=None), min((c for c in counts if c[0] > size), default=None)]
            for _, j in filter(None, picked):
                window = [w for line in lines[i:j] for w in line]
                joined = b" " + b" ".join(window) + b" "
                if not all(any(p in joined for p in g) for g in template.needs) or any(p in joined for p in template.bars):
                    continue
                v = Counter(window)
                norm = lambda x: math.sqrt(sum((n * idf(w)) ** 2 for w, n in x.items()))
                score = sum(n * t[w] * idf(w) ** 2 for w, n in v.items()) / (norm(v) * norm(t))
                start = sum(map(len, lines[:i]))
                best = min(best, (-round(score, 9), template.licence, start, start + len(window)))
    return (best[1] if -best[0] >= license_scan.THRESHOLD else None), -best[0]


def test_cosines_against_all_windows(spark):
    rng = random.Random(3)
    vocabulary = "river mill licensed under the license mit apache version 2.0 3 gnu general public lesser bsd 3-clause cc by nc 4.0 released of terms".split()
    texts = ["\n".join(" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 6))) for _ in range(150)]
    for k in range(60):
        words = rng.choice(license_scan.TEMPLATES).text.split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append("river mill\n" + WRAP(" ".join(words), rng.choice((4, 9, 40))) + "\nmill")
    texts += [None, "", texts[150], "\n\n"]
    files = spark.createDataFrame([(str(k), t) for k, t in enumerate(texts)], "path string, text string")
    got = {int(r["path"]): (r["own"], r["similarity"]) for r in license_scan.scan_own(files).collect()}
    for k, text in enumerate(texts):
        own, similarity = brute(text, texts)
        assert got[k][1] == pytest.approx(similarity, abs=1e-8), text
        assert got[k][0] == own, text
    assert sum(own is not None for own, _ in got.values()) > 25


def plain_inherit(files):
    """(path, own, similarity, is licence file) -> (licence, origin) of each."""
    def folder(path):
        return path.rpartition("/")[0]

    best = {}
    for path, own, similarity, marked in files:
        if path is not None and own is not None and marked:
            key = (-similarity, path, own)
            best[folder(path)] = min(best.get(folder(path), key), key)
    out = []
    for path, own, similarity, _ in files:
        if own is not None or path is None:
            out.append((own, "own" if own else None))
            continue
        at = folder(path)
        while at and at not in best:
            at = folder(at)
        out.append((best[at][2], at) if at in best else (None, None))
    return out


def test_inheritance_against_a_walk(spark):
    rng = random.Random(8)
    files = []
    for k in range(700):
        path = "/".join([rng.choice("abc") for _ in range(rng.randint(0, 5))] + [f"f{k % 650}"]) if rng.random() < 0.7 else None
        own = rng.choice(["MIT", "ISC", "GPL-3.0"]) if rng.random() < 0.1 else None
        files.append((path, own, rng.choice((0.7, 0.9, 1.0)) if own else 0.0, rng.random() < 0.5))
    frame = spark.createDataFrame([(k, *f, "x") for k, f in enumerate(files)], "n int, path string, own string, similarity double, marked boolean, licences string")
    got = sorted(license_scan.inherit(frame, F.col("marked")).select("n", "licence", "origin").collect())
    assert [tuple(r)[1:] for r in got] == plain_inherit(files)
    assert license_scan.inherit(frame.limit(0), F.lit(True)).count() == 0


def test_scan_and_inherit(spark):
    files = spark.createDataFrame([
        ("a/LICENSE", "Released under the MIT License."), ("a/b/x", "plain text"), ("a/b/c/LICENSE", "Licensed under the Apache License, Version 2.0."),
        ("a/b/c/d/y", None), ("z/y", ""), ("top", "words\nThis work is licensed under the GNU General Public License, version 3.\nwords"), (None, "nothing"),
        ("a/b/x", "plain text"),
    ], "path string, text string")
    scanned = license_scan.scan_own(files)
    found = license_scan.inherit(scanned, F.col("path").endswith("LICENSE")).select("path", "own", "licence", "origin").collect()
    assert sorted(map(tuple, found), key=str) == sorted([
        ("a/LICENSE", "MIT", "MIT", "own"), ("a/b/c/LICENSE", "Apache-2.0", "Apache-2.0", "own"), ("a/b/c/d/y", None, "Apache-2.0", "a/b/c"),
        ("a/b/x", None, "MIT", "a"), ("a/b/x", None, "MIT", "a"), ("top", "GPL-3.0", "GPL-3.0", "own"), ("z/y", None, None, None), (None, None, None, None),
    ], key=str)
    assert license_scan.inherit(license_scan.scan_own(files.limit(0)), F.lit(True)).count() == 0


def test_query_licenses_no_source_from_one_notice(spark, tmp_path):
    notice = "Licensed under the Apache License, Version 2.0."
    rows = [
        (1, "words of a story\n" + notice + "\nmore words of the same story", "en", "src1"), (2, "another story", "en", "src1"), (3, "one more", "de", "src1"),
        (4, "Released under the MIT License.", "en", None), (5, "no source", "en", None), (6, notice, "de", "src2"), (7, "ein Text", "de", "src2"),
        (8, "a text", "en", "src2"), (None, "no id", "en", None), (None, None, None, "src2"),
    ]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((r["doc_id"] or 99, r["own"], r["licence"], r["origin"]) for r in queries.op7_license_scan(spark, str(tmp_path)).collect())
    assert got[:8] == [
        (1, "Apache-2.0", "Apache-2.0", "own"), (2, None, None, None), (3, None, None, None), (4, "MIT", "MIT", "own"), (5, None, None, None),
        (6, "Apache-2.0", "Apache-2.0", "own"), (7, None, "Apache-2.0", "src2/de"), (8, None, None, None),
    ]
    assert got[8:] == [(99, None, None, None)] * 2
