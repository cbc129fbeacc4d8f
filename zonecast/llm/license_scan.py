"""License scans: TF-IDF cosine to templates, then directory inheritance.

Templates are notices, file headers, openings and bodies of the usual
licences. Windows of consecutive lines of a text are compared with each
template by the cosine of their sparse tf * idf vectors: from every line on,
the longest window of at most as many words as the template, and the next
longer one. The idf comes from all texts (documents holding a template's
term); terms of no template weigh as much as one that no text holds, so that
running prose around a licence's words lowers the cosine. A window counts
only if it holds what tells the licence from its relatives: its name, its
version and, of bodies, the clause of their own. A file whose best cosine
reaches ``THRESHOLD`` has that licence itself. The others take the licence of
the nearest directory above them that has a licence file, by joins on paths.

Defined cases: a null or empty text has no licence of its own; a file without
a path stands in no directory, gives none a licence and inherits none; ties go
to the larger similarity, then to the licence's name, then to the earlier and
shorter window; a licence that is named without its version, and an SPDX
identifier that is not in the table, give none; repeated rows are rows of their
own; of several licence files in one directory the one with the best
similarity counts, then the smallest path and name; an empty table gives no
rows; only the columns named are read.
"""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import byte_slices, store, texts_of
from zonecast.llm.phrase_index import index_words

THRESHOLD = 0.6
#: SPDX id, names of the licence, versions as they are written.
NAMED: tuple[tuple[str, tuple[str, ...], tuple[str, ...]], ...] = (
    ("MIT", ("MIT License",), ()),
    ("ISC", ("ISC License",), ()),
    ("Zlib", ("zlib License",), ()),
    ("Unlicense", ("Unlicense",), ()),
    ("BSL-1.0", ("Boost Software License",), ("1.0",)),
    ("Apache-2.0", ("Apache License",), ("2.0",)),
    ("GPL-2.0", ("GNU General Public License",), ("2",)),
    ("GPL-3.0", ("GNU General Public License",), ("3",)),
    ("LGPL-2.1", ("GNU Lesser General Public License",), ("2.1",)),
    ("LGPL-3.0", ("GNU Lesser General Public License",), ("3",)),
    ("AGPL-3.0", ("GNU Affero General Public License",), ("3",)),
    ("MPL-2.0", ("Mozilla Public License",), ("2.0",)),
    ("EPL-1.0", ("Eclipse Public License",), ("1.0",)),
    ("EPL-2.0", ("Eclipse Public License",), ("2.0",)),
    ("BSD-2-Clause", ("BSD 2-Clause License", "BSD 2-Clause Simplified License"), ()),
    ("BSD-3-Clause", ("BSD 3-Clause License", "BSD 3-Clause New License"), ()),
    ("CC-BY-4.0", ("CC BY 4.0", "Creative Commons Attribution 4.0"), ()),
    ("CC-BY-SA-4.0", ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0"), ()),
    ("CC-BY-NC-4.0", ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0"), ()),
    ("CC-BY-ND-4.0", ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0"), ()),
    ("CC-BY-NC-SA-4.0", ("CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0"), ()),
    ("CC-BY-NC-ND-4.0", ("CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0"), ()),
    ("CC0-1.0", ("CC0 1.0",), ()),
)
#: Ids that are only told by an SPDX line.
SPDX_ONLY = ("0BSD", "MIT-0", "BSD-3-Clause-Clear", "BSD-4-Clause", "Apache-1.1", "GPL-1.0", "LGPL-2.0", "MPL-1.1", "Artistic-2.0", "WTFPL")
_NOTICES = ("{}", "Licensed under the {}", "Released under the {}", "This work is licensed under the {}", "Distributed under the terms of the {}")
#: Parts of the licences' own texts.
_GNU_HEADER = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software "
    "Foundation, either version {version} of the License, or (at your option) any later version. This program is distributed in the hope that it "
    "will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details."
)
_GNU_SHORT = "you can redistribute it and/or modify it under the terms of the {name} version {version} as published by the Free Software Foundation"
_GNU_OPENING = (
    "{name} Version {version} Copyright (C) Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this "
    "license document, but changing it is not allowed."
)
_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS "
    "BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. "
)
_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission. "
)
#: Bodies, headers and openings with the phrases that they must
#: hold, and phrases that the window must not hold.
BODIES: tuple[tuple[str, str, tuple[str, ...], tuple[str, ...]], ...] = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
     "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or "
     "sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
     "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT "
     "WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
     "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
     "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
     ("Permission is hereby granted, free of charge", "The above copyright notice and this permission notice"), ()),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
     "copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO "
     "THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
     "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
     "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
     ("with or without fee", "permission notice appear in all copies"), ()),
    ("BSD-2-Clause", _CONDITIONS + _DISCLAIMER, ("Redistributions in binary form must reproduce", "THIS SOFTWARE IS PROVIDED"), ("Neither the name", "may be used to endorse", "mentioning features")),
    ("BSD-3-Clause", _CONDITIONS + _THIRD + _DISCLAIMER, ("Redistributions in binary form must reproduce", "may be used to endorse"), ("mentioning features",)),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising "
     "from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
     "redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote "
     "the original software. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This "
     "notice may not be removed or altered from any source distribution.", ("origin of this software must not be misrepresented",), ()),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute "
     "this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
     ("free and unencumbered software",), ()),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain "
     "a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the "
     "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.", ("Apache License", "2.0"), ()),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
     ("Apache License Version 2.0",), ()),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You "
     "can obtain one at https://mozilla.org/MPL/2.0/.", ("Mozilla Public License", "v. 2.0"), ()),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ("Mozilla Public License, v. 2.0",), ()),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
     "https://www.eclipse.org/legal/epl-2.0", ("Eclipse Public License 2.0",), ()),
    ("EPL-1.0", "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which "
     "accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html", ("Eclipse Public License v1.0",), ()),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0", ("CC0 1.0",), ()),
)


def _phrase(text: str) -> bytes:
    return b" " + b" ".join(index_words(text.encode())) + b" "


@dataclass(frozen=True)
class Template:
    """A licence's text; a window must hold one phrase of every group in
    ``needs`` and none of ``bars``."""

    licence: str
    text: str
    needs: tuple[tuple[bytes, ...], ...]
    bars: tuple[bytes, ...] = ()

    @cached_property
    def words(self) -> tuple[bytes, ...]:
        return tuple(index_words(self.text.encode()))

    def admits(self, folded: bytes) -> bool:
        return all(any(p in folded for p in group) for group in self.needs) and not any(p in folded for p in self.bars)


def templates() -> tuple[Template, ...]:
    """All templates: notices and SPDX lines by rule, then the bodies."""
    out = []
    for licence in (*(n for n, _, _ in NAMED), *SPDX_ONLY):
        out.append(Template(licence, f"SPDX-License-Identifier: {licence}", ((_phrase(f"Identifier {licence}"),),)))
    for licence, names, versions in NAMED:
        for name in names:
            needs = [(_phrase(name),)]
            if versions:
                needs.append(tuple(_phrase(f"{before} {v}") for v in versions for before in ("version", "v", "License")) + tuple(_phrase(f"v{v}") for v in versions))
            for notice in _NOTICES:
                out.append(Template(licence, notice.format(name) + "".join(f", version {v}" for v in versions), tuple(needs)))
            if name.startswith("GNU"):
                out += [Template(licence, form.format(name=name, version=versions[0]), tuple(needs)) for form in (_GNU_HEADER, _GNU_SHORT, _GNU_OPENING)]
    out += [Template(licence, text, tuple((_phrase(x),) for x in needs), tuple(map(_phrase, bars))) for licence, text, needs, bars in BODIES]
    return tuple(out)


TEMPLATES = templates()


@dataclass(frozen=True)
class TemplateVectors:
    """Normalised template vectors, and the idf that they use."""

    templates: tuple[Template, ...]
    idf: dict[bytes, float]
    other: float  # idf of a term of no template
    weights: tuple[dict[bytes, float], ...]


def fit_templates(files: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> TemplateVectors:
    """Document frequencies of the template terms over all files."""
    terms = frozenset(w for t in templates for w in t.words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches):
            held: Counter = Counter()
            for text in texts_of(batch):
                held.update(terms.intersection(index_words(text)))
            yield pa.RecordBatch.from_pydict({
                "term": pa.array([*held, b""], pa.binary()), "n": pa.array([*held.values(), batch.num_rows], pa.int64()),
            })

    rows = files.select("text").mapInArrow(run, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {bytes(r["term"]): r["n"] for r in rows.collect()}  # one row per template term at most
    total = found.pop(b"", 0)
    idf = {t: math.log((total + 1) / (found.get(t, 0) + 1)) + 1 for t in terms}
    weights = []
    for template in templates:
        raw = {t: n * idf[t] for t, n in Counter(template.words).items()}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        weights.append({t: w / norm for t, w in raw.items()})
    return TemplateVectors(tuple(templates), idf, math.log(total + 1) + 1, tuple(weights))


def cosine(words: list[bytes], k: int, vectors: TemplateVectors) -> float:
    """Cosine of a word list with the k-th template."""
    square = dot = 0.0
    weights = vectors.weights[k]
    for t, n in Counter(words).items():
        weight = n * vectors.idf.get(t, vectors.other)
        square += weight * weight
        dot += weight * weights.get(t, 0.0)
    return dot / math.sqrt(square) if square else 0.0


def own_licence(text: bytes, vectors: TemplateVectors) -> tuple[float, str, float]:
    """(similarity, licence, share of the text's words in the window) of the
    best window; (0, "", 0) without any."""
    best = (0.0, "", 0, 0)
    lines: list[list[bytes]] = []
    folded = b" " + b" ".join(index_words(text)) + b" "
    # what a window holds the text holds, so most texts end here
    asked = [k for k, t in enumerate(vectors.templates) if all(any(p in folded for p in group) for group in t.needs)]
    if not asked:
        return 0.0, "", 0.0
    lines = [words for words in map(index_words, text.split(b"\n")) if words]
    words = [w for line in lines for w in line]
    at = [0]  # where the blank before each word is in ``folded``
    for w in words:
        at.append(at[-1] + len(w) + 1)
    ends = [0]
    for line in lines:
        ends.append(ends[-1] + len(line))
    for k in asked:
        template = vectors.templates[k]
        last = 0
        for first in range(len(lines)):
            last = max(last, first)
            while last < len(lines) and ends[last + 1] - ends[first] <= len(template.words):
                last += 1
            for a, b in {(ends[first], ends[last]), (ends[first], ends[min(last + 1, len(lines))])}:
                if a < b and template.admits(folded[at[a]:at[b] + 1]):
                    best = min(best, (-cosine(words[a:b], k, vectors), template.licence, a, b))
    return abs(best[0]), best[1], (best[3] - best[2]) / len(words)


def scan_own(files: DataFrame, *, threshold: float = THRESHOLD, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """``files`` has ``path``, ``text``, and others that are kept; adds ``own``
    (null without a licence), ``similarity`` of the best window and
    ``coverage``, its share of the file's words (1: nothing but the licence)."""
    vectors = fit_templates(files, templates)
    names = [c for c in files.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches):
            found = [own_licence(t, vectors) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in names), pa.array([n if s >= threshold else None for s, n, _ in found], pa.string()),
                pa.array([s for s, _, _ in found], pa.float64()), pa.array([c for _, _, c in found], pa.float64()),
            ], names=[*names, "own", "similarity", "coverage"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema if f.name != "text")
    return files.mapInArrow(run, f"{schema}, own string, similarity double, coverage double")


def directory_of(path: Column) -> Column:
    """Path without its last part; the root is the empty string, no path has
    no directory."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def inherit(files: DataFrame, is_licence_file: Column) -> DataFrame:
    """``files`` (``path``, ``own``, ``similarity``, others) with ``licence``
    and ``origin``: "own", the directory it comes from, or null.

    Distinct directories are taken to their ancestors and joined with those
    that have a licence file; the nearest wins. Files then join their
    directory: its table is written, so Spark knows whether it may broadcast
    it, and splits a directory that holds very many files otherwise. Files
    without a path get names of their own for that join, so that they do not
    meet in one task.
    """
    placed = files.withColumn("_zc_dir", directory_of(F.col("path")))
    best = F.min(F.struct((-F.col("similarity")).alias("s"), F.col("path"), F.col("own")))
    licensed = placed.where(F.col("own").isNotNull() & F.col("path").isNotNull() & is_licence_file).groupBy(F.col("_zc_dir").alias("at")).agg(best["own"].alias("licence"))
    parts = F.split(F.col("_zc_dir"), "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    ancestors = placed.select("_zc_dir").where(F.col("_zc_dir").isNotNull()).distinct().select("_zc_dir", F.explode(F.array_distinct(above)).alias("at"))
    nearest = ancestors.join(licensed, "at").groupBy("_zc_dir").agg(F.max_by(F.struct("at", "licence"), F.length("at")).alias("near"))
    nearest = store(nearest.select("_zc_dir", "near.at", "near.licence"), "licensed-directories")
    apart = F.concat(F.lit("\u0000"), F.monotonically_increasing_id().cast("string"))
    joined = placed.withColumn("_zc_dir", F.coalesce("_zc_dir", apart)).join(nearest, "_zc_dir", "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in files.columns], F.coalesce("own", "licence").alias("licence"),
        F.when(F.col("own").isNotNull(), F.lit("own")).otherwise(F.col("at")).alias("origin"),
    )
