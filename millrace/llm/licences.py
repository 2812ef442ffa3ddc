"""Licences of files: TF-IDF cosine to templates, then inheritance from the nearest ancestor directory.

Every line, paragraph and whole text is a unit. Units are compared with licence
notices as sparse TF-IDF vectors, with document frequencies counted over all
lines of the table. A unit without any of a template's weighty terms can't reach
the threshold, so most lines end at one set test, without loss.

A file whose text names no licence takes that of the licence file in its own
directory, or else in the nearest directory above: directories are joined with
their ancestors' licences, and files with their directory.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import written

TERM = re.compile(r"[^\W_]+(?:[.-][0-9]+)*")
LICENCE_FILE = r"(?i)^(licen[sc]e|copying|unlicen[sc]e|notice)([._-].*)?$"

SENTENCE = re.compile(r"(?<=[.;])\s+")
# Most consecutive paragraphs that are compared as one unit.
MOST_PARAGRAPHS = 8

# Parts of full texts and standard headers.
BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution. "
)
BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission. "
)
BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE "
    "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS "
    "OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, "
    "OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
GNU = (
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free "
    "Software Foundation; either version {} of the License, or (at your option) any later version."
)

# Notices by licence.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Apache License Version 2.0, January 2004",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2",
        GNU.format("", "2"),
        "SPDX-License-Identifier: GPL-2.0",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
        GNU.format("", "3"),
        "SPDX-License-Identifier: GPL-3.0",
    ),
    "LGPL-3.0": (
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        GNU.format("Lesser ", "3"),
        "SPDX-License-Identifier: LGPL-3.0",
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        GNU.format("Affero ", "3"),
        "SPDX-License-Identifier: AGPL-3.0",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met; neither the name of the copyright holder nor the names of its contributors may be used to endorse",
        BSD_START + BSD_THIRD + BSD_END,
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "BSD-2-Clause": (
        "Released under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        BSD_START + BSD_END,
        "SPDX-License-Identifier: BSD-2-Clause",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "SPDX-License-Identifier: ISC",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0.", "CC0 1.0 Universal"),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "EPL-2.0": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "SPDX-License-Identifier: EPL-2.0"),
    "Proprietary": ("All rights reserved.", "Confidential and proprietary. Unauthorized copying of this file is strictly prohibited."),
}


def terms_of(text: str) -> list[str]:
    return TERM.findall(text.lower())


def vocabulary(templates: dict[str, tuple[str, ...]]) -> frozenset[str]:
    return frozenset(t for notices in templates.values() for notice in notices for t in terms_of(notice))


class Matcher:
    """Compares units with templates; document frequencies are given for the templates' terms."""

    def __init__(self, templates: dict[str, tuple[str, ...]], lines: int, frequencies: dict[str, int], threshold: float):
        self.threshold = threshold
        self.idf = {t: math.log((1 + lines) / (1 + frequencies.get(t, 0))) + 1 for t in vocabulary(templates)}
        # A term that no template has weighs as one that no line has.
        self.unknown = math.log(1 + lines) + 1
        self.templates = [(name, self._unit(self.vector(terms_of(notice)))) for name, notices in templates.items() for notice in notices]
        # How much a template says: its length as a vector.
        self.norms = [math.sqrt(sum(w * w for w in self.vector(terms_of(notice)).values())) for notices in templates.values() for notice in notices]
        strong: set[str] = set()
        for _, vector in self.templates:
            weak = 0.0
            for term in sorted(vector, key=lambda t: (vector[t], t)):
                weak += vector[term] ** 2
                if weak >= threshold**2:
                    strong.add(term)
        self.strong = frozenset(strong)
        self.by_term: dict[str, list[tuple[int, float]]] = {}
        for k, (_, vector) in enumerate(self.templates):
            for term, weight in vector.items():
                self.by_term.setdefault(term, []).append((k, weight))

    def vector(self, terms: Iterable[str]) -> dict[str, float]:
        return {t: (1 + math.log(n)) * self.idf.get(t, self.unknown) for t, n in Counter(terms).items()}

    @staticmethod
    def _unit(vector: dict[str, float]) -> dict[str, float]:
        size = math.sqrt(sum(w * w for w in vector.values()))
        return {t: w / size for t, w in vector.items()}

    def closest(self, terms: list[str]) -> tuple[float, str, float] | None:
        """(cosine, licence, norm) of the closest template that reaches the threshold; ties go to the first name."""
        if self.strong.isdisjoint(terms):
            return None
        vector = self.vector(terms)
        size = math.sqrt(sum(w * w for w in vector.values()))
        sums: dict[int, float] = {}
        for term, weight in vector.items():
            for k, own in self.by_term.get(term, ()):
                sums[k] = sums.get(k, 0.0) + weight * own
        ranked = min(((-round(s / size, 9), self.templates[k][0], self.norms[k]) for k, s in sums.items() if s / size >= self.threshold), default=None)
        return ranked and (-ranked[0], ranked[1], ranked[2])

    def best(self, terms: list[str]) -> tuple[float, str] | None:
        """(cosine, licence) of the closest template that reaches the threshold; ties go to the first name."""
        found = self.closest(terms)
        return found and found[:2]

    def licence(self, text: str) -> tuple[float, str] | None:
        """The match that says most among the text's lines, sentences, paragraphs, runs of paragraphs, and the whole of it.

        Of one unit the closest template counts; of several units the one whose template holds most,
        so that a full text goes before a sentence which other licences share.
        """
        found: list[tuple[float, str, float] | None] = []
        paragraphs: list[list[str]] = []
        marked: list[int] = []
        lines: list[str] = []

        def close() -> None:
            nonlocal lines
            if not lines:
                return
            own = [terms_of(line) for line in lines]
            paragraph = [t for terms in own for t in terms]
            if not self.strong.isdisjoint(paragraph):
                marked.append(len(paragraphs))
                found.extend(map(self.closest, own))
                found.append(self.closest(paragraph))
                found.extend(self.closest(terms_of(sentence)) for sentence in SENTENCE.split(" ".join(lines)))
            paragraphs.append(paragraph)
            lines = []

        for line in text.split("\n"):
            if TERM.search(line):
                lines.append(line)
            else:
                close()
        close()
        if len(paragraphs) > 1 and marked:
            found.append(self.closest([t for p in paragraphs for t in p]))
        if any(found):
            # Runs begin and end with a paragraph that has a strong term.
            ends = set(marked)
            for k in marked:
                run = list(paragraphs[k])
                for j in range(k + 1, min(len(paragraphs), k + MOST_PARAGRAPHS)):
                    run += paragraphs[j]
                    if j in ends:
                        found.append(self.closest(run))
        hits = [f for f in found if f]
        return min(hits, key=lambda f: (-f[0] * f[2], f[1]))[:2] if hits else None


def frequencies(texts: DataFrame, terms: frozenset[str]) -> tuple[int, dict[str, int]]:
    """(lines, lines with each of the terms) over all rows of a one-column frame; as many numbers as terms come back."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter[str] = Counter()
        lines = 0
        for batch in batches:
            for text in batch.column(0):
                for line in (text.as_py() or "").split("\n"):
                    if own := terms_of(line):
                        lines += 1
                        totals.update(terms.intersection(own))
        names = ["", *totals]
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([lines, *totals.values()], pa.int64())], names=["term", "n"])

    rows = texts.mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = {r["term"]: r["n"] for r in rows}
    return counts.pop("", 0), counts


def parent(path: Column) -> Column:
    """Directory of a path without leading or doubled slashes; empty for the top."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


class LicenceScan:
    """Licences of files by text and by directory.

    `scan` gives one row per input row: doc_id, path, licence, score and origin
    ('text', 'directory' or null). Null and empty texts name no licence; a row
    without a path neither gives nor inherits one. Of several licence files in a
    directory the best match counts, then the first name. Repeated rows fare
    alike. Other columns are not read.
    """

    def __init__(self, templates: dict[str, tuple[str, ...]] | None = None, threshold: float = 0.75):
        self.templates, self.threshold = templates or TEMPLATES, threshold

    def matched(self, df: DataFrame, id_column: str, path_column: str, text_column: str) -> DataFrame:
        """doc_id, path, and the licence and score of each row's own text."""
        templates, threshold = self.templates, self.threshold
        text = F.col(f"`{text_column}`").cast("string")
        lines, counts = frequencies(df.select(text), vocabulary(templates))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(templates, lines, counts, threshold)
            for batch in batches:
                hits = [matcher.licence(t.as_py() or "") for t in batch.column(2)]
                found = [pa.array([h and h[1] for h in hits], pa.string()), pa.array([h and h[0] for h in hits], pa.float64())]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *found], names=["doc_id", "path", "licence", "score"])

        clean = F.regexp_replace(F.regexp_replace(F.col(f"`{path_column}`").cast("string"), "/+", "/"), "^/|/$", "")
        plain = df.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), clean.alias("path"), text.alias("text"))
        return plain.mapInArrow(run, "doc_id long, path string, licence string, score double")

    def scan(self, df: DataFrame, id_column: str = "doc_id", path_column: str = "path", text_column: str = "text") -> DataFrame:
        own = written(self.matched(df, id_column, path_column, text_column).withColumn("folder", parent(F.col("path"))), "licences")
        name = F.regexp_extract("path", r"([^/]*)$", 1)
        given = (
            own.where(F.col("licence").isNotNull() & name.rlike(LICENCE_FILE)).groupBy("folder")
            .agg(F.min(F.struct(-F.col("score"), "licence")).alias("best")).select(F.col("folder").alias("above"), F.col("best.licence").alias("given"))
        )
        needy = own.where(F.col("licence").isNull() & F.col("path").isNotNull()).select("folder").distinct()
        depth = F.size(F.split("folder", "/"))
        ancestors = needy.select("folder", F.explode(F.sequence(F.lit(0), depth)).alias("depth")).withColumn("above", F.expr("substring_index(folder, '/', depth)"))
        nearest = ancestors.join(given, "above").groupBy("folder").agg(F.max(F.struct("depth", "given")).alias("n")).select("folder", F.col("n.given").alias("inherited"))
        joined = own.join(nearest, "folder", "left")
        origin = F.when(F.col("licence").isNotNull(), "text").when(F.col("inherited").isNotNull(), "directory")
        return joined.select("doc_id", "path", F.coalesce("licence", "inherited").alias("licence"), "score", origin.alias("origin"))
