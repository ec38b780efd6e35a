"""License scan: TF-IDF cosine to templates, then inheritance from the nearest directory.

1. Passages of a text are its lines (of a line of more than 2 WINDOW words,
   overlapping windows of that many words) and, for each template, every run of
   as many words of the text as the template has, so that line breaks and other
   words around a notice do not matter. Templates are notices of file headers,
   headings of license texts and their characteristic sentences. A passage is
   compared with the template by the cosine of their TF-IDF vectors over words.
   The document frequencies of the templates' words are counted over all files;
   any other word weighs like the median of those. Only passages that a bound
   proves to be below THRESHOLD are not compared. A passage must hold the version
   of the template's license, if that has one, and no negation that the template
   has not, neither inside nor up to BEFORE words ahead in the same sentence.
2. The best template of THRESHOLD or more is the file's own license. A file is a
   licence file if its name says so or if licence passages make up FILE_SHARE
   of its words; its license holds for its directory.
3. A file without a license of its own gets that of the nearest directory above
   it that has one: distinct directories are joined with their ancestors, the
   deepest match is kept, and files are joined with their directory.

Null and empty texts have no license of their own but inherit. A file without a
path has no directory and cannot inherit. Of equal cosines the first passage, and of those
that begin with one word the first template counts; very long texts are read whole. If several licence files share a directory the one with the highest
cosine, then the smallest license name. Repeated rows are treated alike. Other
columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import log, sqrt
from statistics import median

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship_package, stored

THRESHOLD = 0.6
FILE_SHARE = 0.5
WINDOW = 40  # words
SLACK = 1e-9  # of a cosine, for sums in floating point
WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)?")
SENTENCE_END = re.compile(r"[.;!?](?=\s)|\n\s*\n")
NEGATIONS = frozenset({"not", "never"})
BEFORE = 4  # words
FILE_NAME = r"(?i)^(licen[cs]e|copying|notice)([.-].*)?$"

# Customary notices of public licenses, as they stand in file headers.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-or-later"),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    # Headings of the license texts.
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    # Sentences of the license texts.
    ("MIT", "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                     "products derived from this software without specific prior written permission."),
    ("Proprietary", "All rights reserved. Unauthorized copying of this file is strictly prohibited."),
)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def versions_of(name: str) -> frozenset[str]:
    """How the version at the end of a license's name is written; empty if it has none."""
    found = re.search(r"-(\d+)\.(\d+)$", name)
    if not found:
        return frozenset()
    written = [".".join(found.groups()), *([found[1]] if found[2] == "0" else [])]
    return frozenset(p + w for w in written for p in ("", "v"))


VOCABULARY = sorted({w for _, t in TEMPLATES for w in words_of(t)})
NUMBER = {w: i for i, w in enumerate(VOCABULARY)}
LENGTHS = [len(words_of(t)) for _, t in TEMPLATES]
VERSIONS = [versions_of(name) for name, _ in TEMPLATES]
DENIALS = [NEGATIONS - set(words_of(t)) for _, t in TEMPLATES]


class Matcher:
    """Templates as unit vectors for given document frequencies."""

    def __init__(self, df: dict[str, int], n_files: int):
        self.idf = {w: log((n_files + 1) / (df.get(w, 0) + 1)) + 1 for w in VOCABULARY}
        self.other = median(self.idf.values())
        self.vectors = []
        for name, text in TEMPLATES:
            vector = {w: n * self.idf[w] for w, n in Counter(words_of(text)).items()}
            norm = sqrt(sum(x * x for x in vector.values()))
            self.vectors.append((name, {w: x / norm for w, x in vector.items()}))
        # Per template and word of the vocabulary, then per other word: the unit vector.
        self.units = np.array([[v.get(w, 0.0) for w in VOCABULARY] + [0.0] for _, v in self.vectors])
        self.weights = np.array([self.idf[w] for w in VOCABULARY] + [self.other])

    def _weighted(self, passage: list[str]) -> tuple[dict[str, float], float]:
        """TF-IDF vector of a passage, and its length."""
        weights = {w: n * self.idf.get(w, self.other) for w, n in Counter(passage).items()}
        return weights, sqrt(sum(x * x for x in weights.values()))

    def best(self, passage: list[str]) -> tuple[float, str | None]:
        """Cosine and license of the nearest template."""
        weights, norm = self._weighted(passage)
        top: tuple[float, str | None] = (0.0, None)
        for name, vector in self.vectors:
            cosine = sum(x * weights[w] for w, x in vector.items() if w in weights) / norm if norm else 0.0
            if cosine > top[0] + 1e-12:
                top = cosine, name
        return top

    def possible(self, words: list[str]) -> np.ndarray:
        """Templates that some passage of these words can reach.

        The cosine is at most the length of the template's unit vector over the
        words that both have (Cauchy-Schwarz).
        """
        present = [NUMBER[w] for w in NUMBER.keys() & set(words)]
        return np.flatnonzero((self.units[:, present] ** 2).sum(axis=1) >= (THRESHOLD - SLACK) ** 2)

    def passages(self, words: list[str], template: int, lines: np.ndarray | None = None,
                 sentences: np.ndarray | None = None) -> Iterator[tuple[int, int, float]]:
        """start, end and cosine of the passages that are notices of a template.

        ``lines`` has the first word of each line and the number of words, ``sentences``
        the first words of the sentences; without them all words are one line or sentence.
        """
        n, size = len(words), LENGTHS[template]
        number = np.fromiter((NUMBER.get(w, len(VOCABULARY)) for w in words), np.int64, n)
        weights = self.weights[number]
        products = np.concatenate([[0.0], np.cumsum(self.units[template][number] * weights)])
        squares = np.concatenate([[0.0], np.cumsum(weights**2)])
        start = np.arange(n - size + 1 if n >= size else 0)
        starts, ends = [start], [start + size]
        edges = np.array([0, n]) if lines is None else lines
        long = np.diff(edges) > 2 * WINDOW
        starts.append(edges[:-1][~long])
        ends.append(edges[1:][~long])
        for a, b in zip(edges[:-1][long], edges[1:][long]):
            parts = np.arange(a, b - WINDOW // 2, WINDOW // 2)
            starts.append(parts)
            ends.append(np.minimum(parts + WINDOW, b))
        spans = np.unique(np.stack([np.concatenate(starts), np.concatenate(ends)]), axis=1)
        start, end = spans[:, spans[0] < spans[1]]
        # Repeated words only lengthen the passage's vector.
        bound = (products[end] - products[start]) / np.sqrt(squares[end] - squares[start])
        first = np.array([0]) if sentences is None else sentences
        vector, versions, denials = self.vectors[template][1], VERSIONS[template], DENIALS[template]
        for k in np.flatnonzero(bound >= THRESHOLD - SLACK):
            a, b = int(start[k]), int(end[k])
            own, norm = self._weighted(words[a:b])
            if versions and versions.isdisjoint(own):
                continue
            cosine = sum(x * own[w] for w, x in vector.items() if w in own) / norm
            if cosine >= THRESHOLD:
                since = max(a - BEFORE, int(first[np.searchsorted(first, a, "right") - 1]))
                if denials.isdisjoint(own) and denials.isdisjoint(words[since:a]):
                    yield a, b, cosine

    def scan(self, text: str) -> tuple[str | None, float, float]:
        """License, cosine, and the share of the words in licence passages."""
        words = words_of(text)
        possible = self.possible(words)
        if not len(possible):
            return None, 0.0, 0.0
        lines = np.cumsum([0, *(len(words_of(line)) for line in text.split("\n"))])
        sentences = np.cumsum([0, *(len(words_of(part)) for part in SENTENCE_END.split(text))])[:-1]
        covered = np.zeros(len(words), bool)
        best = []
        for template in possible:
            for a, b, cosine in self.passages(words, template, lines, sentences):
                covered[a:b] = True
                # Cosines that differ by rounding are equal.
                best.append((-round(cosine, 9), a, int(template)))
        if not best:
            return None, 0.0, 0.0
        top = min(best)
        return self.vectors[top[2]][0], round(-top[0], 6), float(covered.mean())


def document_frequencies(files: DataFrame) -> tuple[dict[str, int], int]:
    """Files that hold each word of the vocabulary, and the number of files."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, known = Counter(), set(VOCABULARY)
        for pdf in batches:
            counts[""] += len(pdf)
            for text in pdf["text"]:
                counts.update(known.intersection(words_of(text)))
        if counts[""]:
            yield pd.DataFrame({"word": list(counts), "n": list(counts.values())})

    rows = files.select("text").mapInPandas(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    df = {r["word"]: r["n"] for r in rows}  # one row per word of the templates
    return df, df.pop("", 0)


def _directory(path: Column) -> Column:
    """Everything before the last slash; the top directory is the empty string."""
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.when(path.isNotNull(), F.lit("")))


def scan(files: DataFrame) -> DataFrame:
    """doc_id, path, license, similarity, origin (own, inherited, none) and the directory it comes from.

    ``files`` has the columns doc_id, path and text.
    """
    ship_package(files.sparkSession)
    texts = files.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("path").cast("string").alias("path"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    matcher = files.sparkSession.sparkContext.broadcast(Matcher(*document_frequencies(texts)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in filter(len, batches):
            found = [matcher.value.scan(t) for t in pdf["text"]]
            license_, similarity, share = ([f[i] for f in found] for i in range(3))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "path": pdf["path"], "license": license_, "similarity": similarity, "share": share})

    own = stored(
        texts.mapInPandas(run, "doc_id long, path string, license string, similarity double, share double")
        .withColumn("dir", _directory(F.col("path"))), "licenses")
    name = F.regexp_extract("path", "[^/]*$", 0)
    held = (
        own.filter(F.col("license").isNotNull() & F.col("dir").isNotNull() & (name.rlike(FILE_NAME) | (F.col("share") >= FILE_SHARE)))
        .groupBy(F.col("dir").alias("above"))
        .agg(F.min(F.struct((-F.col("similarity")).alias("rank"), "license")).alias("best"))
        .select("above", F.col("best.license").alias("held"))
    )
    # Directories with all their ancestors; one row per directory and level, whatever the number of files.
    levels = own.select("dir").dropna().distinct().withColumn("parts", F.split("dir", "/"))
    ancestors = levels.select("dir", F.explode(F.concat(
        F.array(F.struct(F.lit(0).alias("depth"), F.lit("").alias("above"))),
        F.when(F.col("dir") != "", F.transform(
            F.sequence(F.lit(1), F.size("parts")),
            lambda i: F.struct(i.alias("depth"), F.array_join(F.slice("parts", 1, i), "/").alias("above")),
        )).otherwise(F.array().cast("array<struct<depth:int,above:string>>")))).alias("a")).select("dir", "a.*")
    nearest = stored(
        ancestors.join(held, "above").groupBy("dir").agg(F.max(F.struct("depth", "above", "held")).alias("a"))
        .select("dir", "a.above", "a.held"), "directories")
    inherits = F.col("license").isNull() & F.col("held").isNotNull()
    return own.join(nearest, "dir", "left").select(
        "doc_id", "path", F.coalesce("license", "held").alias("license"), "similarity",
        F.when(F.col("license").isNotNull(), "own").when(inherits, "inherited").otherwise("none").alias("origin"),
        F.when(inherits, F.col("above")).alias("inherited_from"))
