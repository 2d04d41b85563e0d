"""License scans: sparse TF-IDF cosine to templates, then inheritance from the nearest ancestor directory.

A file's candidate headers are its lines that hold a cue word (licence, copyright, ...), each run of such lines joined
with the lines between two cues at most three lines apart, and the whole text of a licence file, which is also held against
whole texts of short licences, and its first words against the beginnings of long ones. So that line breaks do not
matter, a template of ``NOTICE_WORDS`` or more is also held against windows of words: each of its sentences is laid over the
text by every cue word they share, and the best windows together are its candidate, if they hold the names and numbers of
the template. Where it matches, a template that is only some of its sentences does not count. A candidate and a template are sparse
TF-IDF vectors; the file's licence is the template of the highest cosine, if that reaches ``threshold``. Document
frequencies of the template words are counted over all documents; a word of no template weighs as the mean of those.

A licence file stands for its directory: it is a file named LICENSE, LICENCE or COPYING, or one of at most
``FILE_WORDS`` words whose own licence is found. A file without a licence of its own takes that of the nearest ancestor
directory that has one. Directories, not files, are joined with their ancestors, so the work follows the number of
distinct paths, and files meet their directory's answer in one join that adaptive execution can split where a directory
is hot. A directory with several licence files has the one of the highest score, then of the first path.

Null texts have no licence of their own; null paths have no directory. Texts may be of any length. Of templates with one score
the last by name counts. Repeated rows are each answered, extra columns may have any name, and an empty table gives an empty
result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import cut, small_batches
from lexmill.llm.wordbytes import WORDS_ONLY

# The usual short notices of public licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met. Neither the name of the copyright holder nor the names of its contributors may be used"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0. Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0. Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0. Dedicated to the public domain under CC0 1.0 Universal."),
    ("ISC", "Released under the ISC License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
_MIT_REST = "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS'
_BSD_TWO = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_THREE = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
# Whole texts of short licences, as they stand in licence files.
WHOLE_TEXTS = (
    ("MIT", f"MIT License. Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, {_MIT_REST} {_AS_IS} OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("BSD-2-Clause", f"{_BSD_TWO} {_BSD_END}"),
    ("BSD-3-Clause", f"{_BSD_TWO} {_BSD_THREE} {_BSD_END}"),
    ("ISC", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("Unlicense", f'This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. {_AS_IS} BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
)
_VERBATIM = "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."
# How the texts of long licences begin.
TITLES = (
    ("GPL-3.0", f"GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. {_VERBATIM}"),
    ("GPL-2.0", f"GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc. {_VERBATIM}"),
    ("LGPL-3.0", f"GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. {_VERBATIM}"),
    ("AGPL-3.0", f"GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc. {_VERBATIM}"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions."),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions 1.1. Contributor means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software."),
)
CUES = frozenset("license licence licenses licences licensed licensing copyright copying copyleft permission redistribution unencumbered gnu cc0 spdx".split())
THRESHOLD = 0.75
FILE_WORDS = 60
JOIN_LINES = 3
NOTICE_WORDS = 12
# Words that name a licence: a window needs those of its template; of the kinds of one licence, it has no others.
NAMING = frozenset("apache mit gnu bsd mozilla cc cc0 isc".split())
KINDS = frozenset("lesser library affero".split())
RAW_CUES = frozenset(c.encode() for c in CUES)
SENTENCE = re.compile(r"\.\s+(?=[A-Z])")
WORD = re.compile(r"[0-9a-z\x80-\U0010ffff]+")
CUE = re.compile(r"(?<![0-9A-Za-z\x80-\U0010ffff])(?:" + "|".join(sorted(CUES, key=len, reverse=True)) + r")(?![0-9A-Za-z\x80-\U0010ffff])", re.IGNORECASE | re.ASCII)


def raw_words(text: str | None) -> list[bytes]:
    """The words of a text as bytes: quicker, where no more than their presence is asked for."""
    return (text or "").encode().translate(WORDS_ONLY).split()


def words(text: str) -> list[str]:
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))


def template_words() -> list[str]:
    return sorted({w for _, t in TEMPLATES for w in words(t)})


class Matcher:
    """Templates as unit vectors under given inverse document frequencies."""

    def __init__(self, idf: dict[str, float], threshold: float = THRESHOLD):
        self.idf, self.threshold = idf, threshold
        self.other = sum(idf.values()) / len(idf)
        self.templates = [(name, self.vector(words(t))) for name, t in TEMPLATES]
        self.wholes = [(name, self.vector(words(t))) for name, t in WHOLE_TEXTS]
        self.titles = [(name, self.vector(words(t)), len(words(t))) for name, t in TITLES]
        self.notices = []
        for (name, t), (_, vector) in zip(TEMPLATES, self.templates, strict=True):
            parts = [words(p) for p in SENTENCE.split(t)]
            tokens = [w for p in parts for w in p]
            if len(tokens) >= NOTICE_WORDS and all(CUES.intersection(p) for p in parts):
                laid = [(len(p), [(w, k) for k, w in enumerate(p) if w in CUES], self.vector(p)) for p in parts]
                needed = {w for w in tokens if w in NAMING or w in KINDS or w.isdigit()}
                self.notices.append((name, vector, needed, laid, {tuple(p) for p in parts}))

    def vector(self, tokens: list[str]) -> dict[str, float]:
        v = {w: n * self.idf.get(w, self.other) for w, n in Counter(tokens).items()}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {w: x / norm for w, x in v.items()}

    def best(self, text: str) -> tuple[str | None, float]:
        own = self.vector(words(text))
        return self._best([(self.cosine(t, own), n) for n, t in self.templates])

    def of_file(self, text: str) -> tuple[str | None, float]:
        """Licence whose whole text the file is, or with whose first words it begins."""
        tokens = words(text)
        own = self.vector(tokens)
        return self._best([*[(self.cosine(t, own), n) for n, t in self.wholes], *[(self.cosine(t, self.vector(tokens[:size])), n) for n, t, size in self.titles]])

    def _best(self, scores: list[tuple[float, str]]) -> tuple[str | None, float]:
        score, name = max(scores, key=lambda p: (round(p[0], 9), p[1]))
        return (name, round(score, 6)) if score >= self.threshold else (None, round(score, 6))

    @staticmethod
    def cosine(left: dict[str, float], right: dict[str, float]) -> float:
        return sum(x * right.get(w, 0.0) for w, x in left.items())

    def windows(self, text: str) -> tuple[list[tuple[str, float]], set[str]]:
        """Licences whose notices occur in the text, however its lines are broken, and those that are only a part of them."""
        tokens = words(text)
        have, cues = set(tokens), {}
        for q, w in enumerate(tokens):
            if w in CUES:
                cues.setdefault(w, []).append(q)
        found = []
        for name, vector, needed, laid, parts in self.notices:
            if not needed <= have:
                continue
            header: list[str] = []
            for size, at, part in laid:
                starts = sorted({max(q - k, 0) for w, k in at for q in cues.get(w, ())})
                score, a = max(((self.cosine(part, self.vector(tokens[a : a + size])), -a) for a in starts), default=(0.0, 0))
                if score < self.threshold:
                    break
                header += tokens[-a : size - a]
            else:
                own = set(header)
                score = round(self.cosine(vector, self.vector(header)), 6)
                if score >= self.threshold and needed <= own and own & KINDS == needed & KINDS:
                    found.append((name, score, parts))
        inner = {n for n, _, p in found for m, _, o in found if n != m and p < o}
        return [(n, s) for n, s, _ in found if n not in inner], inner

    def file(self, text: str | None, licence_file: bool) -> tuple[str | None, float]:
        """Licence and score of a whole text: its best candidate header."""
        if not text or not (licence_file or not RAW_CUES.isdisjoint(raw_words(text))):
            return None, 0.0
        lines = text.split("\n")
        at = [i for i, x in enumerate(lines) if CUE.search(x)]
        spans, run = {(i, i) for i in at}, None
        for i in at:
            run = (run[0], i) if run and i - run[1] <= JOIN_LINES else (i, i)
            spans.add(run)
        found = [self.best("\n".join(lines[a : b + 1])) for a, b in sorted(spans)]
        if licence_file:
            found += [self.best(text), self.of_file(text)]
        whole, inner = self.windows(text)
        found = [f for f in found if f[0] not in inner] + whole
        return max(found, key=lambda f: (f[0] is not None, f[1], f[0] or ""))


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[int, dict[str, int]]:
    """Number of documents, and of those with each template word, over all documents. The words are few and fixed."""
    wanted = frozenset(w.encode() for w in template_words())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = 0, Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                total += 1
                seen.update(wanted.intersection(raw_words(t)))
        yield pa.RecordBatch.from_arrays([pa.array(["", *[w.decode() for w in seen]]), pa.array([total, *seen.values()], pa.int64())], ["word", "n"])

    rows = small_batches(docs).select(F.col(text).cast("string").alias("_text")).mapInArrow(scan, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = {r["word"]: r["n"] for r in rows}
    return counts.pop("", 0), counts


def inverse_frequencies(n: int, counts: dict[str, int]) -> dict[str, float]:
    return {w: math.log((n + 1) / (counts.get(w, 0) + 1)) + 1 for w in template_words()}


def own_licences(docs: DataFrame, path: Column, *, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: _key, path, own_licence, own_score, licence_file."""
    held = Matcher(inverse_frequencies(*document_frequencies(docs, text)), threshold)
    kind = docs.schema[key].dataType.simpleString()
    named = re.compile(r"(?:^|/)(?:LICEN[CS]E|COPYING)[^/]*$", re.IGNORECASE)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, files = [], [], []
            for p, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                is_file = bool(p and named.search(p))
                name, score = held.file(t, is_file)
                short = name is not None and len(words(t)) <= FILE_WORDS
                names.append(name)
                scores.append(score)
                files.append(name is not None and (is_file or short))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(files, pa.bool_())], ["_key", "path", "own_licence", "own_score", "licence_file"])

    rows = docs.select(F.col(key).alias("_key"), path.cast("string").alias("path"), F.col(text).cast("string").alias("_text"))
    return rows.mapInArrow(scan, f"_key {kind}, path string, own_licence string, own_score double, licence_file boolean")


def directory_of(path: Column) -> Column:
    """The path up to its last slash, without it; empty at the top."""
    return F.regexp_replace(path, r"(?s)/?[^/]*$", "")


def ancestors_of(directory: Column) -> Column:
    """The directory itself and those above it, up to the top (empty)."""
    parts = F.split(directory, "/")
    here = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    return F.array_distinct(F.concat(F.array(F.lit("")), here))


def inherit(files: DataFrame) -> DataFrame:
    """Adds licence, licence_from (own, a directory, or null). ``files``: path, own_licence, own_score, licence_file."""
    files = files.withColumn("_dir", directory_of(F.col("path")))
    named = files.where("licence_file and _dir is not null").groupBy("_dir").agg(F.min(F.struct((-F.col("own_score")).alias("s"), "path", "own_licence")).alias("m")).select(F.col("_dir").alias("_up"), F.col("m.own_licence").alias("_licence"))
    directories = files.where("_dir is not null").groupBy("_dir").agg(F.count("*").alias("_n")).select("_dir", F.explode(ancestors_of(F.col("_dir"))).alias("_up"))
    nearest = directories.join(named, "_up").groupBy("_dir").agg(F.max(F.struct(F.length("_up").alias("n"), F.col("_up").alias("up"), F.col("_licence").alias("licence"))).alias("a"))
    # The second key keeps the join from reusing the aggregation's partitions, so adaptive execution may split a hot directory.
    joined = files.withColumn("_k", F.xxhash64("_dir")).join(nearest.withColumn("_k", F.xxhash64("_dir")), ["_dir", "_k"], "left").drop("_k")
    return joined.withColumn("licence", F.coalesce("own_licence", "a.licence")).withColumn("licence_from", F.when(F.col("own_licence").isNotNull(), F.lit("own")).otherwise(F.col("a.up"))).drop("a", "_dir")


def scan_licences(docs: DataFrame, path: Column, *, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: key, path, own_licence, own_score, licence_file, licence, licence_from."""
    files = cut(own_licences(docs, path, key=key, text=text, threshold=threshold))
    return inherit(files).select(F.col("_key").alias(key), "path", "own_licence", "own_score", "licence_file", "licence", "licence_from")
