import math
import re
import textwrap
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.llm import licences as lic

MIT, APACHE, GPL = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3."
FILES = [
    ("src/a/LICENSE", APACHE, APACHE), ("src/a/x.py", "plain code\nno notice", None), ("src/a/deep/er/y.py", "code " * 200, None), ("src/a/deep/z.py", "prose\n" + MIT + "\n" + "word " * 100, "MIT"),
    ("src/b/notice.txt", "Copyright 2020 A. Author\n" + GPL, "GPL-3.0"), ("src/b/c/n.py", "", None), ("top.py", None, None), ("other/q.py", "we need a license to sell this thing here today", None),
    ("src/a/deep/er/COPYING", "Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"), ("src/ab/x.py", "x", None), (None, MIT, "MIT"), (None, "x", None), ("src/b/c/n.py", "", None), ("weird//p.py", "x", None), ("m/long.txt", "filler " * 50_000 + "\n" + GPL + "\nmore", "GPL-3.0"),
]


@pytest.fixture(scope="module")
def files(spark):
    rows = [(k, p, t) for k, (p, t, _) in enumerate(FILES)]
    return spark.createDataFrame(rows, "doc_id long, file string, text string").withColumn("licence", F.lit("x")).withColumn("own_score", F.lit("x"))


def brute():
    n = len(FILES)
    df = Counter(w for _, t, _ in FILES for w in set(lic.words(t or "")))
    matcher = lic.Matcher({w: math.log((n + 1) / (df[w] + 1)) + 1 for w in lic.template_words()})
    own, named = [], {}
    for p, t, _ in FILES:
        is_file = bool(p) and p.rsplit("/", 1)[-1].upper().startswith(("LICENSE", "LICENCE", "COPYING"))
        name, score = matcher.file(t, is_file)
        own.append((name, score))
        if p is not None and name and (is_file or len(lic.words(t)) <= lic.FILE_WORDS):
            d = p.rsplit("/", 1)[0] if "/" in p else ""
            d = d.rstrip("/") if d.endswith("/") else d
            named[d] = min(named.get(d, (0, "~", "")), (-score, p, name))
    out = []
    for (p, _, _), (name, _) in zip(FILES, own, strict=True):
        if name or p is None:
            out.append((name, name, "own" if name else None))
            continue
        d = lic_dir(p)
        while d not in named and d:
            d = d.rsplit("/", 1)[0] if "/" in d else ""
        out.append((None, named[d][2] if d in named else None, d if d in named else None))
    return out


def lic_dir(p):
    d = p.rsplit("/", 1)[0] if "/" in p else ""
    return d[:-1] if d.endswith("/") else d


def test_scan(files):
    got = {r["doc_id"]: (r["own_licence"], r["licence"], r["licence_from"]) for r in lic.scan_licences(files, F.col("file")).collect()}
    assert [got[k] for k in range(len(FILES))] == brute()
    assert got[0][0] == "Apache-2.0" and got[3][0] == "MIT" and got[4][0] == got[14][0] == "GPL-3.0" and got[7][0] is None
    assert got[1][1:] == ("Apache-2.0", "src/a") and got[2][1:] == ("CC-BY-NC-4.0", "src/a/deep/er") and got[5][1:] == ("GPL-3.0", "src/b") and got[9][1] is None and got[6][1] is None
    assert lic.scan_licences(files.limit(0), F.col("file")).count() == 0


def test_cosine_is_one_for_a_template_and_falls_with_other_words():
    matcher = lic.Matcher({w: 1.0 + k % 3 for k, w in enumerate(lic.template_words())})
    scores = [matcher.best(GPL + " word" * k)[1] for k in (0, 2, 5, 20)]
    assert scores[0] == pytest.approx(1) and scores == sorted(scores, reverse=True)


def test_frequencies_cover_all_documents(files):
    n, counts = lic.document_frequencies(files)
    assert n == len(FILES) and counts["license"] == sum("license" in lic.words(t or "") for _, t, _ in FILES)


MIT_NOTICE = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
BSD_NOTICE = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
GPL_NOTICE = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""


@pytest.mark.parametrize("name, notice", [("MIT", MIT_NOTICE), ("BSD-2-Clause", BSD_NOTICE), ("BSD-3-Clause", BSD_NOTICE + BSD_THIRD), ("GPL-3.0", GPL_NOTICE)])
@pytest.mark.parametrize("mark", ["", "# ", " * "])
def test_hard_wrapped_notices(name, notice, mark):
    matcher = lic.Matcher({w: 1.0 + k % 3 for k, w in enumerate(lic.template_words())})
    text = "\n".join(mark + x for x in notice.split("\n")) + "\n\ncode " + "word " * 200
    assert matcher.file(text, False)[0] == name
    narrow = "\n".join(" ".join(notice.split()[k : k + 4]) for k in range(0, len(notice.split()), 4))
    assert matcher.file(narrow, False)[0] == name


def test_windows_need_the_names_of_their_template():
    matcher = lic.Matcher({w: 1.0 for w in lic.template_words()})
    for other in (GPL_NOTICE.replace("version 3", "version 2"), GPL_NOTICE.replace("GNU General", "GNU Lesser General")):
        assert matcher.windows(other)[0] == []


def wrapped(text, width=70, lead=""):
    return "\n".join(lead + x for x in textwrap.wrap(text, width))


@pytest.mark.parametrize("name, text", lic.WHOLE_TEXTS + lic.TITLES)
def test_licence_files_are_known_by_their_whole_text_or_beginning(name, text):
    """With a copyright line in front and, for the long licences, much text behind; elsewhere the same words decide nothing."""
    matcher = lic.Matcher({w: 1.0 + k % 3 for k, w in enumerate(lic.template_words())})
    rest = "" if (name, text) in lic.WHOLE_TEXTS else " Preamble. The following terms hold for all that stands here." * 300
    for lead in ("", "Copyright (c) 2020 Some Author\n\n" if not rest else "   "):
        assert matcher.file(lead + wrapped(text + rest), True)[0] == name
    assert matcher.file("prose " * 500 + "license", True)[0] is None


def test_scores_are_those_of_a_plain_cosine(spark):
    """TF-IDF and cosine by NumPy over one-line headers, whose only candidate is the line itself."""
    lines = ["Released under the MIT License.", "Released under some other license today", "Licensed under CC BY 4.0. and more words", "this software has a GNU license, version 3, so we say", "license", "no cue at all", "Released under the MIT License. Released under the MIT License."]
    got = {r["doc_id"]: r for r in lic.own_licences(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"), F.lit("a/b.txt")).withColumnRenamed("_key", "doc_id").collect()}
    split = lambda t: re.findall(r"[0-9a-z]+", t.lower())
    templates = [(n, split(t)) for n, t in lic.TEMPLATES]
    known = sorted({w for _, t in templates for w in t})
    idf = {w: math.log((len(lines) + 1) / (sum(w in split(x) for x in lines) + 1)) + 1 for w in known}
    mean = float(np.mean([idf[w] for w in known]))

    def cosine(a, b):
        every = sorted({*a, *b})
        x, y = (np.array([t.count(w) * idf.get(w, mean) for w in every]) for t in (a, b))
        return float(x @ y / np.sqrt((x @ x) * (y @ y)))

    for k, line in enumerate(lines):
        score, name = max((round(cosine(split(line), t), 9), n) for n, t in templates)
        cue = any(c in split(line) for c in lic.CUES)
        assert got[k]["own_score"] == (pytest.approx(score, abs=2e-6) if cue else 0.0) and got[k]["own_licence"] == (name if cue and score >= lic.THRESHOLD else None), line


def test_a_hot_directory_is_one_answer_for_all_its_files(spark):
    rows = [(k, f"hot/f{k}.py", "code") for k in range(500)] + [(900, "hot/LICENSE", MIT), (901, "LICENSE", GPL), (902, "x.py", None)]
    got = {r["doc_id"]: (r["licence"], r["licence_from"]) for r in lic.scan_licences(spark.createDataFrame(rows, "doc_id long, file string, text string"), F.col("file")).collect()}
    assert {got[k] for k in range(500)} == {("MIT", "hot")} and got[902] == ("GPL-3.0", "")


def test_repeated_rows_and_null_keys_are_each_answered(spark):
    rows = [(1, "a/LICENSE", MIT), (1, "a/LICENSE", MIT), (None, "a/x.py", "code"), (None, "a/x.py", "code")]
    got = sorted((str(r["doc_id"]), r["own_licence"], r["licence"]) for r in lic.scan_licences(spark.createDataFrame(rows, "doc_id long, file string, text string"), F.col("file")).collect())
    assert got == [("1", "MIT", "MIT")] * 2 + [("None", None, "MIT")] * 2
