import re
import unicodedata

import pytest
from pyspark.sql import functions as F
from samples import NOISY

from lexmill.functions import text as tx
from lexmill.operators import clean


def run(spark, column, *texts):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    return [r[0] for r in rows.orderBy("k").select(column(F.col("t"))).collect()]


def test_controls_and_line_ends(spark):
    assert run(spark, lambda c: clean.unify_newlines(clean.strip_controls(c)), "a\0b\x0bc\r\nd\re\tf\x0cg\x7f", None) == ["abc\nd\ne\tfg", None]


def test_special_characters(spark):
    got = run(spark, clean.fold_special, "ﬁnd ﬂow oﬀ eﬃ baﬄe ‘q’ “r” – — … a b­c​‌‍﻿d")
    assert got == ["find flow off effi baffle 'q' \"r\" - - ... a bcd"]


def test_composition(spark):
    texts = ["café", "plain", "déjà", None, "가", "à́"]
    assert run(spark, tx.nfc, *texts) == [unicodedata.normalize("NFC", t) if t else t for t in texts]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("Page 9", "Page 9"),
        ("x Page 9 of 12 the end", "x   the end"),
        ("on page 12 the day", "on  the day"),
        ("a\n\n 42 \n\nb", "a\n \nb"),
        ("a\n12345\nb", "a\n12345\nb"),
        ("see Indian Kanoon - https://x.org/1 now", "see   now"),
        ("NON-REPORTABLE", " "),
        ("a\nhttp://x.org/y\nb", "a\n \nb"),
    ],
)
def test_boilerplate(spark, raw, want):
    assert run(spark, clean.strip_boilerplate, raw) == [want]


def test_hyphens_punctuation_space(spark):
    assert run(spark, clean.join_hyphens, "appli-\ncation stay- \ning é-\nà") == ["application stay- \ning éà"]
    assert run(spark, clean.collapse_punctuation, "a..... b--- c____ d***** e...") == ["a... b-- c__ d*** e..."]
    assert run(spark, clean.normalise_space, "  a \t b  \n  c\n\n\n\nd 　") == ["a b\nc\n\nd"]


def test_noise_goes_and_the_number_stays(spark):
    got = run(spark, clean.clean_text, NOISY)[0]
    assert "Kanoon" not in got and "Page 1" not in got and "JURISDICTION" not in got and "Criminal Appeal No. 5 of 2011" in got and "Page 3" not in got and "18" not in got and "example.org" not in got


def test_counts_and_empty_flag(spark):
    texts = ["one two three", "", None, "word " * 50, "word " * 49]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, raw_text string")
    got = [(r["word_count"], r["char_count"], r["is_empty"]) for r in clean.clean(rows).orderBy("k").collect()]
    assert got == [(3, 13, True), (0, 0, True), (0, 0, True), (50, 249, False), (49, 244, True)]


def test_white_space_is_that_of_python(spark):
    texts = [chr(c) for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    got = run(spark, lambda c: c.rlike("^" + tx.rx(r"\s") + r"\z"), *texts)
    assert got == [t.isspace() for t in texts]
    assert [bool(re.fullmatch(r"\s", t)) for t in texts] == got


def test_title_case(spark):
    texts = ["A.K. SIKRI", "o'neil MC-donald", "é ÀB", "", None]
    assert run(spark, tx.title_case, *texts) == [t.title() if t is not None else None for t in texts]


def test_only_successful_documents_are_used(spark):
    rows = spark.createDataFrame([("a", True), ("", True), ("b", False)], "raw_text string, success boolean")
    assert [r["raw_text"] for r in clean.usable(rows).collect()] == ["a"]


def test_steps_that_look_first_give_what_the_patterns_give(spark):
    from functools import reduce

    import pyspark.sql.functions as F

    from lexmill.functions.text import WHITE_SPACE
    from lexmill.operators import clean

    pieces = ["a", " ", "  ", "\t", "\n", "\n\n\n", " \n", "\n ", "-\n", "....", "---", "___", "****", "..", " ", " \n", "\x1c\n", "\x0b", "Page 3 of 9 ", "é", "‘ﬁ…"]
    texts = [a + b + c for a in pieces for b in pieces for c in pieces] + [None, ""]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").repartition(4)
    t = F.col("t")
    spaced = reduce(lambda x, p: F.regexp_replace(x, *p), [(r"[ \t]+", " "), (clean.LINE_ENDS, ""), (r"\n{3,}", "\n\n")], t)
    plain = {
        "space": (clean.normalise_space(t), F.btrim(spaced, F.lit(WHITE_SPACE))),
        "hyphens": (clean.join_hyphens(t), F.regexp_replace(t, r"([\p{L}\p{Nd}_])-\n([\p{L}\p{Nd}_])", "$1$2")),
        "runs": (clean.collapse_punctuation(t), reduce(lambda x, r: F.regexp_replace(x, r[0], r[1]), clean.RUNS, t)),
        "boilerplate": (clean.strip_boilerplate(t), reduce(lambda x, p: F.regexp_replace(x, p, " "), clean.BOILERPLATE, t)),
    }
    wrong = rows.select(*[F.sum((~a.eqNullSafe(b)).cast("int")).alias(n) for n, (a, b) in plain.items()]).first()
    assert wrong.asDict() == dict.fromkeys(plain, 0)
