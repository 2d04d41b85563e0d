"""Cleaning of extracted text, as column functions, and the stage that applies them in order.

Order: control characters, line ends, canonical composition, special characters, boilerplate, hyphens at line ends,
runs of punctuation, white space. All but the composition are built-in functions.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.text import SPACE, WHITE_SPACE, ascii_only, at, changed, let, nfc, rx, strip, word_count

# Special characters and what they become.
SPECIAL = {
    "ﬁ": "fi", "ﬂ": "fl", "ﬀ": "ff", "ﬃ": "ffi", "ﬄ": "ffl",
    "‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "-", "…": "...",
    " ": " ", "­": "", "​": "", "‌": "", "‍": "", "﻿": "",
}

# Boilerplate of court-judgment files, each replaced by one space, in this order.
BOILERPLATE = (
    rx(r"\bPage\s+[0-9]+\s+(?:of\s+[0-9]+)?\b", "i"),
    rx(r"^\s*[0-9]{1,4}\s*$", "m"),
    rx(r"Indian\s+Kanoon\s*[-–]\s*https?://\S+", "i"),
    rx(r"^\s*https?://\S+\s*$", "m"),
    rx(r"^\s*(?:NON[\s-])?REPORTABLE\s*$", "im"),
    rx(r"IN\s+THE\s+SUPREME\s+COURT\s+OF\s+INDIA\s*\n(?:CIVIL|CRIMINAL|ORIGINAL|APPELLATE|WRIT)?\s*(?:APPELLATE\s+)?JURISDICTION", "i"),
)
# Runs of a mark from this length on become so many of it.
RUNS = ((r"\.{4,}", "..."), (r"-{3,}", "--"), (r"_{3,}", "__"), (r"\*{3,}", "***"))
EMPTY_BELOW = 50
_LINE_SPACE = SPACE.replace(r"\n", "")
LINE_ENDS = f"(?md)^{_LINE_SPACE}+|{_LINE_SPACE}+$"
# The same patterns for Spark, the first behind a look at its first character.
_BOILERPLATE = (at(BOILERPLATE[0], "P"), *BOILERPLATE[1:])
_RARE_SPACES = [s for s in WHITE_SPACE if ord(s) < 128 and s not in " \n"]
# The shortest run that changes, for each of RUNS.
_SHORTEST = ("....", "---", "___", "****")


# Control characters, line ends, and hyphens between two letters or digits at a line's end.
def strip_controls(c: Column) -> Column:
    return F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "")


def unify_newlines(c: Column) -> Column:
    return F.regexp_replace(c, r"\r\n?", "\n")


def fold_special(c: Column) -> Column:
    single = {a: b for a, b in SPECIAL.items() if len(b) < 2}
    gone = [a for a, b in single.items() if not b]
    kept = [a for a, b in single.items() if b]

    def folded(x: Column) -> Column:
        x = F.translate(x, "".join(kept + gone), "".join(single[a] for a in kept))
        return reduce(lambda y, a: F.replace(y, F.lit(a), F.lit(SPECIAL[a])), [a for a, b in SPECIAL.items() if len(b) > 1], x)

    return changed(c, lambda x: ~ascii_only(x), folded)


def strip_boilerplate(c: Column) -> Column:
    return reduce(lambda x, p: F.regexp_replace(x, p, " "), _BOILERPLATE, c)


def join_hyphens(c: Column) -> Column:
    return changed(c, lambda x: x.contains("-\n"), lambda x: F.regexp_replace(x, r"([\p{L}\p{Nd}_])-\n([\p{L}\p{Nd}_])", "$1$2"))


def collapse_punctuation(c: Column) -> Column:
    for (run, to), shortest in zip(RUNS, _SHORTEST, strict=True):
        c = changed(c, lambda x, s=shortest: x.contains(s), lambda x, r=run, t=to: F.regexp_replace(x, r, t))
    return c


def normalise_space(c: Column) -> Column:
    """Single spaces are most of the white space and stay as they are. Where no other white space is left, one space at most stands at the end of a line."""
    spaces_alone = lambda x: reduce(lambda a, s: a & ~x.contains(s), _RARE_SPACES, ascii_only(x))
    by_replacing = lambda x: F.replace(F.replace(x, F.lit(" \n"), F.lit("\n")), F.lit("\n "), F.lit("\n"))
    c = changed(c, lambda x: x.contains("  ") | x.contains("\t"), lambda x: F.regexp_replace(x, r"[ \t]{2,}|\t", " "))
    c = let(c, lambda x: F.when(spaces_alone(x), by_replacing(x)).otherwise(F.regexp_replace(x, LINE_ENDS, "")))
    return strip(changed(c, lambda x: x.contains("\n\n\n"), lambda x: F.regexp_replace(x, r"\n{3,}", "\n\n")))


_BEFORE = (strip_controls, unify_newlines)
_AFTER = (fold_special, strip_boilerplate, join_hyphens, collapse_punctuation, normalise_space)


def _all(steps: tuple[Callable[[Column], Column], ...], c: Column) -> Column:
    return reduce(lambda x, step: step(x), steps, c)


def clean_text(c: Column) -> Column:
    return _all(_AFTER, nfc(_all(_BEFORE, c)))


def usable(raw: DataFrame) -> DataFrame:
    """Documents whose extraction succeeded and gave any text."""
    return raw.where("success and raw_text <> ''")


def clean(docs: DataFrame, text: str = "raw_text") -> DataFrame:
    """Adds clean_text, word_count, char_count and is_empty (fewer than 50 words). A null text counts as empty."""
    # In steps, as composition names its input several times.
    cleaned = docs.withColumn("clean_text", _all(_BEFORE, F.coalesce(F.col(text), F.lit("")))).withColumn("clean_text", nfc(F.col("clean_text")))
    cleaned = cleaned.withColumn("clean_text", _all(_AFTER, F.col("clean_text")))
    return cleaned.withColumn("word_count", word_count(F.col("clean_text"))).withColumn("char_count", F.length("clean_text")).withColumn("is_empty", F.col("word_count") < EMPTY_BELOW)
