"""Column functions over text that Spark lacks or spells differently: Unicode white space, NFC, title case, distinct finds.

Patterns are written for both Java's and RE2's syntax, so that the same string runs in Spark and in SQL elsewhere.
``\\s`` in them stands for Unicode white space: ``rx`` spells it out.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters that count as white space in Python's str methods.
_SPACES = r"\t\n\x0b\f\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SPACE, NOT_SPACE = f"[{_SPACES}]", f"[^{_SPACES}]"


def rx(pattern: str, flags: str = "") -> str:
    """``pattern`` with Unicode white space. Flags: i, s, m; lines end at LF only."""
    out, inside, k = [], False, 0
    while k < len(pattern):
        c = pattern[k : k + 2] if pattern[k] == "\\" else pattern[k]
        if c == r"\s":
            out.append(_SPACES if inside else SPACE)
        elif c == r"\S":
            out.append(NOT_SPACE)
        else:
            inside = True if c == "[" else False if c == "]" else inside
            out.append(c)
        k += len(c)
    # Java ends lines at other characters too, unless told not to (d).
    return (f"(?{flags}{'d' if 'm' in flags else ''})" if flags else "") + "".join(out)


def at(pattern: str, first: str) -> str:
    """``pattern`` behind a look at the one character it begins with (``first``: all of them), which is all that most places of a text need.

    Without this, a word boundary or each of many branches is tried at every place.
    """
    flags = re.match(r"(?:\(\?[a-z]+\))?", pattern)[0]
    return f"{flags}(?=[{first}])(?:{pattern[len(flags):]})"


WHITE_SPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strip(c: Column) -> Column:
    """Without white space at both ends."""
    outer = lambda x, k: F.lit(WHITE_SPACE).contains(F.substring(x, k, 1))
    return changed(c, lambda x: outer(x, 1) | outer(x, -1), lambda x: F.btrim(x, F.lit(WHITE_SPACE)))


def squeeze(c: Column) -> Column:
    """Each run of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, rx(r"\s+"), " "))


def word_count(c: Column) -> Column:
    """Words are what stands between white space: one more than the single spaces that are left when it is squeezed."""
    spaces = lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))
    return let(squeeze(c), lambda x: F.when(x.isNotNull(), F.when(x == "", F.lit(0)).otherwise(spaces(x) + 1)))


def approx_tokens(words: Column) -> Column:
    """1.35 tokens a word, rounded down."""
    return F.floor(words * 135 / 100).cast("int")


def ascii_only(c: Column) -> Column:
    """Whether every character is one byte."""
    return F.octet_length(c) == F.length(c)


def changed(c: Column, there: Callable[[Column], Column], change: Callable[[Column], Column]) -> Column:
    """``change`` of ``c`` where ``there`` finds something to change; other values are passed on without a search by pattern."""
    return let(c, lambda x: F.when(there(x), change(x)).otherwise(x))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def find(c: Column, pattern: str, group: int = 0) -> Column:
    """First match (or a group of it, which must not be empty), null without one."""
    return let(F.regexp_extract(c, pattern, group), lambda x: F.when(x != "", x))


def find_distinct(c: Column, pattern: str | Column) -> Column:
    """All matches with white space squeezed, each spelling once regardless of case, as first seen."""
    found = F.transform(F.regexp_extract_all(c, F.lit(pattern), 0), squeeze)
    fresh = lambda acc, x: F.when(F.exists(acc, lambda y: F.upper(y) == F.upper(x)), acc).otherwise(F.array_append(acc, x))
    return F.aggregate(found, F.array().cast("array<string>"), fresh)


def title_case(c: Column) -> Column:
    """A letter after a letter in lower case, any other letter in upper case.

    ``initcap`` only looks at spaces, so one is put behind every other mark that a letter follows, after a byte that marks it.
    """
    apart = F.regexp_replace(c, r"([^\p{L} ])(?=\p{L})", "$1\u0000 ")
    return F.replace(F.initcap(apart), F.lit("\u0000 "), F.lit(""))


@F.pandas_udf(T.StringType())
def _composed(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


def nfc(c: Column) -> Column:
    """Canonical composition. Only texts beyond Latin-1 without combining marks cross to Python: all others are composed as they are."""
    decomposed = ~ascii_only(c) & c.rlike(r"[^\x00-\x{2ff}]")
    return F.coalesce(_composed(F.when(decomposed, c)), c)
