"""Secret scans: a trigram inverted index in front of regular expressions.

``trigram_query`` derives from a regular expression what every match must contain: a Boolean query (and / or) over
lower-cased trigrams, from literal runs, alternatives and small classes, as in indexed code search. A rule without a
mandatory trigram scans fully.

``postings_table`` is the index: for each trigram that some rule asks for, the documents that contain it (known by a hash of
their text, so equal texts are one). ``rules_met`` merges the posting lists by document, whose trigrams become the bits of
numbers, and tests each rule's query on them: intersections and unions of the lists. What is left are the candidates, with
the rules they are candidates of; only these texts are verified, each with those rules' expressions. Texts whose hashes
clash share their postings, which can add candidates but not lose one.

Candidates meet their texts in a join: they are broadcast if they are few, else texts are shuffled by their hash, where
adaptive execution can split a text of very many copies. Offsets are code points, running sums of the lengths of matches and
of the text between them; sums and replacements take time linear in a text's length, but for a square of its number of
matches over ``STRIDE``. Built-in functions only.

A null text counts as empty and has no spans (redaction leaves it null); a text may be of any length; repeated rows are each
scanned; of spans with one start the order of the rules decides; extra columns may have any name; an empty table gives an
empty result.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.text import let
from lexmill.llm.common import cut, few, text_or_empty


@dataclass(frozen=True)
class Rule:
    """``pattern`` is the same in Java's and Python's syntax. A match counts if ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The three base kinds of the contract, in its order.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
    Rule("url_login", r"[a-z]{1,20}://[A-Za-z0-9._-]+:[^\s/:@]+@[A-Za-z0-9.-]+"),
)

# A query is True (anything), a trigram, or ("and" | "or", frozenset of queries).
Query = bool | str | tuple


def _join(kind: str, parts) -> Query:
    flat = set()
    for p in parts:
        flat |= set(p[1]) if isinstance(p, tuple) and p[0] == kind else {p}
    if kind == "and":
        flat.discard(True)
    elif True in flat or not flat:
        return True
    return True if not flat else next(iter(flat)) if len(flat) == 1 else (kind, frozenset(flat))


def _of_strings(strings: frozenset[str]) -> Query:
    return _join("or", [_join("and", [s[i : i + 3] for i in range(len(s) - 2)]) if len(s) > 2 else True for s in strings]) if strings else True


MOST_STRINGS = 64


def trigram_query(pattern: str) -> Query:
    """The Boolean query that every text with a match of ``pattern`` satisfies, on its lower-cased form."""

    def walk(items) -> tuple[Query, frozenset[str], bool]:
        """Query of what lies behind, the strings that the end of the match so far can be, and whether these are all of it."""
        query, ends, whole = True, frozenset([""]), True

        def close() -> None:
            nonlocal query, ends, whole
            query, ends, whole = _join("and", [query, _of_strings(ends)]), frozenset([""]), False

        def extend(choices) -> None:
            nonlocal ends
            new = frozenset(a + b for a in ends for b in choices)
            if len(new) > MOST_STRINGS:
                close()
                new = frozenset(choices) if len(choices) <= MOST_STRINGS else frozenset([""])
            ends = new

        def absorb(inner_query: Query, inner: frozenset[str], inner_whole: bool) -> None:
            nonlocal query, ends
            if inner_whole:
                extend(inner)
            else:
                close()
                query, ends = _join("and", [query, inner_query]), inner

        for op, value in items:
            if op is sre.LITERAL:
                extend([chr(value).lower()])
            elif op is sre.SUBPATTERN:
                absorb(*walk(value[3]))
            elif op is sre.BRANCH:
                branches = [walk(b) for b in value[1]]
                if all(w for _, _, w in branches):
                    extend(frozenset().union(*[e for _, e, _ in branches]))
                else:
                    close()
                    query = _join("and", [query, _join("or", [_join("and", [q, _of_strings(e)]) for q, e, _ in branches])])
            elif op is sre.IN and (chars := _class(value)):
                extend(chars)
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
                low, high, inner = value
                sub = walk(inner)
                if (low, high) == (0, 1) and sub[2]:
                    extend(sub[1] | {""})
                else:
                    if low:
                        absorb(*sub)
                    if (low, high) != (1, 1):
                        close()
            elif op is not sre.AT:
                close()
        return query, ends, whole

    query, ends, _ = walk(sre_parser.parse(pattern))
    return _join("and", [query, _of_strings(ends)])


def _class(value) -> frozenset[str] | None:
    """The lower-cased characters of a class of at most eight, else none."""
    chars = set()
    for op, x in value:
        if op is sre.LITERAL:
            chars.add(chr(x).lower())
        elif op is sre.RANGE and x[1] - x[0] < 8:
            chars |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
        else:
            return None
    return frozenset(chars) if len(chars) <= 8 else None


def trigrams_of(query: Query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]))


def vocabulary(rules) -> list[str]:
    return sorted(set().union(*[trigrams_of(trigram_query(r.pattern)) for r in rules]))


def matches(bits: Column, query: Query, grams: list[str]) -> Column:
    """Whether a document's bits satisfy the query: intersections and unions of posting lists, bit by bit."""
    if query is True:
        return F.lit(True)
    if isinstance(query, str):
        k = grams.index(query)
        return bits[k // 63].bitwiseAND(F.lit(1 << k % 63)) != 0
    parts = sorted(query[1], key=str)
    singles = [p for p in parts if isinstance(p, str)]
    tests = [matches(bits, p, grams) for p in parts if not isinstance(p, str)]
    for word in sorted({grams.index(g) // 63 for g in singles}):
        mask = F.lit(sum(1 << grams.index(g) % 63 for g in singles if grams.index(g) // 63 == word)).cast("long")
        met = bits[word].bitwiseAND(mask)
        tests.append(met == mask if query[0] == "and" else met != 0)
    return reduce(lambda a, b: a & b if query[0] == "and" else a | b, tests)


def postings_table(docs: DataFrame, rules=BASE + MORE, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The index by trigram: a row (trigram, key) for each trigram of the rules in each document."""
    low = F.lower(text_or_empty(text))  # lowers A-Z like any other letter, so it can add candidates but not lose one
    held = docs.select(F.col(key), low.alias("_low"))
    return held.select(F.explode(F.filter(F.array(*[F.lit(g) for g in vocabulary(rules)]), lambda g: F.contains(F.col("_low"), g))).alias("trigram"), key)


def merged_postings(table: DataFrame, grams: list[str], *, key: str = "doc_id") -> DataFrame:
    """Per document of the posting lists of ``grams``: key, _bits (for each 63 trigrams a number whose bits say which of them it has)."""
    place = F.array_position(F.array(*[F.lit(g) for g in grams]), F.col("trigram")).cast("int") - 1
    placed = table.where(F.col("trigram").isin(grams)).withColumn("_place", place)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_place") % 63)
    words = [F.bit_or(F.when(F.floor(F.col("_place") / 63) == w, bit).otherwise(F.lit(0).cast("long"))) for w in range(-(-len(grams) // 63))]
    return placed.groupBy(key).agg(F.array(*words).alias("_bits"))


def candidates(table: DataFrame, rule: Rule, *, key: str = "doc_id") -> DataFrame:
    """Keys whose postings satisfy the rule's query. A rule without mandatory trigrams has no such list."""
    query = trigram_query(rule.pattern)
    if query is True:
        raise ValueError(f"{rule.kind} has no mandatory trigram: scan all documents")
    grams = sorted(trigrams_of(query))
    return merged_postings(table, grams, key=key).where(matches(F.col("_bits"), query, grams)).select(key)


def rules_met(table: DataFrame, rules=BASE + MORE, *, key: str = "doc_id") -> DataFrame:
    """Documents that are candidates of any rule: key, _met (the rules' bits)."""
    grams = vocabulary(rules)
    queries = [(k, trigram_query(r.pattern)) for k, r in enumerate(rules)]
    met = [F.when(matches(F.col("_bits"), q, grams), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")) for k, q in queries if q is not True]
    return merged_postings(table, grams, key=key).select(key, reduce(lambda a, b: a.bitwiseOR(b), met).alias("_met")).where("_met <> 0")


SPAN = "array<struct<start:int,ord:int,end:int,kind:string>>"


STRIDE = 256


def running(values: Column, start, add) -> Column:
    """For each element what ``add`` makes of ``start`` and those before it, and at last of all of them. Elements go in strides, as arrays can only grow by a copy."""
    first = lambda: F.struct(start.alias("at"), F.array().cast("array<int>").alias("out"))
    step = lambda acc, x: F.struct(add(acc["at"], x).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out"))
    strides = F.transform(F.sequence(F.lit(0), F.ceil(F.size(values) / STRIDE).cast("int")), lambda k: F.slice(values, k * STRIDE + 1, STRIDE))
    inner = F.transform(strides, lambda s: F.aggregate(s, first(), step))

    def joined_up(parts: Column) -> Column:
        outer = F.aggregate(parts, first(), lambda acc, p: step(acc, p["at"]))
        return let(outer, lambda o: F.array_append(F.flatten(F.zip_with(parts, o["out"], lambda p, base: F.transform(p["out"], lambda v: add(base, v)))), o["at"]))

    return let(inner, joined_up)


def spans_of(text: Column, rule: Rule, order: int) -> Column:
    """Spans (start, order of the kind, end, kind) of the rule's matches that count, leftmost and without overlap."""
    pattern = f"(?s){rule.pattern}"
    lengths = lambda found: F.transform(found, F.length)
    sizes = lengths(F.regexp_extract_all(text, F.lit(pattern), 0))
    counted = lengths(F.regexp_extract_all(text, F.lit(pattern), rule.group)) if rule.group else sizes
    gaps = lengths(F.split(text, pattern, -1))

    def placed(m: Column) -> Column:
        moves = F.zip_with(m["gap"], m["size"], lambda g, s: g + F.coalesce(s, F.lit(0)))
        at = running(moves, F.lit(0), lambda a, b: a + b)
        found = F.transform(F.arrays_zip(F.slice(at, 1, F.size(m["size"])).alias("at"), F.slice(m["gap"], 1, F.size(m["size"])).alias("gap"), m["size"].alias("size"), m["part"].alias("part")), lambda x: F.when(
            x["part"] >= rule.least, F.struct((x["at"] + x["gap"]).alias("start"), F.lit(order).alias("ord"), (x["at"] + x["gap"] + x["size"]).alias("end"), F.lit(rule.kind).alias("kind"))))
        return F.filter(found, lambda x: x.isNotNull()).cast(SPAN)

    return let(F.struct(gaps.alias("gap"), sizes.alias("size"), counted.alias("part")), placed)


def _full_scan(text: Column, rule: Rule) -> Column:
    """Cheap test before a full scan's spans are cut: a run that is long enough, for rules that are one repeated class."""
    return text.rlike(f"(?s){rule.pattern.removesuffix('+')}{{{rule.least},}}" if rule.pattern.startswith("[") and rule.pattern.count("[") == 1 and rule.group == 0 else f"(?s){rule.pattern}")


def found_spans(docs: DataFrame, rules=BASE + MORE, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, _text, spans (sorted by start, then by the order of ``rules``)."""
    return _found(docs.select(F.col(key).alias("_key"), F.struct(F.col(text).cast("string").alias("text")).alias("_row")), "text", rules).select("_key", "_text", "spans")


def _found(rows: DataFrame, text: str, rules) -> DataFrame:
    """``rows`` (with a struct _row) and the _text and spans of its field ``text``."""
    own = text_or_empty(F.col("_row").getField(text).cast("string"))
    marked = rows.withColumn("_mark", F.xxhash64(own))
    index = cut(postings_table(marked.select("_mark", own.alias("_text")), rules, key="_mark", text="_text"))
    met = few(rules_met(index, rules, key="_mark").withColumnRenamed("_mark", "_candidate"))
    held = marked.join(met, F.col("_mark") == F.col("_candidate"), "left").withColumn("_text", own)
    parts = []
    for order, rule in enumerate(rules):
        gate = _full_scan(F.col("_text"), rule) if trigram_query(rule.pattern) is True else F.coalesce(F.col("_met"), F.lit(0)).bitwiseAND(F.lit(1 << order).cast("long")) != 0
        parts.append(F.when(gate, spans_of(F.col("_text"), rule, order)).otherwise(F.array().cast(SPAN)))
    return held.withColumn("spans", F.array_sort(F.concat(*parts)))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_assign, n_access, n_hex, base_sha256, spans."""
    found = found_spans(docs, key=key, text=text)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["ord"] < len(BASE))
    return found.select(F.col("_key").alias(key), *[count(r.kind) for r in BASE], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def without_spans(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with each span replaced by ``mark``; overlapping spans are one.

    The text is cut in its UTF-32 form, where a place is found without reading what lies before it. A letter in front keeps
    the decoder from taking a first U+FEFF for a byte order mark.
    """
    def put(m: Column) -> Column:
        hidden = F.lit(mark.encode("utf-32-be").hex().upper())
        piece = lambda a, n: F.hex(F.substring(m["raw"], a * 4 + 1, n * 4))
        done = running(F.transform(spans, lambda s: s["end"]), F.lit(0), F.greatest)
        pieces = F.zip_with(spans, F.slice(done, 1, F.size(spans)), lambda s, at: F.when(s["start"] >= at, F.concat(piece(at, s["start"] - at), hidden)).otherwise(""))
        rest = F.hex(F.substring(m["raw"], F.element_at(done, -1) * 4 + 1, F.octet_length(m["raw"])))
        return F.substring(F.decode(F.unhex(F.concat(F.lit("00000078"), F.array_join(pieces, ""), rest)), "UTF-32"), F.lit(2), F.lit(2**31 - 1))

    return let(F.struct(F.encode(text, "UTF-32").alias("raw")), put)


def redacted(docs: DataFrame, rules=BASE + MORE, *, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with each span of the text replaced by ``mark``; overlapping spans are one. A null text stays null."""
    found = _found(docs.select(F.struct(*docs.columns).alias("_row")), text, rules)
    own = F.col("_row")
    value = F.when(F.size("spans") > 0, without_spans(F.col("_text"), F.col("spans"), mark)).otherwise(own.getField(text))
    return found.select(*[(value if c == text else own.getField(c)).alias(c) for c in docs.columns])
