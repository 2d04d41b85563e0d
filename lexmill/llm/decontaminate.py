"""Benchmark decontamination: a broadcast hash set of normalised test n-grams against the word windows of documents.

A benchmark item gives all its windows of ``width`` consecutive words; an item of fewer words, but not none, is one
window. A document word inside any occurrence of a window is hit. Only words of benchmark items can be in a window, so
each document word becomes the number of that benchmark word or -1, runs of known words are found by a cumulative sum,
the hash of each remaining window is looked up, and each hit is verified on the words themselves.

The set grows with the benchmark, not with the documents. It is held in arrays (``BUILT`` bytes for a byte of text) and
broadcast in blocks of at most ``max_broadcast_bytes``, sizes checked before any text is fetched; items longer than
``PIECE_WORDS`` are cut in pieces that overlap by a window. A document is scanned for all blocks in one pass, one block in
memory at a time, so nothing has to be united afterwards.

Nulls: a null text has no words; a null or empty item has no windows; items with equal texts are all counted; the windows of
an item with a null id are hit as any, and only the list of ids leaves it out. Very long documents are scanned in slices.
An empty document table gives an empty result, an empty benchmark leaves every document clean. Repeated rows are each
judged; extra columns may have any name.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import small_batches
from lexmill.llm.wordbytes import SLICE, WORDS_ONLY, apart, mix, slices, text_chunks, words_of

WIDTH = 10
MAX_BROADCAST_BYTES = 32 << 20
# Bytes of a set for a byte of its items' text: hash, place and number of each word, and the words themselves.
BUILT = 8
PIECE_WORDS = 4_096
_STEP = 0x9E3779B97F4A7C15


class WindowSet:
    """Windows of a block of benchmark items, as places in the row of all their words' numbers."""

    def __init__(self, items: list[tuple[str | None, str]], width: int):
        self.vocabulary: dict[bytes, int] = {}
        self.items, rows, by_length = [i for i, _ in items], [], defaultdict(list)
        at, self.begins = 0, np.zeros(len(items), np.int64)
        for k, (_, text) in enumerate(items):
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in text.encode().translate(WORDS_ONLY).split()]
            self.begins[k] = at
            if ids:
                by_length[min(width, len(ids))].append(np.arange(at, at + max(1, len(ids) - width + 1)))
            rows.append(np.array(ids, np.int32))
            at += len(ids)
        self.ids = np.concatenate(rows) if rows else np.zeros(0, np.int32)
        self.hashes, self.places = {}, {}
        for n, starts in by_length.items():
            places = np.concatenate(starts).astype(np.int32)
            hashes = self.hashed(self.ids, places, n)
            order = np.argsort(hashes, kind="stable")
            self.hashes[n], self.places[n] = hashes[order], places[order]

    @staticmethod
    def hashed(ids: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        """Hash of the n word numbers from each of the places on."""
        out = np.zeros(len(at), np.uint64)
        for k in range(n):
            out = (out + ids[at + k].astype(np.uint64) + np.uint64(1)) * np.uint64(_STEP)
        return mix(out)

    def hits(self, ids: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """First word, last word + 1 and items (their numbers) of each window that occurs among a text's words."""
        known = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(ids >= 0, out=known[1:])
        for n, hashes in self.hashes.items():
            at = np.flatnonzero(known[n:] - known[:-n] == n) if len(ids) >= n else ()
            if not len(at):
                continue
            own = self.hashed(ids, at, n)
            low, high = np.searchsorted(hashes, own, "left"), np.searchsorted(hashes, own, "right")
            for k in np.flatnonzero(high > low).tolist():
                p, places = int(at[k]), self.places[n][low[k] : high[k]]
                same = (self.ids[places[:, None] + np.arange(n)] == ids[p : p + n]).all(axis=1)
                if same.any():
                    yield p, p + n, np.unique(np.searchsorted(self.begins, places[same], "right") - 1)


_HIT = pa.struct([("from_word", pa.int32()), ("to_word", pa.int32()), ("from_byte", pa.int64()), ("to_byte", pa.int64())])


class Scanner:
    """Finds the windows of all blocks in texts, one block in memory at a time. ``sets``: broadcast window sets."""

    def __init__(self, sets: list, width: int):
        self.sets, self.width = sets, width

    def __call__(self, column: pa.Array) -> tuple[list[int], list[list[tuple[int, int, int, int]]], list[set[str]]]:
        """For each text: number of words, merged hit spans (words and bytes), ids of the items."""
        n_words, spans, items = [0] * len(column), [[] for _ in range(len(column))], [set() for _ in range(len(column))]
        for held in self.sets:
            own: WindowSet = held.value
            for lo, _, data, offsets in text_chunks(column):
                if len(data) > SLICE:
                    n_words[lo] = self._long(own, data, spans[lo], items[lo])
                    continue
                ids, starts, ends, first = self._numbered(own, data, offsets)
                for k, (a, b) in enumerate(pairwise(first.tolist())):
                    n_words[lo + k] = b - a
                    if b > a:
                        self._add(own, ids[a:b], starts[a:b] - offsets[k], ends[a:b] - offsets[k], 0, spans[lo + k], items[lo + k])
            if len(self.sets) > 1:
                held.__dict__.pop("_value", None)  # what the worker keeps of a broadcast it has read
        return n_words, [_merged_spans(s) for s in spans], items

    @staticmethod
    def _numbered(own: WindowSet, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        low, starts, ends, first = words_of(data, offsets)
        lookup = own.vocabulary.get
        return np.fromiter((lookup(w, -1) for w in apart(low, starts, ends).split()), np.int64, len(starts)), starts, ends, first

    @staticmethod
    def _add(own: WindowSet, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: int, spans: list, items: set) -> None:
        for a, b, found in own.hits(ids):
            spans.append((before + a, before + b, int(starts[a]), int(ends[b - 1])))
            items.update(own.items[i] for i in found.tolist() if own.items[i] is not None)

    def _long(self, own: WindowSet, data: np.ndarray, spans: list, items: set) -> int:
        """One long text, in slices; a slice starts with the last words of the one before it. The number of its words."""
        held, at, n = None, 0, 0
        for raw in slices(data):
            part = np.frombuffer(raw, np.uint8)
            ids, starts, ends, _ = self._numbered(own, part, np.array([0, len(part)]))
            now, n_now = (ids, starts + at, ends + at), len(ids)
            held = now if held is None else tuple(np.concatenate([h[-(self.width - 1) :] if self.width > 1 else h[:0], x]) for h, x in zip(held, now, strict=True))
            self._add(own, *held, n + n_now - len(held[0]), spans, items)
            at, n = at + len(part), n + n_now
        return n


def _merged_spans(spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Spans of words (and bytes) without overlap or contact."""
    out: list[tuple[int, int, int, int]] = []
    for a, b, s, e in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]), out[-1][2], max(e, out[-1][3]))
        else:
            out.append((a, b, s, e))
    return out


def pieces_of(benchmark: DataFrame, item: str, text: str, width: int) -> DataFrame:
    """The items as rows (i, t), long ones in pieces that overlap by all words of a window but one."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = t.encode().translate(WORDS_ONLY).split()
                for at in range(0, max(1, len(words) - width + 1), PIECE_WORDS) if words else ():
                    yield pa.RecordBatch.from_pydict({"i": pa.array([i], pa.string()), "t": pa.array([b" ".join(words[at : at + PIECE_WORDS + width - 1]).decode()], pa.string())})

    rows = benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).cast("string").alias("t")).where("t is not null and t <> ''")
    return rows.mapInArrow(split, "i string, t string")


def blocks_of(benchmark: DataFrame, item: str, text: str, width: int, max_bytes: int) -> Iterator[list[tuple[str | None, str]]]:
    """The benchmark's pieces in blocks whose sets have at most ``max_bytes``; a piece alone may be larger. Sizes are checked before any text is fetched."""
    pieces = pieces_of(benchmark, item, text, width)
    size = F.sum(F.octet_length("t") * BUILT).alias("b")
    whole = pieces.agg(size, F.count("*").alias("n")).first()
    n = max(1, -(-(whole["b"] or 0) // max_bytes))
    while True:
        block = F.pmod(F.xxhash64("i", "t"), F.lit(n))
        largest = pieces.groupBy(block.alias("k")).agg(size, F.countDistinct("t").alias("n")).where(f"b > {max_bytes} and n > 1") if n > 1 else None
        if largest is None or n >= 4 * whole["n"] or largest.isEmpty():
            break
        n *= 2
    for k in range(n):
        rows = (pieces if n == 1 else pieces.where(block == k)).collect()
        if rows or n == 1:
            yield sorted(((r["i"], r["t"]) for r in rows), key=lambda p: (p[0] is not None, p[0] or "", p[1]))


def window_sets(docs: DataFrame, benchmark: DataFrame, item: str, item_text: str, width: int, max_bytes: int) -> list:
    """A broadcast window set for each block, made one after the other."""
    return [small_batches(docs).sparkSession.sparkContext.broadcast(WindowSet(block, width)) for block in blocks_of(benchmark, item, item_text, width, max_bytes)]


SPANS = "array<struct<from_word:int,to_word:int,from_byte:long,to_byte:long>>"


def hit_spans(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", width: int = WIDTH, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Per row of ``docs``: key, n_words, spans (merged hit spans: words and UTF-8 bytes), items (whose windows occur)."""
    kind = docs.schema[key].dataType.simpleString()
    sets = window_sets(docs, benchmark, item, item_text, width, max_broadcast_bytes)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Scanner(sets, width)
        for batch in batches:
            n_words, spans, items = find(batch.column(1))
            shown = pa.array([[dict(zip(_HIT.names, s, strict=True)) for s in x] for x in spans], pa.list_(_HIT))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), shown, pa.array([sorted(x) for x in items], pa.list_(pa.string()))], ["_key", "n_words", "spans", "items"])

    rows = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    return rows.mapInArrow(scan, f"_key {kind}, n_words long, spans {SPANS}, items array<string>").withColumnRenamed("_key", key)


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per document: key, n_words, n_hit, n_items, items_sha256, contaminated."""
    key = options.get("key", "doc_id")
    return hit_spans(docs, benchmark, **options).select(
        key,
        "n_words",
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["to_word"] - s["from_word"]).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def without_spans(text: str, spans: list[tuple[int, int, int, int]]) -> str:
    """``text`` without the bytes of each span; the white space on one side of a cut goes as well."""
    raw, out, at = text.encode(), [], 0
    for _, _, begin, end in spans:
        out.append(raw[at:begin].rstrip(b" "))
        at = end
    out.append(raw[at:])
    return b"".join(out).decode("utf-8", "ignore")


def clean_documents(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id", item_text: str = "text", width: int = WIDTH, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """The documents in which no window of the benchmark occurs, in their own columns. Only texts go to Python; nothing is shuffled."""
    sets = window_sets(docs, benchmark, item, item_text, width, max_broadcast_bytes)

    @F.arrow_udf("boolean")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        find = Scanner(sets, width)
        for texts in batches:
            yield pa.array([not s for s in find(texts)[1]], pa.bool_())

    return docs.where(clean(F.col(text).cast("string")))


def clean_spans(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id", item_text: str = "text", width: int = WIDTH, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """All documents, with the hit spans removed from the text column."""
    sets = window_sets(docs, benchmark, item, item_text, width, max_broadcast_bytes)

    @F.arrow_udf("string")
    def cleaned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        find = Scanner(sets, width)
        for texts in batches:
            spans = find(texts)[1]
            yield pa.array([t.as_py() if not s else without_spans(t.as_py(), s) for t, s in zip(texts, spans, strict=True)], pa.string())

    return docs.withColumn(text, cleaned(F.col(text).cast("string")))
