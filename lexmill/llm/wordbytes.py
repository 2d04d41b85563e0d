"""Words of many texts at once, as NumPy arrays over their UTF-8 bytes.

A word is a maximal run of ASCII letters, ASCII digits and characters from U+0080 on, with A-Z lower-cased. As every
byte of a multi-byte character is 0x80 or more, words can be found on bytes without decoding.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

IS_WORD = np.zeros(256, np.uint8)
IS_WORD[0x30:0x3A] = IS_WORD[0x41:0x5B] = IS_WORD[0x61:0x7B] = IS_WORD[0x80:] = 1
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
# Every byte that is in no word as a space, A-Z lower-cased.
WORDS_ONLY = bytes(int(LOWER[b]) if IS_WORD[b] else 0x20 for b in range(256))
SLICE = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words: Python's own, which is SipHash-1-3. Its key is the hash seed, which Spark sets for all workers alike."""
    if TaskContext.get() is not None and os.environ.get("PYTHONHASHSEED", "random") == "random":
        raise RuntimeError("PYTHONHASHSEED is not set for this worker: its hashes are not those of others")
    return np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)


def text_chunks(column: pa.Array, limit: int = 1 << 18) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks of about ``limit`` bytes of whole texts: first row, last row + 1, bytes, offsets of the texts in them.

    A null counts as an empty text. A text longer than ``limit`` makes a block of its own.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2] if len(column) else None
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, start and end of each word, and for each text the index of its first word (one more at the end)."""
    low = LOWER[data]
    inside = IS_WORD[data]
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    filled = offsets[1:] > offsets[:-1]
    before[offsets[:-1][filled]] = 0
    after[offsets[1:][filled] - 1] = 0
    starts = np.flatnonzero(inside & (1 - before))
    ends = np.flatnonzero(inside & (1 - after)) + 1
    return low, starts, ends, np.searchsorted(starts, offsets)


def text_words(column: pa.Array) -> Iterator[np.ndarray]:
    """The hashes of each text's words, in order. Long texts are read in slices that end between words."""
    for _, _, data, offsets in text_chunks(column):
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            if b - a <= SLICE:
                yield word_hashes(data[a:b].tobytes().translate(WORDS_ONLY).split())
            else:
                yield np.concatenate([word_hashes(s.translate(WORDS_ONLY).split()) for s in slices(data[a:b])])


def slices(data: np.ndarray, kinds: np.ndarray = IS_WORD, size: int = SLICE) -> Iterator[bytes]:
    """A text's bytes in pieces of about ``size`` that end at a byte of kind 0 (in no word); a longer word stays whole."""
    at = 0
    while at < len(data):
        to = at + size
        while to < len(data):
            gap = np.flatnonzero(kinds[data[to : to + size]] == 0)
            if len(gap):
                to += int(gap[0])
                break
            to += size
        yield data[at:to].tobytes()
        at = to


def apart(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The bytes of the given spans, one space after each, which keeps them apart even where two texts meet."""
    lengths = ends - starts
    to = np.concatenate([[0], np.cumsum(lengths + 1)])
    out = np.full(int(to[-1]), 0x20, np.uint8)
    if len(starts):
        edges = np.zeros(len(low) + 1, np.int8)
        edges[starts] += 1
        np.subtract.at(edges, ends, 1)
        source = np.flatnonzero(np.cumsum(edges[:-1], dtype=np.int8))
        out[source + np.repeat(to[:-1] - starts, lengths)] = low[source]
    return out.tobytes()


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all windows of ``width`` consecutive word hashes (none if there are fewer)."""
    n = len(words) - width + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = (out + words[k : k + n]) * _BASE
        out ^= out >> np.uint64(29)
    return mix(out)


def text_shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingles of one text; a text of fewer words, but not none, is one shingle."""
    if 0 < len(words) < width:
        return shingle_hashes(words, len(words))
    return np.unique(shingle_hashes(words, width))
