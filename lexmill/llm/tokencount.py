"""Token counts by prefix dynamic programming over byte-level BPE.

The text is split into pieces (words with their leading space, numbers, punctuation, white space) as the tokenizer
splits it. Inside a piece, the BPE encoding of each prefix ends in exactly one token: the one whose bytes end the
prefix, and which stays apart from the last token of the prefix before it when the two are encoded together. So

    last[i] = the token t with t = piece[i-len(t):i] and encode(last[i-len(t)] + t) == [last[i-len(t)], t]
    count[i] = count[i - len(t)] + 1

gives the exact token count at every prefix in one pass, and truncation and budget questions (the count of any prefix,
the longest prefix within a budget) are answered from the stored counts without encoding again. Pieces are split and
solved as NumPy arrays over many texts at once; each distinct piece is solved once and kept in a bounded table.

Nulls count as empty texts, which have no tokens. A special token's string inside a text is one token, as the
tokenizers library handles it by default. Long texts are counted in slices that begin where a piece must. Repeated rows are
each counted, and a count of just the limit is not over it; extra columns may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import small_batches
from lexmill.llm.wordbytes import mix, text_chunks

LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3
# The characters with Unicode's White_Space property.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0                　"
# The endings that stay with an apostrophe as one piece.
ONE_LETTER_ENDINGS, TWO_LETTER_ENDINGS = "stmd", ("re", "ve", "ll")
LONGEST_VECTOR_PIECE = 32
LONGEST_KEPT_PIECE = 256
KEPT_PIECES = 800_000
BLOCK_BYTES, SOLVED_AT_ONCE = 1 << 22, 1 << 16
NEVER = 1 << 40
GROUP_BYTES = 8 << 20


PLAIN = np.zeros(256, bool)
PLAIN[[*b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)
# The lowest 0 to 8 bytes of a number.
LOWEST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


class Packed:
    """Short spans of a byte array as numbers: eight bytes each, so that equal numbers and sizes are equal spans."""

    def __init__(self, data: np.ndarray):
        padded = np.concatenate([data, np.zeros(LONGEST_VECTOR_PIECE + 8, np.uint8)]).astype(np.uint64)
        n = len(data) + LONGEST_VECTOR_PIECE
        self.eight = padded[:n].copy()
        for k in range(1, 8):
            self.eight |= padded[k : k + n] << np.uint64(8 * k)

    def word(self, at: np.ndarray, size, k: int = 0) -> np.ndarray:
        """The k-th eight bytes of each span, 0 beyond its end."""
        return self.eight[at + 8 * k] & LOWEST[np.clip(size - 8 * k, 0, 8)]

    def words(self, at: np.ndarray, size) -> np.ndarray:
        return np.stack([self.word(at, size, k) for k in range(LONGEST_VECTOR_PIECE // 8)])


def _mixed(words: np.ndarray) -> np.ndarray:
    """One number for the words of each span; different spans may share one, so what has the number is compared."""
    out = np.zeros(words.shape[1], np.uint64)
    for w in words:
        out = mix(out * _STEP + w)
    return out


@lru_cache(1)
def character_classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[[ord(c) for c in WHITE_SPACE]] = SPACE
    return table


def piece_starts(chars: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mask of the characters (code points) that begin a piece; ``first``: mask of those that begin a text."""
    n = len(chars)
    starts = np.ones(n, bool)
    if n < 2:
        return starts
    kind = character_classes()[chars]
    starts[1:] = (kind[1:] != kind[:-1]) | first[1:]
    # The last white space before other characters is apart from its run; a plain space joins what follows.
    tail = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~first[1:])
    starts[tail] = True
    starts[tail[chars[tail] == 0x20] + 1] = False
    quote = np.flatnonzero((chars[:-1] == 0x27) & starts[:-1] & (kind[1:] == LETTER) & ~first[1:])
    if len(quote):
        one = np.isin(chars[quote + 1], [ord(c) for c in ONE_LETTER_ENDINGS])
        third = np.minimum(quote + 2, n - 1)
        inside = (quote + 2 < n) & ~first[third]
        two = np.zeros(len(quote), bool)
        for a, b in TWO_LETTER_ENDINGS:
            two |= inside & (chars[quote + 1] == ord(a)) & (chars[third] == ord(b))
        starts[quote[one | two] + 1] = False
        for at in (quote[one] + 2, quote[two & ~one] + 3):
            at = at[at < n]
            starts[at[kind[at] == LETTER]] = True
    return starts


class PrefixCounter:
    """Counts of one tokenizer file (its ``tokenizer.json``)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        shown = _byte_letters()
        back = {c: b for b, c in enumerate(shown)}
        raw = lambda s: bytes(back[c] for c in s)
        self.ranks = {}
        for k, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[raw(a), raw(b)] = k
        self.specials = [t["content"] for t in spec.get("added_tokens", [])]
        self._special = re.compile("|".join(re.escape(s) for s in sorted(self.specials, key=len, reverse=True))) if self.specials else None
        self.tokens = sorted({raw(s) for s in spec["model"]["vocab"] if all(c in back for c in s) and s not in self.specials})
        self.ids = {t: k for k, t in enumerate(self.tokens)}
        self.longest = max(map(len, self.tokens))
        # By size, for the vector path: their numbers in order, their words, their ids. Longer tokens are only looked up by their bytes.
        self._by_size = {}
        for size in range(1, LONGEST_VECTOR_PIECE + 1):
            own = [k for k, t in enumerate(self.tokens) if len(t) == size]
            if own:
                words = Packed(np.frombuffer(b"".join(self.tokens[k] for k in own), np.uint8)).words(np.arange(len(own)) * size, size)
                keys = words[0] if size <= 8 else _mixed(words)
                order = np.argsort(keys, kind="stable")
                maybe = np.zeros(1 << 16, bool)
                maybe[mix(keys) >> np.uint64(48)] = True
                self._by_size[size] = keys[order], words[:, order], np.array(own, np.int32)[order], maybe
        self.made_of = {a + b: (a, b) for (a, b) in reversed(self.ranks)}
        self._spines: tuple[dict, dict] = {}, {}
        self._pair_keys, self._pair_fits = np.zeros(0, np.int64), np.zeros(0, bool)
        self._kept: dict[int | bytes, int] = {}  # up to seven bytes: their number and size; else the bytes

    def encode(self, word: bytes) -> list[bytes]:
        """Plain BPE of one piece: merge the pair of lowest rank until none is left."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get((a, b), NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == NEVER:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, before: int, token: int) -> bool:
        """Whether the two tokens stay apart side by side; ``before`` -1: whether the token encodes to itself.

        While the two are built up by merges, only the last part of the first and the first part of the second touch.
        They stay apart if at every such moment a part's own next merge comes before a merge of the two parts.
        """
        if before < 0:
            t = self.tokens[token]
            return self.encode(t) == [t]
        (left, left_ranks), (right, right_ranks) = self._spine(before, 1), self._spine(token, 0)
        i = j = 0
        while True:
            across = self.ranks.get((left[i], right[j]), NEVER)
            if across < left_ranks[i] and across <= right_ranks[j]:
                return False
            if left_ranks[i] == right_ranks[j] == NEVER:
                return True
            if left_ranks[i] <= right_ranks[j]:
                i += 1
            else:
                j += 1

    def _spine(self, token: int, side: int) -> tuple[list[bytes], list[int]]:
        """The parts at one end (0: first, 1: last) as the token is built from one byte up, and the rank of the merge that ends each."""
        known = self._spines[side].get(token)
        if known is None:
            parts, ranks = [self.tokens[token]], [NEVER]
            while len(parts[-1]) > 1:
                pair = self.made_of[parts[-1]]
                ranks.append(self.ranks[pair])
                parts.append(pair[side])
            known = self._spines[side][token] = parts[::-1], ranks[::-1]
        return known

    def _all_fit(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        keys = (before.astype(np.int64) + 1) << 20 | token
        at = np.minimum(np.searchsorted(self._pair_keys, keys), max(len(self._pair_keys) - 1, 0))
        unknown = self._pair_keys[at] != keys if len(self._pair_keys) else np.ones(len(keys), bool)
        if unknown.any():
            new = np.unique(keys[unknown])
            fit = np.fromiter((self.fits((int(k) >> 20) - 1, int(k) & 0xFFFFF) for k in new), bool, len(new))
            both = np.concatenate([self._pair_keys, new])
            order = np.argsort(both, kind="stable")
            self._pair_keys, self._pair_fits = both[order], np.concatenate([self._pair_fits, fit])[order]
            at = np.searchsorted(self._pair_keys, keys)
        return self._pair_fits[at]

    def piece_prefixes(self, piece: bytes) -> np.ndarray:
        """Token count of each byte prefix of one piece, by the recurrence, for pieces of any length."""
        counts, last = np.zeros(len(piece) + 1, np.int32), [-1] * (len(piece) + 1)
        for i in range(1, len(piece) + 1):
            for size in range(min(i, self.longest), 0, -1):
                token = self.ids.get(piece[i - size : i])
                if token is not None and self.fits(last[i - size], token):
                    counts[i], last[i] = counts[i - size] + 1, token
                    break
        return counts

    def tokens_at(self, packed: Packed, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Which of the spans of one size that end at ``at`` are tokens, and the tokens' ids."""
        held = self._by_size.get(size)
        if held is None:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        keys, words, ids, maybe = held
        own = packed.word(at - size, size) if size <= 8 else _mixed(packed.words(at - size, size))
        near = np.flatnonzero(maybe[mix(own) >> np.uint64(48)])
        place = np.searchsorted(keys, own[near])
        place[place == len(keys)] = 0
        hit = keys[place] == own[near]
        near, place = near[hit], place[hit]
        if size > 8 and len(near):
            # Tokens that share a number stand side by side: the first is compared, and all of them where that is not it.
            mine = packed.words(at[near] - size, size)
            same = (words[:, place] == mine).all(axis=0)
            for k in np.flatnonzero(~same).tolist():
                j = place[k]
                while j < len(keys) and keys[j] == own[near[k]] and not same[k]:
                    same[k], place[k] = (words[:, j] == mine[:, k]).all(), j
                    j += 1
            near, place = near[same], place[same]
        return near, ids[place]

    def pieces_prefixes(self, packed: Packed, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The recurrence for many short pieces at once: a row of prefix counts for each."""
        order = np.argsort(starts - ends, kind="stable")  # longest first: those that reach position i are a front part
        begin, size = starts[order], (ends - starts)[order]
        most = int(size[0]) if len(size) else 0  # LONGEST_VECTOR_PIECE at most
        counts, last = np.zeros((len(begin), most + 1), np.uint8), np.full((len(begin), most + 1), -1, np.int32)
        for i in range(1, most + 1):
            live = int(np.searchsorted(-size, -i, "right"))
            todo = np.arange(live)
            for width in range(min(i, self.longest), 0, -1):
                if not len(todo):
                    break
                near, token = self.tokens_at(packed, begin[todo] + i, width)
                if not len(near):
                    continue
                rows = todo[near]
                good = self._all_fit(last[rows, i - width], token)
                rows, token = rows[good], token[good]
                counts[rows, i], last[rows, i] = counts[rows, i - width] + 1, token
                done = np.zeros(live, bool)
                done[rows] = True
                todo = todo[~done[todo]]
        out = np.empty_like(counts)
        out[order] = counts
        return out

    def _solved(self, keys: list, pieces: list[bytes]) -> None:
        """Work out pieces of at most LONGEST_VECTOR_PIECE bytes and keep their counts."""
        for at in range(0, len(pieces), SOLVED_AT_ONCE):
            part = pieces[at : at + SOLVED_AT_ONCE]
            sizes = np.array([len(p) for p in part])
            ends = np.cumsum(sizes)
            table = self.pieces_prefixes(Packed(np.frombuffer(b"".join(part), np.uint8)), ends - sizes, ends)
            self._kept.update(zip(keys[at : at + SOLVED_AT_ONCE], table[np.arange(len(part)), sizes].tolist(), strict=True))

    def _totals(self, keys: list, piece_of) -> np.ndarray:
        """Counts of distinct short pieces, by the keys they are kept under. ``piece_of``: the bytes of the k-th."""
        kept = self._kept
        if len(kept) + len(keys) > KEPT_PIECES:
            kept.clear()
        new = [k for k, key in enumerate(keys) if key not in kept]
        if new:
            self._solved([keys[k] for k in new], [piece_of(k) for k in new])
        return np.fromiter(map(kept.__getitem__, keys), np.int64, len(keys))

    def piece_totals(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Token count of each piece; each distinct piece is solved once. Pieces are told apart by all their bytes."""
        totals, sizes, raw = np.zeros(len(starts), np.int64), ends - starts, data.tobytes()
        packed = Packed(data)
        small = np.flatnonzero(sizes <= 7)
        keys, where, back = np.unique(packed.word(starts[small], sizes[small]) | sizes[small].astype(np.uint64) << np.uint64(56), return_index=True, return_inverse=True)
        first = small[where].tolist()
        totals[small] = self._totals(keys.tolist(), lambda k: raw[starts[first[k]] : ends[first[k]]])[back]
        middle = np.flatnonzero((sizes > 7) & (sizes <= LONGEST_VECTOR_PIECE))
        words = packed.words(starts[middle], sizes[middle])
        _, where, back = np.unique(_mixed(words) + sizes[middle].astype(np.uint64), return_index=True, return_inverse=True)
        pieces = [raw[a:b] for a, b in zip(starts[middle[where]].tolist(), ends[middle[where]].tolist(), strict=True)]
        totals[middle] = self._totals(pieces, pieces.__getitem__)[back]
        # A piece that only shares the number of the first one that has it stands for itself.
        odd = middle[(words != words[:, where[back]]).any(axis=0) | (sizes[middle] != sizes[middle[where[back]]])]
        others = [raw[a:b] for a, b in zip(starts[odd].tolist(), ends[odd].tolist(), strict=True)]
        totals[odd] = [self._totals([p], lambda k, p=p: p)[0] for p in others]
        for k in np.flatnonzero(sizes > LONGEST_VECTOR_PIECE).tolist():
            piece = raw[starts[k] : ends[k]]
            known = self._kept.get(piece)
            totals[k] = int(self.piece_prefixes(piece)[-1]) if known is None else known
            if known is None and len(piece) <= LONGEST_KEPT_PIECE:
                self._kept[piece] = int(totals[k])
        return totals

    def _split(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte position of each piece's start, and for each text the index of its first piece (one more at the end)."""
        text_starts = np.zeros(len(data) + 1, bool)
        text_starts[offsets[:-1]] = True
        leads = np.flatnonzero((data & 0xC0) != 0x80)
        chars = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        starts = leads[piece_starts(chars, text_starts[leads])]
        return starts, np.searchsorted(starts, offsets)

    def counts(self, data: np.ndarray, offsets: np.ndarray, most: int = GROUP_BYTES) -> np.ndarray:
        """Tokens of each text, special strings aside. Texts beyond ``most`` bytes are counted in slices."""
        if len(data) <= most:
            return self._counts(data, offsets)
        return np.array([sum(int(self._counts(part, np.array([0, len(part)]))[0]) for part in _slices(data[a:b], most)) for a, b in pairwise(offsets.tolist())], np.int64)

    def _counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if not len(data):
            return np.zeros(len(offsets) - 1, np.int64)
        starts, first = self._split(data, offsets)
        ends = np.append(starts[1:], len(data))
        sums, at = np.zeros(len(starts) + 1, np.int64), 0
        while at < len(starts):
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + BLOCK_BYTES, "right")))
            low = starts[at]
            sums[at + 1 : to + 1] = self.piece_totals(data[low : ends[to - 1]], starts[at:to] - low, ends[at:to] - low)
            at = to
        np.cumsum(sums, out=sums)
        return sums[first[1:]] - sums[first[:-1]]

    def text_counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text; strings of special tokens are one token each."""
        parts, owner, out = [], [], [0] * len(texts)
        for k, t in enumerate(texts):
            for p in self._special.split(t) if self._special else [t]:
                parts.append(p.encode())
                owner.append(k)
            out[k] = len(self._special.findall(t)) if self._special else 0
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        for k, c in zip(owner, self.counts(np.frombuffer(b"".join(parts), np.uint8), offsets).tolist(), strict=True):
            out[k] += c
        return out

    def prefix_counts(self, text: str) -> np.ndarray:
        """For k = 0 .. len(text), the exact token count of text[:k] (where a cut goes through a special string: as if it were none)."""
        out, before = [np.zeros(1, np.int64)], 0
        for part, special in self._segments(text):
            own = self._segment_prefixes(part) + before
            out.append(own[1:])
            if special:
                inner = self._segment_prefixes(part + special)[len(part) + 1 :] + before
                inner[-1] = own[-1] + 1
                out.append(inner)
            before = int(out[-1][-1]) if len(out[-1]) else before
        return np.concatenate(out)

    def _segments(self, text: str) -> Iterator[tuple[str, str]]:
        at = 0
        for m in self._special.finditer(text) if self._special else ():
            yield text[at : m.start()], m[0]
            at = m.end()
        yield text[at:], ""

    def _segment_prefixes(self, text: str) -> np.ndarray:
        out = np.zeros(len(text) + 1, np.int64)
        if not text:
            return out
        chars = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        first = np.zeros(len(chars), bool)
        first[0] = True
        starts = np.flatnonzero(piece_starts(chars, first)).tolist() + [len(text)]
        kind = character_classes()[chars]
        total, run_start, run_total = 0, 0, 0
        for s, e in zip(starts, starts[1:], strict=False):
            piece = text[s:e]
            by_byte, sizes = self.piece_prefixes(piece.encode()), np.cumsum([len(c.encode()) for c in piece])
            out[s + 1 : e + 1] = total + by_byte[sizes]
            if len(piece) == 3 and piece[0] == "'" and kind[s + 1] == LETTER:  # after one letter of the ending, it is none
                out[s + 2] = total + 2
            if kind[s] == SPACE:
                if s and kind[s - 1] == SPACE:  # cut here, the whole run of white space is one piece
                    out[s + 1] = run_total + self.piece_prefixes(text[run_start : s + 1].encode())[-1]
                else:
                    run_start, run_total = s, total
            total += int(by_byte[-1])
        return out


def _slices(data: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """A text in slices that begin with a space between two ASCII letters or digits, where a piece always begins."""
    at = 0
    while at < len(data):
        to, end = at + size, len(data)
        while to < len(data) - 1:
            part = data[to - 1 : to + size + 1]
            solid = PLAIN[part]
            found = np.flatnonzero((part[1:-1] == 0x20) & solid[:-2] & solid[2:])
            if len(found):
                end = to + int(found[0])
                break
            to += size
        yield data[at:end]
        at = end


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself, or else the next from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


@lru_cache(2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def count_tokens(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", limit: int = 1024) -> DataFrame:
    """Per row: key, n_bytes, n_tokens, over_limit (n_tokens > limit). ``tokenizer``: a file that every executor has."""
    kind = docs.schema[key].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = counter(tokenizer)
        marks = [s.encode() for s in held.specials]
        for batch in batches:
            column = batch.column(1)
            sizes, totals = [], []
            for lo, hi, data, offsets in text_chunks(column, GROUP_BYTES):
                raw = data.tobytes()
                sizes.append(np.diff(offsets))
                if any(m in raw for m in marks):
                    totals.append(np.array(held.text_counts([t or "" for t in column.slice(lo, hi - lo).to_pylist()]), np.int64))
                else:
                    totals.append(held.counts(data, offsets))
            n_bytes, n_tokens = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (sizes, totals))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())], ["_key", "n_bytes", "n_tokens"])

    out = small_batches(docs).select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text")).mapInArrow(scan, f"_key {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("_key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def store_prefix_counts(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key and ``prefix_tokens``, the token count of each prefix of the text (array position k: its first k characters)."""
    kind = docs.schema[key].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = counter(tokenizer)
        for batch in batches:
            for k in range(len(batch)):
                own = held.prefix_counts(batch.column(1)[k].as_py() or "").astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 1), pa.array([own], pa.list_(pa.int32()))], ["_key", "prefix_tokens"])

    return small_batches(docs).select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text")).mapInArrow(scan, f"_key {kind}, prefix_tokens array<int>").withColumnRenamed("_key", key)


def tokens_of_prefix(stored: DataFrame, n_chars, name: str = "n_tokens") -> DataFrame:
    """Add the token count of the first ``n_chars`` characters (a column or number; beyond the end: of the whole text)."""
    n = n_chars if not isinstance(n_chars, int) else F.lit(n_chars)
    return stored.withColumn(name, F.element_at("prefix_tokens", F.least(n, F.size("prefix_tokens") - 1) + 1))


def longest_prefix_within(stored: DataFrame, budget: int, name: str = "n_chars") -> DataFrame:
    """Add the length of the longest prefix of at most ``budget`` tokens; counts can fall again, so all prefixes are asked."""
    fits = F.transform("prefix_tokens", lambda c, i: F.when(c <= budget, i).otherwise(F.lit(0)))
    return stored.withColumn(name, F.array_max(fits))
