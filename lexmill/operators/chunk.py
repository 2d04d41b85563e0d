"""Chunks: recursive splitting at ever finer separators, greedy packing with overlap, numbering.

Costs are estimated tokens (1.35 a word, rounded down) of each piece by itself, so a chunk of single words holds as
many words as its size. Splitting recurses and is an Arrow UDF; packing at one separator, hard splitting, the filter of
short chunks and the numbering are built-in functions.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.functions.text import approx_tokens, rx, strip, word_count

SIZE, OVERLAP, LEAST_WORDS = 512, 64, 10
# Separators from coarse to fine; the empty one cuts anywhere.
SEPARATORS = ("\n\n", "\n", ". ", "! ", "? ", ", ", " ", "")
CHARACTERS_A_TOKEN = 5


def check_sizes(size: int, overlap: int) -> None:
    if size < 1 or not 0 <= overlap < size:
        raise ValueError("a chunk needs a positive size and an overlap below it")


def cost(text: str) -> int:
    return len(text.split()) * 135 // 100


def runs(costs: list[int], size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Ranges of pieces that make a chunk each: full ones, the next of which begins at most ``overlap`` earlier."""
    begin = held = 0
    for k, c in enumerate(costs):
        if held + c > size and k > begin:
            yield begin, k
            while begin < k and held > overlap:
                held -= costs[begin]
                begin += 1
        held += c
    if begin < len(costs):
        yield begin, len(costs)


def split(text: str, size: int = SIZE, overlap: int = OVERLAP, separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """The chunks of one text. Pieces that are too large are split by the finer separators before they are packed."""
    if not text.strip():
        return []
    if cost(text) <= size:
        return [text.strip()]
    at = next((k for k, s in enumerate(separators) if s in text), None)
    if at is None:
        return [text.strip()]
    separator, finer = separators[at], separators[at + 1 :]
    if not separator:
        width, step = size * CHARACTERS_A_TOKEN, (size - overlap) * CHARACTERS_A_TOKEN
        cuts = (text[k : k + width].strip() for k in range(0, len(text), step))
        return [c for c in cuts if c]
    pieces = [q for p in text.split(separator) if p.strip() for q in ([p] if cost(p) <= size else split(p, size, overlap, finer))]
    packed = (separator.join(pieces[a:b]).strip() for a, b in runs([cost(p) for p in pieces], size, overlap))
    return [c for c in packed if c]


def recursive_chunks(text: Column, size: int = SIZE, overlap: int = OVERLAP, separators: tuple[str, ...] = SEPARATORS) -> Column:
    check_sizes(size, overlap)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def chunks(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: split(t or "", size, overlap, separators))

    return chunks(text)


def hard_chunks(text: Column, size: int = SIZE, overlap: int = OVERLAP) -> Column:
    """Windows of characters, white space cut off their ends."""
    check_sizes(size, overlap)
    width, step = size * CHARACTERS_A_TOKEN, (size - overlap) * CHARACTERS_A_TOKEN
    starts = F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text), F.lit(step))).otherwise(F.array().cast("array<int>"))
    return F.filter(F.transform(starts, lambda s: strip(F.substring(text, s, F.lit(width)))), lambda c: c != "")


def word_chunks(text: Column, size: int = SIZE, overlap: int = OVERLAP) -> Column:
    """What packing gives where spaces are the only separator: every word costs 1, so chunks begin every size - overlap words."""
    check_sizes(size, overlap)
    words = F.filter(F.split(text, " "), lambda w: ~w.rlike(rx(r"^\s*\z")))
    n = F.size(words)
    starts = F.sequence(F.lit(0), F.when(n > size, F.ceil((n - size) / (size - overlap)) * (size - overlap)).otherwise(0).cast("int"), F.lit(size - overlap))
    packed = F.transform(starts, lambda s: strip(F.array_join(F.slice(words, s + 1, F.lit(size)), " ")))
    fits = approx_tokens(word_count(text)) <= size
    return F.when(n == 0, F.array().cast("array<string>")).when(fits, F.array(strip(text))).otherwise(packed)


def numbered(docs: DataFrame, chunks: Column, *, key: str = "case_id", least_words: int = LEAST_WORDS, carry: tuple[str, ...] = ()) -> DataFrame:
    """A row for each chunk of ``least_words`` or more: key, chunk_index from 0, text, char_count, approx_token_count, total_chunks, and the columns to ``carry``."""
    counted = docs.select(key, *carry, chunks.alias("_chunks")).withColumn("_chunks", F.transform("_chunks", lambda c: F.struct(c.alias("text"), word_count(c).alias("words"))))
    kept = counted.withColumn("_chunks", F.filter("_chunks", lambda c: c["words"] >= least_words))
    spread = kept.select(key, *carry, F.size("_chunks").alias("total_chunks"), F.posexplode("_chunks").alias("chunk_index", "_c"))
    return spread.select(key, "chunk_index", F.col("_c.text").alias("text"), F.length("_c.text").alias("char_count"), approx_tokens(F.col("_c.words")).alias("approx_token_count"), "total_chunks", *carry)


def chunk(docs: DataFrame, *, key: str = "case_id", text: str = "clean_text", size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """Chunks of each document; a null text has none."""
    return numbered(docs, recursive_chunks(F.col(text), size, overlap), key=key)
