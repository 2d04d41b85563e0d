"""Embeddings: unit vectors of fixed length for texts.

The default needs no model: words and the three-letter runs in them are hashed into ``DIM`` counts, scaled to unit
length, in Arrow batches. It compares wording, not meaning. Another model plugs in as a function from a
list of texts to a matrix, loaded once in each Python worker and fed Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIM = 384
WORD_WEIGHT, GRAM_WEIGHT = 2.0, 1.0


_WORD = re.compile(r"[^\W_]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _STEP
    return h ^ (h >> np.uint64(32))


def hashed_vector(text: str, dim: int = DIM) -> np.ndarray:
    """Hashed counts of the words and of the three-letter runs inside them, scaled to unit length."""
    words = _WORD.findall(text.lower())
    if not words:
        return np.zeros(dim, np.float32)
    chars = np.frombuffer(" ".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) for w in words])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    # A word's hash: its characters' own, each by its place in the word, added up.
    place = np.arange(len(chars)) - np.repeat(starts, sizes + 1)[: len(chars)]
    each = _mixed(chars * np.uint64(1_000_003) + place.astype(np.uint64) * _STEP)
    whole = np.add.reduceat(np.where(chars == 0x20, np.uint64(0), each), starts)
    inside = (chars[:-2] != 0x20) & (chars[1:-1] != 0x20) & (chars[2:] != 0x20)
    grams = _mixed((chars[:-2] * np.uint64(31) + chars[1:-1]) * np.uint64(1_000_033) + chars[2:] + np.uint64(7))[inside]
    counts = WORD_WEIGHT * np.bincount((_mixed(whole) % np.uint64(dim)).astype(np.int64), minlength=dim) + GRAM_WEIGHT * np.bincount((grams % np.uint64(dim)).astype(np.int64), minlength=dim)
    return (counts / np.linalg.norm(counts)).astype(np.float32)


@F.pandas_udf(T.ArrayType(T.FloatType()))
def hashed_embedding(texts: pd.Series) -> pd.Series:
    """A unit vector for each text; all zeros for a text without words."""
    return pd.Series([hashed_vector(t or "") for t in texts], dtype=object)


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double") * x.cast("double")))


def normalised(vector: Column) -> Column:
    """Scaled to unit length, as ``array<float>``; zeros stay zeros."""
    counted = F.transform(F.array(vector), lambda v: F.struct(v.alias("v"), norm(v).alias("n")))[0]
    return F.transform(counted["v"], lambda x: F.when(counted["n"] > 0, x / counted["n"]).otherwise(0.0).cast("float"))


_models: dict[str, Callable[[list[str]], np.ndarray]] = {}


def model_embedding(text: Column, name: str, load: Callable[[], Callable[[list[str]], np.ndarray]], dim: int = DIM, normalise: bool = True) -> Column:
    """Embeddings of a model that ``load`` makes; it is kept by ``name`` for the life of a worker."""

    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if name not in _models:
            _models[name] = load()
        for texts in batches:
            m = np.asarray(_models[name]([t or "" for t in texts]), np.float32).reshape(len(texts), -1)
            if m.shape[1] != dim and len(m):
                raise ValueError(f"{name} gives {m.shape[1]} dimensions, not {dim}")
            if normalise:
                lengths = np.linalg.norm(m, axis=1, keepdims=True)
                m = np.divide(m, lengths, out=np.zeros_like(m), where=lengths > 0)
            yield pd.Series(list(m))

    embed.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}  # not as strings: they tell the kind of UDF
    return F.pandas_udf(embed, T.ArrayType(T.FloatType(), False))(text)


def embed(chunks: DataFrame, *, text: str = "text", embedding: Callable[[Column], Column] = hashed_embedding, name: str = "embedding") -> DataFrame:
    return chunks.withColumn(name, embedding(F.col(text)))


def query_vector(spark, query: str, embedding: Callable[[Column], Column] = hashed_embedding) -> list[float]:
    """The vector of one text, by the same columns as the chunks'."""
    return spark.range(1).select(embedding(F.lit(query)).alias("v")).first()["v"]
