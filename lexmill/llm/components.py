"""Connected components by alternating large-star and small-star steps, for edges of any number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import cut


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Edges with the ``m`` of their u. The second key keeps the join from reusing the aggregation's partitions, which could
    not be split: so adaptive execution may split a node of very many edges."""
    return edges.withColumn("_k", F.xxhash64("u")).join(least.withColumn("_k", F.xxhash64("u")), ["u", "_k"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are tied to the smallest of the node and its neighbours."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _with_least(both.where("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the smallest of them. Edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = _with_least(edges, least).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _sum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(node, root) for each node of an edge: root is the smallest node of its component, which has a row as well.

    ``edges``: columns a and b, any order, loops and repeats allowed. Each round is cut in the shared folder.
    """
    state = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = _sum(state)
    for _ in range(most_rounds):
        state = cut(_small_star(_large_star(state)))
        now = _sum(state)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    roots = state.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
