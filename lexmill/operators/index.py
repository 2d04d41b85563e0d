"""Vector index over chunks: exact and inverted-list search by inner product.

The index is a table (vec_id, case_id, chunk_index, list_id, embedding). Exact search scores a scan and keeps the best k
of each task before anything moves. The inverted-list index puts vectors in the list of their nearest centre and is
stored by list, so a search that probes some lists reads those folders only. Many queries go as one matrix.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lexmill.session import materialise

MAX_BROADCAST_QUERIES = 10_000


def inner_product(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0).cast("double"), lambda s, x: s + x)


def literal_vector(values: list[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def with_ids(rows: DataFrame, order: list[str], first: int = 0, name: str = "vec_id") -> DataFrame:
    """Consecutive numbers in the order of unique columns, whatever the partitions, without a single-task window.

    Rows are dealt by range and sorted; each partition's rows are counted, and a running sum over the partitions gives
    every one its first number.
    """
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = dealt.withColumn("_part", F.spark_partition_id()).withColumn("_mono", F.monotonically_increasing_id())
    placed = materialise(placed)
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.col("_mono").bitwiseAND((1 << 33) - 1)
    return placed.join(F.broadcast(starts), "_part").withColumn(name, F.col("_before") + within + first).drop("_part", "_mono", "_before")


def build_flat(chunks: DataFrame, first_id: int = 0) -> DataFrame:
    """Index rows of embedded chunks (case_id, chunk_index, embedding), all in list 0."""
    rows = with_ids(chunks.select("case_id", "chunk_index", "embedding"), ["case_id", "chunk_index"], first_id)
    return rows.select("vec_id", "case_id", "chunk_index", F.lit(0).alias("list_id"), "embedding")


def train_lists(index: DataFrame, n_lists: int, *, seed: int = 1, sample: int = 100_000) -> list[list[float]]:
    """Centres of the inverted lists, from a sample of at most about ``sample`` vectors; none if there are fewer vectors than lists."""
    n = index.count()
    if n < n_lists:
        return []
    part = index if n <= sample else index.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < int(sample / n * (1 << 20)))
    model = KMeans(k=n_lists, seed=seed, featuresCol="_v", maxIter=15).fit(part.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("_v")))
    return [[float(x) for x in c] for c in model.clusterCenters()]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The vectors of an Arrow column as rows of doubles; a null one is a row of zeros. ``width``: the dimension if all are null."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]) if len(column) else np.zeros(0, np.int32)
    dim = int(sizes.max(initial=0)) or width
    if column.null_count or (sizes != dim).any():
        return np.array([x if x is not None else [0.0] * dim for x in column.to_pylist()], np.float64).reshape(len(column), dim)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def assign_lists(index: DataFrame, centres: list[list[float]]) -> DataFrame:
    """Every vector in the list of the centre of greatest inner product (ties: the first). Without centres: list 0, a flat index.

    Centres are few (n_lists of them) and are broadcast as a matrix; batches are multiplied with it.
    """
    if not centres:
        return index.withColumn("list_id", F.lit(0))
    held = index.sparkSession.sparkContext.broadcast(np.array(centres, np.float64))

    @F.arrow_udf("int")
    def nearest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array((_matrix(column, held.value.shape[1]) @ held.value.T).argmax(axis=1) if len(column) else [], pa.int32())

    return index.withColumn("list_id", nearest(F.col("embedding")))


def probed_lists(centres: list[list[float]], query: list[float], n_probe: int) -> list[int]:
    """The lists nearest to a query."""
    score = lambda c: -sum(a * b for a, b in zip(c, query, strict=True))
    return sorted(range(len(centres)), key=lambda k: (score(centres[k]), k))[:n_probe] or [0]


def scores_of(index: DataFrame, query: list[float]) -> Column:
    """Inner products of the index's vectors with one query, a batch at a time."""
    held = index.sparkSession.sparkContext.broadcast(np.array(query, np.float64))

    @F.arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array(_matrix(column, len(held.value)) @ held.value if len(column) else [], pa.float64())

    return scores(F.col("embedding"))


def top_k(index: DataFrame, query: list[float], k: int, lists: list[int] | None = None) -> DataFrame:
    """The k index rows of greatest inner product with ``score``, best first (ties: smaller vec_id). ``lists``: probe these only."""
    rows = index if lists is None else index.where(F.col("list_id").isin(lists))
    scored = rows.withColumn("score", scores_of(rows, query))
    return scored.orderBy(F.desc("score"), "vec_id").limit(k)


def _best_of(scores: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of scores its number and the places of the k greatest; of equal ones the first places."""
    for q, own in enumerate(scores):
        if len(own) <= k:
            yield q, np.arange(len(own))
            continue
        least = np.partition(own, -k)[-k]
        above = np.flatnonzero(own > least)
        yield q, np.concatenate([above, np.flatnonzero(own == least)[: k - len(above)]])


def top_k_each(index: DataFrame, queries: DataFrame, k: int, *, query_id: str = "query_id", query: str = "query", centres: list[list[float]] | None = None, n_probe: int = 0) -> DataFrame:
    """The k nearest index rows of each of many queries: query_id, vec_id, score, rank. With ``centres``, of the ``n_probe`` nearest lists of each.

    Queries are a stated set that meets all vectors; more of them than MAX_BROADCAST_QUERIES go in blocks of that many. Each
    batch of vectors is multiplied with the queries' matrix and gives k rows a query, so little is shuffled.
    """
    spark = index.sparkSession
    kind = queries.schema[query_id].dataType
    slim = queries.select(F.col(query_id).alias("query_id"), F.col(query).alias("_q"))
    n = slim.count()
    blocks = max(1, -(-n // MAX_BROADCAST_QUERIES))
    slim = materialise(slim) if blocks > 1 else slim
    lists = np.array(centres, np.float64) if centres else None
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    rows = index.select("vec_id", "embedding", *(["list_id"] if centres else []))
    out = None
    for b in range(blocks):
        own = slim if blocks == 1 else slim.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b)
        asked = own.collect()  # at most about MAX_BROADCAST_QUERIES
        matrix = np.array([r["_q"] for r in asked], np.float64) if asked else np.zeros((0, 0))
        probes = None if lists is None or not asked else np.argsort(-(matrix @ lists.T), axis=1, kind="stable")[:, :n_probe]
        held = spark.sparkContext.broadcast(([r["query_id"] for r in asked], matrix, probes))

        def scan(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            ids, matrix, probes = held.value
            for batch in batches:
                if not ids or not batch.num_rows:
                    continue
                batch = batch.take(pa.array(np.argsort(batch.column(0).to_numpy(), kind="stable")))
                numbers, vectors, found = batch.column(0).to_numpy(), _matrix(batch.column(1), matrix.shape[1]), []
                if probes is None:
                    parts = [(np.arange(len(ids)), np.arange(len(numbers)))]
                else:
                    in_list = batch.column(2).to_numpy()
                    parts = [(np.flatnonzero((probes == x).any(axis=1)), np.flatnonzero(in_list == x)) for x in np.unique(in_list).tolist()]
                for asked, places in parts:
                    for at in range(0, len(asked), 256):  # scores of some queries at a time
                        scores = matrix[asked[at : at + 256]] @ vectors[places].T
                        found += [(asked[at + q], places[own], scores[q][own]) for q, own in _best_of(scores, k)]
                if found:
                    who = np.repeat([f[0] for f in found], [len(f[1]) for f in found])
                    columns = [pa.array([ids[q] for q in who.tolist()], to_arrow_type(kind)), pa.array(numbers[np.concatenate([f[1] for f in found])], pa.int64()), pa.array(np.concatenate([f[2] for f in found]))]
                    yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

        near = rows.mapInArrow(scan, f"query_id {kind.simpleString()}, vec_id long, score double")
        ranked = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        out = ranked if out is None else out.unionByName(ranked)
    return out


def probes_for(index: DataFrame, centres: list[list[float]], queries: DataFrame, k: int, recall: float, *, most: int = 200, query_id: str = "query_id", query: str = "query") -> int:
    """The least number of lists to probe that finds this share of the k nearest vectors of the first ``most`` queries, by an exact search."""
    sample = materialise(queries.orderBy(query_id).limit(most))
    exact = top_k_each(index, sample, k, query_id=query_id, query=query).join(index.select("vec_id", "list_id"), "vec_id").select("query_id", "list_id").collect()
    lists = np.array(centres, np.float64)
    place = {r[query_id]: np.argsort(np.argsort(-(lists @ np.array(r[query], np.float64)), kind="stable"), kind="stable") for r in sample.collect()}
    needed = np.sort([int(place[r["query_id"]][r["list_id"]]) + 1 for r in exact])
    return int(needed[min(len(needed) - 1, math.ceil(recall * len(needed)) - 1)]) if len(needed) else len(centres)


def count(index: DataFrame) -> int:
    return index.count()
