"""Keyed tables without a database: existence, upsert, lookups, unique keys, cascading deletes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def existing(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """The rows whose key is in the table."""
    return rows.join(table.select(key), key, "left_semi")


def missing(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    return rows.join(table.select(key), key, "left_anti")


def upsert(table: DataFrame, rows: DataFrame, key: str, *, now=None, created: str = "created_at", updated: str = "updated_at") -> DataFrame:
    """The table after each row was inserted or has overwritten the one with its key, keeping when that was created.

    ``rows`` has each key once and the table's columns but for the two times. One full join, so both sides move once.
    """
    now = now if now is not None else F.current_timestamp().cast("timestamp_ntz")
    values = [c for c in table.columns if c not in (key, created, updated)]
    new = rows.select(F.col(key).alias("_key"), F.struct(*values).alias("_new"))
    old = table.select(F.col(key).alias("_old_key"), F.struct(*table.columns).alias("_old"))
    both = old.join(new, F.col("_key") == F.col("_old_key"), "full")
    given = F.col("_key").isNotNull()
    out = {key: F.coalesce("_key", "_old_key")}
    out |= {c: F.when(given, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")) for c in values}
    out[created] = F.coalesce(f"_old.{created}", now)
    out[updated] = F.when(given, now).otherwise(F.col(f"_old.{updated}"))
    return both.select(*[out[c].alias(c) for c in table.columns])


def lookup(table: DataFrame, key: str, value) -> DataFrame:
    return table.where(F.col(key) == value)


def in_list(table: DataFrame, key: str, values: list) -> DataFrame:
    """Rows whose key is in a list that the caller holds."""
    return table.where(F.col(key).isin(list(values)))


def first_of_key(rows: DataFrame, key: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that come first with their key, and the rest, each with ``_rank``."""
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank"), ranked.where("_rank > 1")


def delete_cascade(parents: DataFrame, children: DataFrame, gone: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Both tables without the keys in ``gone``."""
    return missing(parents, gone, key), missing(children, gone, key)


def chunks_of(chunks: DataFrame, case_id: str) -> DataFrame:
    return chunks.where(F.col("case_id") == case_id).orderBy("chunk_index")


def chunks_by_vector(chunks: DataFrame, vec_ids: list[int]) -> DataFrame:
    return chunks.where(F.col("vec_id").isin(list(vec_ids)))


def replace_children(children: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """All children of the keys in ``rows`` replaced by those rows."""
    return missing(children, rows.select(key).distinct(), key).unionByName(rows)


def fill_vector_ids(chunks: DataFrame, index: DataFrame) -> DataFrame:
    """Chunks with the vector of their (case_id, chunk_index), -1 where there is none."""
    ids = index.select("case_id", "chunk_index", F.col("vec_id").alias("_vec"))
    return chunks.drop("vec_id").join(ids, ["case_id", "chunk_index"], "left").withColumn("vec_id", F.coalesce("_vec", F.lit(-1).cast("long"))).drop("_vec")


def counts(**tables: DataFrame) -> DataFrame:
    """One row with the number of rows of each table."""
    out = None
    for name, t in tables.items():
        one = t.agg(F.count("*").alias(name))
        out = one if out is None else out.join(F.broadcast(one))
    return out
