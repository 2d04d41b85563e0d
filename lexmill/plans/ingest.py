"""Ingest: files to cases, chunks and vectors, resumable by file, committed at once.

One run: discover, cut to a limit, drop what the checkpoint says is done, extract, clean, read metadata, keep the first file
of each case, chunk, embed, index; then what changed of cases, chunks, index and checkpoint is published together. A file is
"done" only with its vectors. Content that was ingested before, under any path, replaces its case's chunks and vectors.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.config import Settings
from lexmill.operators import chunk, clean, embed, index, keyed, metadata, runs
from lexmill.session import materialise
from lexmill.sources import pdf
from lexmill.sources.store import Change, Store

NOW = "timestamp_ntz"


def documents(raw: DataFrame) -> DataFrame:
    """Raw documents with clean text, metadata and a state: ok, or failed with a reason."""
    cleaned = clean.clean(raw)
    read = metadata.extract(cleaned)
    reason = F.when(~F.col("success"), F.coalesce("extraction_error", F.lit("extraction failed"))).when(F.col("raw_text") == "", F.lit("no text")).when(F.col("is_empty"), F.lit("too little text after cleaning"))
    return read.withColumn("reason", reason)


def process(store: Store, raw: DataFrame, settings: Settings, *, run_id: str, embedding: Callable[[Column], Column] = embed.hashed_embedding) -> dict[str, int]:
    """Ingest raw documents into the store and commit; the numbers of processed and failed files, and of all vectors."""
    now = F.current_timestamp().cast(NOW)
    docs = materialise(documents(raw))
    good = docs.where("reason is null")
    # The same bytes under two paths are one document; a case number that another file has is that file's.
    by_hash, twins = keyed.first_of_key(good, "file_hash", ["file_path"])
    cases_now = store.read("cases")
    known = cases_now.select(F.col("case_id"), F.col("file_hash").alias("_known"))
    taken = by_hash.join(known, "case_id").where(F.col("file_hash") != F.col("_known")).select("file_path", "case_id")
    fresh, rivals = keyed.first_of_key(by_hash.join(taken.select("file_path"), "file_path", "left_anti"), "case_id", ["file_path"])
    fresh = materialise(fresh)

    value_columns = [c for c in cases_now.columns if c not in ("created_at", "updated_at")]
    # Only rows that change are written: those of files that were there before keep their time of creation.
    cases = keyed.upsert(keyed.existing(cases_now, fresh, "file_hash"), fresh.select(*value_columns), "file_hash", now=now)
    made = chunk.chunk(fresh, size=settings.chunk_size, overlap=settings.chunk_overlap).withColumn("created_at", now)
    # A file whose content has changed its case's name leaves the old name's chunks behind: they go as well.
    renamed = cases_now.join(fresh.select("file_hash"), "file_hash", "left_semi").select("case_id")
    gone = materialise(fresh.select("case_id").unionByName(renamed).distinct())
    embedded = embed.embed(made, embedding=embedding)
    first = store.read("index").agg(F.coalesce(F.max("vec_id") + 1, F.lit(0).cast("long")).alias("n")).first()["n"]
    centres = [r["centre"] for r in store.read("centres").orderBy("list_id").collect()]
    new_index = materialise(index.assign_lists(index.build_flat(embedded, first).drop("list_id"), centres))
    new_chunks = keyed.fill_vector_ids(made, new_index)

    failed = docs.where("reason is not null").select("file_path", F.col("reason").alias("error"))
    clash = lambda rows: rows.select("file_path", F.concat(F.lit("case_id of another file: "), F.col("case_id")).alias("error"))
    failed = materialise(failed.unionByName(clash(taken)).unionByName(clash(rivals)))
    done = fresh.select("file_path", "case_id").unionByName(twins.select("file_path", "case_id"))
    states = runs.transitions(done, runs.DONE, case_id=F.col("case_id")).unionByName(runs.transitions(failed, runs.FAILED, error=F.col("error")))
    states = materialise(states)
    store.commit({
        "cases": Change(materialise(cases), "file_hash", fresh), "chunks": Change(new_chunks, "case_id", gone), "index": Change(new_index, "case_id", gone),
        "checkpoint": Change(states, "file_path", states),
    })
    if settings.n_lists and not centres:
        rebuild_lists(store, settings.n_lists)
    row = states.agg(F.count(F.when(F.col("status") == runs.DONE, 1)).alias("processed"), F.count(F.when(F.col("status") == runs.FAILED, 1)).alias("failed")).first()
    return {"processed": row["processed"], "failed": row["failed"], "vectors": store.read("index").count()}


def _run_row(spark: SparkSession, run_id: str, status: str, total: int, processed: int = 0, failed: int = 0, skipped: int = 0, error: str | None = None) -> DataFrame:
    now = F.current_timestamp().cast(NOW)
    ended = now if status in ("completed", "failed") else F.lit(None).cast(NOW)
    started = now if status == "running" else F.lit(None).cast(NOW)
    text = F.lit(error).cast("string")
    return spark.range(1).select(
        F.lit(run_id).alias("run_id"), F.lit(status).alias("status"), F.lit(total).alias("total_files"), F.lit(processed).alias("processed_files"), F.lit(failed).alias("failed_files"), F.lit(skipped).alias("skipped_files"),
        started.alias("started_at"), ended.alias("completed_at"), F.substring(text, 1, runs.ERROR_LENGTH).alias("error_log"), now.alias("at"),
    )


def record_run(store: Store, *args, **values) -> None:
    """Append a state of a run; earlier states keep the start where a later one has none."""
    row = _run_row(store.spark, *args, **values)
    events = store.read("runs")
    begun = events.where(F.col("run_id") == args[0]).agg(F.min("started_at").alias("_begun"))
    row = row.join(F.broadcast(begun)).withColumn("started_at", F.coalesce("started_at", "_begun")).drop("_begun")
    store.commit({"runs": Change(materialise(row))})


def run(spark: SparkSession, store: Store, pdf_dir: str, settings: Settings | None = None, *, limit: int | None = None, retry_failed: bool = False, run_id: str | None = None, cascade=pdf.CASCADE, embedding: Callable[[Column], Column] = embed.hashed_embedding) -> dict:
    """One ingest of a folder. Returns the summary: run_id, total, processed, skipped, failed, vectors."""
    settings = settings or Settings()
    run_id = run_id or uuid.uuid4().hex
    store.create()
    found = materialise(pdf.discover(spark, pdf_dir, limit))
    todo = materialise(runs.unprocessed(found, store.read("checkpoint"), retry_failed))
    total, open_ = found.count(), todo.count()
    summary = {"run_id": run_id, "total": total, "processed": 0, "skipped": total - open_, "failed": 0, "vectors": store.read("index").count()}
    if not open_:
        return summary
    record_run(store, run_id, "running", open_, skipped=summary["skipped"])
    spark.sparkContext.setJobGroup(run_id, f"ingest of {pdf_dir}")
    try:
        summary |= process(store, pdf.extract(pdf.load(spark, pdf_dir, todo), cascade), settings, run_id=run_id, embedding=embedding)
    except Exception as e:
        record_run(store, run_id, "failed", open_, skipped=summary["skipped"], error=str(e))
        raise
    record_run(store, run_id, "completed", open_, processed=summary["processed"], failed=summary["failed"], skipped=summary["skipped"])
    return summary


def rebuild_lists(store: Store, n_lists: int) -> int:
    """Train inverted lists on the whole index and store it by list; the number of lists (0: too few vectors, flat).

    An ingest does this by itself once there are ``Settings.n_lists`` vectors; later vectors join the lists that are there.
    """
    rows = store.read("index")
    centres = index.train_lists(rows, n_lists)
    if not centres:
        return 0
    table = store.spark.createDataFrame([(k, c) for k, c in enumerate(centres)], "list_id int, centre array<double>")
    store.commit({"index": materialise(index.assign_lists(rows, centres)), "centres": table})
    return len(centres)
