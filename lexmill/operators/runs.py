"""State of ingest: checkpoints by file and runs, both kept as appended transitions whose latest row counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

IN_PROGRESS, DONE, FAILED = "in_progress", "done", "failed"
ERROR_LENGTH = 2000
CHECKPOINT = "file_path string, status string, case_id string, error string, processed_at timestamp_ntz"
RUNS = "run_id string, status string, total_files int, processed_files int, failed_files int, skipped_files int, started_at timestamp_ntz, completed_at timestamp_ntz, error_log string, at timestamp_ntz"


def latest(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key; combined in each task before it moves."""
    values = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_v")).select(*[F.col(key) if c == key else F.col(f"_v.{c}").alias(c) for c in rows.columns])


def transitions(files: DataFrame, status: str, *, case_id=None, error=None, now=None) -> DataFrame:
    """Checkpoint rows that put each file_path of ``files`` in a state."""
    now = now if now is not None else F.current_timestamp().cast("timestamp_ntz")
    return files.select(
        "file_path", F.lit(status).alias("status"), (case_id if case_id is not None else F.lit(None)).cast("string").alias("case_id"),
        F.substring((error if error is not None else F.lit(None)).cast("string"), 1, ERROR_LENGTH).alias("error"), now.alias("processed_at"),
    )


def merge_checkpoint(checkpoint: DataFrame, rows: DataFrame) -> DataFrame:
    """Each file's row replaced by its new one."""
    return checkpoint.join(rows.select("file_path"), "file_path", "left_anti").unionByName(rows)


def unprocessed(files: DataFrame, checkpoint: DataFrame, retry_failed: bool = False) -> DataFrame:
    """Files that are not done, nor failed unless these are tried again."""
    skip = checkpoint.where(F.col("status").isin([DONE] if retry_failed else [DONE, FAILED]))
    return files.join(skip.select("file_path"), "file_path", "left_anti")


def status_counts(checkpoint: DataFrame) -> DataFrame:
    return checkpoint.groupBy("status").agg(F.count("*").alias("n"))


def run_state(events: DataFrame, run_id: str | None = None) -> DataFrame:
    """The latest state of each run, or of one."""
    rows = events if run_id is None else events.where(F.col("run_id") == run_id)
    return latest(rows, "run_id", ["at"])


def summary(files: DataFrame, vectors: int) -> DataFrame:
    """One row over files with a ``state`` (processed, skipped, failed): the counts and the vectors."""
    state = lambda s: F.count(F.when(F.col("state") == s, 1)).alias(s)
    return files.agg(F.count("*").alias("total"), *map(state, ("processed", "skipped", "failed"))).withColumn("vectors", F.lit(vectors).cast("long"))
