"""Incremental ingest: a file stream whose micro-batches go through the same plan as a batch run.

The stream's own log keeps files from being read twice; the store's checkpoint knows what failed and may be tried again
by a batch run. A batch that is repeated after a crash replaces what it wrote before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexmill.config import Settings
from lexmill.operators import runs
from lexmill.plans.ingest import process
from lexmill.sources import pdf
from lexmill.sources.store import Store

FILES = "path string, modificationTime timestamp, length long, content binary"


def watch(spark: SparkSession, store: Store, pdf_dir: str, checkpoint_dir: str, settings: Settings | None = None, *, available_now: bool = True, files_per_batch: int = 1000) -> StreamingQuery:
    """Start the stream. ``available_now``: ingest what is there and stop; else go on as files arrive."""
    settings = settings or Settings()
    store.create()
    files = (
        spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch).load(pdf_dir)
    )

    def ingest(batch: DataFrame, number: int) -> None:
        own = Store(batch.sparkSession, store.root)
        named = batch.select(F.col("path").alias("file_path"), "content")
        todo = runs.unprocessed(named, own.read("checkpoint"))
        process(own, pdf.extract(todo), settings, run_id=f"stream-{number}")

    query = files.writeStream.foreachBatch(ingest).option("checkpointLocation", checkpoint_dir)
    return (query.trigger(availableNow=True) if available_now else query).start()
