"""The engine as Python functions: search, ingest, run status, statistics, cases, health."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.config import Settings
from lexmill.operators import embed, index, keyed, runs
from lexmill.operators import search as searching
from lexmill.plans import ingest
from lexmill.sources.store import Store


class NotFound(LookupError):
    """No such case or run."""


class Engine:
    def __init__(self, spark: SparkSession, store: str | None = None, settings: Settings | None = None, embedding: Callable[[Column], Column] = embed.hashed_embedding):
        self.spark, self.settings, self.embedding = spark, settings or Settings.load(), embedding
        self.store = Store(spark, store or f"{self.settings.data_dir}/store")
        self.store.create()

    def health(self) -> dict:
        return {"status": "ok"}

    def stats(self) -> DataFrame:
        """One row: cases, chunks, vectors, model, dimension."""
        counted = keyed.counts(cases=self.store.read("cases"), chunks=self.store.read("chunks"), vectors=self.store.read("index"))
        return counted.select("*", F.lit(getattr(self.embedding, "__name__", "custom")).alias("model"), F.lit(self.settings.embedding_dim).alias("dim"))

    def search(self, request: searching.Request) -> DataFrame:
        """One row: query, total_hits, results. Reads one snapshot of the store and writes nothing."""
        vector = embed.query_vector(self.spark, request.query, self.embedding)
        centres = [r["centre"] for r in self.store.read("centres").orderBy("list_id").collect()]
        lists = index.probed_lists(centres, vector, self.settings.n_probe) if centres else None
        hits = searching.search(self.store.read("index"), self.store.read("chunks"), self.store.read("cases"), request, vector, lists)
        return searching.response(request.query, hits)

    def case(self, case_id: str) -> DataFrame:
        """The case's row, or NotFound."""
        found = keyed.lookup(self.store.read("cases"), "case_id", case_id)
        if found.isEmpty():
            raise NotFound(case_id)
        return found.select(*searching.SNIPPET, "page_count", "word_count")

    def start_ingest(self, pdf_dir: str, *, limit: int | None = None, retry_failed: bool = False, wait: bool = False) -> dict:
        """Start an ingest; its run_id and the number of files it will look at."""
        from lexmill.sources import pdf

        path = self.spark._jvm.org.apache.hadoop.fs.Path(pdf_dir)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            raise ValueError(f"no such folder: {pdf_dir}")
        run_id, files = uuid.uuid4().hex, pdf.discover(self.spark, pdf_dir, limit).count()
        job = lambda: ingest.run(self.spark, self.store, pdf_dir, self.settings, limit=limit, retry_failed=retry_failed, run_id=run_id, embedding=self.embedding)
        if wait:
            job()
        else:
            threading.Thread(target=job, daemon=True, name=f"ingest-{run_id}").start()
        return {"run_id": run_id, "total_files": files, "status": "accepted"}

    def run_status(self, run_id: str) -> DataFrame:
        found = runs.run_state(self.store.read("runs"), run_id)
        if found.isEmpty():
            raise NotFound(run_id)
        return found
