"""A corpus pipeline of five operators: quality, near duplicates, decontamination, secrets, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet in the shared
folder and rereads it as the next stage's documents, so a lost executor costs a stage's tasks at most. All stages but the
last return the columns of ``documents``. The last adds ``mix_epochs`` (whole copies) and ``mix_tokens`` (tokens of all
copies and the part), in place of columns of these names; texts stay whole, and ``mixing.epoch_texts`` makes the stream of
copies and prefixes that the two numbers stand for. The folder of the last stage is the result and stays; those before it
are deleted.

Null and empty texts pass every stage but mixing, where a document without tokens is in no prefix. Rows with a null key are
scored, compared and mixed as any other. Repeated rows are copies, of which one stays. Extra columns are kept, whatever
their names. Empty tables give an empty result with all columns; without labels the classifier keeps all documents, and
without a benchmark all are clean.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import decontaminate, jaccard, mixing, quality, secretscan
from lexmill.llm.common import table
from lexmill.llm.queries import domain_of
from lexmill.session import shared_folder

# Languages to target weights, domains and sources by their tokens; nine tenths of the words that come in are taken.
WEIGHTS = {"lang": {"en": 5.5, "de": 1.5, "fr": 1.5, "es": 1.5}}
SHARE = 0.9
MAX_EPOCHS = 2

#: Settings for the many small plans of a stage: the driver compiles no code for them only to see that it compiles, and keeps no long texts of them.
SMALL_PLANS = {"spark.sql.codegen.wholeStage": "false", "spark.sql.maxPlanStringLength": "1000"}
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _small_plans(stage: Stage) -> Stage:
    """``stage`` with SMALL_PLANS while it works out what its result is made of; the result itself runs as the caller has set."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        before = {k: spark.conf.get(k, None) for k in SMALL_PLANS}
        for k, v in SMALL_PLANS.items():
            spark.conf.set(k, v)
        try:
            return stage(spark, docs, sf_dir)
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)

    return run_stage


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. It is fitted on the labelled rows of ``documents`` as they came."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


@_small_plans
def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates one row stays, under the smallest key; rows without a key are compared as well."""
    return jaccard.one_of_each(docs, nulls_apart=False)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts, whose lengths are counted anew."""
    redacted = secretscan.redacted(docs)
    return redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else redacted


@_small_plans
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each leaf of the tree of domains, languages and sources gives a prefix of its tokens."""
    return mixing.mixed_documents(docs, domain=domain_of(F.col("source")), budget_share=SHARE, weights=WEIGHTS, max_epochs=MAX_EPOCHS)


STAGES = [
    ("quality", classify),
    ("near_duplicates", deduplicate),
    ("decontamination", remove_benchmark),
    ("secrets", remove_secrets),
    ("mixing", mix),
]

# A fitted classifier has no SQL: tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}-{name}")
        docs = spark.read.parquet(f"{base}/{k}-{name}")
        if k:
            _remove(spark, f"{base}/{k - 1}-{STAGES[k - 1][0]}")
    return docs


def _remove(spark: SparkSession, folder: str) -> None:
    """Delete a stage's result once the next one is written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
