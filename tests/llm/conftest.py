import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of texts, with extra columns whose names operators use inside."""

    def make(texts, start=0, extra=True, lang="en", source="src0"):
        rows = [(start + k, t, lang, source, len(t or "")) for k, t in enumerate(texts)]
        df = spark.createDataFrame(rows, DOCS)
        return df.withColumns({c: F.lit("x") for c in ("_key", "_text", "score", "kind", "path", "spans", "root")}) if extra else df

    return make
