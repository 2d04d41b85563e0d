"""Search: nearest chunks, joined with their texts and cases, filtered by metadata, ranked and cut."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.operators.index import top_k

OVERSAMPLE = 5


class IndexEmptyError(RuntimeError):
    """Raised where a search meets an index without vectors."""


def _any_contains(values: Column, part: str) -> Column:
    return F.exists(values, lambda x: F.contains(F.lower(x), F.lit(part.lower())))


@dataclass(frozen=True)
class Filters:
    """Conditions on cases. An unset one, and one on a field that a case lacks, lets the case through."""

    year_from: int | None = None
    year_to: int | None = None
    case_type: str | None = None
    outcome: str | None = None
    judge_name: str | None = None
    act_cited: str | None = None

    def __post_init__(self) -> None:
        for y in (self.year_from, self.year_to):
            if y is not None and not 1950 <= y <= 2024:
                raise ValueError("years lie from 1950 to 2024")

    def condition(self) -> Column:
        tests = [F.lit(True)]
        if self.year_from:
            tests.append((F.coalesce("year", F.lit(0)) == 0) | (F.col("year") >= self.year_from))
        if self.year_to:
            tests.append((F.coalesce("year", F.lit(0)) == 0) | (F.col("year") <= self.year_to))
        for name, value in (("case_type", self.case_type), ("outcome", self.outcome)):
            if value:
                tests.append((F.coalesce(name, F.lit("")) == "") | F.contains(F.lower(name), F.lit(value.lower())))
        for name, value in (("judges", self.judge_name), ("acts_cited", self.act_cited)):
            if value:
                tests.append((F.coalesce(F.size(name), F.lit(0)) <= 0) | _any_contains(F.col(name), value))
        out = tests[0]
        for t in tests[1:]:
            out = out & t
        return out


@dataclass(frozen=True)
class Request:
    query: str
    top_k: int = 10
    filters: Filters = field(default_factory=Filters)
    include_chunk_text: bool = True
    mode: str = "post"

    def __post_init__(self) -> None:
        if len(self.query) < 3:
            raise ValueError("a query has at least 3 characters")
        if not 1 <= self.top_k <= 50:
            raise ValueError("top_k is from 1 to 50")
        if self.mode not in ("post", "pre"):
            raise ValueError("mode is post or pre")


SNIPPET = ("case_id", "case_number", "case_type", "year", "judgment_date", "petitioner", "respondent", "bench", "judges", "outcome", "acts_cited", "citations", "file_name", "extraction_confidence")
LISTS = ("judges", "acts_cited", "citations")


def snippet_fields() -> list[Column]:
    """The fields of a case as a search result shows them: dates as text, no list null."""
    shown = {c: F.col(c) for c in SNIPPET}
    shown |= {c: F.coalesce(c, F.array().cast("array<string>")) for c in LISTS}
    shown["judgment_date"] = F.col("judgment_date").cast("string")
    return [v.alias(c) for c, v in shown.items()]


def snippet() -> Column:
    return F.struct(*snippet_fields())


def search(index: DataFrame, chunks: DataFrame, cases: DataFrame, request: Request, vector: list[float], lists: list[int] | None = None) -> DataFrame:
    """Hits: rank, score, case, chunk_index, chunk_text.

    Mode "post" takes the nearest 5 * top_k chunks and filters those, so it may give fewer than top_k though more match;
    mode "pre" filters the cases first and ranks all their chunks.
    """
    if index.isEmpty():
        raise IndexEmptyError("the index has no vectors: ingest documents first")
    if request.mode == "pre":
        allowed = cases.where(request.filters.condition()).select("case_id")
        index = index.join(allowed, "case_id", "left_semi")
        near = top_k(index, vector, request.top_k, lists)
    else:
        near = top_k(index, vector, request.top_k * OVERSAMPLE, lists)
    # At most 5 * 50 rows.
    near = F.broadcast(near.select("vec_id", "score"))
    joined = chunks.select("vec_id", "case_id", "chunk_index", "text").join(near, "vec_id")
    with_case = cases.select(*SNIPPET).join(F.broadcast(joined), "case_id")
    kept = with_case if request.mode == "pre" else with_case.where(request.filters.condition())
    best = kept.orderBy(F.desc("score"), "vec_id").limit(request.top_k)
    ranked = best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "vec_id")))
    text = F.col("text") if request.include_chunk_text else F.lit(None).cast("string")
    return ranked.select("rank", F.round("score", 4).alias("score"), snippet().alias("case"), "chunk_index", text.alias("chunk_text"))


def response(query: str, hits: DataFrame) -> DataFrame:
    """One row: the query, the number of hits returned (not of all that match) and the hits in order."""
    own = F.array_sort(F.collect_list(F.struct("rank", "score", "case", "chunk_index", "chunk_text")))
    return hits.agg(F.count("*").alias("total_hits"), own.alias("results")).select(F.lit(query).alias("query"), "total_hits", "results")
