"""The registered queries of the document engine and their SQL in DuckDB's dialect."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import text as tx
from lexmill.operators import chunk, clean, embed, index, keyed, metadata, runs
from lexmill.operators import search as searching
from lexmill.plans import fixtures
from lexmill.plans.fixtures import dirty_documents, judgments
from lexmill.session import dealt, materialise
from lexmill.sources import pdf

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
AS_OF = 2026
K = 10


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return dealt(rows) if name in ("documents", "pages") else rows


# --- SQL pieces -------------------------------------------------------------------------------------------------


def _lit(pattern: str) -> str:
    """A pattern as an SQL string; Java's d flag has no name in RE2, where it holds always."""
    for a, b in (("(?md)", "(?m)"), ("(?imd)", "(?im)"), ("(?id)", "(?i)")):
        pattern = pattern.replace(a, b)
    return "'" + pattern.replace("'", "''") + "'"


def _sub(x: str, pattern: str, to: str) -> str:
    return f"regexp_replace({x}, {_lit(pattern)}, {_lit(to)}, 'g')"


def _find(x: str, pattern: str, group: int = 0) -> str:
    return f"CASE WHEN regexp_matches({x}, {_lit(pattern)}) THEN regexp_extract({x}, {_lit(pattern)}, {group}) END"


def _strip(x: str) -> str:
    return _sub(x, tx.rx(r"^\s+|\s+\z"), "")


def _squeeze(x: str) -> str:
    return _strip(_sub(x, tx.rx(r"\s+"), " "))


def _words(x: str) -> str:
    return f"len(regexp_extract_all({x}, {_lit(tx.rx(chr(92) + 'S+'))}))"


def _distinct(x: str, pattern: str) -> str:
    """Matches joined by bars, each once regardless of case."""
    found = f"list_transform(regexp_extract_all({x}, {_lit(pattern)}), lambda f: {_squeeze('f')})"
    return f"(SELECT coalesce(string_agg(v, '|' ORDER BY i), '') FROM (SELECT v, i, row_number() OVER (PARTITION BY upper(v) ORDER BY i) AS r FROM (SELECT unnest(l) AS v, generate_subscripts(l, 1) AS i FROM (SELECT {found} AS l))) WHERE r = 1)"


def _initcap(x: str) -> str:
    return f"array_to_string(list_transform(string_split({x}, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"


J = fixtures.in_duckdb(fixtures.JUDGMENTS_SQL)
D = fixtures.in_duckdb(fixtures.DIRTY_SQL)
_CONTROLS, _NEWLINES = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", r"\r\n?"


def _specials(x: str) -> str:
    for a, b in clean.SPECIAL.items():
        x = f"replace({x}, '{a}', {_lit(b)})"
    return x


def _boilerplate(x: str) -> str:
    return reduce(lambda s, p: _sub(s, p, " "), clean.BOILERPLATE, x)


def _hyphens(x: str) -> str:
    return _sub(x, r"([\p{L}\p{Nd}_])-\n([\p{L}\p{Nd}_])", r"\1\2")


def _punctuation(x: str) -> str:
    return reduce(lambda s, r: _sub(s, r[0], r[1]), clean.RUNS, x)


def _space(x: str) -> str:
    return _strip(_sub(_sub(_sub(x, r"[ \t]+", " "), clean.LINE_ENDS, ""), r"\n{3,}", "\n\n"))


def _cleaned(x: str) -> str:
    return _space(_punctuation(_hyphens(_boilerplate(_specials(f"nfc_normalize({_sub(_sub(x, _CONTROLS, ''), _NEWLINES, chr(10))})")))))


# --- extraction and cleaning ------------------------------------------------------------------------------------


@query("SELECT doc_id, sha256(text) AS file_hash, octet_length(encode(text)) AS bytes FROM documents")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = F.encode("text", "UTF-8")
    return _t(spark, sf_dir, "documents").select("doc_id", F.sha2(content, 256).alias("file_hash"), F.octet_length(content).cast("long").alias("bytes"))


@query(f"SELECT doc_id, length({_sub('text', tx.rx(chr(92) + 's+'), '')}) >= {pdf.LEAST_CHARACTERS} AS sufficient FROM documents")
def extract_sufficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").select("doc_id", pdf.sufficient_text(F.col("text")).alias("sufficient"))


@query(
    f"""SELECT 'page/' || page_id AS file_path, CAST(page_id AS VARCHAR) AS file_name, CAST(CASE WHEN ok THEN 1 ELSE 0 END AS INT) AS page_count, CASE WHEN ok THEN 'untag' ELSE 'failed' END AS extraction_method,
    sha256(html) AS file_hash, ok AS success, CAST(CASE WHEN ok THEN length(t) ELSE 0 END AS INT) AS n_chars
    FROM (SELECT *, length({_sub('t', tx.rx(chr(92) + 's+'), '')}) >= {pdf.LEAST_CHARACTERS} AS ok FROM (SELECT *, regexp_replace(html, '<[^>]*>', ' ', 'g') AS t FROM pages))"""
)
def extract_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cascade over the bytes of web pages: the first extractor wants a PDF file and fails, the next takes tags out."""
    files = _t(spark, sf_dir, "pages").select(F.concat(F.lit("page/"), F.col("page_id")).alias("file_path"), F.encode("html", "UTF-8").alias("content"))
    return pdf.extract(files, (("builtin", pdf.builtin_text), ("untag", untagged))).select("file_path", "file_name", "page_count", "extraction_method", "file_hash", "success", F.length("raw_text").alias("n_chars"))


def untagged(content: bytes) -> tuple[str, int]:
    import re

    return re.sub(rb"<[^>]*>", b" ", content).decode(), 1


@query(f"SELECT doc_id, {_sub(_sub('text', _CONTROLS, ''), _NEWLINES, chr(10))} AS text FROM ({D})")
def clean_control_newlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_documents(spark, sf_dir).select("doc_id", clean.unify_newlines(clean.strip_controls(F.col("text"))).alias("text"))


@query(f"SELECT doc_id, {_specials('text')} AS text FROM ({D})")
def clean_special_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_documents(spark, sf_dir).select("doc_id", clean.fold_special(F.col("text")).alias("text"))


@query(f"SELECT doc_id, nfc_normalize(text) AS text FROM ({D})")
def clean_nfc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_documents(spark, sf_dir).select("doc_id", tx.nfc(F.col("text")).alias("text"))


@query(f"SELECT doc_id, {_boilerplate('text')} AS text FROM ({J})")
def clean_boilerplate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judgments(spark, sf_dir).select("doc_id", clean.strip_boilerplate(F.col("text")).alias("text"))


@query(f"SELECT doc_id, {_hyphens('text')} AS text FROM ({D})")
def clean_hyphen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_documents(spark, sf_dir).select("doc_id", clean.join_hyphens(F.col("text")).alias("text"))


@query(f"SELECT doc_id, {_punctuation('text')} AS text FROM ({D})")
def clean_punct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_documents(spark, sf_dir).select("doc_id", clean.collapse_punctuation(F.col("text")).alias("text"))


@query(f"SELECT doc_id, {_space('text')} AS text FROM ({D})")
def clean_whitespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_documents(spark, sf_dir).select("doc_id", clean.normalise_space(F.col("text")).alias("text"))


@query(f"SELECT doc_id, {_cleaned('text')} AS clean_text FROM ({D})")
def clean_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean(dirty_documents(spark, sf_dir), "text").select("doc_id", "clean_text")


@query(f"SELECT doc_id, {_words('t')} AS word_count, length(t) AS char_count, {_words('t')} < {clean.EMPTY_BELOW} AS is_empty FROM (SELECT doc_id, {_cleaned('text')} AS t FROM ({J}))")
def clean_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = clean.clean(judgments(spark, sf_dir), "text")
    return done.select("doc_id", F.col("word_count").cast("long").alias("word_count"), F.col("char_count").cast("long").alias("char_count"), "is_empty")


# --- metadata ---------------------------------------------------------------------------------------------------

_NUMBER = _squeeze(_find("text", metadata.CASE_NUMBER))
_YEAR = f"""CAST(coalesce(regexp_extract_all(coalesce({_NUMBER}, ''), {_lit(metadata.YEAR)}, 1)[-1], regexp_extract_all(substr(text, 1, 500), {_lit(metadata.YEAR)}, 1)[1]) AS INT)"""
_N = f"(SELECT *, {_NUMBER} AS number, {_YEAR} AS y FROM ({J}))"
_SLUG = _sub(_sub("lower(number)", "[^a-z0-9]+", "_"), "^_+|_+$", "")
_TYPE_TEXT = "(coalesce(number, '') || chr(10) || substr(text, 1, 2000))"
_TYPE = "CASE " + " ".join(f"WHEN regexp_matches({_TYPE_TEXT}, {_lit(tx.rx(p, 'i'))}) THEN '{name}'" for p, name in metadata.CASE_TYPES) + " END"
_OUTCOME = _initcap(_squeeze("coalesce(" + ", ".join(_find("right(text, 2000)", tx.rx(p, "i"), 1) for p in metadata.OUTCOMES) + ")"))
_PETITIONER = _squeeze(_find("substr(text, 1, 3000)", metadata.party_pattern(metadata.PETITIONER_ROLES), 1))
_RESPONDENT = _squeeze(_find("substr(text, 1, 3000)", metadata.party_pattern(metadata.RESPONDENT_ROLES), 1))


@query(f"SELECT doc_id, number AS case_number FROM {_N}")
def meta_case_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judgments(spark, sf_dir).select("doc_id", metadata.case_number(F.col("text")).alias("case_number"))


@query(f"SELECT doc_id, y AS year FROM {_N}")
def meta_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judgments(spark, sf_dir).withColumn("number", metadata.case_number(F.col("text")))
    return rows.select("doc_id", metadata.year(F.col("number"), F.col("text")).alias("year"))


@query(f"SELECT doc_id, CASE WHEN number IS NOT NULL AND y IS NOT NULL THEN substr(CASE WHEN ends_with({_SLUG}, CAST(y AS VARCHAR)) THEN {_SLUG} ELSE {_SLUG} || '_' || y END, 1, 120) ELSE 'sha_' || substr(file_hash, 1, 16) END AS case_id FROM {_N}")
def meta_case_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judgments(spark, sf_dir).withColumn("number", metadata.case_number(F.col("text"))).withColumn("y", metadata.year(F.col("number"), F.col("text")))
    return rows.select("doc_id", metadata.case_id(F.col("number"), F.col("y"), F.col("file_hash")).alias("case_id"))


@query(f"SELECT doc_id, {_TYPE} AS case_type FROM {_N}")
def meta_case_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judgments(spark, sf_dir).withColumn("number", metadata.case_number(F.col("text")))
    return rows.select("doc_id", metadata.case_type(F.col("number"), F.col("text")).alias("case_type"))


def _full_year(x: str) -> str:
    n = f"(CAST({x} AS INT) + {AS_OF // 100 * 100})"
    return f"CASE WHEN length({x}) = 2 THEN CASE WHEN {n} >= {AS_OF + 50} THEN {n} - 100 WHEN {n} < {AS_OF - 50} THEN {n} + 100 ELSE {n} END ELSE CAST({x} AS INT) END"


_FULL = f"lpad(CAST({_full_year('p[3]')} AS VARCHAR), 4, '0')"
_FULL_FIRST = f"lpad(CAST({_full_year('p[1]')} AS VARCHAR), 4, '0')"
_DATE_SQL = f"""
SELECT doc_id, CAST(CASE WHEN regexp_matches(f, '[A-Za-z]') THEN try_strptime({_sub('f', '^([0-9]+)(?:st|nd|rd|th)', chr(92) + '1')}, '%d %B %Y')
  ELSE coalesce(try_strptime(p[1] || '/' || p[2] || '/' || {_FULL}, '%d/%m/%Y'), try_strptime(p[1] || '/' || p[2] || '/' || {_FULL}, '%m/%d/%Y'),
    CASE WHEN length(p[1]) = 2 AND length(p[3]) = 2 THEN try_strptime({_FULL_FIRST} || '/' || p[2] || '/' || p[3], '%Y/%m/%d') END) END AS DATE) AS judgment_date
FROM (SELECT doc_id, f, string_split({_sub('f', '[.-]', '/')}, '/') AS p FROM (SELECT doc_id, {_find('text', metadata.DATE, 1)} AS f FROM ({J})))
"""


@query(_DATE_SQL)
def meta_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judgments(spark, sf_dir).select("doc_id", metadata.judgment_date(F.col("text"), F.lit(AS_OF)).alias("judgment_date"))


@query(f"SELECT doc_id, {_PETITIONER} AS petitioner, {_RESPONDENT} AS respondent FROM ({J})")
def meta_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return judgments(spark, sf_dir).select("doc_id", metadata.party(t, metadata.PETITIONER_ROLES).alias("petitioner"), metadata.party(t, metadata.RESPONDENT_ROLES).alias("respondent"))


_TITLED = "array_to_string(list_transform(range(1, length(v) + 1), lambda i: CASE WHEN i = 1 OR NOT regexp_matches(v[i - 1], '[A-Za-z]') THEN upper(v[i]) ELSE lower(v[i]) END), '')"


def _names(x: str, pattern: str) -> str:
    found = f"list_filter(list_transform(regexp_extract_all({x}, {_lit(pattern)}, 1), lambda f: {_squeeze('f')}), lambda f: f <> '')"
    return f"list_transform({found}, lambda v: {_TITLED})"


_JUDGES_SQL = f"""(SELECT doc_id, text, array_to_string(CASE WHEN len(a) > 0 THEN a ELSE b END, '|') AS names, CASE WHEN len(a) > 0 THEN a ELSE b END AS l FROM
 (SELECT doc_id, text, list_filter(a0, lambda x, i: list_position(a0, x) = i) AS a, list_filter(b0, lambda x, i: list_position(b0, x) = i) AS b FROM
  (SELECT doc_id, text, {_names(f"coalesce({_find('substr(text, 1, 3000)', metadata.CORAM, 1)}, '')", metadata.JUSTICE_NAME)} AS a0, {_names('substr(text, 1, 3000)', metadata.HONBLE_NAME)} AS b0 FROM ({J}))))"""


@query(f"SELECT doc_id, names AS judges FROM {_JUDGES_SQL}")
def meta_judges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judgments(spark, sf_dir).select("doc_id", F.array_join(metadata.judges(F.col("text")), "|").alias("judges"))


@query(f"SELECT doc_id, CASE WHEN len(l) > 0 THEN array_to_string(l, ' & ') ELSE {_squeeze(_find('substr(text, 1, 3000)', metadata.BENCH, 1))} END AS bench FROM {_JUDGES_SQL}")
def meta_bench(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judgments(spark, sf_dir).withColumn("judges", metadata.judges(F.col("text")))
    return rows.select("doc_id", metadata.bench(F.col("text"), F.col("judges")).alias("bench"))


@query(f"SELECT doc_id, {_OUTCOME} AS outcome FROM ({J})")
def meta_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judgments(spark, sf_dir).select("doc_id", metadata.outcome(F.col("text")).alias("outcome"))


@query(f"SELECT doc_id, {_distinct('text', metadata.ACTS)} AS acts_cited FROM ({J})")
def meta_acts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judgments(spark, sf_dir).select("doc_id", F.array_join(tx.find_distinct(F.col("text"), metadata.ACTS), "|").alias("acts_cited"))


@query(f"SELECT doc_id, {_distinct('text', metadata.CITATION)} AS citations FROM ({J})")
def meta_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judgments(spark, sf_dir).select("doc_id", F.array_join(tx.find_distinct(F.col("text"), metadata.CITATION), "|").alias("citations"))


@query(
    f"""SELECT n.doc_id, round((CASE WHEN number IS NOT NULL THEN 25 ELSE 0 END + CASE WHEN {_TYPE} IS NOT NULL THEN 15 ELSE 0 END + CASE WHEN y IS NOT NULL THEN 10 ELSE 0 END
    + CASE WHEN j.names <> '' THEN 20 ELSE 0 END + CASE WHEN {_OUTCOME.replace('text', 'n.text')} IS NOT NULL THEN 15 ELSE 0 END
    + CASE WHEN {_PETITIONER.replace('text', 'n.text')} IS NOT NULL OR {_RESPONDENT.replace('text', 'n.text')} IS NOT NULL THEN 10 ELSE 0 END
    + CASE WHEN regexp_matches(n.text, {_lit(metadata.CITATION)}) THEN 5 ELSE 0 END) / 100, 2) AS extraction_confidence
    FROM {_N} n JOIN (SELECT doc_id AS jd, names FROM {_JUDGES_SQL}) j ON n.doc_id = j.jd""".replace(_TYPE_TEXT, "(coalesce(number, '') || chr(10) || substr(n.text, 1, 2000))")
)
def meta_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.extract(judgments(spark, sf_dir), text="text", as_of=AS_OF).select("doc_id", "extraction_confidence")


_CLEAN_J = f"WITH jc AS MATERIALIZED (SELECT doc_id, file_path, file_hash, {_cleaned('text')} AS text FROM ({J}))"
_CASE_ID = f"CASE WHEN number IS NOT NULL AND y IS NOT NULL THEN substr(CASE WHEN ends_with({_SLUG}, CAST(y AS VARCHAR)) THEN {_SLUG} ELSE {_SLUG} || '_' || y END, 1, 120) ELSE 'sha_' || substr(file_hash, 1, 16) END"
_BENCH = f"CASE WHEN len(l) > 0 THEN array_to_string(l, ' & ') ELSE {_squeeze(_find('substr(text, 1, 3000)', metadata.BENCH, 1))} END"
_FIELDS = f"""SELECT n.doc_id, {_CASE_ID} AS case_id, number AS case_number, {_TYPE} AS case_type, y AS year, judgment_date, CAST(NULL AS DATE) AS filing_date, {_PETITIONER} AS petitioner, {_RESPONDENT} AS respondent,
    {_BENCH} AS bench, names AS judges, {_distinct('text', metadata.ACTS)} AS acts_cited, {_distinct('text', metadata.CITATION)} AS citations, {_OUTCOME} AS outcome
    FROM {_N} n JOIN (SELECT doc_id AS jd, names, l FROM {_JUDGES_SQL}) ON n.doc_id = jd JOIN (SELECT doc_id AS dd, judgment_date FROM ({_DATE_SQL})) ON n.doc_id = dd""".replace(f"({J})", "jc")


@query(
    f"""{_CLEAN_J} SELECT *, round((CASE WHEN case_number IS NOT NULL THEN 25 ELSE 0 END + CASE WHEN case_type IS NOT NULL THEN 15 ELSE 0 END + CASE WHEN year IS NOT NULL THEN 10 ELSE 0 END + CASE WHEN judges <> '' THEN 20 ELSE 0 END
    + CASE WHEN outcome IS NOT NULL THEN 15 ELSE 0 END + CASE WHEN petitioner IS NOT NULL OR respondent IS NOT NULL THEN 10 ELSE 0 END + CASE WHEN citations <> '' THEN 5 ELSE 0 END) / 100, 2) AS extraction_confidence FROM ({_FIELDS})"""
)
def meta_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fields of all judgments, after cleaning."""
    done = metadata.extract(clean.clean(judgments(spark, sf_dir), "text"), as_of=AS_OF)
    return done.select("doc_id", "case_id", "case_number", "case_type", "year", "judgment_date", "filing_date", "petitioner", "respondent", "bench", F.array_join("judges", "|").alias("judges"), F.array_join("acts_cited", "|").alias("acts_cited"), F.array_join("citations", "|").alias("citations"), "outcome", "extraction_confidence")


# --- chunks -----------------------------------------------------------------------------------------------------


@query(f"SELECT doc_id, CAST({_words('text')} * 135 // 100 AS INT) AS approx_tokens FROM documents")
def approx_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").select("doc_id", tx.approx_tokens(tx.word_count(F.col("text"))).alias("approx_tokens"))


_HARD = chunk.SIZE * chunk.CHARACTERS_A_TOKEN
_HARD_STEP = (chunk.SIZE - chunk.OVERLAP) * chunk.CHARACTERS_A_TOKEN


@query(f"SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS INT) AS chunk_index, c AS text FROM (SELECT doc_id, s, {_strip(f'substr(text, s, {_HARD})')} AS c FROM (SELECT doc_id, text, unnest(range(1, length(text) + 1, {_HARD_STEP})) AS s FROM documents)) WHERE c <> ''")
def chunk_hard_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").select("doc_id", F.posexplode(chunk.hard_chunks(F.col("text"))).alias("chunk_index", "text"))


@query(
    f"""SELECT doc_id, CAST(i AS INT) AS chunk_index, {_strip(f"array_to_string(list_slice(w, i * {chunk.SIZE - chunk.OVERLAP} + 1, i * {chunk.SIZE - chunk.OVERLAP} + n), ' ')")} AS text FROM (
    SELECT doc_id, w, CASE WHEN {_words('t')} * 135 // 100 <= {chunk.SIZE} THEN len(w) ELSE {chunk.SIZE} END AS n,
      unnest(range(CAST(CASE WHEN len(w) = 0 THEN 0 WHEN {_words('t')} * 135 // 100 <= {chunk.SIZE} OR len(w) <= {chunk.SIZE} THEN 1 ELSE 1 + ceil((len(w) - {chunk.SIZE}) / {chunk.SIZE - chunk.OVERLAP}) END AS BIGINT))) AS i
    FROM (SELECT doc_id, replace(text, chr(10), ' ') AS t, list_filter(string_split(replace(text, chr(10), ' '), ' '), lambda x: NOT regexp_matches(x, {_lit(tx.rx('^' + chr(92) + 's*' + chr(92) + 'z'))})) AS w FROM documents))"""
)
def chunk_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spaces as the only separator."""
    return _t(spark, sf_dir, "documents").select("doc_id", F.posexplode(chunk.word_chunks(F.replace(F.col("text"), F.lit("\n"), F.lit(" ")))).alias("chunk_index", "text"))


def _packed(pieces: str, separator: str) -> str:
    """The chunks that packing makes of a list of texts: a fold that holds the open chunk's pieces and their costs."""
    costed = f"list_transform({pieces}, lambda e: {{'t': e, 'c': CAST({_words('e')} * 135 // 100 AS BIGINT)}})"
    glued = lambda x: _strip(f"array_to_string(list_transform({x}, lambda e: e.t), {_lit(separator)})")
    full = f"(acc.held + x.c > {chunk.SIZE} AND len(acc.cur) > 0)"
    # Of a full chunk the next one keeps the longest end that costs no more than the overlap.
    start = f"list_filter(range(1, len(acc.cur) + 2), lambda i: coalesce(list_sum(list_transform(acc.cur[i:], lambda e: e.c)), 0) <= {chunk.OVERLAP})[1]"
    kept = f"CASE WHEN {full} THEN acc.cur[{start}:] ELSE acc.cur END"
    step = f"""(SELECT {{'out': CASE WHEN {full} THEN list_append(acc.out, {glued('acc.cur')}) ELSE acc.out END, 'cur': list_append({kept}, x), 'held': CAST(coalesce(list_sum(list_transform({kept}, lambda e: e.c)), 0) + x.c AS BIGINT)}})"""
    begin = "{'out': CAST([] AS VARCHAR[]), 'cur': CAST([] AS STRUCT(t VARCHAR, c BIGINT)[]), 'held': CAST(0 AS BIGINT)}"
    done = f"list_reduce({costed}, lambda acc, x: {step[8:-1]}, {begin})"
    return f"list_filter(list_transform([{done}], lambda f: list_append(f.out, {glued('f.cur')}))[1], lambda e: e <> '')"


def _split_sql(x: str, level: int = 0) -> str:
    """The chunks of a text that costs more than a chunk, by the separators from ``level`` on."""
    if not chunk.SEPARATORS[level]:
        step = (chunk.SIZE - chunk.OVERLAP) * chunk.CHARACTERS_A_TOKEN
        return f"list_filter(list_transform(range(1, length({x}) + 1, {step}), lambda i: {_strip(f'substr({x}, i, {_HARD})')}), lambda e: e <> '')"
    sep, part = _lit(chunk.SEPARATORS[level]), f"p{level}"
    pieces = f"list_filter(string_split({x}, {sep}), lambda e: {_words('e')} > 0)"
    finer = f"flatten(list_transform({pieces}, lambda {part}: CASE WHEN {_words(part)} * 135 // 100 <= {chunk.SIZE} THEN [{part}] ELSE {_split_sql(part, level + 1)} END))"
    return f"list_transform([{finer}], lambda l{level}: CASE WHEN contains({x}, {sep}) THEN {_packed(f'l{level}', chunk.SEPARATORS[level])} ELSE l{level} END)[1]"


_CHUNKS_SQL = f"""SELECT doc_id, list_filter(CASE WHEN {_words('t')} = 0 THEN [] WHEN {_words('t')} * 135 // 100 <= {chunk.SIZE} THEN [{_strip('t')}] ELSE {_split_sql('t')} END, lambda e: {_words('e')} >= {chunk.LEAST_WORDS}) AS l
    FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)"""


@query(
    f"""SELECT doc_id, CAST(i - 1 AS INT) AS chunk_index, l[i] AS text, CAST(length(l[i]) AS INT) AS char_count, CAST({_words('l[i]')} * 135 // 100 AS INT) AS approx_token_count, CAST(len(l) AS INT) AS total_chunks
    FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM ({_CHUNKS_SQL}))"""
)
def chunk_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.chunk(_t(spark, sf_dir, "documents"), key="doc_id", text="text")


@query(
    f"""SELECT doc_id, CAST(len(l) AS BIGINT) AS chunks, CAST(list_max(list_transform(l, lambda e: {_words('e')} * 135 // 100)) AS INT) AS largest, CAST(list_sum(list_transform(l, lambda e: length(e))) AS BIGINT) AS chars
    FROM ({_CHUNKS_SQL}) WHERE len(l) > 0"""
)
def chunk_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = chunk.chunk(_t(spark, sf_dir, "documents"), key="doc_id", text="text")
    return made.groupBy("doc_id").agg(F.count("*").alias("chunks"), F.max("approx_token_count").alias("largest"), F.sum("char_count").alias("chars"))


# --- embeddings and the index ----------------------------------------------------------------------------------


@query(f"SELECT doc_id, CAST({embed.DIM} AS INT) AS dim, CASE WHEN regexp_matches(coalesce(text, ''), '[\\p{{L}}\\p{{Nd}}]') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS norm FROM documents")
def embed_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = embed.embed(_t(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", F.size("embedding").alias("dim"), F.round(embed.norm(F.col("embedding")), 4).alias("norm"))


@query("SELECT doc_id, regexp_matches(coalesce(text, ''), '[\\p{L}\\p{Nd}]') AS is_query FROM documents WHERE doc_id = (SELECT min(doc_id) FROM documents)")
def embed_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vector of a question is that of a chunk with its words: their inner product is 1."""
    docs = _t(spark, sf_dir, "documents").select("doc_id", "text")
    first = docs.join(docs.agg(F.min("doc_id").alias("doc_id")), "doc_id", "left_semi")
    vector = embed.query_vector(spark, first.first()["text"] or "")
    return embed.embed(first).select("doc_id", (F.abs(index.inner_product(F.col("embedding"), index.literal_vector(vector)) - 1) < 1e-5).alias("is_query"))


def _mixed_sql(h: str) -> str:
    """The embedding's mixing of 64-bit numbers; products are taken modulo 2^64."""
    return f"list_transform([CAST((CAST(xor({h}, {h} >> 29) AS UHUGEINT) * 11400714819323198485) % 18446744073709551616 AS UBIGINT)], lambda m: xor(m, m >> 32))[1]"


_LETTERS = "list_transform(range(1, length(w) + 1), lambda i: CAST(unicode(w[i]) AS UHUGEINT))"
_LETTER_HASHES = f"list_transform(range(1, len(c) + 1), lambda i: {_mixed_sql('CAST((c[i] * 1000003 + CAST(i - 1 AS UHUGEINT) * 11400714819323198485) % 18446744073709551616 AS UBIGINT)')})"
_GRAM_HASHES = f"list_transform(range(1, len(c) - 1), lambda i: {_mixed_sql('CAST((c[i] * 31 + c[i + 1]) * 1000033 + c[i + 2] + 7 AS UBIGINT)')} % {embed.DIM})"


@query(
    f"""WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+')) AS w FROM documents),
    v AS (SELECT w, {_LETTERS} AS c FROM (SELECT DISTINCT w FROM t)),
    h AS (SELECT w, CAST(list_sum(list_transform({_LETTER_HASHES}, lambda x: CAST(x AS HUGEINT))) % 18446744073709551616 AS UBIGINT) AS whole, {_GRAM_HASHES} AS grams FROM v),
    p AS (SELECT w, {_mixed_sql('whole')} % {embed.DIM} AS place, {embed.WORD_WEIGHT} AS n FROM h UNION ALL SELECT w, unnest(grams), {embed.GRAM_WEIGHT} FROM h),
    n AS (SELECT doc_id, place, sum(n) AS n FROM t JOIN p ON t.w = p.w GROUP BY doc_id, place)
    SELECT doc_id, count(*) AS n_places, sha256(string_agg(CAST(place AS VARCHAR), ',' ORDER BY place)) AS places_sha256, CAST(arg_max(place, n * 1000 - place) AS INT) AS largest, round(CAST(max(n) AS DOUBLE) / sqrt(CAST(sum(n * n) AS DOUBLE)), 2) AS size
    FROM n GROUP BY doc_id"""
)
def embed_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which places of each vector are filled, and the largest of them."""
    done = embed.embed(_t(spark, sf_dir, "documents").select("doc_id", "text"))
    places = F.filter(F.transform("embedding", lambda x, i: F.struct(x.alias("x"), (-i).alias("i"))), lambda e: e["x"] > 0)
    own = done.select("doc_id", places.alias("p")).where(F.size("p") > 0)
    ids = F.array_join(F.transform("p", lambda e: (-e["i"]).cast("string")), ",")
    return own.select("doc_id", F.size("p").cast("long").alias("n_places"), F.sha2(ids, 256).alias("places_sha256"), (-F.array_max("p")["i"]).alias("largest"), F.round(F.array_max("p")["x"].cast("double"), 2).alias("size"))


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")


def _query(spark: SparkSession, sf_dir: str) -> list[float]:
    """The vector with the smallest number."""
    return _index(spark, sf_dir).orderBy("vec_id").select("embedding").first()["embedding"]


_Q = "(SELECT embedding AS q FROM embeddings ORDER BY vec_id LIMIT 1)"
_SCORE = "list_sum(list_transform(range(1, len(embedding) + 1), lambda i: CAST(embedding[i] AS DOUBLE) * CAST(q[i] AS DOUBLE)))"


@query(f"SELECT vec_id, round({_SCORE}, 4) AS score FROM embeddings, {_Q} ORDER BY {_SCORE} DESC, vec_id LIMIT {K}")
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.top_k(_index(spark, sf_dir), _query(spark, sf_dir), K).select("vec_id", F.round("score", 4).alias("score"))


@query("SELECT count(*) AS n FROM embeddings")
def vector_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir).agg(F.count("*").alias("n"))


@query(
    f"""SELECT query_id, vec_id, round(s, 4) AS score, CAST(r AS INT) AS rank FROM (SELECT a.vec_id AS query_id, b.vec_id, s, row_number() OVER (PARTITION BY a.vec_id ORDER BY s DESC, b.vec_id) AS r FROM
    (SELECT vec_id, embedding AS q FROM embeddings WHERE vec_id % 100 = 0) a, LATERAL (SELECT vec_id, {_SCORE} AS s FROM embeddings) b) WHERE r <= {K}"""
)
def vector_self_hit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest of each vector whose number is divisible by 100 (the query set), among all vectors."""
    rows = _index(spark, sf_dir)
    asked = rows.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return index.top_k_each(rows, asked, K).select("query_id", "vec_id", F.round("score", 4).alias("score"), "rank")


N_LISTS, IVF_RECALL = 256, 0.95


def _inverted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, list[list[float]]]:
    """The vectors by list, the query set (numbers divisible by 100), and the lists' centres."""
    rows = _index(spark, sf_dir)
    centres = index.train_lists(rows, N_LISTS)
    listed = materialise(index.assign_lists(rows, centres))
    return listed, listed.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query")), centres


@query()
def vector_ivf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest vectors of the query set in as many lists as give the recall, measured by an exact search."""
    listed, asked, centres = _inverted(spark, sf_dir)
    n_probe = index.probes_for(listed, centres, asked, K, IVF_RECALL) if centres else 0
    return index.top_k_each(listed, asked, K, centres=centres, n_probe=n_probe).select("query_id", "vec_id", F.round("score", 4).alias("score"), "rank")


@query(ORACLE_SQL["vector_self_hit"])
def vector_ivf_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lists probed: the exact answer by way of the lists."""
    listed, asked, centres = _inverted(spark, sf_dir)
    return index.top_k_each(listed, asked, K, centres=centres, n_probe=len(centres)).select("query_id", "vec_id", F.round("score", 4).alias("score"), "rank")


@query("SELECT vec_id, true AS listed FROM embeddings")
def vector_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector is in one list."""
    listed, _, centres = _inverted(spark, sf_dir)
    return listed.select("vec_id", F.col("list_id").between(0, max(len(centres) - 1, 0)).alias("listed"))


@query("SELECT CAST(row_number() OVER (ORDER BY doc_id, total, label) - 1 AS BIGINT) AS vec_id, doc_id FROM (SELECT doc_id, n_chars AS total, source AS label FROM documents)")
def vector_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.with_ids(_t(spark, sf_dir, "documents").select("doc_id"), ["doc_id"]).select("vec_id", "doc_id")


def semantic_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question over all documents: clean, chunk, embed, rank, join back."""
    docs = clean.clean(_t(spark, sf_dir, "documents"), "text")
    made = chunk.numbered(docs, chunk.recursive_chunks(F.col("clean_text")), key="doc_id", carry=("lang", "source"))
    embedded = embed.embed(made)
    near = embedded.withColumn("score", index.inner_product(F.col("embedding"), index.literal_vector(embed.query_vector(spark, "licensed under the general public license"))))
    best = near.orderBy(F.desc("score"), "doc_id", "chunk_index").limit(K)
    return best.select("doc_id", "lang", "source", "chunk_index", F.round("score", 4).alias("score"), "text")


query()(semantic_search)

# --- search with metadata ---------------------------------------------------------------------------------------

_FILTERS = searching.Filters(year_from=1993, year_to=1999, case_type="petition", outcome="allow", act_cited="act")


def _cases(spark: SparkSession, sf_dir: str, only: DataFrame | None = None) -> DataFrame:
    """Metadata of all judgments (``only``: of those whose doc_id is there), with a rank that ties them to vectors: vector n belongs to the n-th order."""
    texts = judgments(spark, sf_dir)
    done = metadata.extract(texts if only is None else texts.join(only, "doc_id", "left_semi"), text="text", as_of=AS_OF)
    return done.withColumn("file_name", F.substring_index("file_path", "/", -1)).withColumn("case_id", F.concat(F.lit("case"), F.col("doc_id")))


def _search(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    """Only cases that can be hits are read for metadata: those of the nearest vectors, or before filtering those of all vectors."""
    vectors, asked = _index(spark, sf_dir), _query(spark, sf_dir)
    rows = vectors.select("vec_id", F.concat(F.lit("case"), F.col("vec_id") + 1).alias("case_id"), F.lit(0).alias("chunk_index"), "embedding")
    chunks = rows.select("vec_id", "case_id", "chunk_index", F.concat(F.lit("chunk "), F.col("vec_id")).alias("text"))
    request = searching.Request("a question", K, _FILTERS, mode=mode)
    can_be = index.top_k(rows, asked, K * searching.OVERSAMPLE) if mode == "post" else rows
    cases = materialise(_cases(spark, sf_dir, can_be.select((F.col("vec_id") + 1).alias("doc_id"))))
    hits = searching.search(rows, chunks, cases, request, asked)
    return hits.select("rank", "score", F.col("case.case_id").alias("case_id"), F.col("case.case_type").alias("case_type"), F.col("case.outcome").alias("outcome"), F.col("case.year").alias("year"), "chunk_text")


def _search_sql(mode: str) -> str:
    acts = _distinct("text", metadata.ACTS)
    cond = "(coalesce(y, 0) = 0 OR (y >= 1993 AND y <= 1999)) AND (coalesce(ct, '') = '' OR contains(lower(ct), 'petition')) AND (coalesce(oc, '') = '' OR contains(lower(oc), 'allow')) AND (acts = '' OR contains(lower(acts), 'act'))"
    near = f"SELECT vec_id, s FROM (SELECT vec_id, {_SCORE} AS s FROM embeddings, {_Q})" + (f" ORDER BY s DESC, vec_id LIMIT {K * searching.OVERSAMPLE}" if mode == "post" else "")
    return f"""SELECT CAST(row_number() OVER (ORDER BY s DESC, vec_id) AS INT) AS rank, round(s, 4) AS score, 'case' || doc_id AS case_id, ct AS case_type, oc AS outcome, y AS year, 'chunk ' || vec_id AS chunk_text
    FROM ({near}) v JOIN (SELECT doc_id, y, {_TYPE} AS ct, {_OUTCOME} AS oc, {acts} AS acts FROM {_N}) c ON c.doc_id = v.vec_id + 1 WHERE {cond} ORDER BY s DESC, vec_id LIMIT {K}"""


@query(_search_sql("post"))
def search_post_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir, "post")


@query(_search_sql("pre"))
def search_pre_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir, "pre")


@query(
    f"""SELECT 'a question' AS query, count(*) AS total_hits, coalesce(string_agg(case_id || ':' || score || ':' || chunk_text, '|' ORDER BY rank), '') AS results
    FROM (SELECT rank, case_id, printf('%.4f', score) AS score, chunk_text FROM ({_search_sql("post")}))"""
)
def search_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: the question, the number of hits and the hits in order."""
    vectors, asked = _index(spark, sf_dir), _query(spark, sf_dir)
    rows = vectors.select("vec_id", F.concat(F.lit("case"), F.col("vec_id") + 1).alias("case_id"), F.lit(0).alias("chunk_index"), "embedding")
    chunks = rows.select("vec_id", "case_id", "chunk_index", F.concat(F.lit("chunk "), F.col("vec_id")).alias("text"))
    near = index.top_k(rows, asked, K * searching.OVERSAMPLE).select((F.col("vec_id") + 1).alias("doc_id"))
    hits = searching.search(rows, chunks, materialise(_cases(spark, sf_dir, near)), searching.Request("a question", K, _FILTERS), asked)
    shown = F.transform("results", lambda r: F.concat_ws(":", r["case"]["case_id"], F.format_number(r["score"], 4), r["chunk_text"]))
    return searching.response("a question", hits).select("query", "total_hits", F.array_join(shown, "|").alias("results"))


@query(f"SELECT doc_id, number AS case_number, {_TYPE} AS case_type, y AS year, {_PETITIONER} AS petitioner, {_RESPONDENT} AS respondent, {_OUTCOME} AS outcome, {_distinct('text', metadata.CITATION)} AS citations, ks.f AS file_name FROM {_N} n, LATERAL (SELECT doc_id || '.pdf' AS f) ks")
def case_snippet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields as columns, not as a struct, so that those which are not returned are not worked out."""
    shown = _cases(spark, sf_dir).select("doc_id", *searching.snippet_fields())
    return shown.select("doc_id", "case_number", "case_type", "year", "petitioner", "respondent", "outcome", F.array_join("citations", "|").alias("citations"), "file_name")


# --- keyed tables and state -------------------------------------------------------------------------------------


@query("SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders) AS present FROM customer")
def case_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, orders = _t(spark, sf_dir, "customer").select("c_custkey"), _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    there, not_there = keyed.existing(customers, orders, "c_custkey"), keyed.missing(customers, orders, "c_custkey")
    return there.withColumn("present", F.lit(True)).unionByName(not_there.withColumn("present", F.lit(False)))


_NOW, _THEN = "2024-05-06 07:08:09", "2020-01-01 00:00:00"


@query(
    f"""SELECT coalesce(s.s_suppkey, c.c_custkey) AS key, coalesce(c.c_name, s.s_name) AS name, coalesce(c.c_acctbal, s.s_acctbal) AS balance,
    CASE WHEN s.s_suppkey IS NULL THEN TIMESTAMP '{_NOW}' ELSE TIMESTAMP '{_THEN}' END AS created_at, CASE WHEN c.c_custkey IS NULL THEN TIMESTAMP '{_THEN}' ELSE TIMESTAMP '{_NOW}' END AS updated_at
    FROM supplier s FULL JOIN customer c ON s.s_suppkey = c.c_custkey"""
)
def case_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers put into a table of suppliers by number."""
    then = F.lit(_THEN).cast("timestamp_ntz")
    table = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"), then.alias("created_at"), then.alias("updated_at"))
    rows = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    return keyed.upsert(table, rows, "key", now=F.lit(_NOW).cast("timestamp_ntz"))


@query("SELECT * FROM orders WHERE o_orderkey = 7")
def case_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.lookup(_t(spark, sf_dir, "orders"), "o_orderkey", 7)


@query("SELECT * FROM orders WHERE o_orderkey IN (1, 2, 3, 33, 66, 1000000007)")
def case_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.in_list(_t(spark, sf_dir, "orders"), "o_orderkey", [1, 2, 3, 33, 66, 1000000007])


@query("SELECT l_orderkey AS case_id, l_linenumber AS chunk_index, l_partkey FROM lineitem WHERE l_orderkey = 7 ORDER BY l_linenumber")
def chunks_of_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("case_id"), F.col("l_linenumber").alias("chunk_index"), "l_partkey")
    return keyed.chunks_of(rows, 7)


@query("SELECT 'orders' AS name, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT s_suppkey FROM supplier) UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT s_suppkey FROM supplier))")
def cascade_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of customers that share a supplier's number go, and their lines with them."""
    orders, lines = _t(spark, sf_dir, "orders"), _t(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    gone = keyed.existing(orders, _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("o_custkey")), "o_custkey").select("o_orderkey")
    left = keyed.delete_cascade(orders, lines, gone, "o_orderkey")
    return reduce(DataFrame.unionByName, [t.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, t in zip(("orders", "lineitem"), left, strict=True)])


@query("SELECT o_orderkey, o_custkey, CAST(r AS INT) AS rank FROM (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r > 1")
def unique_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first order of each customer stands; the others break the key."""
    return keyed.first_of_key(_t(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"])[1].select("o_orderkey", "o_custkey", F.col("_rank").alias("rank"))


@query("SELECT l_orderkey AS case_id, l_linenumber AS chunk_index, coalesce(p_partkey, -1) AS vec_id FROM lineitem LEFT JOIN part ON l_orderkey = p_partkey AND l_linenumber = p_size")
def vector_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers filled in on (case, chunk), -1 where there is none."""
    chunks = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("case_id"), F.col("l_linenumber").alias("chunk_index"))
    ids = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("case_id"), F.col("p_size").alias("chunk_index"), F.col("p_partkey").alias("vec_id"))
    return keyed.fill_vector_ids(chunks, ids)


@query("SELECT l_orderkey AS case_id, l_linenumber AS chunk_index, l_partkey AS vec_id FROM lineitem WHERE l_partkey IN (1, 5, 77, 1000000007)")
def chunks_by_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("case_id"), F.col("l_linenumber").alias("chunk_index"), F.col("l_partkey").alias("vec_id"))
    return keyed.chunks_by_vector(rows, [1, 5, 77, 1000000007])


_TRANSITIONS_SQL = "SELECT 'user/' || user_id AS file_path, CASE event_type WHEN 'purchase' THEN 'done' WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'failed' ELSE 'in_progress' END AS status, event_id, ts FROM events"
_LATEST_SQL = f"SELECT file_path, status, event_id FROM (SELECT *, row_number() OVER (PARTITION BY file_path ORDER BY ts DESC, event_id DESC) AS r FROM ({_TRANSITIONS_SQL})) WHERE r = 1"


def _transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "purchase", runs.DONE).when(F.col("event_type").isin("error", "signup"), runs.FAILED).otherwise(runs.IN_PROGRESS)
    return _t(spark, sf_dir, "events").select(F.concat(F.lit("user/"), "user_id").alias("file_path"), kind.alias("status"), "event_id", "ts")


@query(f"SELECT c_custkey FROM customer WHERE 'user/' || c_custkey NOT IN (SELECT file_path FROM ({_LATEST_SQL}) WHERE status IN ('done', 'failed'))")
def checkpoint_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = runs.latest(_transitions(spark, sf_dir), "file_path", ["ts", "event_id"])
    files = _t(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("user/"), "c_custkey").alias("file_path"))
    return runs.unprocessed(files, state).select("c_custkey")


@query(
    f"""WITH old AS (SELECT file_path, status, event_id FROM (SELECT *, row_number() OVER (PARTITION BY file_path ORDER BY ts DESC, event_id DESC) AS r FROM ({_TRANSITIONS_SQL}) WHERE event_id % 2 = 0) WHERE r = 1),
    new AS (SELECT file_path, status, event_id FROM (SELECT *, row_number() OVER (PARTITION BY file_path ORDER BY ts DESC, event_id DESC) AS r FROM ({_TRANSITIONS_SQL}) WHERE event_id % 3 = 0) WHERE r = 1)
    SELECT * FROM new UNION ALL SELECT * FROM old WHERE file_path NOT IN (SELECT file_path FROM new)"""
)
def checkpoint_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of one set of events put over those of another."""
    of = lambda k: runs.latest(_transitions(spark, sf_dir).where(F.col("event_id") % k == 0), "file_path", ["ts", "event_id"]).select("file_path", "status", "event_id")
    return runs.merge_checkpoint(of(2), of(3))


@query(f"SELECT file_path AS run_id, status, event_id FROM ({_LATEST_SQL}) WHERE file_path = (SELECT min(file_path) FROM ({_TRANSITIONS_SQL}))")
def run_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state that one run has come to by its transitions."""
    events = _transitions(spark, sf_dir).select(F.col("file_path").alias("run_id"), "status", "event_id", F.struct("ts", "event_id").alias("at"))
    return runs.run_state(events, events.agg(F.min("run_id")).first()[0]).select("run_id", "status", "event_id")


@query(f"SELECT status, count(*) AS n FROM ({_LATEST_SQL}) GROUP BY status")
def checkpoint_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.status_counts(runs.latest(_transitions(spark, sf_dir), "file_path", ["ts", "event_id"]))


@query(_LATEST_SQL)
def run_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.latest(_transitions(spark, sf_dir), "file_path", ["ts", "event_id"]).select("file_path", "status", "event_id")


@query(f"SELECT count(*) AS total, count(*) FILTER (status = 'done') AS processed, count(*) FILTER (status = 'in_progress') AS skipped, count(*) FILTER (status = 'failed') AS failed, CAST(7 AS BIGINT) AS vectors FROM ({_LATEST_SQL})")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = runs.latest(_transitions(spark, sf_dir), "file_path", ["ts", "event_id"])
    shown = F.when(F.col("status") == runs.DONE, "processed").when(F.col("status") == runs.FAILED, "failed").otherwise("skipped")
    return runs.summary(state.select(shown.alias("state")), 7)


@query("SELECT (SELECT count(*) FROM orders) AS cases, (SELECT count(*) FROM lineitem) AS chunks, (SELECT count(*) FROM embeddings) AS vectors")
def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.counts(cases=_t(spark, sf_dir, "orders"), chunks=_t(spark, sf_dir, "lineitem"), vectors=_t(spark, sf_dir, "embeddings"))
