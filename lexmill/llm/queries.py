"""The registered queries of this subpackage and their SQL.

Each query applies its operator, with production parameters, to its whole table. Queries without SQL (a fitted model, a
media format, a parser, a tokenizer, mined rules) are tested against brute force, round trips and held-out rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import decontaminate, htmltext, jaccard, licences, mixing, quality, secretscan, tokencount, transport, urlfilter
from lexmill.llm.common import table

# The explicit URL rules, each a verdict and host + path.
URL_RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]
MIX_WEIGHTS = {"domain": {"domain0": 4.0, "domain1": 3.0, "domain2": 2.0, "domain3": 1.0}, "lang": {"en": 5.0, "de": 2.0, "fr": 2.0}}
MIX_SHARE = 0.5
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def domain_of(source: Column) -> Column:
    """A source's domain: its trailing number modulo 4 (none: ``domain0``)."""
    number = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    return F.concat(F.lit("domain"), F.pmod(F.when(number == "", F.lit(0)).otherwise(F.try_to_number(number, F.lit("999999999")).cast("int")), F.lit(4)).cast("string"))


def licence_path(key: Column, source: Column, lang: Column) -> Column:
    """A path for each document: source, language, a folder of 100 keys, the key."""
    return F.concat_ws("/", source, lang, F.concat(F.lit("d"), F.floor(key / 100).cast("string")), F.concat(key.cast("string"), F.lit(".txt")))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_transport(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transport.digest(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.report(table(spark, sf_dir, "documents"))


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents"), licence_path(F.col("doc_id"), F.col("source"), F.col("lang")))


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of the documents with the pages' numbers mark URLs: low quality or toxic ones are to be blocked."""
    pages = table(spark, sf_dir, "pages")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("_label"), "quality", "toxic").where("quality is not null and toxic is not null")
    labelled = pages.select("page_id", "url").join(labels, F.col("page_id") == F.col("_label")).where("url is not null")
    return urlfilter.judge(pages, labelled, (F.col("quality") == 0) | (F.col("toxic") == 1), explicit=URL_RULES)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), domain=domain_of(F.col("source")), budget_share=MIX_SHARE, weights=MIX_WEIGHTS)


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality, op2_transport, op3_decontaminate, op4_html, op5_secrets, op6_licences, op7_urls, op8_mixing, op9_tokens, op10_jaccard)
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP3_SQL = f"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS win
       FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
dw AS (SELECT p.doc_id, p.i, l.n, array_to_string(list_slice(p.w, p.i, p.i + l.n - 1), ' ') AS win
       FROM p JOIN (SELECT DISTINCT n FROM bw) l ON p.i + l.n - 1 <= len(p.w)),
h AS (SELECT dw.doc_id, dw.i, dw.n, bw.item FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM h) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list_distinct(list(item))), ',') AS ids FROM h GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(hit.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items.ids, '')) AS items_sha256,
       coalesce(hit.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
"""


def _op5_sql() -> str:
    parts = []
    for order, r in enumerate(secretscan.BASE + secretscan.MORE):
        p = "'(?s)" + r.pattern.replace("'", "''") + "'"
        parts.append(
            f"""SELECT row, {order} AS ord, '{r.kind}' AS kind, lens[k].st AS st, lens[k].en AS en FROM (
            SELECT row, k, list_transform(range(1, len(m) + 1), lambda i: {{'st': CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS BIGINT),
              'en': CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + list_sum(list_transform(m[1:i], lambda x: length(x))) AS BIGINT)}}) AS lens, length(q[k]) AS part
            FROM (SELECT row, m, g, q, unnest(range(1, len(m) + 1)) AS k FROM (
              SELECT row, regexp_extract_all(t, {p}) AS m, regexp_extract_all(t, {p}, {r.group}) AS q, string_split_regex(t, {p}) AS g FROM d WHERE regexp_matches(t, {p})))) WHERE part >= {r.least}"""
        )
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
s AS ({' UNION ALL '.join(parts)}),
a AS (SELECT row, count(*) FILTER (ord = 0) AS n0, count(*) FILTER (ord = 1) AS n1, count(*) FILTER (ord = 2) AS n2,
        string_agg(kind || ':' || st || ':' || en, ',' ORDER BY st, ord) FILTER (ord < 3) AS base,
        string_agg(kind || ':' || st || ':' || en, ',' ORDER BY st, ord) AS spans FROM s GROUP BY row)
SELECT d.doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a ON d.row = a.row
"""


def _weight_sql(level: str) -> str:
    if level not in MIX_WEIGHTS:
        return "CAST(sum(tokens) AS DOUBLE)"
    return "CASE " + level + " " + " ".join(f"WHEN '{k}' THEN CAST({v} AS DOUBLE)" for k, v in MIX_WEIGHTS[level].items()) + " ELSE CAST(1 AS DOUBLE) END"


def _level_sql(name: str, keys: list[str], up: str) -> str:
    above = keys[:-1]
    part = f"PARTITION BY {', '.join(above)}" if above else ""
    on = " AND ".join(f"n.{c} = u.{c}" for c in above) or "true"
    order = f"{part} ORDER BY cap / w, {', '.join(keys)}"
    return f"""
{name}_n AS (SELECT {', '.join(keys)}, sum(tokens) * {mixing.MAX_EPOCHS} AS cap, {_weight_sql(keys[-1])} AS w FROM leaf WHERE tokens > 0 GROUP BY {', '.join(keys)}),
{name}_b AS (SELECT n.*, u.share AS budget FROM {name}_n n JOIN {up} u ON {on}),
{name}_l AS (SELECT *, (budget - coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM {name}_b),
{name} AS (SELECT {', '.join(keys)}, CASE WHEN lev * w >= cap THEN CAST(cap AS DOUBLE) ELSE greatest(max(CASE WHEN lev * w < cap THEN lev END) OVER ({part}), 0) * w END AS share FROM {name}_l)"""


OP8_SQL = rf"""
WITH d AS (SELECT doc_id, 'domain' || (CASE WHEN regexp_extract(source, '([0-9]{{1,9}})$', 1) = '' THEN 0 ELSE CAST(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS BIGINT) END % 4) AS domain, lang, source,
             CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \t\r\n]+')) AS BIGINT) AS tokens FROM documents),
leaf AS (SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS tokens FROM d GROUP BY domain, lang, source),
root AS (SELECT CAST(floor(sum(tokens) * {MIX_SHARE}) AS DOUBLE) AS share FROM leaf),
{_level_sql('l1', ['domain'], 'root')}, {_level_sql('l2', ['domain', 'lang'], 'l1')}, {_level_sql('l3', ['domain', 'lang', 'source'], 'l2')},
plan AS (SELECT leaf.*, CAST(floor(l3.share + 1e-6) AS BIGINT) // greatest(leaf.tokens, 1) AS epochs, CAST(floor(l3.share + 1e-6) AS BIGINT) % greatest(leaf.tokens, 1) AS rest
         FROM leaf JOIN l3 ON leaf.domain = l3.domain AND leaf.lang = l3.lang AND leaf.source = l3.source),
o AS (SELECT d.*, plan.epochs, plan.rest, CAST('0x' || substr(md5('{mixing.SEED}:' || plan.epochs || ':' || d.doc_id), 1, 8) AS BIGINT) AS h
      FROM d JOIN plan ON d.domain = plan.domain AND d.lang = plan.lang AND d.source = plan.source),
r AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM o)
SELECT doc_id, domain, lang, source, tokens AS n_tokens, epochs, CAST(tokens * epochs + greatest(0, least(tokens, rest - before)) AS BIGINT) AS tokens_taken FROM r
"""

OP10_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + {jaccard.WIDTH - 1}), ' ') AS sh
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {jaccard.WIDTH - 1}, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS (SELECT c.a, c.b FROM c JOIN n x ON c.a = x.doc_id JOIN n y ON c.b = y.doc_id WHERE c.both >= {jaccard.THRESHOLD} * (x.n + y.n - c.both) - 1e-9),
r(node, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node WHERE r.root < e.b),
k AS (SELECT node, min(root) AS class_id FROM r GROUP BY node),
m AS (SELECT a, count(*) AS links FROM e GROUP BY a),
f AS (SELECT doc_id, string_agg(sh, '|' ORDER BY sh) AS f FROM s GROUP BY doc_id),
g AS (SELECT f, count(*) AS copies FROM f GROUP BY f)
SELECT d.doc_id, k.class_id, CAST(coalesce(m.links, 0) AS BIGINT) AS n_links, CAST(coalesce(g.copies, 1) AS BIGINT) AS n_copies
FROM d JOIN k ON d.doc_id = k.node LEFT JOIN m ON m.a = d.doc_id LEFT JOIN f ON f.doc_id = d.doc_id LEFT JOIN g ON g.f = f.f
"""

ORACLE_SQL: dict[str, str] = {"op3_decontaminate": OP3_SQL, "op5_secrets": _op5_sql(), "op8_mixing": OP8_SQL, "op10_jaccard": OP10_SQL}
