"""Derived inputs in SQL that Spark and DuckDB read alike: court judgments from orders, and dirtied documents.

The text of ``{orders}`` and the like is put in by each engine. No backslash stands in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexmill.session import dealt

NL = "chr(10)"


def _case(modulus: int, *branches: str, offset: int = 0) -> str:
    """One of the SQL expressions by the order's key."""
    whens = " ".join(f"WHEN {k} THEN {b}" for k, b in enumerate(branches[:-1]))
    return f"CASE (k + {offset}) % {modulus} {whens} ELSE {branches[-1]} END"


_NAME = "'KETAN ' || letters"
_LINES = [
    _case(
        4,
        f"'IN THE SUPREME COURT OF INDIA' || {NL} || 'CIVIL APPELLATE JURISDICTION' || {NL}",
        f"'NON-REPORTABLE' || {NL} || 'IN THE SUPREME COURT OF INDIA ' || {NL} || 'CRIMINAL APPELLATE JURISDICTION' || {NL}",
        f"'Page 1 of 12' || {NL} || 'Indian Kanoon - http://indiankanoon.org/doc/' || ks || '/' || {NL} || '  17 ' || {NL} || {NL} || 'https://example.org/' || ks || {NL}",
        f"'REPORTABLE' || {NL}",
    ),
    _case(
        12,
        "'CIVIL APPEAL NO. ' || ks || ' OF ' || ys",
        "'Criminal Appeal No. ' || ks || '/' || ys",
        "'W.P. (C) No. ' || ks || ' of ' || ys",
        "'W.P.(Crl.) No. ' || ks || ' of ' || ys",
        "'SLP (C) No. ' || ks || ' of ' || ys",
        "'S.L.P.(Criminal) No ' || ks || ' / ' || ys",
        "'Transfer Petition (C) No. ' || ks || ' of ' || ys",
        "'Review Petition (Crl.) No. ' || ks || ' of ' || ys",
        "'No number here'",
        "'Civil Appeal Nos. ' || ks || '-' || ks || ' of ' || ys",
        "'Original Suit No. 2010 of 1949'",
        f"'Contempt  Petition (C)  No. ' || ks || {NL} || ' of ' || ys",
    ),
    _case(5, f"{_NAME} || ' ... APPELLANT'", f"{_NAME} || ' AND OTHERS ..... PETITIONERS'", f"{_NAME} || '   ... Appellant(s)'", f"{_NAME} || ' .. APPELLANT'", "'The parties are known.'"),
    "'VERSUS'",
    _case(4, f"'STATE OF ' || letters || ' .... RESPONDENT'", f"{_NAME} || ' & ANR. ...Respondent(s)'", "'UNION OF INDIA ... ACCUSED '", "'No one answers.'", offset=1),
    _case(
        6,
        f"'CORAM:' || {NL} || 'HON''BLE MR. JUSTICE A.K. ' || letters || {NL} || 'HON''BLE MRS. JUSTICE R. BANUMATHI'",
        f"'CORAM : JUSTICE ' || letters || ' DESAI'",
        f"'CORAM:' || {NL} || 'JUSTICE S. ANAND' || {NL} || 'JUSTICE ' || letters || ' ROY'",
        f"'Before the Hon''ble Mr. Justice ' || letters || ' Rao' || {NL} || 'and others'",
        f"'BENCH: a full court of ' || letters || '  sat on this' || {NL}",
        "'No judge is named.'",
        offset=2,
    ),
    _case(
        9,
        "'The order dated 15th March ' || ys || ' of the court below is under challenge.'",
        "'Judgment dated: ' || CAST(d AS STRING) || '/' || CAST(m AS STRING) || '/' || ys || ' is assailed.'",
        "'An order dated 13.' || CAST(m AS STRING) || '.' || ys || ' was made.'",
        "'It is DATED 12-25-' || ys || ' and was filed.'",
        "'An order dated 31.02.' || ys || ' cannot be.'",
        "'Dated 5/6/99 and again dated 1st May 2001.'",
        "'No date is given.'",
        "'The judgment dated 2 june ' || ys || ' stands.'",
        "'Order dated 99-01-20 is quoted.'",
        offset=3,
    ),
    _case(
        7,
        "'Section 302 of the Indian Penal Code (IPC) and the indian  penal code, with the Cr.P.C. too.'",
        "'The Constitution of India, the C.P.C. and the Code of Civil Procedure were read.'",
        "'The NDPS Act, the GST Act, the Income-Tax Act and the Income Tax Act.'",
        "'The Employees'' Provident Funds and Miscellaneous Provisions Act and the Limitation Act.'",
        "'The Motor Vehicles Act, the MOTOR VEHICLES ACT and the Environmental Protection Act.'",
        "'The Scheduled Castes and Scheduled Tribes (Prevention of Atrocities) Act and I.P.C. sections.'",
        "'No statute.'",
        offset=4,
    ),
    _case(
        8,
        "'See AIR ' || ys || ' SC 1234 and (2020) 5 SCC 123.'",
        "'See [2019] 1 SCC 100 and 1998 SCR ' || ks || '.'",
        "'See 2001 SC 77, air 2001  sc 77 and 2001 SC 77.'",
        "'See (1999)  2 SCC  ' || ks || ', 2003 AIR 45.'",
        "'No report.'", "'No report.'", "'See AIR 1990 SC 1.'", "'Nothing.'",
        offset=5,
    ),
    _case(
        10,
        "'Short.'",
        "repeat('The court heard the learned counsel at length and considered the record on page 12 the same day. ', 40)",
        "repeat('Heard both sides on the question of law that arises here and reserved the matter for orders. ', 8)",
        "repeat('The facts lie in a narrow compass and need no more than a few words for this purpose. ', 25)",
        "repeat('Leave was granted and the record of the courts below was called for and read in full. ', 5)",
        "repeat('The appel-' || chr(10) || 'lant was heard .... and the other side ---- was not ____ heard at all *****. ', 6)",
        "repeat('The matter was argued over several days and the written notes were also seen by us. ', 7)",
        "repeat('We have given our anxious thought to what was said for the parties before this court. ', 9)",
        "repeat('There is no merit in the plea that the trial was not fair to the one who stood it. ', 6)",
        "repeat('The evidence was read again with the help of the learned counsel for both of them. ', 11)",
    ),
    _case(
        7,
        "'For these reasons the appeal is allowed. No order as to costs.'",
        "'The petition is dismissed.'",
        "'It is dismissed with costs.'",
        "'We hereby allow it.'",
        "'The conviction is set  aside.'",
        "'The appeals are allowed.'",
        f"'The appeal is disposed' || {NL} || 'of.'",
        offset=6,
    ),
    _case(11, "repeat('This is the end of the record and nothing follows but the seal. ', 40)", *["''"] * 10),
]

JUDGMENTS_SQL = f"""
SELECT k AS doc_id, 'file:/judgments/' || ks || '.pdf' AS file_path, sha2_of AS file_hash, {f" || {NL} || ".join(f"({x})" for x in _LINES)} AS text
FROM (SELECT o_orderkey AS k, CAST(o_orderkey AS STRING) AS ks, CAST(year(o_orderdate) AS STRING) AS ys, month(o_orderdate) AS m, day(o_orderdate) AS d,
             translate(CAST(c_custkey AS STRING), '0123456789', 'ABCDEFGHIJ') AS letters, md5(CAST(o_orderkey AS STRING)) AS sha2_of
      FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey)
"""

DIRTY_SQL = f"""
SELECT doc_id, 'NON-REPORTABLE' || {NL} || 'Page 3 of 9 In' || chr(7) || 'tro' || chr(13) || chr(10) || chr(9) || 'ﬁrst ﬂow oﬀer eﬃcient baﬄe ‘a’ “b” – — … ' || chr(160) || 'x' || chr(173) || 'y' || '\u200b\ufeffz' || chr(13)
  || 'cafe\u0301 de\u0301ja\u0300 vu' || {NL} || {NL} || {NL} || {NL} || '   42  ' || {NL} || 'appli-' || {NL} || 'cation stay- ' || {NL} || 'ing ......  ---- ______ *****' || chr(12) || {NL}
  || 'see Indian Kanoon - https://indiankanoon.org/doc/' || CAST(doc_id AS STRING) || '/ here' || {NL} || ' http://example.org/x ' || {NL} || text || {NL} || ' Page 9' AS text
FROM {{documents}}
"""


def tables_of(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, file_path, file_hash, text: a judgment for each order.

    The small order rows are dealt to all cores before they grow into texts; a number of partitions that is given is kept.
    """
    tables = tables_of(spark, sf_dir, "orders", "customer")
    tables["orders"] = tables["orders"].repartition(2 * spark.sparkContext.defaultParallelism, "o_orderkey")
    return spark.sql(JUDGMENTS_SQL, **tables)


def dirty_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text: every document with noise around its text."""
    return spark.sql(DIRTY_SQL, documents=dealt(tables_of(spark, sf_dir, "documents")["documents"]))


def in_duckdb(sql: str) -> str:
    return sql.format(orders="orders", customer="customer", documents="documents")
