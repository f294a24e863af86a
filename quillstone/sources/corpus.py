"""Deterministic corpora derived from order tables, by SQL that Spark and other engines read alike.

The tables at hand hold no legal references and no headings; these corpora do, and as every text is put together from
pieces, the places of the pieces are known without searching for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("orders", "lineitem", "customer", "documents", "pages")

ACT_PICK = """CASE l_suppkey % 7 WHEN 0 THEN 'Companies Act, 2013' WHEN 1 THEN 'Income-tax Act, 1961' WHEN 2 THEN 'Customs Act, 1962'
    WHEN 3 THEN 'Insolvency and Bankruptcy Code, 2016' WHEN 4 THEN 'Competition Act, 2002' WHEN 5 THEN 'Indian Contract Act, 1872'
    ELSE 'Securities and Exchange Board of India Act, 1992' END"""
ORG_PICK = """CASE o_custkey % 6 WHEN 0 THEN 'Reserve Bank of India' WHEN 1 THEN 'Securities and Exchange Board of India' WHEN 2 THEN 'Central Board of Direct Taxes'
    WHEN 3 THEN 'National Green Tribunal' WHEN 4 THEN 'Delhi High Court' ELSE 'Ministry of Finance' END"""
REF_PICK = """CASE l_linenumber % 4 WHEN 0 THEN 'Section ' || CAST(l_partkey % 300 + 1 AS STRING) || '(' || CAST(l_linenumber AS STRING) || ')'
    WHEN 1 THEN 'Rule ' || CAST(l_partkey % 90 + 1 AS STRING) WHEN 2 THEN 'Article ' || CAST(l_partkey % 395 + 1 AS STRING)
    ELSE 'Clause (b) of Section ' || CAST(l_partkey % 300 + 1 AS STRING) END"""
NOTE_PICK = """CASE l_orderkey % 3 WHEN 0 THEN 'S.O. ' || CAST(l_orderkey AS STRING) || '(E)' WHEN 1 THEN 'G.S.R. ' || CAST(l_orderkey % 900 + 1 AS STRING)
    ELSE 'Circular No. ' || CAST(l_orderkey % 40 + 1 AS STRING) || '/2020' END"""
MONEY_PICK = """CASE l_linenumber % 3 WHEN 0 THEN 'Rs. ' || CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING)
    WHEN 1 THEN 'USD ' || CAST(CAST(floor(l_quantity) AS BIGINT) AS STRING) ELSE 'INR ' || CAST(CAST(floor(l_quantity) AS BIGINT) AS STRING) || ' Crore' END"""
#: What stands before, between and after the six entities; the last holds things that only look like references.
FILLERS = ("as per ", " of the ", ", the ", " issued ", " dated ", " for a sum of ", " only, see xSection 9 and rule 7 of the annex.")
LABELS = ("SECTION_REF", "ACT_NAME", "ORG", "NOTIFICATION", "DATE", "MONEY")

PIECES = f"""SELECT ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS sid, l_orderkey AS oid, o_custkey AS cust, l_linenumber AS ln,
    {REF_PICK} AS e0, {ACT_PICK} AS e1, {ORG_PICK} AS e2, {NOTE_PICK} AS e3, CAST(CAST(l_shipdate AS DATE) AS STRING) AS e4, {MONEY_PICK} AS e5
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
SENTENCE = " || ".join(x for i, f in enumerate(FILLERS) for x in ([f"'{f}'", f"e{i}"] if i < 6 else [f"'{f}'"]))
SENTENCES = f"SELECT sid, oid, cust, ln, {SENTENCE} AS text FROM ({PIECES}) AS pieces"


def _start(i: int) -> str:
    return " + ".join([str(sum(len(f) for f in FILLERS[: i + 1])), *(f"length(e{k})" for k in range(i))])


GOLD = " UNION ALL ".join(
    f"SELECT sid, '{label}' AS label, e{i} AS span_text, CAST({_start(i)} AS INT) AS start, CAST({_start(i)} + length(e{i}) AS INT) AS stop, {i} AS ord FROM ({PIECES}) AS p{i}" for i, label in enumerate(LABELS)
)
MARKDOWN_LINES = f"""SELECT cust AS doc_id, sid, CASE WHEN ln = 1 THEN CASE WHEN oid % 3 = 0 THEN '<!-- page ' || CAST(oid % 97 + 1 AS STRING) || ' -->' || chr(10) ELSE '' END
    || repeat('#', CAST(oid % 5 + 1 AS INT)) || ' Order ' || CAST(oid AS STRING) || chr(10) ELSE '' END || text AS line FROM ({SENTENCES}) AS sentences"""

PDF_SPANS = """SELECT l_orderkey AS doc_id, CAST(l_linenumber % 2 + 1 AS INT) AS page_no, CAST(600.0 AS DOUBLE) AS page_width, CAST((l_linenumber * 100000 + l_partkey) * 1000 + l_suppkey % 1000 AS BIGINT) AS block_no, CAST(0 AS INT) AS line_no, k AS span_no,
    CASE WHEN l_partkey % 17 = 0 THEN 1 ELSE 0 END AS kind, CAST(l_suppkey % 6 * 75 AS DOUBLE) AS x0, CAST(l_partkey % 5 * 60 AS DOUBLE) AS y0, CAST(l_suppkey % 6 * 75 + 50 AS DOUBLE) AS x1,
    CAST(l_partkey % 5 * 60 + 12 AS DOUBLE) AS y1, CAST(CASE (l_partkey + k) % 4 WHEN 0 THEN 10 WHEN 1 THEN 10 WHEN 2 THEN 12 ELSE 16 END AS DOUBLE) AS size,
    CASE WHEN k = 0 THEN 'Clause  ' ELSE CAST(l_partkey AS STRING) END AS text FROM lineitem, (SELECT 0 AS k UNION ALL SELECT 1 AS k) AS two"""

_URL = "'https://d' || CAST({k} % 7 AS STRING) || '.example.org/p/' || CAST({k} AS STRING) || CASE WHEN {k} % 10 = 3 THEN '.pdf' ELSE '' END"
SITE = f"""SELECT {_URL.format(k='c_custkey')} AS url, CAST(CASE c_custkey % 11 WHEN 0 THEN 404 WHEN 5 THEN 500 ELSE 200 END AS INT) AS status,
    CASE WHEN c_custkey % 10 = 3 THEN 'application/pdf' ELSE 'text/html' END AS content_type, c_custkey AS k FROM customer"""
LINKS = " UNION ALL ".join(f"SELECT {_URL.format(k='c_custkey')} AS src, {pos} AS pos, {_URL.format(k=f'({to})')} AS link FROM customer" for pos, to in enumerate(("c_custkey + 7", "c_custkey * 8", "c_custkey + 21", "c_custkey * 2", "c_custkey * 15")))
SEEDS = f"SELECT {_URL.format(k='c_custkey')} AS url, c_custkey AS ord FROM (SELECT min(c_custkey) AS c_custkey FROM customer GROUP BY c_custkey % 7) AS firsts"


#: Rules for robots of the made-up sites: base, entry, agent, ord, path_prefix, allow.
ROBOTS = (
    ("https://d1.example.org", 0, "*", 0, "/p/1", False), ("https://d2.example.org", 0, "*", 0, "/p/20", True), ("https://d2.example.org", 0, "*", 1, "/p/2", False),
    ("https://d3.example.org", 0, "*", 0, "/", False), ("https://d3.example.org", 1, "Quill", 0, "/p/3", False), ("https://d4.example.org", 0, "another", 0, "/", False),
)


def spread(scan: DataFrame) -> DataFrame:
    """scan, dealt anew where it has fewer partitions than the cluster has cores: one small file is otherwise one task."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(2 * cores) if scan.rdd.getNumPartitions() < cores else scan


def views(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = TABLES) -> None:
    for name in names:
        scan = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        (spread(scan) if name == "lineitem" else scan).createOrReplaceTempView(name)


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sid, oid, cust, ln, text: one sentence for each line of an order."""
    views(spark, sf_dir, ("orders", "lineitem"))
    return spark.sql(SENTENCES)


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sid, label, span_text, start, stop, ord: the entities of sentences(), by construction; one scan, no search."""
    views(spark, sf_dir, ("orders", "lineitem"))
    span = lambda i: f"struct('{LABELS[i]}' AS label, e{i} AS span_text, CAST({_start(i)} AS INT) AS start, CAST({_start(i)} + length(e{i}) AS INT) AS stop, {i} AS ord)"
    return spark.sql(f"SELECT sid, inline(array({', '.join(map(span, range(6)))})) FROM ({PIECES}) AS pieces")


def markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text: a document for each customer, with a heading for each order and page markers."""
    views(spark, sf_dir, ("orders", "lineitem"))
    rows = spark.sql(MARKDOWN_LINES).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("sid", "line"))).alias("l"))
    return rows.select("doc_id", F.array_join(F.transform("l", lambda x: x.line), "\n").alias("text"))


def pdf_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, ("lineitem",))
    return spark.sql(PDF_SPANS.replace("FROM lineitem, (SELECT 0 AS k UNION ALL SELECT 1 AS k) AS two", "FROM lineitem LATERAL VIEW explode(array(0, 1)) two AS k"))


def site(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Seeds, links and pages of a made-up site of sites."""
    views(spark, sf_dir, ("customer",))
    return spark.sql(SEEDS).withColumn("name", F.col("url")), spark.sql(LINKS), spark.sql(SITE).drop("k")


#: A text's reference by label; {n} is a number. Each is found whole, by the rule named.
CASES = (
    ("const_article", "SECTION_REF", "Article {n}(1) of the Constitution"), ("clause_subsec_sec", "SECTION_REF", "Clause (c) of Sub-section (4) of Section {n}A"), ("clause_sec", "SECTION_REF", "Clause (d) of Section {n}(2)"),
    ("proviso_sec", "SECTION_REF", "second proviso to Section {n}"), ("explanation_sec", "SECTION_REF", "Explanation 3 to Section {n}(2)"), ("subsec_sec", "SECTION_REF", "Sub-section (2) of Section {n}"),
    ("order_rule", "SECTION_REF", "Order V Rule {n}"), ("schedule", "SECTION_REF", "Second Schedule to the Act"), ("sec_with_sub", "SECTION_REF", "Section {n}(4)(c)"), ("sec_plain", "SECTION_REF", "Section {n}"),
    ("rule_plain", "SECTION_REF", "Rule {n}"), ("chapter", "SECTION_REF", "Chapter {n}"), ("para", "SECTION_REF", "para {n}"),
    ("so", "NOTIFICATION", "S.O. {n}(E)"), ("gsr", "NOTIFICATION", "G.S.R. {n}"), ("circular", "NOTIFICATION", "Circular No. {n} of 2018"), ("instruction", "NOTIFICATION", "Instruction No {n}/2020"),
    ("letter", "NOTIFICATION", "Letter No. {n}/x dated"), ("fno", "NOTIFICATION", "F. No. {n}/3-TPL"), ("press", "NOTIFICATION", "Press Release No. {n}/2"), ("notif_no", "NOTIFICATION", "Notification No. {n}/2020"),
    ("order_no", "NOTIFICATION", "Order No. {n}/AB"), ("cbdt_ref", "NOTIFICATION", "CBIC Notification No. {n}/2021"),
    ("wef", "DATE", "w.e.f 1.4.2020"), ("iso", "DATE", "2021-12-31"), ("dd_mm_yyyy_dash", "DATE", "1-2-2020"), ("dd_mm_yyyy_slash", "DATE", "01/02/2020"), ("dd_mm_yyyy_dot", "DATE", "1.12.2020"),
    ("dd_month_yyyy", "DATE", "3rd May 2011"), ("month_dd_yyyy", "DATE", "May 3, 2011"), ("month_year", "DATE", "June, 2015"), ("fy", "DATE", "F.Y. 2019-20"), ("ay", "DATE", "AY 2020-21"),
    ("inr_crore_lakh", "MONEY", "INR {n} Crore"), ("crore_lakh_words", "MONEY", "Rs {n}.5 lakh"), ("numeral_crore", "MONEY", "{n}.25 Lakh rupee"), ("usd", "MONEY", "USD {n}.50"), ("eur", "MONEY", "EUR {n}"), ("gbp", "MONEY", "GBP {n}"),
    ("rupee_sym", "MONEY", "₹{n}"), ("rs_plain", "MONEY", "Rs. {n}"),
)


def cases_sql(cases: list[tuple[str, str]]) -> str:
    """Cases (label, template) by the parts' keys: pid, label, span_text, text; the span begins at 9. Each is in the text twice."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    values = ", ".join(f"({i}, {quoted(label)}, {quoted(text)})" for i, (label, text) in enumerate(cases))
    return f"""SELECT p_partkey AS pid, label, span, 'it says ' || span || ' while ' || span || ' in part.' AS text
        FROM (SELECT p_partkey, label, replace(template, '{{n}}', CAST(p_partkey % 300 + 1 AS STRING)) AS span FROM part JOIN (SELECT * FROM (VALUES {values}) AS v(i, label, template)) AS c ON p_partkey % {len(cases)} = i) AS x"""


def cases(spark: SparkSession, sf_dir: str, own: list[tuple[str, str]]) -> DataFrame:
    views(spark, sf_dir, ("part",))
    escaped = cases_sql(own).replace("''", "\\'")
    return spark.sql(escaped)
