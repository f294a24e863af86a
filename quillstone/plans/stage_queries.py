"""Registered queries of scans, sinks, stages and rules: what is written is read back and compared with SQL over the source tables."""

from __future__ import annotations

import re

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import legal
from ..functions import text as T
from ..functions import urls as U
from ..operators import chunks as C
from ..operators import crawl as K
from ..operators import evaluate as E
from ..operators import html as H
from ..operators import pdf as P
from ..operators import spans as N
from ..operators import summary
from ..sources import corpus, files
from . import pipeline
from .queries import _BLOCKS, _FOLD, _H1, _ORDERED, _PART, _PARTIAL, _SCORED, _STRICT, _TITLE, _crawl_sql, _crawled, _faulty, _resolved, long, query, read

_PAGE_TITLE = f"coalesce(nullif(regexp_replace({_TITLE}, '^\\s+|\\s+$', '', 'g'), ''), regexp_replace({_H1}, '^\\s+|\\s+$', '', 'g'))"

# --- scans and sinks --------------------------------------------------------------------------------------------------


@query(f"SELECT 'site ' || lpad(CAST(ord AS STRING), 9, '0') AS name, url, row_number() OVER (ORDER BY ord) - 1 AS place FROM ({corpus.SEEDS}) AS s")
def seeds_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeds as a JSON object, written and read in its order."""
    seeds, _, _ = corpus.site(spark, sf_dir)
    path = files.scratch(spark, "seeds")
    named = seeds.select(F.format_string("site %09d", "ord").alias("name"), "url")
    whole = named.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", "url")))).alias("m"))  # seeds are few
    whole.select(F.to_json("m").alias("value")).coalesce(1).write.text(path)
    return files.read_seeds(spark, path).select("name", "url", F.col("ord").cast("long").alias("place"))


@query(f"SELECT url, status, content_type, false AS used_js, 'data/raw/' || substr(md5(url), 1, 16) || CASE WHEN content_type = 'application/pdf' OR lower(url) LIKE '%.pdf' THEN '.pdf' ELSE '.html' END AS path_to_raw, true AS stamped FROM ({_crawl_sql()}) AS i")
def crawl_index_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The crawl index as JSON lines, written and read."""
    path = files.scratch(spark, "crawl_index")
    files.write_jsonl(K.index(_crawled(spark, sf_dir)), path)
    stamped = F.col("timestamp").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}\+00:00$")
    return files.read_jsonl(spark, path, "crawl_index").select("url", *long("status"), "content_type", "used_js", "path_to_raw", stamped.alias("stamped"))


@query("SELECT substr(md5(url), 1, 16) AS stem, md5(max(html)) AS html_md5, 'html' AS kind FROM pages GROUP BY 1")
def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw pages by their path, written and read."""
    path = files.scratch(spark, "raw")
    pages = read(spark, sf_dir, "pages").select(F.concat(F.lit("data/raw/"), U.url_hash(F.col("url")), F.lit(".html")).alias("path"), F.col("html").cast("binary").alias("content"))
    files.write_raw(pages, path)
    own = files.read_raw(spark, path)
    return own.select(U.file_stem(F.col("path")).alias("stem"), F.md5("content").alias("html_md5"), F.regexp_extract("path", r"\.([^.]+)$", 1).alias("kind"))


@query("SELECT page_id, md5(html) AS html_md5 FROM pages")
def html_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as a file of a folder each, read as a tree."""
    path = files.scratch(spark, "tree")
    read(spark, sf_dir, "pages").select("page_id", "html").repartition("page_id").write.partitionBy("page_id").text(path)
    own = files.read_html(spark, path, "*.txt")  # the sink's own ending; it ends the text with a line feed
    return own.select(F.regexp_extract("path", r"page_id=(-?\d+)", 1).cast("long").alias("page_id"), F.md5(F.regexp_replace("html", r"\n\z", "")).alias("html_md5"))


@query(f"SELECT sid, label, span_text, CAST(start AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop, row_number() OVER (PARTITION BY sid ORDER BY start) - 1 AS place FROM ({corpus.GOLD}) AS g")
def gold_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold texts with their entities as JSON lines, written and read."""
    path = files.scratch(spark, "gold")
    entity = F.struct("start", F.col("stop").alias("end"), "label", F.col("span_text").alias("text"))
    gold = corpus.gold(spark, sf_dir).groupBy("sid").agg(F.sort_array(F.collect_list(entity)).alias("e"))
    shaped = F.transform("e", lambda e: F.struct(e.label.alias("label"), e.text.alias("text"), e.start.alias("start"), e.end.alias("end")))
    files.write_jsonl(gold.select(F.col("sid").cast("string").alias("text"), shaped.alias("entities")), path)
    own = files.read_jsonl(spark, path, "gold").select(F.col("text").cast("long").alias("sid"), F.posexplode("entities").alias("place", "e"))
    return own.select("sid", "e.label", F.col("e.text").alias("span_text"), F.col("e.start").cast("long").alias("start"), F.col("e.end").cast("long").alias("stop"), F.col("place").cast("long").alias("place"))


@query("SELECT CAST(count(*) FILTER (c_custkey % 5 > 0) AS BIGINT) AS kept, CAST(sum(c_custkey) FILTER (c_custkey % 5 > 0) AS BIGINT) AS keys, CAST(0 AS BIGINT) AS missing FROM customer")
def tolerant_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of which every fifth is broken; a missing file is an empty table."""
    path = files.scratch(spark, "broken")
    line = F.to_json(F.struct(F.col("c_custkey").cast("string").alias("url"), F.lit(200).alias("status")))
    read(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 5 == 0, F.substring(line, 1, 9)).otherwise(line).alias("value")).write.text(path)
    own = files.read_jsonl(spark, path, "crawl_index", tolerant=True).agg(F.count("*").alias("kept"), F.sum(F.col("url").cast("long")).alias("keys"))
    gone = files.read_jsonl(spark, f"{path}-nowhere", "crawl_index", tolerant=True).agg(F.count("*").alias("missing"))
    return own.crossJoin(gone)  # one row each


def _rules_sql(rules: list) -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join(f'({i}, {quoted(a)}, {quoted(n)}, {p}, {quoted(x)})' for i, (a, n, p, x) in enumerate(rules))}) AS v(place, label, id, priority, pattern)"


@query(f"SELECT 'standard' AS ruleset, CAST(place AS BIGINT) AS place, label, id, CAST(priority AS BIGINT) AS priority, pattern FROM ({_rules_sql(N.rules())}) AS a UNION ALL SELECT 'builtin', CAST(place AS BIGINT), label, id, CAST(priority AS BIGINT), pattern FROM ({_rules_sql(N.rules('builtin'))}) AS b")
def rules_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both rule sets as YAML, read back."""
    rows = []
    for ruleset in ("standard", "builtin"):
        by_label: dict[str, list] = {}
        for label, name, priority, pattern in N.rules(ruleset):
            by_label.setdefault(label.lower(), []).append({"id": name, "priority": priority, "pattern": pattern})
        back = N.read_rules(yaml.safe_dump(by_label, sort_keys=False, allow_unicode=True))
        place = {(r[1], r[3]): i for i, r in enumerate(N.rules(ruleset))}
        rows += [(ruleset, place[r[1], r[3]], r[0], r[1], r[2], r[3]) for r in back]
    return spark.createDataFrame(rows, "ruleset string, place long, label string, id string, priority long, pattern string")


# --- functions --------------------------------------------------------------------------------------------------------

_CASED = "array_to_string(list_transform(regexp_extract_all({x}, '\\p{{L}}+|[^\\p{{L}}]+'), lambda p: CASE WHEN p[1] = 'ß' THEN 'Ss' ELSE upper(p[1]) END || lower(p[2:])), '')"
_URL_TITLE = _CASED.format(x=f"replace(replace(trim({_PART.format(u='url', i=3)}, '/'), '-', ' '), '/', ' > ')")


@query(f"SELECT page_id, CASE WHEN {_URL_TITLE} = '' THEN url ELSE {_URL_TITLE} END AS title, {_CASED.format(x='coalesce(text, $$$$)').replace('$$$$', chr(39) * 2)} AS cased FROM pages LEFT JOIN benchmark ON page_id = item_id")
def url_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles from urls, and texts in title case."""
    own = read(spark, sf_dir, "pages").join(read(spark, sf_dir, "benchmark"), F.col("page_id") == F.col("item_id"), "left")
    return own.select("page_id", U.url_title(F.col("url")).alias("title"), T.title_case(F.coalesce("text", F.lit(""))).alias("cased"))


_SAMPLE = "regexp_replace(substr(coalesce(text, ''), 1, 2000), '^\\s+|\\s+$', '', 'g')"
_LANGUAGE = " UNION ALL ".join(
    f"SELECT doc_id, {i} AS i, '{lang}' AS lang, len(list_filter(regexp_split_to_array(lower(sample), '\\s+'), lambda w: list_contains([{', '.join(chr(39) + w + chr(39) for w in words.split())}], w))) AS n, length(sample) AS chars FROM s"
    for i, (lang, words) in enumerate(T.STOP_WORDS.items())
)


@query(f"WITH s AS (SELECT doc_id, {_SAMPLE} AS sample FROM documents), l AS ({_LANGUAGE}) SELECT doc_id, CASE WHEN chars > 20 AND n > 0 THEN lang ELSE 'en' END AS language FROM l QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, i) = 1")
def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each text by its stop words."""
    return read(spark, sf_dir, "documents").select("doc_id", T.detect_language(F.coalesce("text", F.lit("")), "stopwords").alias("language"))


_UNCLEAN = "coalesce(text, '') || '  ' || chr(10) || chr(10) || chr(10) || chr(10) || '[Home ' || doc_id || '](https://a.org/x)' || chr(10) || 'see [a](b) here  ' || chr(10) || '  [Top](#top) ' || chr(10) || repeat(chr(10), CAST(doc_id % 4 AS INT)) || 'end '"


@query(rf"""WITH u AS (SELECT doc_id, {_UNCLEAN} AS md FROM documents), c AS (SELECT doc_id, regexp_replace(regexp_replace(md, '\n{{3,}}', chr(10) || chr(10), 'g'), '(?m)^\s*\[([^\]]{{1,60}})\]\([^)]+\)\s*$', '', 'g') AS md FROM u)
    SELECT doc_id, md5(regexp_replace(regexp_replace(md, '(?m)[ \t]+$', '', 'g'), '^\s+|\s+$', '', 'g')) AS text_md5 FROM c""")
def clean_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with links and blank lines added, cleaned."""
    own = read(spark, sf_dir, "documents").select("doc_id", F.expr(_UNCLEAN.replace("chr(10)", "char(10)")).alias("md"))
    return own.select("doc_id", F.md5(T.clean_markdown(F.col("md"))).alias("text_md5"))


@query("SELECT p_partkey, CASE WHEN least(v, 1) * 100 >= 70 THEN '#22c55e' WHEN least(v, 1) * 100 >= 40 THEN '#f59e0b' ELSE '#ef4444' END AS color FROM (SELECT p_partkey, (p_partkey % 130) / 100 AS v FROM part) AS x")
def bar_colors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", summary.bar_color((F.col("p_partkey") % 130) / F.lit(100)).alias("color"))


# --- rules and gazetteers ---------------------------------------------------------------------------------------------


def _found(spark: SparkSession, sf_dir: str, cases: list[tuple[str, str]], **options) -> DataFrame:
    own = N.annotate(corpus.cases(spark, sf_dir, cases).select("pid", "text"), "pid", **options)
    return N.entities(own, "pid").select("pid", "label", "span_text", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("stop"))


def _cases_query(name: str, cases: list[tuple[str, str]], **options) -> None:
    """Each case, twice in a text."""
    at = lambda k: f"8 + {k} * (length(span) + 7)"
    spans = " UNION ALL ".join(f"SELECT pid, label, span AS span_text, CAST({at(k)} AS BIGINT) AS start, CAST({at(k)} + length(span) AS BIGINT) AS stop FROM c" for k in (0, 1))

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _found(spark, sf_dir, cases, **options)

    run.__name__ = name
    query(f"WITH c AS ({corpus.cases_sql(cases)}) {spans}")(run)


_BUILTIN = {r[1] for r in N.rules("builtin")}
_cases_query("ner_rules", [c[1:] for c in corpus.CASES])
_cases_query("ner_builtin_rules", [c[1:] for c in corpus.CASES if c[0] in _BUILTIN], own_rules=N.rules("builtin"))
_cases_query("ner_gazetteers", [*(("ACT_NAME", p) for p in N.acts()), *(("ORG", p) for p in N.organisations())])
_cases_query("ner_act_structure", [("ACT_NAME", "Lighthouse Keepers Act, 1931"), ("ACT_NAME", "Quarry Safety Rules 1999"), ("ACT_NAME", "Canal (Tolls) Code, 1902")])


def _zeta(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in re.finditer(r"Zeta [A-Z]\w*", text)]


_cases_query("ner_model_hook", [("ORG", "Zeta Mills"), ("ORG", "Zeta Works"), ("ORG", "Reserve Bank of India")], model=_zeta)

# --- stages -----------------------------------------------------------------------------------------------------------


@query(f"SELECT url, substr(md5(url), 1, 16) AS url_hash, 'html' AS source_type, {_PAGE_TITLE} AS title, 'en' AS detected_language, 'normalized/' || substr(md5(url), 1, 16) || '.md' AS path_to_text, true AS long_enough FROM pages")
def normalized_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages through the parse stage's operator and the index file, each of a repeated url; texts are held against expectations in tests."""
    path = files.scratch(spark, "normalized_index")
    pages = read(spark, sf_dir, "pages").select("url", F.md5("html").alias("digest"), F.concat(F.lit("data/raw/"), U.url_hash(F.col("url")), F.lit(".html")).alias("path_to_raw"), F.lit("text/html").alias("content_type"), "html")
    raw = pages.select("digest", F.col("path_to_raw").alias("path"), F.col("html").cast("binary").alias("content")).dropDuplicates(["digest"])
    files.write_jsonl(pipeline.parse_documents(pages.drop("html"), raw, on="digest").drop("text"), path)
    own = files.read_jsonl(spark, path, "normalized_index")
    return own.select("url", "url_hash", "source_type", "title", "detected_language", "path_to_text", (F.col("char_count") >= 50).alias("long_enough"))


#: A crawl index of pages and PDF files, with records that lack a url, a path or raw data.
_INDEX = """SELECT CASE WHEN page_id % 17 = 3 THEN NULL WHEN page_id % 17 = 4 THEN '' ELSE url END AS url, CASE WHEN page_id % 17 = 5 THEN NULL ELSE 'data/raw/h' || CAST(page_id AS STRING) || '.html' END AS path_to_raw, 'text/html' AS content_type FROM pages
    UNION ALL SELECT 'https://pdf.example.org/' || CAST(o_orderkey AS STRING), 'data/raw/an-order_' || CAST(o_orderkey AS STRING) || CASE WHEN o_orderkey % 3 = 0 THEN '.bin' ELSE '.pdf' END,
      CASE WHEN o_orderkey % 3 = 0 THEN 'application/pdf; q=1' ELSE 'application/octet-stream' END FROM orders"""
_PDF_TITLE = "CASE WHEN doc_id % 4 = 0 THEN '  Order ' || CAST(doc_id AS STRING) END"


@query(f"""WITH i AS ({_INDEX}), known AS (SELECT url, path_to_raw, regexp_extract(path_to_raw, '([^/]+?)(\\.[^./]*)?$', 1) AS url_hash FROM i WHERE url <> '' AND path_to_raw <> ''),
    {_ORDERED}, x AS (SELECT doc_id, page_no, string_agg(CASE WHEN gap THEN chr(10) ELSE '' END || CASE WHEN level IS NULL THEN text ELSE chr(10) || repeat('#', level) || ' ' || text || chr(10) END, chr(10) ORDER BY ord) AS body FROM h GROUP BY ALL),
    pg AS (SELECT doc_id, page_no, chr(10) || '<!-- page ' || page_no || ' -->' || chr(10) || coalesce(chr(10) || body, '') AS md FROM (SELECT DISTINCT doc_id, page_no FROM t) LEFT JOIN x USING (doc_id, page_no)),
    pdf AS (SELECT doc_id, regexp_replace(string_agg(md, chr(10) || chr(10) ORDER BY page_no), '\\n{{4,}}', chr(10) || chr(10) || chr(10), 'g') AS text FROM pg GROUP BY doc_id)
    SELECT known.url, url_hash, 'html' AS source_type, {_PAGE_TITLE} AS title, NULL AS text_md5 FROM known JOIN pages ON url_hash = 'h' || CAST(page_id AS STRING) WHERE page_id % 19 <> 7
    UNION ALL SELECT url, url_hash, 'pdf', coalesce(trim({_PDF_TITLE}), nullif(regexp_extract(text, '(?m)^#\\s+(.+)$', 1), ''), 'An Order ' || CAST(doc_id AS STRING)), md5(text) FROM known JOIN pdf ON url_hash = 'an-order_' || CAST(doc_id AS STRING) WHERE length(text) >= 50""")
def parse_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and PDF files of one crawl index, parsed by their kinds; records without url, path or raw data drop out."""
    corpus.views(spark, sf_dir, ("pages", "orders"))
    raw = read(spark, sf_dir, "pages").where("page_id % 19 <> 7").select(F.format_string("data/raw/h%d.html", "page_id").alias("path"), F.col("html").cast("binary").alias("content"))
    own = corpus.pdf_spans(spark, sf_dir)
    own = own.withColumn("title", F.expr(_PDF_TITLE)).withColumn("path", F.format_string("data/raw/an-order_%d.pdf", "doc_id"))
    docs = pipeline.parse_documents(spark.sql(_INDEX), raw, own)
    return docs.select("url", "url_hash", "source_type", "title", F.when(F.col("source_type") == "pdf", F.md5("text")).alias("text_md5"))


@query("SELECT doc_id, md5(text) AS text_md5 FROM documents WHERE doc_id % 7 <> 0 AND text IS NOT NULL")
def texts_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index joined with the texts that are there: every seventh is missing."""
    path = files.scratch(spark, "texts")
    docs = read(spark, sf_dir, "documents").where("text is not null").withColumn("path_to_text", F.format_string("normalized/%d.md", "doc_id"))
    files.write_texts(docs.where("doc_id % 7 <> 0").select(F.col("path_to_text").alias("path"), "text"), path)
    return docs.select("doc_id", "path_to_text").join(spark.read.parquet(path), F.col("path") == F.col("path_to_text")).select("doc_id", F.md5("text").alias("text_md5"))


def _chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = corpus.markdown(spark, sf_dir)
    named = docs.select(F.concat(F.lit("https://c.org/"), "doc_id").alias("url"), F.substring(F.md5(F.col("doc_id").cast("string")), 1, 16).alias("url_hash"), F.concat(F.lit("Customer "), "doc_id").alias("title"), "text")
    return pipeline.chunk_documents(named)


@query(f"""WITH RECURSIVE {_FOLD} SELECT substr(md5(CAST(doc_id AS STRING)), 1, 16) || ':' || lpad(CAST(n AS STRING), 4, '0') AS chunk_id, 'https://c.org/' || doc_id AS url, 'Customer ' || doc_id AS title, section_path, page_no, char_start, char_end,
    token_estimate, md5(text) AS text_md5 FROM chunks""")
def chunks_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks as JSON lines, written and read."""
    path = files.scratch(spark, "chunks")
    files.write_jsonl(_chunked(spark, sf_dir), path)
    own = files.read_jsonl(spark, path, "chunks")
    return own.select("chunk_id", "url", "title", F.array_join("section_path", " > ").alias("section_path"), *long("page_no", "char_start", "char_end", "token_estimate"), F.md5("text").alias("text_md5"))


@query(f"SELECT CAST(sid AS STRING) AS chunk_id, oid, string_agg(label || ':' || span_text || ':' || CAST(start AS STRING) || ':' || CAST(stop AS STRING), ',' ORDER BY start) AS entities FROM ({corpus.GOLD}) AS g JOIN (SELECT DISTINCT sid, oid FROM ({corpus.SENTENCES}) AS s) AS o USING (sid) GROUP BY ALL")
def annotations_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations as JSON lines, written, read and joined with what they annotate by chunk_id."""
    path = files.scratch(spark, "annotations")
    own = corpus.sentences(spark, sf_dir).select(F.col("sid").cast("string").alias("chunk_id"), "oid", "text")
    files.write_jsonl(N.annotate(own, "chunk_id"), path)
    shown = F.transform("entities", lambda e: F.concat_ws(":", e.label, e.text, e.start, e.end))
    return files.read_jsonl(spark, path, "annotations").join(own, "chunk_id").select("chunk_id", "oid", F.array_join(shown, ",").alias("entities"))


_TOTALS = "(SELECT count(*) FROM g) AS total_gold, (SELECT count(*) FROM p) AS total_pred, (SELECT CAST(sum(tp) AS BIGINT) FROM c) AS total_tp"


@query(f"SELECT * FROM (WITH {_STRICT}, {_SCORED} SELECT 'strict' AS mode, r.*, {_TOTALS} FROM r) AS a UNION ALL SELECT * FROM (WITH {_PARTIAL}, {_SCORED} SELECT 'partial' AS mode, r.*, {_TOTALS} FROM r) AS b")
def report_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evaluation report as one JSON document, written and read: its labels and totals."""
    found, path = files.scratch(spark, "entities"), files.scratch(spark, "report")
    _resolved(spark, sf_dir).withColumnRenamed("stop", "end").write.parquet(found)
    pred, gold = spark.read.parquet(found), _faulty(spark, sf_dir).withColumnRenamed("stop", "end")
    files.write_report(E.report(pred, gold, "sid", "strict").unionByName(E.report(pred, gold, "sid", "partial")), path)
    own = files.read_report(spark, path)
    rows = own.select("mode", "report.total_gold", "report.total_pred", "report.total_tp", F.explode("report.per_label").alias("label", "s"))
    return rows.select("mode", "label", "s.tp", "s.fp", "s.fn", "s.precision", "s.recall", "s.f1", "total_gold", "total_pred", "total_tp")


@query(f"WITH RECURSIVE {_FOLD} SELECT bin, coalesce(n, 0) AS n FROM (SELECT unnest(['&lt; 400', '400–600', '600–800', '&gt; 800']) AS bin) LEFT JOIN (SELECT CASE WHEN token_estimate < 400 THEN '&lt; 400' WHEN token_estimate < 600 THEN '400–600' WHEN token_estimate <= 800 THEN '600–800' ELSE '&gt; 800' END AS bin, count(*) AS n FROM chunks GROUP BY 1) USING (bin)")
def html_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The histogram in the HTML report, read from the page."""
    page = summary.html_report(K.index(_crawled(spark, sf_dir)), C.chunk(corpus.markdown(spark, sf_dir), "doc_id"))
    rows = re.findall(r"<tr><td>([^<]*)</td><td>(\d+)</td><td>[\d.]+</td></tr>", page)
    return spark.createDataFrame([(b, int(n)) for b, n in rows], "bin string, n long")


@query(f"""WITH RECURSIVE {_FOLD} SELECT * FROM (SELECT (SELECT count(*) FROM ({_crawl_sql()}) AS i) AS crawled, (SELECT count(*) FROM chunks) AS chunked, (SELECT count(*) FROM chunks) AS annotated, (SELECT CAST(sum(token_estimate) AS BIGINT) FROM chunks) AS tokens)""")
def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the crawl, chunk and annotate stages report, over files of a made-up site and of the orders' documents."""
    root = files.scratch(spark, "root")
    seeds, links, pages = corpus.site(spark, sf_dir)
    anchor = F.concat(F.lit('<a href="'), "link", F.lit('">x</a>'))
    body = links.groupBy("src").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", anchor.alias("a")))), lambda x: x.a), "").alias("links"))
    site = pages.join(body, F.col("url") == F.col("src"), "left").select("url", "status", "content_type", F.concat(F.lit("<p>"), F.coalesce("links", F.lit("")), F.lit("</p>")).cast("binary").alias("content"), F.lit(None).cast("string").alias("rendered"))
    site.write.parquet(f"{root}/site")
    whole = seeds.agg(F.map_from_entries(F.transform(F.sort_array(F.collect_list(F.struct("ord", "name", "url"))), lambda s: F.struct(s["name"], s["url"]))).alias("m"))
    whole.select(F.to_json("m").alias("value")).coalesce(1).write.text(f"{root}/seeds.json")
    crawled = pipeline.crawl_stage(spark, root)
    made = files.scratch(spark, "documents")  # read twice
    corpus.markdown(spark, sf_dir).write.parquet(made)
    docs = spark.read.parquet(made).withColumn("url_hash", F.substring(F.md5(F.col("doc_id").cast("string")), 1, 16)).withColumn("path", F.concat(F.lit("normalized/"), "url_hash", F.lit(".md")))
    files.write_texts(docs.select("path", "text"), f"{root}/normalized")
    index = docs.select(F.concat(F.lit("https://c.org/"), "doc_id").alias("url"), "url_hash", F.lit("html").alias("source_type"), F.lit("t").alias("title"), F.lit("en").alias("detected_language"), F.length("text").alias("char_count"), F.col("path").alias("path_to_text"))
    files.write_jsonl(index, f"{root}/normalized_index")
    chunked, annotated = pipeline.chunk_stage(spark, root), pipeline.annotate_stage(spark, root)
    tokens = files.read_jsonl(spark, f"{root}/chunks", "chunks").agg(F.sum("token_estimate")).first()[0]
    return spark.createDataFrame([(crawled, chunked, annotated, tokens)], "crawled long, chunked long, annotated long, tokens long")
