"""The registered queries of the library's own operators and the SQL that checks them."""

from __future__ import annotations

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
from ..operators import sections as S
from ..operators import spans as N
from ..operators import summary
from ..sources import corpus, files
from . import pipeline

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def long(*names: str) -> list:
    return [F.col(n).cast("long").alias(n) for n in names]


# --- tokens -----------------------------------------------------------------------------------------------------------

_WORDS = r"len(list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda x: x <> ''))"
_TOKENS = f"greatest(1, CAST(floor({_WORDS} / 0.75) AS INT))"
_BIN = "CASE WHEN t < 400 THEN '< 400' WHEN t < 600 THEN '400–600' WHEN t <= 800 THEN '600–800' ELSE '> 800' END"


@query(f"""WITH c AS (SELECT {_TOKENS} AS t FROM documents), n AS (SELECT {_BIN} AS bin, count(*) AS n FROM c GROUP BY 1),
    b AS (SELECT unnest(['< 400', '400–600', '600–800', '> 800']) AS bin)
    SELECT bin, coalesce(n, 0) AS n, round(coalesce(n, 0) * 100.0 / (SELECT count(*) FROM c), 1) AS share FROM b LEFT JOIN n USING (bin)""")
def token_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(T.count_tokens(F.coalesce("text", F.lit(""))).alias("token_estimate"))
    return C.histogram(docs)


@query(f"SELECT doc_id, CAST({_TOKENS} AS BIGINT) AS tokens, array_to_string(list_filter(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda x: x <> '')[-56:], ' ') AS tail FROM documents")
def token_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = T.words(F.coalesce("text", F.lit("")))
    return read(spark, sf_dir, "documents").select("doc_id", T.tokens_of(F.size(ws)).cast("long").alias("tokens"), T.last_words(ws, C.OVERLAP).alias("tail"))


# --- urls and pages ---------------------------------------------------------------------------------------------------

_PART = "regexp_extract({u}, '^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\\?([^#]*))?(?:#(.*))?$', {i})"
_NORM = (
    "regexp_replace(CASE WHEN {s} <> '' THEN lower({s}) || ':' ELSE '' END || CASE WHEN {a} <> '' THEN '//' || lower({a}) ELSE '' END || {p} || CASE WHEN {q} <> '' THEN '?' || {q} ELSE '' END, '/+$', '')"
).format(s=_PART.format(u="url", i=1), a=_PART.format(u="url", i=2), p=_PART.format(u="url", i=3), q=_PART.format(u="url", i=4))
_SUFFIX = f"lower(regexp_extract({_PART.format(u='url', i=3)}, '[^/](\\.[^./]+)/*$', 1))"


@query(f"""SELECT page_id, {_NORM} AS normalized, substr(md5(url), 1, 16) AS url_hash, lower({_PART.format(u='url', i=2)}) AS domain, lower(url) LIKE '%.pdf' AS is_pdf,
    {_SUFFIX} IN ({', '.join(f"'.{x}'" for x in U.SKIPPED)}) AS skipped FROM pages""")
def url_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return read(spark, sf_dir, "pages").select("page_id", U.normalize(u).alias("normalized"), U.url_hash(u).alias("url_hash"), U.domain_of(u).alias("domain"), U.is_pdf(u).alias("is_pdf"), U.should_skip(u).alias("skipped"))


@query(f"SELECT lower({_PART.format(u='url', i=2)}) AS domain, count(*) AS pages, count(DISTINCT {_NORM}) AS urls FROM pages GROUP BY 1")
def domain_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = read(spark, sf_dir, "pages").select(U.domain_of(F.col("url")).alias("domain"), U.normalize(F.col("url")).alias("url"))
    return own.groupBy("domain").agg(F.count("*").alias("pages"), F.count_distinct("url").alias("urls"))


@query(f"SELECT substr(md5({_NORM}), 1, 16) AS url_hash, min(page_id) AS page_id, count(*) AS n FROM pages GROUP BY 1")
def url_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = read(spark, sf_dir, "pages").select("page_id", U.url_hash(U.normalize(F.col("url"))).alias("url_hash"))
    return own.groupBy("url_hash").agg(F.min("page_id").alias("page_id"), F.count("*").alias("n"))


_DEC = "{x}"
for _name, _char in (("&nbsp;", "\u00a0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
    _DEC = "replace({}, '{}', '{}')".format(_DEC, _name, _char.replace("'", "''"))
_PATH = f"trim({_PART.format(u='url', i=3)}, '/')"
_TITLE = r"regexp_replace(regexp_replace({d}, '^\s+|\s+$', '', 'g'), '\s*[|\-–—]\s*[^\n]{{3,40}}$', '')".format(d=_DEC.format(x="regexp_extract(html, '(?is)<title[^>]*>([^<]*)</title>', 1)"))
_H1 = _DEC.format(x="regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g')")


@query(f"SELECT page_id, coalesce(nullif(regexp_replace({_TITLE}, '^\\s+|\\s+$', '', 'g'), ''), regexp_replace({_H1}, '^\\s+|\\s+$', '', 'g')) AS title FROM pages")
def page_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", H.title(F.col("html"), F.col("url")).alias("title"))


_ABS = f"""CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href WHEN starts_with(href, '//') THEN {_PART.format(u='base', i=1)} || ':' || href
    ELSE {_PART.format(u='base', i=1)} || '://' || {_PART.format(u='base', i=2)} || CASE WHEN starts_with(href, '/') THEN href ELSE regexp_extract({_PART.format(u='base', i=3)}, '^(.*/)[^/]*$', 1) || href END END"""


@query(f"""WITH b AS (SELECT page_id, url AS base, regexp_replace(html, '(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->', '', 'g') AS h FROM pages),
    l AS (SELECT page_id, base, regexp_extract_all(h, '(?is)<a\\s(?:[^>]*?\\s)?href\\s*=\\s*["'']([^"'']*)["'']', 1) AS hs FROM b),
    u AS (SELECT page_id, base, unnest(range(len(hs))) AS pos, regexp_replace({_DEC.format(x='unnest(hs)')}, '^\\s+|\\s+$', '', 'g') AS href FROM l),
    a AS (SELECT page_id, pos, regexp_replace({_ABS}, '#.*$', '') AS url FROM u WHERE href <> '' AND NOT regexp_matches(href, '^(#|mailto:|tel:|javascript:)'))
    SELECT page_id, pos, {_NORM} AS link, lower({_PART.format(u='url', i=2)}) AS domain FROM a WHERE NOT ({_SUFFIX} IN ({', '.join(f"'.{x}'" for x in U.SKIPPED)}))""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = H.links(read(spark, sf_dir, "pages"), keep=("page_id",))
    return own.select("page_id", *long("pos"), "link", "domain")


_FLAT = r"regexp_replace(html, '(?is)<!--.*?-->', ' ', 'g')"
for _tag in ("script", "style", "head", "nav", "footer"):
    _FLAT = rf"regexp_replace({_FLAT}, '(?is)<{_tag}\b[^>]*>.*?</{_tag}>', ' ', 'g')"
_FLAT = rf"trim(regexp_replace(regexp_replace({_FLAT}, '<[^>]*>', ' ', 'g'), '[ \t\r\n\f\x0b]+', ' ', 'g'))"


@query(f"SELECT page_id, md5({_FLAT}) AS text_md5, length({_FLAT}) AS n_chars FROM pages")
def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = read(spark, sf_dir, "pages").select("page_id", H.flat_text(F.col("html")).alias("t"))
    return own.select("page_id", F.md5("t").alias("text_md5"), F.length("t").cast("long").alias("n_chars"))


_BODY = r"regexp_extract(html, '(?is)<body[^>]*>(.*)</body>', 1)"


@query(rf"""WITH b AS (SELECT page_id, url, html, {_BODY} AS body FROM pages),
    t AS (SELECT *, {_DEC.format(x="regexp_replace(regexp_replace(body, '(?s)<!--.*?-->', '', 'g'), '<[^>]*>', chr(10), 'g')")} AS said FROM b)
    SELECT page_id, lower({_PART.format(u='url', i=2)}) IN ({', '.join(f"'{d}'" for d in U.JS_DOMAINS)}) OR (regexp_matches(html, '(?i)<body') AND
      length(regexp_replace(regexp_replace(said, '\s*\n\s*', '', 'g'), '^\s+|\s+$', '', 'g')) < 500 AND len(regexp_extract_all(body, '(?i)<script[\s>]')) > 3) AS needs_js FROM t""")
def page_needs_js(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", H.needs_js(F.col("html"), F.col("url")).alias("needs_js"))


# --- sections and chunks ----------------------------------------------------------------------------------------------

_MARKDOWN = f"md AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY sid, line) AS text FROM ({corpus.MARKDOWN_LINES}) AS m GROUP BY doc_id)"
_HEAD = r"'^(#{1,4})\s+(.+)$'"
_BLOCKS = rf"""{_MARKDOWN},
  parts AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n FROM md),
  l AS (SELECT *, CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS char_start,
    regexp_extract(trim(line), '^<!--\s*page\s+(\d+)\s*-->', 1) AS page, length(regexp_extract(line, {_HEAD}, 1)) AS level, trim(regexp_extract(line, {_HEAD}, 2)) AS heading FROM parts),
  k AS (SELECT *, CASE WHEN page <> '' THEN 'page' WHEN level > 0 THEN 'heading' WHEN trim(line) <> '' THEN 'content' ELSE 'blank' END AS kind FROM l),
  f AS (SELECT *, coalesce(last_value(CASE WHEN kind = 'page' THEN CAST(page AS INT) END IGNORE NULLS) OVER w, 1) AS page_no,
    {', '.join(f"last_value(CASE WHEN kind = 'heading' AND level <= {k} THEN {{'level': level, 'heading': heading}} END IGNORE NULLS) OVER w AS h{k}" for k in range(1, 5))}
    FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
  blocks AS (SELECT doc_id, n, trim(line) AS block, page_no, char_start, char_start + length(line) AS char_end,
    concat_ws(' > ', {', '.join(f"CASE WHEN h{k}.level = {k} THEN h{k}.heading END" for k in range(1, 5))}) AS path FROM f WHERE kind = 'content')"""


@query(f"WITH {_BLOCKS} SELECT doc_id, CAST(n AS BIGINT) AS n, md5(block) AS block_md5, CAST(page_no AS BIGINT) AS page_no, char_start, char_end, path AS section_path FROM blocks")
def section_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = S.blocks(corpus.markdown(spark, sf_dir), "doc_id")
    return own.select("doc_id", *long("n"), F.md5("block").alias("block_md5"), *long("page_no", "char_start", "char_end"), F.array_join("section_path", " > ").alias("section_path"))


#: One row for each document and block: the fold's state after the block, and what it emitted before and after it.
_FOLD = rf"""{_BLOCKS},
  b AS (SELECT *, len(list_filter(regexp_split_to_array(block, '\s+'), lambda x: x <> '')) AS w, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS i FROM blocks),
  s AS (
    SELECT doc_id, 0::BIGINT AS i, 0::BIGINT AS w, 0 AS items, 1 AS page, 0::BIGINT AS cs, 0::BIGINT AS ce, 1 AS lp, 0::BIGINT AS ls, '' AS path, 1::BIGINT AS fb, false AS lead,
      NULL::STRUCT(w BIGINT, page INT, cs BIGINT, ce BIGINT, path VARCHAR, fb BIGINT, lb BIGINT, lead BOOLEAN) AS soft, NULL::STRUCT(w BIGINT, page INT, cs BIGINT, ce BIGINT, path VARCHAR, fb BIGINT, lb BIGINT, lead BOOLEAN) AS hard FROM (SELECT DISTINCT doc_id FROM b)
    UNION ALL
    SELECT doc_id, i, CASE WHEN over_ THEN least(w2, 56) ELSE w2 END, CASE WHEN over_ THEN 1 ELSE items2 END, CASE WHEN over_ THEN page_no ELSE page2 END, CASE WHEN over_ THEN char_start ELSE cs2 END, char_end,
      page_no, char_start, path, CASE WHEN over_ THEN i + 1 ELSE fb2 END, over_ OR lead2, soft, CASE WHEN over_ THEN {{'w': w2, 'page': page2, 'cs': cs2, 'ce': char_end, 'path': path, 'fb': fb2, 'lb': i, 'lead': lead2}} END
    FROM (SELECT *, greatest(1, CAST(floor(w2 / 0.75) AS INT)) >= 900 AS over_ FROM (
      SELECT doc_id, i, page_no, char_start, char_end, path, CASE WHEN f THEN {{'w': sw, 'page': spage, 'cs': scs, 'ce': sce, 'path': spath, 'fb': sfb, 'lb': i - 1, 'lead': slead}} END AS soft, CASE WHEN f OR sitems = 0 THEN i ELSE sfb END AS fb2, f OR slead AS lead2,
        CASE WHEN f THEN least(sw, 56) ELSE sw END + bw AS w2, CASE WHEN f THEN 1 ELSE sitems END + 1 AS items2,
        CASE WHEN f THEN slp WHEN sitems = 0 THEN page_no ELSE spage END AS page2, CASE WHEN f THEN sls WHEN sitems = 0 THEN char_start ELSE scs END AS cs2
      FROM (SELECT b.doc_id, b.i, b.page_no, b.char_start, b.char_end, b.path, b.w AS bw, s.w AS sw, s.items AS sitems, s.page AS spage, s.cs AS scs, s.ce AS sce, s.lp AS slp, s.ls AS sls, s.path AS spath, s.fb AS sfb, s.lead AS slead,
          s.items > 0 AND s.path <> b.path AND greatest(1, CAST(floor(s.w / 0.75) AS INT)) >= 400 AS f FROM s JOIN b ON s.doc_id = b.doc_id AND b.i = s.i + 1)))),
  e AS (SELECT doc_id, i, 0 AS k, soft AS c FROM s WHERE soft IS NOT NULL UNION ALL SELECT doc_id, i, 1, hard FROM s WHERE hard IS NOT NULL
    UNION ALL SELECT doc_id, i, 2, {{'w': w, 'page': page, 'cs': cs, 'ce': ce, 'path': path, 'fb': fb, 'lb': i, 'lead': lead}} FROM s WHERE items > 0 AND i = (SELECT max(i) FROM b WHERE b.doc_id = s.doc_id)),
  chunks AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i, k) AS n, c.path AS section_path, CAST(c.page AS BIGINT) AS page_no, c.cs AS char_start, c.ce AS char_end,
    CAST(greatest(1, floor(c.w / 0.75)) AS BIGINT) AS token_estimate, array_to_string(list_concat(CASE WHEN c.lead THEN
      [array_to_string(list_filter(regexp_split_to_array(array_to_string(bl[greatest(1, c.fb - 56):c.fb - 1], ' '), '\s+'), lambda x: x <> '')[-56:], ' ')] ELSE [] END, bl[c.fb:c.lb]), ' ') AS text
    FROM e JOIN (SELECT doc_id, list(block ORDER BY i) AS bl FROM b GROUP BY doc_id) AS own USING (doc_id))"""
_FOLD = _FOLD.replace("md AS (", "md AS MATERIALIZED (", 1).replace("  b AS (", "  b AS MATERIALIZED (", 1)


@query(f"WITH RECURSIVE {_FOLD} SELECT doc_id, n, section_path, page_no, char_start, char_end, token_estimate, md5(text) AS text_md5 FROM chunks")
def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = C.chunk(corpus.markdown(spark, sf_dir), "doc_id")
    return own.select("doc_id", *long("n"), F.array_join("section_path", " > ").alias("section_path"), *long("page_no", "char_start", "char_end", "token_estimate"), F.md5("chunk_text").alias("text_md5"))


@query(f"WITH RECURSIVE {_FOLD} SELECT count(*) AS chunks, round(avg(token_estimate), 6) AS avg_tokens FROM chunks")
def chunk_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = summary.chunk_totals(C.chunk(corpus.markdown(spark, sf_dir), "doc_id"))
    return own.select("chunks", F.round("avg_tokens", 6).alias("avg_tokens"))


# --- spans ------------------------------------------------------------------------------------------------------------


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = corpus.sentences(spark, sf_dir)
    return N.entities(N.annotate(own.select("sid", "text"), "sid"), "sid").withColumnRenamed("end", "stop")


def _by_label(name: str, label: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _resolved(spark, sf_dir).where(F.col("label") == label).select("sid", "span_text", *long("start", "stop"))

    run.__name__ = name
    query(f"SELECT sid, span_text, CAST(start AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM ({corpus.GOLD}) AS g WHERE label = '{label}'")(run)


for _label in legal.LABEL_PRIORITY:
    _by_label(f"ner_{_label.lower()}", _label)


@query(f"SELECT sid, string_agg(label || ':' || CAST(start AS STRING) || ':' || CAST(stop AS STRING), ',' ORDER BY start) AS entities FROM ({corpus.GOLD}) AS g GROUP BY sid")
def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = N.annotate(corpus.sentences(spark, sf_dir).select("sid", "text"), "sid")
    shown = F.transform("entities", lambda e: F.concat_ws(":", e.label, e.start, e.end))
    return own.select("sid", F.array_join(shown, ",").alias("entities"))


@query(f"SELECT label, count(*) AS n, count(DISTINCT span_text) AS texts FROM ({corpus.GOLD}) AS g GROUP BY label")
def entity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved(spark, sf_dir).groupBy("label").agg(F.count("*").alias("n"), F.count_distinct("span_text").alias("texts"))


# --- evaluation -------------------------------------------------------------------------------------------------------

#: Gold with faults: every fifth sentence lacks its third entity, every seventh has its second shifted by a few characters, and by half of it every eleventh.
_FAULTY = "SELECT sid, label, {text} AS span_text, start + shift AS start, stop + shift AS stop, ord FROM (SELECT *, CASE WHEN sid % 7 = 0 AND ord = 1 THEN 4 WHEN sid % 11 = 0 AND ord = 1 THEN 14 ELSE 0 END AS shift FROM {gold}) AS x WHERE NOT (sid % 5 = 0 AND ord = 2)"
_SHIFTED = "CASE WHEN shift > 0 THEN span_text || '~' ELSE span_text END"


def _faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus.gold(spark, sf_dir).createOrReplaceTempView("quillstone_gold")
    return spark.sql(_FAULTY.format(gold="quillstone_gold", text=_SHIFTED))


_EVAL = f"g AS ({_FAULTY.format(gold=f'({corpus.GOLD}) AS y', text=_SHIFTED)}), p AS ({corpus.GOLD})"
_STRICT = f"""{_EVAL}, gs AS (SELECT DISTINCT sid, label, span_text FROM g), ps AS (SELECT DISTINCT sid, label, span_text FROM p),
    c AS (SELECT label, count(*) FILTER (a AND b) AS tp, count(*) FILTER (a AND b IS NULL) AS fp, count(*) FILTER (a IS NULL AND b) AS fn
    FROM (SELECT *, true AS a FROM ps) FULL JOIN (SELECT *, true AS b FROM gs) USING (sid, label, span_text) GROUP BY label)"""
#: Sentences have at most one entity of a label, so that one-to-one matching is a join here.
_PARTIAL = f"""{_EVAL}, j AS (SELECT label, g.sid IS NOT NULL AND p.sid IS NOT NULL AND greatest(0, least(p.stop, g.stop) - greatest(p.start, g.start)) >= 0.5 * (g.stop - g.start) AS hit, p.sid IS NOT NULL AS a, g.sid IS NOT NULL AS b
    FROM p FULL JOIN g USING (sid, label)), c AS (SELECT label, count(*) FILTER (hit) AS tp, count(*) FILTER (a AND NOT hit) AS fp, count(*) FILTER (b AND NOT hit) AS fn FROM j GROUP BY label)"""
_SCORED = "s AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS pr, coalesce(tp / nullif(tp + fn, 0), 0) AS re FROM c), r AS (SELECT label, tp, fp, fn, round(pr, 4) AS precision, round(re, 4) AS recall, round(coalesce(2 * pr * re / nullif(pr + re, 0), 0), 4) AS f1 FROM s)"


@query(f"WITH {_STRICT}, {_SCORED} SELECT * FROM r")
def eval_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.scores(E.strict_counts(_resolved(spark, sf_dir), _faulty(spark, sf_dir), "sid"))


@query(f"WITH {_PARTIAL}, {_SCORED} SELECT * FROM r")
def eval_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    pred, gold = (df.withColumnRenamed("stop", "end") for df in (_resolved(spark, sf_dir), _faulty(spark, sf_dir)))
    return E.scores(E.partial_counts(pred, gold, "sid"))


@query(f"""WITH {_STRICT}, {_SCORED}, t AS (SELECT sum(tp) AS tp, (SELECT count(*) FROM p) AS np, (SELECT count(*) FROM g) AS ng FROM r)
    SELECT 'macro' AS scope, round(avg(precision), 4) AS precision, round(avg(recall), 4) AS recall, round(avg(f1), 4) AS f1 FROM r
    UNION ALL SELECT 'micro', round(tp / np, 4), round(tp / ng, 4), round(2 * (tp / np) * (tp / ng) / (tp / np + tp / ng), 4) FROM t""")
def eval_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = files.scratch(spark, "entities")  # read twice
    _resolved(spark, sf_dir).write.parquet(path)
    pred, gold = spark.read.parquet(path), _faulty(spark, sf_dir)
    scored = E.scores(E.strict_counts(pred, gold, "sid"))
    return E.averages(scored, pred.agg(F.count("*").alias("n")), gold.agg(F.count("*").alias("n")))


# --- pdf --------------------------------------------------------------------------------------------------------------

_MODAL = f"""sp AS ({corpus.PDF_SPANS}), t AS (SELECT * FROM sp WHERE kind = 0), m0 AS (SELECT doc_id, page_no, size, count(*) AS n, min(block_no * 1000::BIGINT + line_no * 10 + span_no) AS f FROM t GROUP BY ALL),
    m AS (SELECT doc_id, page_no, size AS modal FROM m0 QUALIFY row_number() OVER (PARTITION BY doc_id, page_no ORDER BY n DESC, f) = 1)"""
_ORDERED = rf"""{_MODAL}, b AS (SELECT doc_id, page_no, block_no, min(page_width) AS pw, min(x0) AS x0, min(y0) AS y0, min(y1) AS y1, max(size) AS ms, trim(regexp_replace(string_agg(text, '' ORDER BY line_no, span_no), '[ \t]+', ' ', 'g')) AS text FROM t GROUP BY ALL),
    col AS (SELECT doc_id, page_no, count(DISTINCT round_even(x0 / 50, 0)) AS n_columns FROM b GROUP BY ALL),
    o AS (SELECT b.*, modal, n_columns, row_number() OVER w AS ord, lag(y1) OVER w AS bottom FROM b JOIN m USING (doc_id, page_no) JOIN col USING (doc_id, page_no) WHERE length(text) >= 2
      WINDOW w AS (PARTITION BY doc_id, page_no ORDER BY CASE WHEN n_columns >= 4 THEN CAST(x0 >= pw / 2 AS INT) ELSE 0 END, y0, CASE WHEN n_columns < 4 THEN x0 END NULLS FIRST, block_no)),
    h AS (SELECT *, CASE WHEN ms / modal >= 1.5 THEN 1 WHEN ms / modal >= 1.25 THEN 2 WHEN ms / modal >= 1.15 THEN 3 END AS level, coalesce(bottom >= 0 AND y0 - bottom > modal * 1.8, false) AS gap FROM o)"""


@query(f"WITH {_MODAL} SELECT doc_id, CAST(page_no AS BIGINT) AS page_no, modal FROM m")
def pdf_modal_font(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.modal_sizes(corpus.pdf_spans(spark, sf_dir)).select("doc_id", *long("page_no"), "modal")


@query(f"WITH {_ORDERED} SELECT doc_id, CAST(page_no AS BIGINT) AS page_no, CAST(block_no AS BIGINT) AS block_no, ord, n_columns >= 4 AS two_column, CAST(level AS BIGINT) AS level, gap, text FROM h")
def pdf_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = P.ordered_blocks(corpus.pdf_spans(spark, sf_dir))
    return own.select("doc_id", *long("page_no", "block_no", "ord"), "two_column", *long("level"), "gap", "text")


@query(f"""WITH {_ORDERED}, x AS (SELECT doc_id, page_no, string_agg(CASE WHEN gap THEN chr(10) ELSE '' END || CASE WHEN level IS NULL THEN text ELSE chr(10) || repeat('#', level) || ' ' || text || chr(10) END, chr(10) ORDER BY ord) AS body FROM h GROUP BY ALL),
    pg AS (SELECT doc_id, page_no, chr(10) || '<!-- page ' || page_no || ' -->' || chr(10) || coalesce(chr(10) || body, '') AS md FROM (SELECT DISTINCT doc_id, page_no FROM t) LEFT JOIN x USING (doc_id, page_no))
    SELECT doc_id, md5(regexp_replace(string_agg(md, chr(10) || chr(10) ORDER BY page_no), '\\n{{4,}}', chr(10) || chr(10) || chr(10), 'g')) AS text_md5 FROM pg GROUP BY doc_id""")
def pdf_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.markdown(corpus.pdf_spans(spark, sf_dir)).select("doc_id", F.md5("text").alias("text_md5"))


# --- crawl ------------------------------------------------------------------------------------------------------------

def _crawl_sql(extra: str = "", allowed: str = "true") -> str:
    """The crawl in SQL; extra: further tables, allowed: a condition on url."""
    dom = "lower(regexp_extract({u}, '^[^:]+://([^/]*)', 1))"
    out = [f"lk AS ({corpus.LINKS}), st AS ({corpus.SITE}), c0 AS (SELECT url, ord, {dom.format(u='url')} AS d FROM ({corpus.SEEDS}) AS sd){extra}"]
    for k in range(4):
        seen = " UNION ALL ".join(f"SELECT url FROM t{j}" for j in range(k)) or "SELECT NULL AS url WHERE false"
        used = " UNION ALL ".join(f"SELECT d FROM t{j} WHERE ok" for j in range(k)) or "SELECT NULL AS d WHERE false"
        out.append(f"""f{k} AS (SELECT url, min(ord) AS ord, min(d) AS d FROM c{k} WHERE url NOT IN ({seen}) AND {allowed} GROUP BY url),
          q{k} AS (SELECT f{k}.*, status, content_type, coalesce(status = 200 OR (NOT lower(f{k}.url) LIKE '%.pdf' AND status < 400), false) AS ok FROM f{k} LEFT JOIN st USING (url)),
          t{k} AS (SELECT * FROM (SELECT *, coalesce(sum(CAST(ok AS INT)) OVER (PARTITION BY d ORDER BY ord, url ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (SELECT count(*) FROM ({used}) AS us WHERE us.d = q{k}.d) AS before FROM q{k}) WHERE before < {K.MAX_PAGES})""")
        if k < 3:
            out.append(f"""c{k + 1} AS (SELECT link AS url, row_number() OVER (PARTITION BY d ORDER BY ord, CASE WHEN lower(link) LIKE '%.pdf' THEN 0 ELSE 1 END, pos, link) AS ord, d FROM t{k} JOIN lk ON src = url
              WHERE ok AND NOT lower(url) LIKE '%.pdf' AND content_type <> 'application/pdf' AND {dom.format(u='link')} = d)""")
    every = " UNION ALL ".join(f"SELECT url, {k} AS depth, d AS seed_dom, status, content_type FROM t{k} WHERE ok" for k in range(4))
    return f"WITH {', '.join(out)} SELECT url, CAST(depth AS BIGINT) AS depth, seed_dom, CAST(status AS BIGINT) AS status, content_type FROM ({every}) AS every_level"


def _crawled(spark: SparkSession, sf_dir: str, robots: DataFrame | None = None) -> DataFrame:
    seeds, links, pages = corpus.site(spark, sf_dir)
    return K.crawl(seeds, links, pages, robots)


@query(_crawl_sql())
def crawl_bfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _crawled(spark, sf_dir).select("url", *long("depth"), "seed_dom", *long("status"), "content_type")


_ROBOTS_SQL = f""", ro AS (SELECT * FROM (VALUES {", ".join(map(str, corpus.ROBOTS))}) AS v(base, entry, agent, ord, path_prefix, allow) WHERE agent = '*' OR contains('{K.AGENT.split("/")[0]}', lower(agent))),
    rg AS (SELECT base, path_prefix, allow, ord FROM ro QUALIFY entry = first_value(entry) OVER (PARTITION BY base ORDER BY agent = '*', entry))"""
_ALLOWED = "coalesce((SELECT arg_min(allow, ord) FROM rg WHERE starts_with(url, base || path_prefix)), true)"


@query(_crawl_sql(_ROBOTS_SQL, _ALLOWED))
def crawl_robots(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(corpus.ROBOTS), "base string, entry int, agent string, ord int, path_prefix string, allow boolean")
    return _crawled(spark, sf_dir, rules).select("url", *long("depth"), "seed_dom", *long("status"), "content_type")


@query(f"""WITH i AS ({_crawl_sql()}) SELECT count(*) AS pages, count(*) FILTER (content_type <> 'application/pdf' AND NOT lower(url) LIKE '%.pdf') AS html,
    count(*) FILTER (content_type = 'application/pdf' OR lower(url) LIKE '%.pdf') AS pdf, 0 AS js, count(*) FILTER (content_type <> 'application/pdf' AND NOT lower(url) LIKE '%.pdf') AS static_html FROM i""")
def crawl_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.composition(K.index(_crawled(spark, sf_dir)))


# --- the whole run ----------------------------------------------------------------------------------------------------


@query(f"""WITH RECURSIVE {_FOLD} SELECT (SELECT count(DISTINCT doc_id) FROM b) AS documents, count(*) AS chunks, count(*) FILTER (token_estimate < 400) AS short_chunks FROM chunks""")
def legal_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = pipeline.annotate_documents(corpus.markdown(spark, sf_dir))
    return own.agg(F.count_distinct("doc_id").alias("documents"), F.count("*").alias("chunks"), F.count_if(F.col("token_estimate") < 400).alias("short_chunks"))


#: What the sentences can hold, also where an overlap begins within one; look-alikes have a letter before them or begin small.
_KINDS = {
    "SECTION_REF": r"(?:^|[^A-Za-z0-9_])(?:Clause \(b\) of Section|Section|Rule|Article) \d+", "ACT_NAME": r"\b[A-Z][A-Za-z &(),-]{5,80}(?:Act|Code), \d{4}\b",
    "ORG": r"Reserve Bank of India|Securities and Exchange Board of India(?: Act)?|Central Board of Direct Taxes|National Green Tribunal|Delhi High Court|Ministry of Finance",
    "NOTIFICATION": r"S\.O\. \d+\(E\)|G\.S\.R\. \d+|Circular No\. \d+/2020", "DATE": r"\d{4}-\d{2}-\d{2}", "MONEY": r"Rs\. \d+|USD \d+|INR \d+ Crore",
}
_COUNTED = " UNION ALL ".join(f"SELECT '{label}' AS label, len(list_filter(regexp_extract_all(text, '{pattern}'), lambda x: x NOT LIKE '%India Act')) AS k FROM chunks" for label, pattern in _KINDS.items())


@query(f"WITH RECURSIVE {_FOLD} SELECT label, CAST(sum(k) AS BIGINT) AS n, count(*) FILTER (k > 0) AS chunks FROM ({_COUNTED}) AS c GROUP BY label")
def legal_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = pipeline.annotate_documents(corpus.markdown(spark, sf_dir))
    return own.select("chunk_id", F.inline_outer("entities")).groupBy("label").agg(F.count("*").alias("n"), F.count_distinct("chunk_id").alias("chunks"))
