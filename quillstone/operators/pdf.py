"""PDF pages as tables of spans to Markdown: fonts, columns, gaps and headings by aggregates and windows.

Spans: doc_id, page_no, page_width, block_no, line_no, span_no, kind (0: text), x0, y0, x1, y1 (of the block), size, text.
Any reader that fills such rows will do; pages are independent of each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

PAGE = ("doc_id", "page_no")
DEFAULT_SIZE = 12.0


def modal_sizes(spans: DataFrame) -> DataFrame:
    """doc_id, page_no, modal: the commonest font size, to a tenth; of equally common ones that seen first."""
    order = F.struct("block_no", "line_no", "span_no")
    counted = spans.where("kind = 0").groupBy(*PAGE, F.bround(F.coalesce("size", F.lit(DEFAULT_SIZE)), 1).alias("size")).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return counted.groupBy(*PAGE).agg(F.min(F.struct((-F.col("n")).alias("n"), "first", "size")).alias("best")).select(*PAGE, F.col("best.size").alias("modal"))


def text_blocks(spans: DataFrame) -> DataFrame:
    """Text blocks with their spans' texts joined by nothing, cleaned, and their largest font."""
    parts = F.array_sort(F.collect_list(F.struct("line_no", "span_no", F.coalesce("text", F.lit("")).alias("text"))))
    out = spans.where("kind = 0").groupBy(*PAGE, "block_no").agg(
        F.first("page_width").alias("page_width"), F.first("x0").alias("x0"), F.first("y0").alias("y0"), F.first("y1").alias("y1"),
        F.max(F.coalesce("size", F.lit(DEFAULT_SIZE))).alias("max_size"), F.array_join(F.transform(parts, lambda p: p.text), "").alias("text"),
    )
    return out.withColumn("text", T.clean_pdf_text(T.strip(F.col("text"))))


def columns(blocks: DataFrame) -> DataFrame:
    """doc_id, page_no, n_columns (distinct left edges in steps of 50), two_column (from four on)."""
    n = F.count_distinct(F.bround(F.col("x0") / 50, 0))
    return blocks.groupBy(*PAGE).agg(n.alias("n_columns")).withColumn("two_column", F.col("n_columns") >= 4)


def heading_level(size: Column, modal: Column) -> Column:
    ratio = F.when(modal != 0, size / modal).otherwise(F.lit(1.0))
    return F.when(ratio >= 1.5, 1).when(ratio >= 1.25, 2).when(ratio >= 1.15, 3)


def ordered_blocks(spans: DataFrame) -> DataFrame:
    """Text blocks of two characters or more in reading order: with ord, level and gap (a blank line goes before)."""
    blocks = text_blocks(spans)
    own = blocks.join(columns(blocks), list(PAGE)).join(modal_sizes(spans), list(PAGE))
    right = F.col("x0") >= F.col("page_width") / 2
    keys = (F.when(F.col("two_column"), right.cast("int")).otherwise(0), F.col("y0"), F.when(~F.col("two_column"), F.col("x0")), F.col("block_no"))
    w = Window.partitionBy(*PAGE).orderBy(*keys)
    own = own.where(F.length("text") >= 2).withColumn("ord", F.row_number().over(w)).withColumn("level", heading_level(F.col("max_size"), F.col("modal")))
    bottom = F.lag("y1").over(w)
    return own.withColumn("gap", F.coalesce((bottom >= 0) & (F.col("y0") - bottom > F.col("modal") * 1.8), F.lit(False)))


def page_markdown(spans: DataFrame) -> DataFrame:
    """doc_id, page_no, markdown for each page that has a text block."""
    shown = F.when(F.col("level").isNotNull(), F.concat(F.lit("\n"), F.repeat(F.lit("#"), F.col("level")), F.lit(" "), F.col("text"), F.lit("\n"))).otherwise(F.col("text"))
    row = F.struct("ord", F.when(F.col("gap"), F.concat(F.lit("\n"), shown)).otherwise(shown).alias("shown"))
    body = ordered_blocks(spans).withColumn("row", row).groupBy(*PAGE).agg(F.array_sort(F.collect_list("row")).alias("rows"))
    pages = spans.where("kind = 0").select(*PAGE).distinct().join(body, list(PAGE), "left")
    head = F.format_string("\n<!-- page %d -->\n", "page_no")
    rest = F.transform(F.coalesce("rows", F.array().cast("array<struct<ord:int,shown:string>>")), lambda r: r.shown)
    return pages.select(*PAGE, F.array_join(F.concat(F.array(head), rest), "\n").alias("markdown"))


def markdown(spans: DataFrame) -> DataFrame:
    """doc_id, text: a document's pages, in order, with at most three line ends in a row."""
    pages = page_markdown(spans).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page_no", "markdown"))).alias("p"))
    joined = F.array_join(F.transform("p", lambda x: x.markdown), "\n\n")
    return pages.select("doc_id", F.regexp_replace(joined, "\n{4,}", "\n\n\n").alias("text"))


def title(meta: Column, text: Column, stem: Column) -> Column:
    """The metadata's title, else the first top heading, else the file's name in title case."""
    heading = T.strip(F.regexp_extract(text, r"(?md)^#\s+(.+)$", 1))
    named = T.title_case(F.translate(stem, "-_", "  "))
    return F.coalesce(F.nullif(T.strip(meta), F.lit("")), F.nullif(heading, F.lit("")), named)


def normalize(texts: DataFrame, least: int = 50, detector: str = "constant") -> DataFrame:
    """Markdown of PDF files (url, url_hash, _meta, text) as documents, with the columns of html.normalize(); _meta is the title in the file or null."""
    named = title(F.coalesce("_meta", F.lit("")), F.col("text"), F.col("url_hash"))
    out = texts.select("url", "url_hash", F.lit("pdf").alias("source_type"), named.alias("title"), "text")
    out = out.withColumn("detected_language", T.detect_language(F.col("text"), detector)).withColumn("char_count", F.length("text"))
    return out.where(F.col("char_count") >= least).select("url", "url_hash", "source_type", "title", "detected_language", "char_count", "text")
