"""Run summaries: crawl composition, chunk statistics and a plain HTML report of both."""

from __future__ import annotations

import html

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import histogram


def composition(crawl_index: DataFrame) -> DataFrame:
    """One row: pages, html, pdf, js, static_html."""
    path = F.coalesce("path_to_raw", F.lit(""))
    one = crawl_index.agg(F.count("*").alias("pages"), F.count_if(path.endswith(".html")).alias("html"), F.count_if(path.endswith(".pdf")).alias("pdf"), F.count_if(F.coalesce("used_js", F.lit(False))).alias("js"))
    return one.withColumn("static_html", F.col("html") - F.col("js"))


def chunk_totals(chunks: DataFrame) -> DataFrame:
    """One row: chunks, avg_tokens (0 without chunks)."""
    return chunks.agg(F.count("*").alias("chunks"), F.coalesce(F.avg(F.coalesce("token_estimate", F.lit(0))), F.lit(0.0)).alias("avg_tokens"))


def bar_color(value, most: float = 1.0):
    pct = F.least(value / most, F.lit(1.0)) * 100
    return F.when(pct >= 70, "#22c55e").when(pct >= 40, "#f59e0b").otherwise("#ef4444")


def html_report(crawl_index: DataFrame, chunks: DataFrame, report: DataFrame | None = None) -> str:
    """The report as an HTML page. Only aggregates come to the driver: single rows, four bins and a row for each label."""
    rows = lambda df: "".join("<tr>" + "".join(f"<td>{html.escape(str(v))}</td>" for v in r) + "</tr>" for r in df.collect())
    parts = [("Crawl", composition(crawl_index)), ("Chunks", chunk_totals(chunks)), ("Tokens", histogram(chunks))]
    if report is not None:
        parts.append(("Spans", report.withColumn("color", bar_color(F.col("f1")))))
    body = "".join(f"<h2>{name}</h2><table><tr>{''.join(f'<th>{c}</th>' for c in df.columns)}</tr>{rows(df)}</table>" for name, df in parts)
    return f"<!DOCTYPE html><html lang=\"en\"><head><meta charset=\"UTF-8\"><title>Run summary</title></head><body><h1>Run summary</h1>{body}</body></html>"
