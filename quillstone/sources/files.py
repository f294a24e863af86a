"""Scans and sinks of the stages' files: JSON lines with fixed schemas, seeds, raw pages, rules and reports."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "crawl_index": "url string, status int, content_type string, used_js boolean, timestamp string, path_to_raw string",
    "normalized_index": "url string, url_hash string, source_type string, title string, detected_language string, char_count int, path_to_text string",
    "chunks": "chunk_id string, url string, title string, section_path array<string>, page_no int, char_start int, char_end int, token_estimate int, text string",
    "annotations": "chunk_id string, entities array<struct<label:string,text:string,start:int,end:int>>",
    "gold": "text string, entities array<struct<label:string,text:string,start:int,end:int>>",
}


def read_jsonl(spark: SparkSession, path: str, kind: str, tolerant: bool = False) -> DataFrame:
    """Rows of a JSON lines file or folder; blank lines are skipped.

    Malformed lines fail the read, or, if tolerant, are left out; a missing path is then an empty table.
    """
    reader = spark.read.schema(SCHEMAS[kind]).option("mode", "DROPMALFORMED" if tolerant else "FAILFAST")
    try:
        return reader.json(path)
    except AnalysisException as e:
        if tolerant and "PATH_NOT_FOUND" in (e.getCondition() or ""):
            return spark.createDataFrame([], SCHEMAS[kind])
        raise


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """Seeds of a JSON object name -> url, in the file's order: name, url, ord."""
    text = spark.read.text(path, wholetext=True)
    pairs = F.map_entries(F.from_json("value", "map<string,string>"))
    return text.select(F.posexplode(pairs).alias("ord", "e")).select(F.col("e.key").alias("name"), F.col("e.value").alias("url"), "ord")


def read_html(spark: SparkSession, path: str, names: str = "*.html") -> DataFrame:
    """path, html of the pages under a folder; invalid UTF-8 is replaced."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", names).option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.make_valid_utf8(F.col("content").cast("string")).alias("html"))


def write_raw(raw: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Raw data by path (path, content) as a Parquet table: a file for each page would be millions of small ones. The last of equal paths counts."""
    raw.groupBy("path").agg(F.max("content").alias("content")).write.mode(mode).parquet(path)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """path, content of a table by write_raw(), or of a folder of files."""
    try:
        found = spark.read.option("pathGlobFilter", "*.parquet").parquet(path)
    except AnalysisException as e:
        if "UNABLE_TO_INFER_SCHEMA" not in (e.getCondition() or ""):
            raise
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return found.select("path", "content")


def write_texts(texts: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Markdown texts by path (path, text) as a Parquet table with one row for each path."""
    texts.groupBy("path").agg(F.max("text").alias("text")).write.mode(mode).parquet(path)


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, or None where there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or ""):
            return None
        raise


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder of spark.checkpoint.dir; on one machine without that setting, in the warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared}/quillstone-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


_SCORES = "precision:double,recall:double,f1:double"
_LABELS = f"map<string,struct<{_SCORES},tp:bigint,fp:bigint,fn:bigint>>"
_REPORT = f"map<string,struct<mode:string,total_gold:bigint,total_pred:bigint,total_tp:bigint,per_label:{_LABELS},macro:struct<{_SCORES}>,micro:struct<{_SCORES}>>>"


def write_report(report: DataFrame, path: str) -> None:
    """The evaluation report as one JSON document: mode -> totals, per_label, macro and micro. It has a row for each label and mode."""
    scores = ("precision", "recall", "f1")
    row = F.struct("scope", F.struct(*scores, "tp", "fp", "fn").alias("row"))
    mean = lambda scope: F.max(F.when(F.col("scope") == scope, F.struct(*scores))).alias(scope)
    totals = [F.max(c).alias(c) for c in ("total_gold", "total_pred", "total_tp")]
    labels = F.map_from_entries(F.sort_array(F.collect_list(F.when(~F.col("scope").isin("macro", "micro"), row)))).alias("per_label")
    modes = report.groupBy("mode").agg(*totals, labels, mean("macro"), mean("micro"))
    whole = modes.agg(F.map_from_entries(F.collect_list(F.struct("mode", F.struct(*modes.columns).alias("report")))).alias("report"))
    whole.select(F.to_json("report", {"pretty": "true"}).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """mode and report, a struct, for each mode of a written report."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", _REPORT)).alias("mode", "report"))
