"""Annotation as a stream: chunk files that arrive are annotated once each; row by row, so no state is kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import spans
from ..sources.files import SCHEMAS


def read_chunks(spark: SparkSession, path: str, files_at_once: int = 64) -> DataFrame:
    return spark.readStream.schema(SCHEMAS["chunks"]).option("maxFilesPerTrigger", files_at_once).json(path)


def annotate(chunks: DataFrame, **options) -> DataFrame:
    return spans.annotate(chunks, "chunk_id", **options)


def fresh_pages(pages: DataFrame, seen: str = "timestamp", late: str = "1 day") -> DataFrame:
    """A stream of crawled pages with each url once within `late`; the state holds that long only. timestamp is ISO 8601 text."""
    stamped = pages.withColumn("_seen", F.to_timestamp(seen)).withWatermark("_seen", late)
    return stamped.dropDuplicatesWithinWatermark(["url"]).drop("_seen")


def run(spark: SparkSession, source: str, target: str, checkpoint: str) -> StreamingQuery:
    """Annotates what is there and ends; the next call goes on after it. The sink is exactly-once by its checkpoint."""
    own = annotate(read_chunks(spark, source))
    return own.writeStream.format("json").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
