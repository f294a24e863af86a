"""Spans for SQL users: SELECT * FROM extract_spans(TABLE(SELECT sid, text FROM t))."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from ..operators.spans import Finder, acts, organisations, resolve, rules
from . import legal


class ExtractSpans:
    """A row for each entity: the first column of the input, label, text, start and end."""

    def __init__(self) -> None:
        self.find = Finder(rules(), {"ACT_NAME": acts(), "ORG": organisations()}, legal.ACT_PATTERN)

    def eval(self, row):
        for label, text, start, end in resolve(self.find(row[1] or "")):
            yield str(row[0]), label, text, start, end


def register(spark: SparkSession) -> None:
    spark.udtf.register("extract_spans", udtf(ExtractSpans, returnType="id string, label string, text string, start int, end int"))
