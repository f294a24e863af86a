"""The corpus pipeline: toxicity, SimHash near-dedup, PII, mixing and packing, each stage a written table.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's
docs. All but the last return the columns of documents. An empty table passes through every stage; null texts count as
empty ones; repeated rows, ties and extra columns are defined by each operator's docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillstone.llm import mixing, packing, pii, simhash, toxicity
from quillstone.llm.common import materialize, table
from quillstone.llm.queries import tokenizer_path


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the labels of this corpus, does not reject."""
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least doc_id, of each group of SimHash near-duplicates."""
    return simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and disclosing terms replaced in their texts."""
    return pii.sanitise(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it, in the order of training positions."""
    return mixing.resample(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxic),
    ("simhash_dedup", near_duplicates),
    ("pii", personal_data),
    ("mixing", mixture),
    ("packing", packed),
]

#: Fitted trees, hashed orders and tokenizers are not SQL; tests compare every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
