"""Shared pieces of the llm operators: written tables, table access and connected components."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space separates words; everything else belongs to a word.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where it is unset (tests on one machine), a temporary one."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="quillstone-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
        sc.setCheckpointDir(found)
    return found


def own_dir(spark: SparkSession) -> str:
    """The folder of this application's tables."""
    return f"{shared_dir(spark)}/quillstone-{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Deletes all tables that operators have written in this application, whose results must not be read afterwards.

    Operators delete what only their rounds need; a result may read the rest. For long sessions, between jobs.
    """
    _delete(spark, own_dir(spark))


def materialize(df: DataFrame, name: str = "part") -> DataFrame:
    """df written as Parquet to the shared folder and read again.

    It cuts the lineage: a lost executor costs a read of this table, not a second run of what made it. The table stays
    until forget() or release().
    """
    spark = df.sparkSession
    path = f"{own_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path).withMetadata(df.columns[0], {"path": path})


def forget(df: DataFrame) -> None:
    """Deletes the table that materialize() wrote for df, which must not be read afterwards."""
    path = next((f.metadata["path"] for f in df.schema.fields if "path" in (f.metadata or {})), None)
    if path:
        _delete(df.sparkSession, path)


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of undirected edges (a long, b long): rows (id, component), component being the least id.

    Alternates large-star and small-star steps (Kiveris et al., 2014). Each works on a written table, is a pair of
    joins and pre-aggregated minima by vertex, and leaves the hub of a large group to AQE's skew handling; nothing
    is collected but the number of edges and a checksum. Vertices without an edge do not appear. An empty table
    gives an empty table.
    """
    two = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    two = two.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = materialize(two, "edges")
    state = None
    for _ in range(most_rounds):
        # large-star: every larger neighbour of u goes to the least of u and its neighbours
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small-star: u and its smaller neighbours go to the least of these neighbours
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        row = new.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
        forget(now)
        now = new
        if state == tuple(row):
            break
        state = tuple(row)
    else:
        raise RuntimeError("components did not settle")
    stars = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return stars.unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def local_groups(linked: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least id of each row's and column's component in a block, by propagation along linked (rows x columns)."""
    most = np.iinfo(np.int64).max
    r, c = rows.copy(), columns.copy()
    for _ in range(len(r) + len(c)):
        c2 = np.minimum(c, np.where(linked, r[:, None], most).min(0))
        r2 = np.minimum(r, np.where(linked, c2[None, :], most).min(1))
        if (r2 == r).all() and (c2 == c).all():
            break
        r, c = r2, c2
    return r, c
