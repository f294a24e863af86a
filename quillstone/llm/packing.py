"""Best-fit packing of tokenized documents into sequences of fixed length, by bulk-synchronous rounds.

A round range-sorts the unplaced pieces and the open gaps together, longest first, gaps before pieces of their size. In
this order a piece takes the gap before it that is nobody else's and came last: its best fit, the smallest that holds
it; where several want one gap, the rank in the order decides. That is the matching of brackets, gaps opening and pieces
closing, and is found by sweeps: the nesting depth is a running sum with a running minimum, within each sorted range and
then over the ranges' ends, and on one level of depth each piece follows the gap it takes. Then the gaps shrink, and what
found no gap goes to the next round; where no gap holds the longest piece left, new sequences are opened.

A gap at least twice as long as the longest piece left takes part several times, so that the longest piece shrinks by a
factor from round to round, and the number of rounds grows with the logarithm of the sequence length. Tables between
rounds are written. The driver learns a few sums for each round, nothing of single pieces or gaps.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, materialize

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Rows of a sorted range; up to so many ranges their ends are broadcast.
SWEEP_ROWS, BROADCAST_PARTS = 50_000, 10_000
BATCH_CHARS = 1 << 22


def encoder(tokenizer: str):
    """A function from a text to its ids, as numpy uint32.

    tokenizer: path of a tokenizers JSON file. Where the same vocabulary lies beside it as ranks (.tiktoken) and the file
    is a plain byte-level BPE, tiktoken makes the same ids several times faster; texts that hold one of the file's
    added tokens, and all other files, go through tokenizers.
    """
    import json
    import os

    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(tokenizer)
    with open(tokenizer, encoding="utf-8") as f:
        spec = json.load(f)
    ranks_path = os.path.splitext(tokenizer)[0] + ".tiktoken"
    pre = spec.get("pre_tokenizer") or {}
    plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not spec.get("normalizer")
    if not (plain and os.path.exists(ranks_path)):
        return lambda text: np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    split = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    fast = tiktoken.Encoding("byte_level", pat_str=split, mergeable_ranks=ranks, special_tokens={})
    added = [t["content"] for t in spec.get("added_tokens", [])]

    def encode(text: str) -> np.ndarray:
        if any(t in text for t in added):
            return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(fast.encode_ordinary(text), np.uint32)

    return encode


def cut(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids: full ones at the end, the shorter one first."""
    first = n % most
    return ([(0, first)] if first else []) + [(at, most) for at in range(first, n, most)]


def pieces(docs: DataFrame, tokenizer: str, most: int = 1024, end_id: int = 2) -> DataFrame:
    """The pieces of each row of docs: doc_id, piece, start, length, ids_crc32; null text is empty and has the end id alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer)
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        for b in batches:
            rows = []
            for doc, text in zip(b["doc"], b["text"], strict=True):
                ids = np.append(encode(text or ""), np.uint32(end_id)).astype("<u4")
                for k, (at, n) in enumerate(cut(len(ids), most)):
                    rows.append((None if doc == "" else int(doc), k, at, n, zlib.crc32(ids[at : at + n].tobytes())))
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    return docs.select(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).alias("doc"), "text").mapInPandas(run, PIECES)


def sweep(left: DataFrame, gaps: DataFrame, longest: int, n_left: int, n_gaps: int) -> DataFrame:
    """One sorted sweep, as a written table of pieces and gaps with depth, the nesting before each; a piece at depth 0 finds no gap.

    left: uid, len. gaps: seq, free. Ranges split sizes that many rows share, as the sort goes on by id.
    """
    # no more slots than about twice the pieces, over all gaps
    most_slots = max(1, -(-2 * n_left // max(1, n_gaps)))
    slots = F.greatest(F.lit(1), F.least(F.floor(F.col("free") / longest), F.lit(most_slots))).cast("int")
    offered = gaps.withColumn("slots", slots).select(F.lit(0).alias("kind"), F.col("seq").alias("id"), F.explode(F.sequence(F.lit(1), "slots")).alias("slot"), F.floor(F.col("free") / F.col("slots")).cast("long").alias("size"), "free")
    asked = left.select(F.lit(1).alias("kind"), F.col("uid").alias("id"), F.lit(0).alias("slot"), F.col("len").alias("size"), F.lit(0).cast("long").alias("free"))
    order = (F.desc("size"), F.col("kind"), F.col("id"), F.col("slot"))
    parts = -(-(n_left + n_gaps) // SWEEP_ROWS)
    ranged = offered.unionByName(asked).repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    def accumulate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, total, low = 0, 0, 0
        for b in batches:
            if b.empty:
                continue
            run = total + np.cumsum(np.where(b["kind"] == 0, 1, -1))
            lows = np.minimum.accumulate(np.r_[low, run])
            yield b.assign(place=np.arange(rows, rows + len(b)), run=run, low=lows[:-1])
            rows, total, low = rows + len(b), int(run[-1]), int(lows[-1])

    schema = "kind int, id long, slot int, size long, free long, part int, place long, run long, low long"
    ran = materialize(ranged.mapInPandas(accumulate, schema), "sweep")
    # one row for each range: the sum before it and the least sum so far
    ends = ran.groupBy("part").agg(F.max_by("run", "place").alias("total"), F.least(F.min("run"), F.lit(0)).alias("least"))
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("base", F.coalesce(F.sum("total").over(before), F.lit(0)))
    ends = ends.select("part", "base", F.least(F.coalesce(F.min(F.col("base") + F.col("least")).over(before), F.lit(0)), F.lit(0)).alias("floor"))
    step = F.when(F.col("kind") == 0, 1).otherwise(-1)
    depth = F.col("base") + F.col("run") - step - F.least("floor", F.col("base") + F.col("low"))
    return ran.join(F.broadcast(ends) if parts <= BROADCAST_PARTS else ends, "part").withColumn("depth", depth)


def matches(swept: DataFrame, most: int) -> DataFrame:
    """uid, len, seq and offset of the pieces of a sweep that take a gap.

    On one level there are at most a gap and a piece of each size, so no level is large; nor is the group of a sequence.
    """
    level = F.when(F.col("kind") == 0, F.col("depth") + 1).otherwise(F.col("depth"))
    nested = swept.withColumn("level", level).where("level > 0")
    on_level = Window.partitionBy("level").orderBy("part", "place")
    taken = nested.withColumn("gap", F.lag(F.struct(F.col("id").alias("seq"), "free")).over(on_level)).where("kind = 1")
    taken = taken.select(F.col("id").alias("uid"), F.col("size").alias("len"), "gap.seq", "gap.free")
    inside = Window.partitionBy("seq").orderBy("uid").rowsBetween(Window.unboundedPreceding, -1)
    return taken.withColumn("offset", F.lit(most) - F.col("free") + F.coalesce(F.sum("len").over(inside), F.lit(0))).drop("free")


def assign(pieces: DataFrame, most: int = 1024) -> DataFrame:
    """pieces with sequence_id and offset, columns that replace such of pieces.

    pieces needs length (1..most); every other column stays. Repeated rows and rows without an id are pieces of their
    own. An empty table gives an empty one.
    """
    spark = pieces.sparkSession
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    rows = materialize(pieces.select(*kept).withColumn("_uid", F.monotonically_increasing_id()), "pieces")
    lengths = rows.agg(F.min("length").alias("least"), F.max("length").alias("longest")).first()
    if lengths["least"] is not None and not 1 <= lengths["least"] <= lengths["longest"] <= most:
        raise ValueError("a piece's length is outside 1..most")
    left = rows.where(F.col("length") < most).select(F.col("_uid").alias("uid"), F.col("length").cast("long").alias("len"))
    gaps = spark.createDataFrame([], "seq long, free long")
    placed, opened, n_gaps, widest, swept = [], 0, 0, 0, None
    while True:
        big = F.col("len") > widest
        sums = left.agg(
            F.count("*").alias("n"), F.min("len").alias("least"), F.max("len").alias("longest"), F.coalesce(F.sum(F.when(big, F.col("len"))), F.lit(0)).alias("big"),
            F.count_if(big & (F.col("len") > most // 2)).alias("halves"),
        ).first()
        if not sums["n"]:
            break
        if new := max(-(-sums["big"] // most), sums["halves"]):
            gaps = gaps.unionByName(spark.range(opened, opened + new).select(F.col("id").alias("seq"), F.lit(most).cast("long").alias("free")))
            opened, n_gaps = opened + new, n_gaps + new
        before, last = swept, gaps
        gaps = gaps.where(F.col("free") >= sums["least"])
        swept = sweep(left, gaps, sums["longest"], sums["n"], n_gaps)
        found = materialize(matches(swept, most), "placed")
        placed.append(found)
        used = found.groupBy("seq").agg(F.sum("len").alias("used"))
        gaps = materialize(gaps.join(used, "seq", "left").select("seq", (F.col("free") - F.coalesce("used", F.lit(0))).alias("free")).where("free > 0"), "gaps")
        state = gaps.agg(F.count("*").alias("n"), F.coalesce(F.max("free"), F.lit(0)).alias("widest")).first()
        n_gaps, widest = state["n"], state["widest"]
        for old in (before, last):  # what this round began with
            if old is not None:
                forget(old)
        left = swept.where("kind = 1 and depth = 0").select(F.col("id").alias("uid"), F.col("size").alias("len"))
    if swept is not None:
        forget(swept)
        forget(gaps)
    every = rows.where(F.col("length") == most).select(F.col("_uid").alias("uid"), (-1 - F.col("_uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    for found in placed:
        every = every.unionByName(found.select("uid", F.col("seq").alias("sequence_id"), "offset"))
    return rows.join(every, F.col("_uid") == F.col("uid")).select(*kept, "sequence_id", "offset")


def pack(docs: DataFrame, tokenizer: str, most: int = 1024, end_id: int = 2) -> DataFrame:
    """Every piece of docs with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null text is empty and has the end id alone; rows that share an id, or have none, are documents of their own. Long
    texts are cut into pieces. Other columns of docs are not read; an empty table gives an empty one.
    """
    return assign(pieces(docs, tokenizer, most, end_id), most)


def sequences(packed: DataFrame, docs: DataFrame, tokenizer: str, most: int = 1024, end_id: int = 2) -> DataFrame:
    """The token ids of each sequence: (sequence_id, ids array<int>). A sequence holds at most `most` ids, so groups are bounded.

    docs must be the documents that were packed. A piece is found by its id, place, length and checksum, so that documents
    may be repeated, share an id, or have none: what these columns do not tell apart has the same ids.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer)
        for b in batches:
            rows = []
            for doc, text in zip(b["doc"], b["text"], strict=True):
                ids = np.append(encode(text or ""), np.uint32(end_id)).astype("<u4")
                for k, (at, n) in enumerate(cut(len(ids), most)):
                    rows.append((f"{doc}:{k}:{n}:{zlib.crc32(ids[at : at + n].tobytes())}", ids[at : at + n].astype(np.int32)))
            yield pd.DataFrame(rows, columns=["key", "ids"])

    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    ids = docs.select(doc.alias("doc"), "text").mapInPandas(run, "key string, ids array<int>").groupBy("key").agg(F.first("ids").alias("ids"))
    placed = packed.select(F.concat_ws(":", doc, "piece", "length", "ids_crc32").alias("key"), "sequence_id", "offset").join(ids, "key")
    parts = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.transform("parts", lambda p: p.ids)).alias("ids"))
