"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint is 64 bits wide and two documents are linked if theirs differ in at most three. Drop the third of the
bits in which two such fingerprints differ most: at most two differing bits are left. So each fingerprint shuffles, for
each dropped third, itself and all its variants at one bit (half of what is left), and the two meet at a variant in the
middle. 131 rows for each distinct fingerprint find every link, with keys of 42 or 43 bits, where a plain ball of
radius two over 64 bits takes 2,081. The variants are shuffled once; what collides is verified within its key, and of
the links found there only a spanning forest leaves it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, local_groups, materialize

#: Bits [low, high) of the three parts of a fingerprint.
PARTS = ((0, 21), (21, 42), (42, 64))
RADIUS = 3
BLOCK = 1 << 16
#: Fingerprints of one key that are compared at a time; a key that holds more is dealt into pairs of such blocks.
KEY_ROWS = 1_024


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprint(text: str | None) -> int:
    """Signed 64-bit SimHash of 3-word shingles, repeats included; 0 for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space count
    if not words:
        return 0
    n, ones = max(1, len(words) - 2), np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        part = words[at : at + BLOCK + 2]
        shingles = map(b" ".join, zip(part, part[1:], part[2:], strict=False)) if len(words) > 2 else [b" ".join(words)]
        h = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), np.uint64)
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp long) for each row of docs; a null text counts as empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "fp": np.array([fingerprint(x) for x in b["text"]], np.int64)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, "doc_id long, fp long")


def balls(distinct: DataFrame) -> DataFrame:
    """key, fp: the variants of each fingerprint, column fp."""
    every = []
    for low, high in PARTS:
        keep = _signed(((1 << 64) - 1) ^ ((1 << high) - (1 << low)))
        for bit in (-1, *(i for i in range(64) if not low <= i < high)):
            every.append(F.struct(F.lit(keep).cast("long").alias("keep"), F.lit(_signed(1 << bit) if bit >= 0 else 0).cast("long").alias("flip")))
    ball = distinct.select("fp", F.inline(F.array(*every)))
    return ball.select((F.col("fp").bitwiseAND(F.col("keep"))).bitwiseXOR(F.col("flip")).alias("key"), "fp")


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (fingerprint, a smaller one) that connect whatever links of the fingerprints a with those in b connect."""
    linked = np.bitwise_count(a.view(np.uint64)[:, None] ^ b.view(np.uint64)[None, :]) <= RADIUS
    row, column = local_groups(linked, a, b)
    fp, least = np.r_[a, b], np.r_[row, column]
    return fp[least < fp], least[least < fp]


def within_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For rows (key, fp) sorted by both: kind 0, edges (a, b) of each key; kind 1, rows (key, fp) of keys with over KEY_ROWS fingerprints."""
    key, held = np.zeros(0, np.int64), np.zeros(0, np.int64)
    large = None

    def frame(kind: int, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"kind": np.full(len(a), kind, np.int32), "a": a, "b": b})

    def found(key: np.ndarray, fp: np.ndarray) -> Iterator[pd.DataFrame]:
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        size = np.diff(np.r_[first, len(key)])
        two = first[size == 2]
        near = np.bitwise_count(fp[two].view(np.uint64) ^ fp[two + 1].view(np.uint64)) <= RADIUS
        out = [(fp[two + 1][near], fp[two][near])]
        out += [forest(fp[at : at + n], fp[at : at + n]) for at, n in zip(first[size > 2].tolist(), size[size > 2].tolist(), strict=True)]
        a, b = (np.concatenate([x[i] for x in out]) for i in (0, 1))
        if len(a):
            yield frame(0, a[a != b], b[a != b])

    for batch in batches:
        key, held = np.r_[key, batch["key"].to_numpy()], np.r_[held, batch["fp"].to_numpy()]
        if not len(key):
            continue
        if large is not None:
            n = int(np.searchsorted(key, large, side="right"))
            yield frame(1, key[:n], held[:n])
            key, held = key[n:], held[n:]
            if not len(key):
                continue
            large = None
        # the last key may go on in the next batch; a key within a batch may be large as well
        last = int(np.searchsorted(key, key[-1]))
        names, counts = np.unique(key[:last], return_counts=True)
        many = np.isin(key[:last], names[counts > KEY_ROWS])
        yield from found(key[:last][~many], held[:last][~many])
        if many.any():
            yield frame(1, key[:last][many], held[:last][many])
        key, held = key[last:], held[last:]
        if len(key) > KEY_ROWS:
            large = key[-1]
            yield frame(1, key, held)
            key, held = key[:0], held[:0]
    yield from found(key, held)


def links(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints, column fp: they connect what links of up to three bits connect, and no more.

    Two fingerprints with at most one differing bit on each side of the middle meet at a key. A key's edges are a
    spanning forest, as many as it has fingerprints at most, however many links there are among them.
    """
    dealt = balls(distinct).repartition("key").sortWithinPartitions("key", "fp")
    found = materialize(dealt.mapInPandas(within_keys, "kind int, a long, b long"), "links")
    edges = found.where("kind = 0").select("a", "b")
    # keys with many fingerprints: block i meets block j, each pair in a task of bounded size
    large = found.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("fp")).distinct()
    sizes = large.groupBy("key").agg(F.ceil(F.count("*") / KEY_ROWS).cast("int").alias("blocks"))
    own = large.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    own = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = own.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "fp")

    def product(group: pd.DataFrame) -> pd.DataFrame:
        mine = (group["own"] == group["i"]).to_numpy()
        fp = group["fp"].to_numpy()
        a, b = (fp, fp) if (group["i"] == group["j"]).all() else (fp[mine], fp[~mine])
        edges = forest(a, b) if len(a) and len(b) else (fp[:0], fp[:0])
        return pd.DataFrame({"a": edges[0], "b": edges[1]})

    return edges.unionByName(pairs.groupBy("key", "i", "j").applyInPandas(product, "a long, b long")).distinct()


def groups(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint string, component_id) for each row of docs.

    component_id is the least doc_id reachable over links, the document's own included. Documents with equal
    fingerprints (also those without words, fingerprint 0) are linked, whatever their number: only one row for each
    distinct fingerprint enters the search. Null ids keep a row of their own with a null component unless something
    with an id is reachable. Other columns are not read.
    """
    fps = materialize(fingerprints(docs), "fingerprints")
    distinct = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    parts = components(links(distinct.select("fp"))).withColumnRenamed("id", "fp")
    known = distinct.join(parts, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("part"))
    known = materialize(known, "parts")
    heads = known.groupBy("part").agg(F.min("least").alias("component_id"))
    by_fp = known.join(heads, "part").select("fp", "component_id")
    out = fps.join(by_fp, "fp")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """docs without the documents from which a smaller doc_id is reachable; rows that stay, and columns, are unchanged.

    Repeated rows of an id that stays are one document: the one with the least text remains. Rows with a null id stay.
    """
    losers = groups(docs).where("component_id < doc_id").select("doc_id").distinct()
    order = Window.partitionBy("doc_id").orderBy("text")
    ranked = docs.where("doc_id is not null").join(losers, "doc_id", "left_anti").withColumn("_rank", F.row_number().over(order))
    # rows without an id are no one group: they go past the window
    return ranked.where("_rank = 1").select(*docs.columns).unionByName(docs.where("doc_id is null"))
