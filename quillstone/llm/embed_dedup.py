"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within cells, one representative for a group.

All vectors of a label and length begin as one cell. A large cell is split by centres fitted on a sample of it, its parts
again, level by level, so that the number of cells grows with the table. A vector is compared in its home cell, that of the
nearest centres. Vectors of other cells that may have a neighbour there are copied into it: those whose distance to the
plane between the two centres is at most a margin. With margin = sin(acos(threshold)), the default, no link can be lost,
whatever the data. Whether a cell is split, and into how many, is chosen by the estimated work: where the margin copies
vectors to most parts, few or none are less work. The result does not depend on it.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, local_groups, materialize

#: The centres of a split are fitted on about so many of the cell's vectors, drawn by a hash of their ids.
MAX_SAMPLE = 8_000
#: Vectors at home in a part, on average, at least; parts of one split at most; levels at most.
CELL_ROWS, MAX_CELLS, MAX_LEVELS = 500, 512, 6
#: So many pairs of a product cost as much as one row sent to it; sampled vectors on which copies are estimated.
PAIRS_A_ROW, COST_SAMPLE = 700, 2_000
#: Rows on each side of one product; rows that are dealt to the parts of a cell at a time.
BLOCK_ROWS, DEAL_ROWS = 1_024, 2_048
KEY = ["label", "width", "cell"]


def centres(sample: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Spherical k-means of unit vectors: unit centres, at most k of them."""
    if not len(sample):
        return np.zeros((0, 0))
    at = sample[np.random.default_rng(seed).choice(len(sample), min(k, len(sample)), replace=False)]
    for _ in range(rounds):
        home = (sample @ at.T).argmax(1)
        sums = np.zeros_like(at)
        np.add.at(sums, home, sample)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        at = np.where(length > 1e-12, sums / np.maximum(length, 1e-12), at)
    return at


def unit(vectors: list) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in vectors], np.float64)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def spread(x: np.ndarray, at: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, home?) of the cells in which unit vectors x are needed."""
    near = x @ at.T
    home = near.argmax(1)
    apart = np.sqrt(np.maximum(2 - 2 * (at @ at.T), 1e-18))
    away = near[np.arange(len(x)), home][:, None] - near <= margin * apart[home] + 1e-9
    away[np.arange(len(x)), home] = True
    row, cell = np.nonzero(away)
    return row, cell, home[row] == cell


def cells(sample: np.ndarray, most: int, group: float, margin: float) -> np.ndarray:
    """Centres of most cells, or of half as many and so on, whichever means least work for groups of so many vectors; none for one cell."""
    best, least = np.zeros((0, sample.shape[1])), 2 * np.ceil(group / BLOCK_ROWS) + group / PAIRS_A_ROW
    k = most
    while k > 1 and len(sample):
        at = centres(sample, k)
        copies = len(spread(sample[:COST_SAMPLE], at, margin)[0]) / len(sample[:COST_SAMPLE])
        home = group / k
        # a split handles each row once and each of its copies once more
        work = 1 + copies + np.ceil(home * copies / BLOCK_ROWS) + copies * np.ceil(home / BLOCK_ROWS) + home * copies / PAIRS_A_ROW
        if work < least:
            best, least = at, work
        k //= 2
    return best


def usable(embedding: str = "embedding", label: str = "label"):
    """True for rows that can link: a label, and a vector that is not null, not zero and holds finite numbers only."""
    finite = F.forall(embedding, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(F.col(label).isNotNull() & finite & F.exists(embedding, lambda v: v != 0), F.lit(False))


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, margin: float | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of vectors (vec_id, embedding, label).

    n_links counts the other rows with an equal label and a cosine of at least threshold; component_id is the least
    vec_id reachable. Equal vectors of one label enter the search once, with their number. Rows that cannot link (see
    usable()) have no links and are kept. Vectors of different lengths are not linked and are compared apart. Repeated
    rows are rows of their own. Other columns are not read; an empty table gives an empty one.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").cast("string").alias("label"))
    good = rows.where(usable())
    classes = good.groupBy("label", "embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    classes = materialize(classes.where("id is not null"), "classes")
    edges, counts = _compare(classes, threshold, margin)
    parts = components(edges)
    found = classes.join(counts, "id", "left").join(parts, "id", "left")
    found = found.select("label", "embedding", F.coalesce("near", F.lit(0)).alias("near"), "copies", F.coalesce("component", "id").alias("component"))
    joined = rows.withColumn("_ok", usable()).alias("r").join(found.alias("f"), F.expr("r._ok and r.label = f.label and r.embedding = f.embedding"), "left")
    links = F.coalesce(F.col("f.near") + F.col("f.copies") - 1, F.lit(0)).cast("long")
    component = F.coalesce("f.component", "r.vec_id")
    return joined.select("r.vec_id", links.alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("r.vec_id")).alias("kept"))


def place(classes: DataFrame, margin: float) -> DataFrame:
    """label, width, cell, home, id, copies, embedding: the cells in which each row of classes is needed, one of them its home.

    Each level fits centres on a sample of every cell that is large, deals the vectors of those whose split saves work to
    the parts, and goes on with the parts. The driver learns only whether a level has split anything.
    """

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["draw", "id"])
        rows = int(group["home_rows"].iloc[0])
        at = cells(unit(group["embedding"].tolist()), min(MAX_CELLS, rows // CELL_ROWS), rows, margin)
        first = {c: pd.Series([group[c].iloc[0]] * len(at), dtype=object) for c in KEY}  # of a type even where it is empty
        return pd.DataFrame({**first, "part": np.arange(len(at)), "centre": pd.Series(list(at), dtype=object), "blocks": -(-int(group["all_rows"].iloc[0]) // DEAL_ROWS)})

    def deal(own: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
        if own.empty:
            return pd.DataFrame(columns=["label", "width", "cells", "home_cell", "id", "copies", "embedding"], dtype=object)
        parts = parts.sort_values("part")
        row, part, nearest = spread(unit(own["embedding"].tolist()), np.array(parts["centre"].tolist(), np.float64), margin)
        cell = (int(own["cell"].iloc[0]) + 1) * MAX_CELLS + part
        home = np.where(own["home"], cell[nearest], -1)  # a copy has no home here
        needed = np.split(cell, np.flatnonzero(np.diff(row)) + 1)
        same = {c: own[c].to_numpy() for c in ("id", "copies", "embedding")}
        return pd.DataFrame({"label": own["label"].to_numpy(object), "width": own["width"].to_numpy(), "cells": pd.Series(needed, dtype=object), "home_cell": home, **same})

    now = classes.select("label", F.size("embedding").alias("width"), F.lit(0).cast("long").alias("cell"), F.lit(True).alias("home"), "id", "copies", "embedding")
    done, draw = [], F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    for _ in range(MAX_LEVELS):
        sizes = now.groupBy(*KEY).agg(F.count_if("home").alias("home_rows"), F.count("*").alias("all_rows"))
        large = materialize(sizes.where(F.col("home_rows") >= 2 * CELL_ROWS), "large")
        sample = now.where("home").join(large, KEY).withColumn("draw", draw).where(F.col("draw") < MAX_SAMPLE / F.col("home_rows"))
        sample = sample.select(*KEY, "id", "embedding", "draw", "home_rows", "all_rows")
        fitted = materialize(sample.groupBy(*KEY).applyInPandas(fit, "label string, width int, cell long, part int, centre array<double>, blocks int"), "centres")
        if fitted.isEmpty():
            break
        split = fitted.where("part = 0").select(*KEY, "blocks")
        done.append(now.join(split, KEY, "left_anti"))
        # a cell's vectors meet its centres in blocks of bounded size
        own = now.join(split, KEY).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks"))).drop("blocks").groupBy(*KEY, "block")
        theirs = fitted.select(*KEY, "part", "centre", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)).alias("block")).groupBy(*KEY, "block")
        dealt = own.cogroup(theirs).applyInPandas(deal, "label string, width int, cells array<long>, home_cell long, id long, copies long, embedding array<float>")
        dealt = dealt.select("label", "width", F.explode_outer("cells").alias("cell"), "home_cell", "id", "copies", "embedding")
        now = materialize(dealt.select(*KEY, (F.col("cell") == F.col("home_cell")).alias("home"), "id", "copies", "embedding"), "placed")
    for part in done:
        now = now.unionByName(part)
    return materialize(now, "placed") if done else now


def _compare(classes: DataFrame, threshold: float, margin: float | None) -> tuple[DataFrame, DataFrame]:
    """Edges (a, b) that span the groups, and (id, near): how many rows of other classes each class links with."""
    lossless = math.sqrt(1 - threshold * threshold) if 0 < threshold < 1 else float(threshold <= 0)
    placed = place(classes, lossless if margin is None else min(lossless, margin))
    blocks = lambda n: F.ceil(n / BLOCK_ROWS).cast("int")
    sizes = placed.groupBy(*KEY).agg(blocks(F.count_if("home")).alias("home_blocks"), blocks(F.count("*")).alias("all_blocks"))
    dealt = placed.join(sizes.where("home_blocks > 0"), KEY)
    block = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    # block i of the home rows meets block j of all rows of the cell: each product has a task of bounded size
    left = dealt.where("home").select(*KEY, "id", "copies", "embedding", block("home_blocks").alias("i"), F.explode(every("all_blocks")).alias("j"), F.lit(True).alias("is_home"))
    right = dealt.select(*KEY, "id", "copies", "embedding", F.explode(every("home_blocks")).alias("i"), block("all_blocks").alias("j"), F.lit(False).alias("is_home"))

    def product(group: pd.DataFrame) -> pd.DataFrame:
        h, m = group[group["is_home"]], group[~group["is_home"]]
        empty = pd.DataFrame({"id": [], "least": [], "near": []}).astype("int64")
        if h.empty or m.empty:
            return empty
        a, b, copies = h["id"].to_numpy(), m["id"].to_numpy(), m["copies"].to_numpy()
        linked = (unit(h["embedding"].tolist()) @ unit(m["embedding"].tolist()).T >= threshold) & (a[:, None] != b[None, :])
        near = (linked * copies[None, :]).sum(1)
        r, c = local_groups(linked, a, b)
        out = pd.DataFrame({"id": np.concatenate([a, b]), "least": np.concatenate([r, c]), "near": np.concatenate([near, np.zeros(len(b), np.int64)])})
        return out[(out["near"] > 0) | (out["least"] < out["id"])]

    both = left.unionByName(right).groupBy(*KEY, "i", "j")
    found = materialize(both.applyInPandas(product, "id long, least long, near long"), "products")
    edges = found.where("least < id").select(F.col("id").alias("a"), F.col("least").alias("b")).distinct()
    return edges, found.groupBy("id").agg(F.sum("near").cast("long").alias("near"))
