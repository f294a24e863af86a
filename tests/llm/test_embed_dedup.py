import random

import numpy as np
import pytest

from quillstone.llm import common, embed_dedup
from tests.llm.test_simhash import groups_of

SCHEMA = "vec_id long, embedding array<float>, label int, id long, cell string, copies int"


def vectors(n=160, dim=64, seed=1):
    rng = np.random.default_rng(seed)
    out = []
    base = rng.normal(size=(12, dim))
    for i in range(n):
        v = base[i % 12] + rng.normal(size=dim) * 0.25 if i % 3 == 0 else rng.normal(size=dim)
        out.append((1000 - i, (v * (1 + i % 5)).astype(np.float32).tolist(), i % 2))
    out += [(2000 + i, out[3][1], out[3][2]) for i in range(4)]
    zero = [0.0] * dim
    out += [(1, None, 1), (2, zero, 1), (3, [float("nan"), *zero[1:]], 1), (4, [None, *zero[1:]], 1), (5, out[3][1], None), (6, [float("inf"), *zero[1:]], 0), (7, [1.0, 2.0], 1), (8, [2.0, 4.0], 1), (9, [], 1)]
    return [(*r, 1, "x", 3) for r in out]


def brute(rows, threshold=0.93):
    def ok(v, label):
        return label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = {r[0]: (np.array(r[1], np.float64), r[2]) for r in rows if ok(r[1], r[2])}

    def linked(a, b):
        (u, s), (v, t) = good[a], good[b]
        return s == t and len(u) == len(v) and u @ v / np.sqrt((u @ u) * (v @ v)) >= threshold

    parts = groups_of(list(good), linked)
    return {i: (sum(linked(i, j) for j in good if j != i), parts[i]) if i in good else (0, i) for i in (r[0] for r in rows)}


@pytest.mark.parametrize("cell_rows", [2_000, 20])
def test_matches_brute_force(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(embed_dedup, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(embed_dedup, "BLOCK_ROWS", 16)
    rows = vectors()
    got = embed_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_recall_in_many_cells(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "CELL_ROWS", 40)
    rng = np.random.default_rng(7)
    rows = []
    for i in range(400):
        v = rng.normal(size=64)
        rows.append((2 * i, v.tolist(), 0))
        d = rng.normal(size=64) * np.linalg.norm(v) * 0.045
        rows.append((2 * i + 1, (v + d).tolist(), 0))
    want = brute(rows)
    got = {r.vec_id: r.n_links for r in embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    assert sum(w[0] for w in want.values()) > 500
    assert sum(got.values()) >= 0.99 * sum(w[0] for w in want.values()) and all(got[i] <= w[0] for i, w in want.items())


def test_local_groups():
    rng = random.Random(1)
    ids = list(range(30))
    edges = {(a, b) for a in ids for b in ids if a != b and rng.random() < 0.03}
    edges |= {(b, a) for a, b in edges}
    linked = np.array([[(a, b) in edges for b in ids] for a in ids])
    r, c = common.local_groups(linked, np.array(ids), np.array(ids))
    want = groups_of(ids, lambda a, b: (a, b) in edges)
    # a row and a column of one vector are two vertices here: what is linked at all is in one group
    assert all(min(r[i], c[i]) == want[i] or not linked[i].any() for i in ids)


def test_empty_table(spark):
    assert embed_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    none = spark.createDataFrame([(1, None, None, 1, "x", 1)], SCHEMA)
    assert [tuple(r) for r in embed_dedup.near_duplicates(none).collect()] == [(1, 0, 1, True)]


def low_dimensional(n=400, dim=768, inner=4):
    rng = np.random.default_rng(3)
    return rng.normal(size=(n, inner)) @ np.linalg.qr(rng.normal(size=(dim, inner)))[0].T


def test_no_link_is_lost_in_a_subspace(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "CELL_ROWS", 25)
    monkeypatch.setattr(embed_dedup, "cells", lambda sample, most, group, margin: embed_dedup.centres(sample, most))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(low_dimensional())]
    want = brute(rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    assert sum(w[0] for w in want.values()) > 100 and got == want


@pytest.mark.parametrize("seed", [1, 2])
def test_no_link_is_lost_over_several_levels(spark, monkeypatch, seed):
    monkeypatch.setattr(embed_dedup, "CELL_ROWS", 20)
    monkeypatch.setattr(embed_dedup, "MAX_CELLS", 3)
    monkeypatch.setattr(embed_dedup, "DEAL_ROWS", 32)
    monkeypatch.setattr(embed_dedup, "cells", lambda sample, most, group, margin: embed_dedup.centres(sample, most))
    rows = [(r[0], r[1], r[2] % 2) for r in ((i, v.tolist(), i) for i, v in enumerate(low_dimensional(300, 32, 3 + seed)))]
    rows += [(900 + i, v[1][:8], v[2]) for i, v in enumerate(rows[:60])]  # another width
    classes = spark.createDataFrame([(i, v, str(c), 1) for i, v, c in rows], "id long, embedding array<float>, label string, copies long")
    placed = embed_dedup.place(classes, 0.3676)
    assert max(r.cell for r in placed.select("cell").distinct().collect()) >= 12  # the parts of parts
    assert placed.where("home").count() == placed.where("home").select("id").distinct().count() == len(rows)
    got = embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    want = brute(rows)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want and sum(w[0] for w in want.values()) > 100


def test_cells_are_used_where_they_save_work():
    rng = np.random.default_rng(4)
    blobs = np.repeat(np.eye(64)[:40], 100, 0) + rng.normal(size=(4000, 64)) * 0.01
    blobs = blobs[rng.permutation(4000)]
    assert len(embed_dedup.cells(embed_dedup.unit(list(blobs)), 32, 64_000, 0.37)) > 1
    assert len(embed_dedup.cells(embed_dedup.unit(list(rng.normal(size=(4000, 64)))), 26, 5_500, 0.37)) < 26
