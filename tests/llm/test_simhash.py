import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quillstone.llm import common, simhash


def plain(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups_of(ids, linked):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(ids, 2):
        if linked(a, b):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_fingerprint_follows_its_definition():
    for text in ("", None, "One", "one TWO", "a b c d", "Ä b c d\x0be", "x " * 300):
        assert simhash.fingerprint(text) & (1 << 64) - 1 == plain(text)
    assert simhash.fingerprint("ONE two Three") == simhash.fingerprint("one two three")


def test_long_texts_are_worked_on_in_blocks(monkeypatch):
    text = " ".join(f"w{i % 37}" for i in range(500))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK", 64)
    assert simhash.fingerprint(text) == whole


def parts_of(edges):
    parent = {}

    def find(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in parent}


@pytest.mark.parametrize("rows", [2, 7, 1_024])
def test_links_connect_what_pairs_within_the_radius_connect(spark, monkeypatch, rows):
    monkeypatch.setattr(simhash, "KEY_ROWS", rows)
    rng = random.Random(3)
    own = {rng.getrandbits(64) for _ in range(30)}
    for x in list(own)[:12]:
        for n in (1, 2, 3, 3, 4):
            y = x
            for b in rng.sample(range(64), n):
                y ^= 1 << b
            own.add(y)
    center = rng.getrandbits(64)  # very many near each other
    own |= {center ^ (1 << rng.randrange(10)) ^ (1 << rng.randrange(10)) for _ in range(300)}
    signed = [simhash._signed(x) for x in own]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        found = [(r.a, r.b) for r in simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    near = [p for p in itertools.combinations(signed, 2) if bin((p[0] ^ p[1]) & (1 << 64) - 1).count("1") <= 3]
    assert parts_of(found) == parts_of(near) and all(a > b for a, b in found)


def test_groups_match_brute_force(docs, rows):
    got = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.groups(docs).collect()}
    ids = {r[0]: plain(r[1]) for r in rows if r[0] is not None}
    parts = groups_of(list(ids), lambda a, b: bin(ids[a] ^ ids[b]).count("1") <= 3)
    assert {k: v for k, v in got.items() if k[0] is not None} == {(i, f"{f:016x}"): parts[i] for i, f in ids.items()}
    assert simhash.groups(docs).count() == len(rows)


def test_one_of_each_group_stays_and_columns_too(docs, rows):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    heads = {r.component_id for r in simhash.groups(docs).where("doc_id is not null").collect()}
    assert sorted(i for i in ids if i is not None) == sorted(heads) and ids.count(None) == 1


def test_empty_table(none):
    assert simhash.groups(none).count() == 0 and simhash.keep_one(none).count() == 0


def test_components_of_random_graphs(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 130)] + [(200, 200)]
    found = {r.id: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {frozenset(e) for e in edges}
    want = groups_of(sorted({x for e in edges for x in e}), lambda a, b: frozenset((a, b)) in linked)
    alone = want.keys() - {x for a, b in edges if a != b for x in (a, b)}
    assert found == {k: v for k, v in want.items() if k not in alone}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_materialized_tables_can_be_dropped(spark):
    df = common.materialize(spark.range(5).withColumn("x", F.lit(1)))
    assert df.count() == 5
    common.forget(df)
    assert np.array(spark.range(1).collect()).size
