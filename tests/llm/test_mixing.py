import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quillstone.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shared(sizes, weights, most=3.0):
    """Targets by resharing the excess until none is above."""
    total, full, target = float(sum(sizes.values())), set(), {}
    while True:
        left = total - sum(most * sizes[s] for s in full)
        open_weight = sum(w for s, w in weights.items() if s not in full)
        target = {s: most * sizes[s] if s in full else left * w / open_weight for s, w in weights.items()}
        over = {s for s in weights if s not in full and target[s] > most * sizes[s]}
        if not over:
            return target
        full |= over


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 3, None: 50}, {"a": 5}, {"a": 0, "b": 7}, {chr(97 + i): 1 + i**3 for i in range(20)}])
def test_targets(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(mixing.contract_weights(table)).collect()}
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = shared(sizes, {s: 1 + i % 3 for i, s in enumerate(order)})
    assert got == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_mix(docs, rows):
    got = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(2)).collect()
    assert sorted((str(r.doc_id), r.taken) for r in got) == sorted((str(r.doc_id), r.taken) for r in again)
    assert len(got) == len(rows)
    taken, size, largest, target = defaultdict(int), defaultdict(int), defaultdict(int), {}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and len(r.positions) == r.copies and all(0 <= p <= 1 for p in r.positions)
        assert r.positions == sorted(r.positions) and r.position == (r.positions[0] if r.positions else None)
        taken[r.source] += r.taken
        size[r.source] += r.size
        largest[r.source] = max(largest[r.source], r.size)
        target[r.source] = r.target
    by_id = {r[0]: len(WORD.findall(r[1] or "")) for r in rows}
    assert all(by_id[r.doc_id] == r.size for r in got) and all(r.source_size == size[r.source] for r in got)
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in size)
    positions = [-1 if r.position is None else r.position for r in got]
    assert positions == sorted(positions)


def test_slices_do_not_change_the_sums(docs, monkeypatch):
    whole = sorted((str(r.doc_id), r.taken) for r in mixing.mix(docs).collect())
    monkeypatch.setattr(mixing, "SLICE_ROWS", 3)
    assert sorted((str(r.doc_id), r.taken) for r in mixing.mix(docs).collect()) == whole


def test_schedules_are_inverted(spark):
    knots = "array(struct(0.0D as t, 1.0D as w), struct(0.25D as t, 3.0D as w), struct(0.5D as t, 0.0D as w), struct(1.0D as t, 0.0D as w))"
    df = spark.range(0, 101).select((F.col("id") / 100.0).alias("u"), F.expr(knots).alias("k")).withColumn("area", mixing.integral(F.col("k")))
    df = df.select("u", "area", mixing.invert(F.col("k"), F.col("u") * F.col("area")).alias("t"))
    for r in df.collect():
        t = min(r.t, 0.5)
        a = t + 4 * t * t if t <= 0.25 else 0.5 + 3 * (t - 0.25) - 6 * (t - 0.25) ** 2
        assert r.area == pytest.approx(0.875) and a == pytest.approx(r.u * r.area, abs=1e-6)


def test_resample_repeats_rows(docs, rows):
    out = mixing.resample(docs)
    assert out.columns == docs.columns
    copies = defaultdict(int)
    for r in out.collect():
        copies[r.doc_id] += 1
    want = {r.doc_id: r.copies for r in mixing.mix(docs).collect() if r.size}
    once = [r[0] for r in rows].count
    assert all(copies[d] == n * once(d) for d, n in want.items() if once(d) == 1)
    assert all(copies[r[0]] == once(r[0]) for r in rows if not (r[1] or "").split())


def test_empty_table(none):
    assert mixing.mix(none).count() == 0 and mixing.resample(none).count() == 0


def test_weights_are_met_along_the_whole_curriculum(spark):
    # a's target is a third of its size, b's is twice its size, c's is capped at three times
    sizes = {"a": 900, "b": 300, "c": 30}
    rows = [(1000 * k + i, s, "w " * 10) for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    flat = {"a": 1.0, "b": 2.0, "c": 9.0}
    def weights(sources):
        w = F.element_at(F.create_map(*(F.lit(x) for p in flat.items() for x in p)), F.col("source"))
        return sources.withColumn("knots", F.array(F.struct(F.lit(0.0).alias("t"), (w * 0.5).alias("w")), F.struct(F.lit(1.0).alias("t"), (w * 1.5).alias("w"))))
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    mixed = mixing.mix(docs, weights).collect()
    for s in sizes:
        at = sorted(p for r in mixed if r.source == s for p in r.positions[: r.copies])
        assert len(at) * 10 == pytest.approx(next(r.target for r in mixed if r.source == s), abs=10)
        for t in (0.25, 0.5, 0.75, 0.95):  # the schedule's area up to t is t / 2 + t^2 / 2
            assert sum(p < t for p in at) / len(at) == pytest.approx(t / 2 + t * t / 2, abs=2 / len(at) + 0.01)
    order = [r.source for r in mixing.resample(docs, weights).collect()]
    tail = order[-len(order) // 5 :]
    assert all(tail.count(s) / len(tail) == pytest.approx(order.count(s) / len(order), abs=0.03) for s in sizes)


def test_repeats_are_no_neighbours(spark):
    docs = spark.createDataFrame([(i, "a" if i % 50 else "b", "w " * 9) for i in range(500)], "doc_id long, source string, text string")
    order = [r.doc_id for r in mixing.resample(docs).collect()]
    assert len(order) > len(set(order)) and all(x != y for x, y in zip(order, order[1:], strict=False))


def test_taken_words_follow_the_schedule_for_every_source(spark):
    """The property, without the operator's formula: words taken before t are the area's share, within one document."""
    rows = [(i, f"s{i % 7}" if i % 3 else "big", "w " * (1 + i * 7 % 40)) for i in range(900)]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    for k, source in enumerate(sorted({r.source for r in mixed})):
        own = [(p, r.size) for r in mixed if r.source == source for p in r.positions]
        target = next(r.target for r in mixed if r.source == source)
        tilt = 0.5 if k % 2 else -0.5
        for t in (i / 10 for i in range(1, 11)):
            wanted = target * ((1 - tilt) * t + tilt * t * t)  # the integral of (1 - tilt) + 2 * tilt * t
            assert sum(n for p, n in own if p < t) == pytest.approx(wanted, abs=41)
