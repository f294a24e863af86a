import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillstone.llm import common, packing
from quillstone.llm.queries import tokenizer_path


def best_fit_decreasing(lengths, most):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        gap = min(fits) if fits else most
        if fits:
            gaps.remove(gap)
        else:
            gaps.append(0)
            gaps.remove(0)
        gaps.append(gap - n)
    return len(gaps)


@pytest.mark.parametrize("seed", range(4))
def test_rounds_are_as_good_as_one_piece_at_a_time(spark, seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(packing, "SWEEP_ROWS", [7, 60, 200, 10_000][seed])
    most = [10, 64, 1024, 1024][seed]
    # the last one has one very common length
    lengths = [min(most, max(1, int(rng.expovariate(4 / most)))) if seed < 3 or i % 3 else 300 for i in range(500)]
    pieces = spark.createDataFrame([(i, n, "x") for i, n in enumerate(lengths)], "doc_id long, length long, offset string")
    got = packing.assign(pieces, most).collect()
    assert sorted((r.doc_id, r.length) for r in got) == list(enumerate(lengths))
    used = defaultdict(list)
    for r in got:
        used[r.sequence_id].append((r.offset, r.length))
    for own in used.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= most
    assert len(used) <= best_fit_decreasing(lengths, most) * 1.02 + 1


def test_a_sweep_gives_the_smallest_gap_that_is_left(spark, monkeypatch):
    monkeypatch.setattr(packing, "SWEEP_ROWS", 6)
    rng = random.Random(3)
    lengths, free = [rng.randint(30, 50) for _ in range(40)], [rng.randint(25, 55) for _ in range(40)]
    left = spark.createDataFrame(list(enumerate(lengths)), "uid long, len long")
    gaps = spark.createDataFrame(list(enumerate(free)), "seq long, free long")
    got = packing.matches(packing.sweep(left, gaps, 50, 40, 40), 64).collect()
    open_gaps, want = sorted(free), []
    for n in sorted(lengths, reverse=True):  # by rank: the longest piece first takes its successor
        fits = [g for g in open_gaps if g >= n]
        if fits:
            open_gaps.remove(fits[0])
            want.append((n, fits[0]))
    assert sorted((r.len, free[r.seq]) for r in got) == sorted(want)
    assert all(lengths[r.uid] == r.len and r.offset == 64 - free[r.seq] for r in got) and len({r.seq for r in got}) == len(got)


def test_ids_are_those_of_the_tokenizer(rows):
    slow = Tokenizer.from_file(tokenizer_path())
    encode = packing.encoder(tokenizer_path())
    for text in [*(r[1] or "" for r in rows), "Straße  çé\n\n\t x'll 12345 日本 <|endoftext|> a", "   \x1c", "🙂" * 50, "a" * 3000]:
        assert encode(text).tolist() == slow.encode(text, add_special_tokens=False).ids


def test_pieces_and_places(docs, rows, monkeypatch):
    monkeypatch.setattr(packing, "SWEEP_ROWS", 40)
    slow = Tokenizer.from_file(tokenizer_path())
    got = packing.pack(docs, tokenizer_path(), most=64).collect()
    want = defaultdict(list)
    for r in rows:
        ids = [*slow.encode(r[1] or "", add_special_tokens=False).ids, 2]
        for k, (at, n) in enumerate(packing.cut(len(ids), 64)):
            want[r[0]].append((k, at, n, zlib.crc32(np.array(ids[at : at + n], "<u4").tobytes())))
    own = defaultdict(list)
    for r in got:
        own[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    assert {k: sorted(v) for k, v in own.items()} == {k: sorted(v) for k, v in want.items()}
    used = defaultdict(list)
    for r in got:
        used[r.sequence_id].append((r.offset, r.length))
    for places in used.values():
        ends = [0, *np.cumsum([n for _, n in sorted(places)]).tolist()]
        assert [o for o, _ in sorted(places)] == ends[:-1] and ends[-1] <= 64


def test_sequences_hold_the_ids(spark):
    rows = [(i, f"text number {i} " * (i + 1)) for i in range(8)]
    rows += [rows[3], rows[3], (3, "another text"), (None, "no id"), (None, "no id either"), (9, None), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    packed = packing.pack(docs, tokenizer_path(), most=32)
    whole = {r.sequence_id: r.ids for r in packing.sequences(packed, docs, tokenizer_path(), most=32).collect()}
    assert sum(map(len, whole.values())) == sum(r.length for r in packed.collect())
    for r in packed.collect():
        part = np.array(whole[r.sequence_id][r.offset : r.offset + r.length], "<u4")
        assert zlib.crc32(part.tobytes()) == r.ids_crc32


def test_empty_table(none):
    assert packing.pack(none, tokenizer_path()).count() == 0


def test_other_columns_stay(docs):
    pieces = packing.pieces(docs, tokenizer_path()).withColumn("size", F.lit(1))
    assert packing.assign(pieces).columns == [*pieces.columns, "sequence_id", "offset"]


def test_rounds_leave_nothing_but_their_result(spark):
    import glob

    left = lambda: {p.rsplit("/", 1)[1].split("-")[0] for p in glob.glob(f"{common.own_dir(spark)}/*")}
    common.release(spark)
    pieces = spark.createDataFrame([(i, 1 + i * 37 % 900) for i in range(400)], "doc_id long, length long")
    out = packing.assign(pieces)
    assert left() == {"pieces", "placed"} and out.count() == 400
    common.release(spark)
    assert left() == set()
