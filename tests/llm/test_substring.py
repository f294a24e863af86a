import hashlib
import random

import numpy as np

from quillstone.llm import substring
from tests.llm.conftest import invented


def brute(rows):
    grams, out = {}, []
    far = 1 << 63
    split = [(far if r[0] is None else r[0], (r[1] or "").encode().split()) for r in rows]
    for d, w in split:
        for i in range(len(w) - 12):
            k = tuple(w[i : i + 13])
            grams[k] = min(grams.get(k, far), d)
    for (d, w), r in zip(split, rows, strict=True):
        gone = {k for i in range(len(w) - 12) if grams[tuple(w[i : i + 13])] < d for k in range(i, i + 13)}
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((r[0], len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(docs):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring.dedup(docs).collect()), key=str)


def test_matches_brute_force(docs, rows):
    got = run(docs)
    assert got == brute(rows)
    assert sum(r[2] for r in got) > 300


def test_runs_periods_and_overlaps(spark):
    rng = random.Random(2)
    base = invented(rng, 40)
    texts = ["a " * 13, "a " * 12, "b " + "a " * 30 + "c", "a b " * 20, "b a " * 9, "x y z " * 10, base, base[7:], "q " + base + " r", "a  b\t" * 8 + "a b", base.upper(), "a " * 14]
    rows = [(50 - i, t) for i, t in enumerate(texts)] + [(50, texts[0]), (7, None), (8, "")]
    assert run(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_windows_with_equal_words_have_equal_representatives():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(6)]  # few words: many runs and pairs
    window = [rng.choice(vocabulary) for _ in range(13)]
    seen = set()
    for _ in range(200):
        before, after = ([rng.choice(vocabulary) for _ in range(rng.randrange(0, 20))] for _ in range(2))
        w = [x.encode() for x in (*before, *window, *after)]
        seen.add(int(substring.representatives(substring.word_hashes(w), np.array([len(w)]))[len(before)]))
    assert len(seen) == 1


def test_long_documents_are_cut_into_overlapping_parts(spark, monkeypatch):
    w = [x.encode() for x in invented(random.Random(9), 900).split()]
    whole = substring.representatives(substring.word_hashes(w), np.array([len(w)]))[: len(w) - 12]
    monkeypatch.setattr(substring, "PART_WORDS", 100)
    cut = [substring.representatives(h, sizes)[substring.window_starts(sizes)] for h, sizes, _ in substring.parts([w])]
    assert np.array_equal(np.concatenate(cut), whole)


def test_empty_table(none):
    assert substring.dedup(none).count() == 0
