import hashlib
import re
from collections import Counter

import xxhash

from quillstone.llm import imatch


def fingerprint(text, lexicon):
    own = sorted({w for w in re.split(r"[\W_]+", text.lower()) if w in lexicon})
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    if not own:
        return [md5(f"{i}:{md5(text)}")[:8] for i in range(1, 65)]
    out = []
    for i, share in enumerate((256, 64, 16, 4)):  # of 256
        for k in range(16):
            drawn = [w for w in own if int(md5(w)[3 * i : 3 * i + 2], 16) < share and int(md5(w)[3 * i + 2], 16) == k]
            out.append(md5(" ".join(drawn))[:8] if drawn else "00000000")
    return out


def likeness(a, b):
    either = [x == y for x, y in zip(a, b, strict=True) if x != "00000000" or y != "00000000"]
    return 1.0 if a == b else sum(either) / len(either)


def brute(rows, least, most):
    ids = sorted({r[0] for r in rows if r[0] is not None}, reverse=True) + ([None] if any(r[0] is None for r in rows) else [])
    text, df = {}, Counter()
    signed = lambda t: (xxhash.xxh64_intdigest(t.encode(), 42) + 2**63) % 2**64 - 2**63
    for r in rows:
        t = r[1] or ""
        text[r[0]] = min(text.get(r[0], t), t, key=signed)
        df.update({w for w in re.split(r"[\W_]+", t.lower()) if w})
    lexicon = {w for w, n in df.items() if least * len(rows) <= n <= max(most * len(rows), 1)}
    out = []
    for r in rows:
        t = r[1] or ""
        after = ids[(ids.index(r[0]) + 1) % len(ids)]
        k = len(t) // 3
        edited = t[: len(t) - k] + text[after][:k]
        f, e, n = (fingerprint(x, lexicon) for x in (t, edited, text[after]))
        out.append((r[0], len(t), hashlib.sha256(edited.encode()).hexdigest(), "".join(f), "".join(e), likeness(f, e), likeness(f, n)))
    return out


def test_whole_result_by_brute_force(spark, docs, rows):
    for least, most in ((1 / 500, 1 / 10), (0.05, 0.5), (2.0, 1.0)):  # the last band holds nothing
        got = sorted(map(str, map(tuple, imatch.compare_edits(docs, least, most).collect())))
        assert got == sorted(map(str, brute(rows, least, most)))
    extreme = [(-(2**63), "one text"), (2**63 - 1, "another"), (None, "none"), (None, ""), (0, None), (0, None)]
    got = imatch.compare_edits(spark.createDataFrame(extreme, "doc_id long, text string"), 0, 1)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute(extreme, 0, 1)))


def test_ranges_and_joins_do_not_change_the_result(docs, monkeypatch):
    whole = sorted(map(str, imatch.compare_edits(docs).collect()))
    monkeypatch.setattr(imatch, "RANGE_ROWS", 5)
    monkeypatch.setattr(imatch, "SET_TERMS", 1)
    assert sorted(map(str, imatch.compare_edits(docs).collect())) == whole


def test_the_lexicon_is_a_band(spark):
    docs = spark.createDataFrame([(i, "the " + " ".join(f"t{j}" for j in range(10) if i % (j + 1) == 0)) for i in range(1, 1001)], "doc_id long, text string")
    got = {r.term: r.df for r in imatch.lexicon(docs, 0.15, 0.4).collect()}
    assert got == {f"t{j}": 1000 // (j + 1) for j in range(10) if 150 <= 1000 // (j + 1) <= 400}


def test_an_edit_leaves_a_likeness_and_another_text_does_not(spark):
    own = lambda a: " ".join(f"term{(a * 37 + k * 13) % 2000}" for k in range(60))
    docs = spark.createDataFrame([(i, own(i)) for i in range(200)], "doc_id long, text string")
    got = imatch.compare_edits(docs).collect()
    assert sum(r.near_edited > r.near_next for r in got) > 150


def test_empty_and_single(spark, none):
    assert imatch.compare_edits(none).count() == 0
    r = imatch.compare_edits(spark.createDataFrame([(4, "abcdef")], "doc_id long, text string")).first()
    assert r.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()
