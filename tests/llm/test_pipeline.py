import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillstone.llm import packing, pii, simhash, toxicity
from tests.llm.conftest import invented
from tests.llm.test_simhash import groups_of, plain

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    """documents and labels with toxic rows, copies, personal data, empty and null texts, ties and a row without id."""
    import random

    rng, rows, labels = random.Random(6), [], []
    for i in range(420):
        words, toxic = invented(rng, rng.randint(15, 60)).split(), i % 6 == 0
        for _ in range(3 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["grobian", "widerling", "schmutzfink"]))
        if i % 11 == 5:
            words.insert(3, f"mail{i}@example.org")
        rows.append([i, " ".join(words), "en", f"s{i % 5}"])
        labels.append((i, 1, int(toxic)))
    for i in range(0, 40):
        rows.append([500 + i, rows[i + 1][1] + (" " if i % 2 else ""), "de", "s1"])
    rows += [[900, None, None, None], [901, "", "en", "s0"], [None, "niemand hat das gezählt", "de", None], [902, rows[3][1], "en", "s2"], [7, rows[7][1], "en", "s2"]]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


@pytest.fixture(scope="module")
def stages(spark, root, tmp_path_factory):
    """What goes into and comes out of each stage."""
    docs, out = spark.read.parquet(f"{root}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, root).write.parquet(path)
        out[name] = (docs, docs := spark.read.parquet(path))
    return out


def test_all_but_the_last_keep_the_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_dedup", "pii", "mixing", "packing"]
    for name, (before, after) in stages.items():
        assert name == "packing" or after.dtypes == before.dtypes


def test_toxicity_rejects_toxic_and_keeps_clean_documents(spark, root, stages):
    before, after = stages["toxicity"]
    labels = spark.read.parquet(f"{root}/labels.parquet")
    model = toxicity.fit(before, labels)
    rows = before.collect()
    keep = Counter(tuple(r) for r, s in zip(rows, model.scores([r.text for r in rows]), strict=True) if s < 0.5)
    assert Counter(map(tuple, after.collect())) == keep
    toxic = {r.doc_id for r in rows if re.search("grobian|widerling|schmutzfink", r.text or "")}
    left = {r.doc_id for r in after.collect()}
    assert len(toxic & left) <= 2 and len({r.doc_id for r in rows} - left - toxic) <= 2


def test_near_duplicates_leave_one(stages):
    before, after = stages["simhash_dedup"]
    fps = {r.doc_id: plain(r.text) for r in before.collect() if r.doc_id is not None}
    heads = groups_of(list(fps), lambda a, b: bin(fps[a] ^ fps[b]).count("1") <= simhash.RADIUS)
    assert sorted((r.doc_id for r in after.collect()), key=str) == sorted({*heads.values(), None}, key=str)


def test_personal_data_is_replaced(stages):
    before, after = stages["pii"]
    got = {r.doc_id: r for r in after.collect()}
    assert len(got) == before.count()
    for r in before.collect():
        assert got[r.doc_id].text == (None if r.text is None else pii.replace(r.text, [])) and got[r.doc_id].n_chars == (None if r.text is None else len(got[r.doc_id].text))
    assert sum("[EMAIL]" in (r.text or "") for r in got.values()) > 10 and not any("@" in (r.text or "") for r in got.values())


def test_the_mixture_meets_its_targets(stages):
    from tests.llm.test_mixing import shared

    before, after = stages["mixing"]
    size, words = defaultdict(int), {}
    for r in before.collect():
        words[r.doc_id] = (r.source, len((r.text or "").encode().split()))
        size[r.source] += words[r.doc_id][1]
    order = sorted(size, key=lambda s: (s is None, s or ""))
    target = shared(dict(size), {s: 1 + i % 3 for i, s in enumerate(order)})
    copies, taken = Counter(r.doc_id for r in after.collect()), defaultdict(int)
    for d, n in copies.items():
        assert n <= 3
        taken[words[d][0]] += n * words[d][1]
    assert all(abs(taken[s] - target[s]) <= max(n for own, n in words.values() if own == s) for s in size)
    assert all(copies[d] == 1 for d, (_, n) in words.items() if n == 0)
    assert {tuple(r) for r in after.collect()} <= {tuple(r) for r in before.collect()}


def test_everything_mixed_is_packed(spark, root, stages):
    before, after = stages["packing"]
    encode = packing.encoder(corpus_pipeline.tokenizer_path())
    want = Counter((r.doc_id, len(encode(r.text or "")) + 1) for r in before.collect())
    got = Counter()
    for r in after.groupBy("doc_id").agg(F.sum("length").alias("n")).collect():
        got[r.doc_id] = r.n
    totals = Counter()
    for (d, n), times in want.items():
        totals[d] += n * times
    assert got == totals
    assert after.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 1024
    assert corpus_pipeline.run(spark, root).count() == after.count()


def test_an_empty_corpus(spark, root, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{root}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
