import random

import numpy as np
import pytest

from quillstone.llm import toxicity
from tests.llm.conftest import invented


def test_isotonic_is_monotone_and_keeps_means():
    rng = np.random.default_rng(0)
    x = rng.random(400)
    y = (rng.random(400) < x).astype(float)
    at, value = toxicity.isotonic(x, y)
    assert (np.diff(value) >= 0).all() and (np.diff(at) >= 0).all()
    assert np.interp(x, at, value).mean() == pytest.approx(y.mean(), abs=0.02)


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    model = toxicity.Trees.fit(x[:1500], y[:1500])
    assert ((model.raw(x[1500:]) > 0) == y[1500:].astype(bool)).mean() > 0.95


def test_features_see_proximity_and_disguise():
    lexicon = toxicity.Lexicon({"idiot$": 3.0, "schur": 2.0})
    get = lambda t: dict(zip(toxicity.FEATURES, toxicity.features(t, lexicon), strict=True))
    assert get("you are an idiot")["second_person_near"] > get("you " + "word " * 8 + "idiot")["second_person_near"] > get("an idiot")["second_person_near"] == 0
    assert get("an id10t here, 1d!ot!")["obfuscated_lexicon"] >= 1 and get("nothing here")["obfuscated_lexicon"] == 0
    assert get("Schurke, idiots, idiot")["lexicon_distinct"] == 2
    assert get("x" * 2_000_000 + " 1")["obfuscated_per_1000"] == 0  # in linear time
    assert get("IDIOT STOP")["capitals"] == 1 and set(get("").values()) == {0.0}


def test_nearness_counts_words_not_characters():
    lexicon = toxicity.Lexicon({"idiot$": 3.0})
    for between in (0, 1, 5, 11, 12, 40):
        for text in ("You, " + "unbelievablylongword " * between + "idiot!", "an idiot " + "unbelievablylongword " * between + "(du)"):
            got = dict(zip(toxicity.FEATURES, toxicity.features(text, lexicon), strict=True))
            assert got["second_person_near"] == (1 / (1 + between) if between < 12 else 0)
            assert got["second_person_per_1000"] > 0


def corpus(n=700):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(n):
        words, toxic = invented(rng, rng.randint(20, 80)).split(), i % 5 == 0
        for _ in range(rng.randint(1, 4) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["grobian", "widerling", "schmutz" + rng.choice(["a", "os", "em"])]))
        docs.append((i, " ".join(words), 5, 0.5))
        if i % 2 == 0 or toxic:
            labels.append((i, 1, int(toxic)))
    docs += [(n, None, 5, 0.5), (n + 1, "", 5, 0.5), (None, "grobian", 5, 0.5), (0, docs[0][1], 5, 0.5)]
    return docs, [*labels, (n + 7, 1, 1), (3, 1, None), (None, 0, 1)]


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    d, own = spark.createDataFrame(docs, "doc_id long, text string, predicted int, score double"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.score(d, own).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    truth = {i: y for i, _, y in labels}
    held = [r for r in got if r.held_out and truth.get(r.doc_id) is not None]
    assert len(held) > 50 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    kept = toxicity.reject(d, own)
    assert kept.columns == d.columns
    gone = {r.doc_id for r in got if r.predicted}
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got} - gone


def test_scores_do_not_depend_on_held_out_labels(spark):
    docs, labels = corpus(300)
    d = spark.createDataFrame(docs, "doc_id long, text string, a int, b double")
    import zlib

    flipped = [(i, q, 1 - t if t is not None and i is not None and zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    one, two = ({(r.doc_id, r.score) for r in toxicity.score(d, spark.createDataFrame(x, "doc_id long, quality int, toxic int")).collect()} for x in (labels, flipped))
    assert one == two


def test_without_labels_or_rows(spark, none):
    labels = "doc_id long, quality int, toxic int"
    d = spark.createDataFrame([(1, "x"), (2, None)], "doc_id long, text string")
    assert [r.score for r in toxicity.score(d, spark.createDataFrame([], labels)).collect()] == [0.0, 0.0]
    assert toxicity.score(none, spark.createDataFrame([(1, 1, 1)], labels)).count() == 0
