"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

The lexicon (whole words and word beginnings) is learned from the labelled sample, the trees and the calibration after
it; scoring is one pass over the texts in which nothing is shuffled. Labels, language, source and id are no inputs.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: The model is fitted on at most so many labelled rows, those with the least hash of their id.
MAX_TRAINING_ROWS = 40_000
#: The lexicon keeps at most so many entries, those with the largest likelihood ratio.
MAX_LEXICON = 2_000
STEMS = (4, 5, 6, 7)
#: Least likelihood-ratio statistic and odds ratio of a lexicon entry.
LEAST_G2, LEAST_ODDS = 27.0, 20.0
#: Second-person pronouns of the languages in use.
SECOND_PERSON = frozenset(b"you your yours yourself u ur du dich dir dein deine deinen ihr euch euer tu te toi ton ta tes vous votre vos usted ustedes ti tus vosotros".split())
#: Words between a word of the lexicon and a pronoun that count as near.
NEAR_WORDS = 12
FEATURES = (
    "log_words", "lexicon_per_1000", "log_lexicon", "lexicon_distinct", "lexicon_best", "lexicon_sum_per_1000", "second_person_near",
    "second_person_per_1000", "capitals", "shouted_per_1000", "exclamations", "questions", "punctuation", "obfuscated_per_1000", "obfuscated_lexicon",
)
_WORD = re.compile(r"[^\W\d_]+")
_SPACED = re.compile(r"[^\x20\x09-\x0D]+")
_SHOUT = re.compile(r"\b[A-Z]{3,}\b")
_INNER = re.compile(r"(?<=[^\W\d_])[0-9@$*!|+]+(?=[^\W\d_])")
_SYMBOLS = frozenset("0123456789@$*!|+")
MIXED_CHARS = 64
_PLAIN = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l", "+": "t", "*": None})
_PUNCT = [b for b in range(33, 127) if not chr(b).isalnum()]
#: All ASCII characters but letters to blanks.
_LETTERS = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))


def stems(text: str) -> set[str]:
    """Words of a text, ended by a "$", and their beginnings."""
    out = set()
    for w in set(_WORD.findall(text.lower())):
        out.add(w + "$")
        out.update(w[:n] for n in STEMS if len(w) >= n)
    return out


def mixed_words(text: str) -> list[str]:
    """Words with digits or symbols between letters, at most MIXED_CHARS to each side of the first such place."""
    out, done = [], 0
    for m in _INNER.finditer(text):
        if m.start() < done:
            continue
        start, end = m.span()
        while start > max(done, m.start() - MIXED_CHARS) and (text[start - 1].isalpha() or text[start - 1] in _SYMBOLS):
            start -= 1
        while end < min(len(text), m.end() + MIXED_CHARS) and (text[end].isalpha() or text[end] in _SYMBOLS):
            end += 1
        out.append(text[start:end])
        done = end
    return out


@dataclass
class Lexicon:
    """Weights of word beginnings and of whole words (ended by a "$")."""

    weights: dict[str, float]
    automaton: object = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "automaton": None}

    def word(self, word: str) -> float:
        w = self.weights
        return max([w.get(word + "$", 0.0), *(w.get(word[:n], 0.0) for n in STEMS)])

    def hits(self, low: str) -> list[tuple[int, str, float]]:
        """(start, word, weight) of the lexicon's words in a lower-cased text."""
        if not self.weights:
            return []
        if self.automaton is None:
            import ahocorasick

            self.automaton = ahocorasick.Automaton()
            for k in {k.rstrip("$") for k in self.weights}:
                self.automaton.add_word(k, len(k))
            self.automaton.make_automaton()
        found: dict[int, tuple[int, str, float]] = {}
        for end, n in self.automaton.iter(low):
            start = end - n + 1
            if start in found or (start and low[start - 1].isalpha()):
                continue
            m = _WORD.match(low, start)
            if m and (weight := self.word(m[0])):
                found[start] = (start, m[0], weight)
        return [found[k] for k in sorted(found)]


def plain_words(text: str) -> list[bytes]:
    """Words between white space and ASCII characters that are no letters."""
    return text.encode("utf-8", "surrogatepass").translate(_LETTERS).split()


def nearness(low: str, hits: list[tuple[int, str, float]], pronouns: list[int]) -> float:
    """1 / (1 + words between) for the closest hit and pronoun with fewer than NEAR_WORDS words between, or 0; pronouns: their places among plain_words(low)."""
    best, place, at = 0.0, 0, 0
    for start, *_ in hits if pronouns else ():
        place, at = place + len(plain_words(low[at:start])), start
        k = bisect_left(pronouns, place)
        for other in pronouns[max(0, k - 1) : k + 1]:
            between = max(0, abs(other - place) - 1)
            if between < NEAR_WORDS:
                best = max(best, 1.0 / (1 + between))
    return best


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The dense features FEATURES of a whole text; all zero for an empty one."""
    if not text:
        return [0.0] * len(FEATURES)
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    low = text.lower()
    words = sum(1 for _ in _SPACED.finditer(text)) if len(text) > 1 << 24 else len(_SPACED.findall(text))
    per = 1000.0 / max(1, words)
    hits = lexicon.hits(low)
    pronouns = [i for i, w in enumerate(plain_words(low)) if w in SECOND_PERSON]
    near = nearness(low, hits, pronouns)
    mixed = mixed_words(text) if int(raw[48:58].sum() + raw[[64, 36, 33, 42, 124, 43]].sum()) else []
    disguised = [lexicon.word(m.lower().translate(_PLAIN)) for m in mixed]
    shouted = len(_SHOUT.findall(text)) if int(raw[65:91].sum()) else 0
    chars, letters = len(text), max(1, int(raw[65:91].sum() + raw[97:123].sum()))
    total = sum(h[2] for h in hits)
    return [
        math.log1p(words), len(hits) * per, math.log1p(len(hits)), float(len({h[1] for h in hits})), max([0.0, *(h[2] for h in hits)]), total * per, near,
        len(pronouns) * per, raw[65:91].sum() / letters, shouted * per, raw[33] / chars, raw[63] / chars, raw[_PUNCT].sum() / chars, len(mixed) * per, float(sum(d > 0 for d in disguised)),
    ]


@dataclass
class Trees:
    """Boosted regression trees on binned features, for the logistic loss."""

    base: float
    rate: float
    edges: list[np.ndarray]
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # by node of a full binary tree: feature (-1 for a leaf), bin, value

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        b, out = self._bins(x), np.full(len(x), self.base)
        for feature, cut, value in self.trees:
            at = np.zeros(len(x), np.int64)
            while (inner := feature[at] >= 0).any():
                f = np.where(inner, feature[at], 0)
                at = np.where(inner, 2 * at + 1 + (b[np.arange(len(x)), f] > cut[at]), at)
            out += self.rate * value[at]
        return out

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 48, least: int = 5, l2: float = 1.0) -> Trees:
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
        share = min(max(y.mean(), 1e-4), 1 - 1e-4)
        model = cls(math.log(share / (1 - share)), rate, edges, [])
        b, raw = model._bins(x), np.full(len(x), model.base)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-raw))
            g, h = y - p, np.maximum(p * (1 - p), 1e-6)
            size = 2 ** (depth + 1) - 1
            feature, cut, value = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)
            at = np.zeros(len(x), np.int64)
            for node in range(size):
                rows = np.flatnonzero(at == node)
                if not len(rows):
                    continue
                gs, hs = g[rows].sum(), h[rows].sum()
                value[node] = gs / (hs + l2)
                if node >= 2**depth - 1 or len(rows) < 2 * least:
                    continue
                best = (1e-6, -1, 0)
                for j, e in enumerate(edges):
                    n = len(e) + 1
                    bj = b[rows, j]
                    gl, hl, nl = (np.cumsum(np.bincount(bj, w, n))[:-1] for w in (g[rows], h[rows], None))
                    gain = gl**2 / (hl + l2) + (gs - gl) ** 2 / (hs - hl + l2) - gs**2 / (hs + l2)
                    gain[(nl < least) | (len(rows) - nl < least)] = 0
                    if len(gain) and gain.max() > best[0]:
                        best = (gain.max(), j, int(gain.argmax()))
                if best[1] >= 0:
                    feature[node], cut[node] = best[1], best[2]
                    at[rows] = 2 * node + 1 + (b[rows, best[1]] > best[2])
            model.trees.append((feature, cut, value))
            raw += rate * value[at]
        return model


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing least-squares fit of y by score (pool adjacent violators); equal scores are one point."""
    at, inverse = np.unique(score, return_inverse=True)
    n, s = np.bincount(inverse).astype(float), np.bincount(inverse, y.astype(float))
    blocks: list[list[float]] = []
    for i in range(len(at)):
        blocks.append([s[i], n[i], i, i])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2], last[3]]
    knots = [(at[int(i)], s / n) for s, n, lo, hi in blocks for i in dict.fromkeys((lo, hi))]
    return np.array([k[0] for k in knots]), np.array([k[1] for k in knots])


@dataclass
class Model:
    """What scoring needs; trees is None where the labels gave no two classes, and share is then every score."""

    lexicon: Lexicon
    share: float
    trees: Trees | None = None
    knots: tuple[np.ndarray, np.ndarray] | None = None

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.trees is None:
            return np.full(len(texts), self.share)
        raw = self.trees.raw(np.array([features(t or "", self.lexicon) for t in texts]).reshape(len(texts), len(FEATURES)))
        # a thousandth of the uncalibrated score keeps the order of rows on one step of the calibration
        return 0.999 * np.interp(raw, *self.knots) + 0.001 / (1 + np.exp(-raw))


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves no remainder by 5; a null id counts as an empty text, so as held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS, seed: int = 11) -> Model:
    """Fits on the labelled rows that are not held out, at most max_rows of them.

    The sample's ids are broadcast (max_rows rows at most), its texts stay distributed; the counts of stems are
    aggregated in Spark and the lexicon's entries and the sample's features, both bounded, come to the driver. Rows
    without a label (null toxic) are left out; an id with several labels is toxic if one of them says so, and one with
    several texts has that of the least hash.
    """
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    known = known.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(max_rows)
    known = known.select(F.col("doc_id").alias("_id"), "_toxic")
    text = F.coalesce("text", F.lit("")).alias("text")
    sample = docs.select("doc_id", text).join(F.broadcast(known), F.col("doc_id") == F.col("_id"))
    sample = materialize(sample.groupBy("_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("_toxic").alias("_toxic")), "sample")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, list[int]] = {}

        def flush() -> pd.DataFrame:
            out = pd.DataFrame([(k, *v) for k, v in seen.items()], columns=["stem", "toxic", "clean"])
            seen.clear()
            return out

        for b in batches:
            for t, y in zip(b["text"], b["_toxic"], strict=True):
                for s in stems(t):
                    seen.setdefault(s, [0, 0])[0 if y else 1] += 1
                if len(seen) > 200_000:
                    yield flush()
        yield flush()

    totals = {bool(r["_toxic"]): r["count"] for r in sample.groupBy((F.col("_toxic") != 0).alias("_toxic")).count().collect()}
    toxic, clean = totals.get(True, 0), totals.get(False, 0)
    if not toxic or not clean:
        return Model(Lexicon({}), 1.0 if toxic else 0.0)
    counts = sample.select("text", "_toxic").mapInPandas(count, "stem string, toxic long, clean long").groupBy("stem").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    both = toxic + clean
    part = lambda k, share: F.when(k > 0, k * F.log(k / (share * (F.col("a") + F.col("b"))))).otherwise(0.0)
    odds = ((F.col("a") + 0.5) / (toxic - F.col("a") + 0.5)) / ((F.col("b") + 0.5) / (clean - F.col("b") + 0.5))
    scored = counts.where("a > 1").select("stem", (2 * (part(F.col("a"), F.lit(toxic / both)) + part(F.col("b"), F.lit(clean / both)))).alias("g2"), odds.alias("odds"))
    chosen = scored.where((F.col("g2") >= LEAST_G2) & (F.col("odds") >= LEAST_ODDS)).orderBy(F.desc("g2"), "stem").limit(MAX_LEXICON)
    lexicon = Lexicon({r["stem"]: math.log(r["odds"]) for r in chosen.collect()})

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["_id"], "toxic": b["_toxic"], "x": [features(t, lexicon) for t in b["text"]]})

    rows = sample.mapInPandas(measure, "id long, toxic int, x array<double>").toPandas().sort_values(["id", "toxic"], kind="stable")
    x, y = np.array(rows["x"].tolist()), (rows["toxic"].to_numpy() != 0).astype(float)
    order = np.random.default_rng(seed).permutation(len(y))
    calibrate = np.zeros(len(y), bool)
    for value in (0.0, 1.0):  # a quarter of each class calibrates, where there are four
        own = order[y[order] == value]
        calibrate[own[: len(own) // 4]] = True
    if calibrate.sum() == 0 or len(set(y[calibrate])) < 2:
        calibrate[:] = True
    use = ~calibrate if len(set(y[~calibrate])) == 2 else np.ones(len(y), bool)
    trees = Trees.fit(x[use], y[use])
    return Model(lexicon, float(y.mean()), trees, isotonic(trees.raw(x[calibrate]), y[calibrate]))


def scorer(model: Model):
    """A function from a text column to its score, 0 to 1."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.scores(texts.tolist()))

    return score


def score(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs.

    Null and empty texts are scored from all-zero features, long ones whole. Equal texts, repeated rows among them, have
    equal scores. Other columns are not read, so that their names may clash with the result's. Without labels of both
    classes the score is the one class's share; an empty table gives an empty one.
    """
    own = scorer(fit(docs, labels, max_rows))
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), own("text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def reject(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """The rows of docs that are not predicted toxic, unchanged."""
    return docs.where(scorer(fit(docs, labels, max_rows))(F.col("text")) < 0.5)
