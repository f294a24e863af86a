"""Substring dedup by recompression.

Rounds name pairs and runs of symbols, beginning with words. A coin, a bit of the name's hash, makes each symbol a left
or a right one; a left symbol followed by a right one becomes a new symbol, named by its two names. Names are hashes, so
that equal word sequences get equal names on all executors without a shuffle. Every symbol carries its context, the
words on which its existence depends; two equal windows hold the same symbols among those whose context lies inside.

A window of 13 words is represented by its highest symbol (ties: the largest hash) with the context inside: at least a
single word, mostly a symbol of four to eight words. Neighbouring windows share theirs, so there are several times fewer
than windows. Only symbols that occur in two documents reveal possible repeats; only windows represented by such are
verified, by hashes of all their words.

Documents are dealt once into blocks by a hash of their id, and the three passes (symbols, suspected windows, removal)
read that one shuffle. A block tells the corpus of each symbol or window once, with the least and the largest of its own
documents, however many hold it: a passage in a third of all documents is one row for each block.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

WINDOW = 13
ROUNDS = 4
#: Characters of a block, on average, and words that are worked on at a time; longer texts are cut into overlapping parts.
BLOCK_CHARS, PART_WORDS = 2_000_000, 1 << 18
_FAR = 1 << 60
NULL_ID = (1 << 63) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))


def window_starts(sizes: np.ndarray) -> np.ndarray:
    """For documents laid end to end: whether a window starts at each word."""
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(sizes.sum())
    return left >= WINDOW


#: An odd multiplier and its inverse modulo 2**64 for each of the two window hashes.
_BASES = tuple((p, pow(p, -1, 1 << 64)) for p in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93))


def window_hashes(h: np.ndarray, which: int) -> np.ndarray:
    """A hash of the words i..i+12 for each i that has so many, from differences of a running polynomial in the words' hashes."""
    base, inverse = (np.full(len(h), np.uint64(x), np.uint64) for x in _BASES[which])
    up, down = np.multiply.accumulate(base), np.multiply.accumulate(inverse)
    total = np.cumsum(mix(h + np.uint64(which)) * up)
    n = max(0, len(h) - WINDOW + 1)
    before = np.r_[np.zeros(1, np.uint64), total[: max(0, n - 1)]][:n]
    return mix((total[WINDOW - 1 :][:n] - before) * down[:n])


def representatives(h: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The representing symbol of the window at each word: six bits of level, then the hash of its name."""
    n = len(h)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    name, low, high = mix(h), np.arange(n), np.arange(1, n + 1)
    by_width: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(WINDOW + 1)]

    def offer(level: int, names: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
        key = (np.uint64(level) << np.uint64(58)) | (mix(names + np.uint64(level)) >> np.uint64(6))
        width = hi - lo
        for w in range(1, WINDOW + 1):
            if (own := width == w).any():
                by_width[w].append((lo[own], key[own]))

    offer(0, name, low, high)
    for level in range(1, ROUNDS + 1):
        with_next = doc[1:] == doc[:-1]
        # runs: named by symbol and length, known from both neighbours
        begins = np.flatnonzero(np.r_[True, ~(with_next & (name[1:] == name[:-1]))])
        ends = np.r_[begins[1:], len(name)]
        run = (ends - begins > 1) & (begins > 0) & (ends < len(name))
        b, e = begins[run], ends[run]
        inside = (doc[b - 1] == doc[b]) & (doc[e] == doc[b]) if len(b) else np.zeros(0, bool)
        b, e = b[inside], e[inside]
        offer(2 * level - 1, mix(name[b] + (e - b).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), low[b - 1], high[np.minimum(e, len(high) - 1)])
        # pairs: a left symbol and a right one; who stays alone depends on the neighbour with which it did not pair
        right = (mix(name ^ np.uint64(level)) >> np.uint64(63)).astype(bool)
        pair = with_next & ~right[:-1] & right[1:]
        first = np.flatnonzero(pair)
        alone = np.ones(len(name), bool)
        alone[first] = alone[first + 1] = False
        other = np.where(right, np.arange(len(name)) - 1, np.arange(len(name)) + 1)
        known = (other >= 0) & (other < len(name))
        other = np.clip(other, 0, len(name) - 1)
        known &= doc[other] == doc
        lo = np.where(known, np.minimum(low, low[other]), -_FAR)
        hi = np.where(known, np.maximum(high, high[other]), _FAR)
        name2 = name.copy()
        name2[first] = mix(name[first] * np.uint64(0x9E3779B97F4A7C15) + mix(name[first + 1] + np.uint64(level)))
        offer(2 * level, name2[first], lo[first], hi[first])
        stay = np.ones(len(name), bool)
        stay[first + 1] = False
        name, low, high, doc = name2[stay], lo[stay], hi[stay], doc[stay]
    best, at = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    for width in range(1, WINDOW + 1):  # at: the highest symbol whose context begins at a word and is at most width long
        for lo, key in by_width[width]:
            np.maximum.at(at, lo, key)
        shift = WINDOW - width
        np.maximum(best[: n - shift], at[shift:], out=best[: n - shift])
    return best


def window_digests(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """95 bits for each window: 64 and 31."""
    return window_hashes(h, 0).view(np.int64), (window_hashes(h, 1) >> np.uint64(33)).astype(np.int64)


def parts(held: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Word hashes of documents laid end to end, the parts' sizes and each part's document, PART_WORDS or so at a time.

    A document longer than that is cut into parts that overlap by twelve words, so that each window lies in one of them;
    its symbols depend on its own words only and come out the same.
    """
    hashes, sizes, docs, n = [], [], [], 0
    for i, w in enumerate(held):
        for at in range(0, max(1, len(w) - WINDOW + 1), PART_WORDS):
            part = w[at : at + PART_WORDS + WINDOW - 1]
            if len(part) < WINDOW:
                continue
            hashes.append(word_hashes(part))
            sizes.append(len(part))
            docs.append(i)
            n += len(part)
            if n >= PART_WORDS:
                yield np.concatenate(hashes), np.array(sizes), np.array(docs)
                hashes, sizes, docs, n = [], [], [], 0
    if hashes:
        yield np.concatenate(hashes), np.array(sizes), np.array(docs)


def least_of(keys: list[np.ndarray], docs: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Each distinct row of keys, the least of its docs, and whether it has others."""
    order = np.lexsort((docs, *keys[::-1]))
    keys, docs = [k[order] for k in keys], docs[order]
    new = np.ones(len(docs), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(docs)] - 1
    return [k[first] for k in keys], docs[first], docs[last] > docs[first]


def originals(block: pd.DataFrame, flags: pd.DataFrame) -> tuple[np.ndarray, list[list[bytes]]]:
    """Ids and words of the documents of a block that are no copies of a document with a smaller id."""
    copies = set(zip(flags.loc[flags["kind"] == 0, "a"], flags.loc[flags["kind"] == 0, "b"], strict=True))
    own = [(d, t) for d, h, t in zip(block["doc"], block["text_hash"], block["text"], strict=True) if (d, h) not in copies]
    return np.array([d for d, _ in own], np.int64), [words(t) for _, t in own]


def find_symbols(block: pd.DataFrame, flags: pd.DataFrame) -> pd.DataFrame:
    """symbol, low, more of the symbols that represent a window of the block's documents: the least one and whether there are others."""
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    ids, held = originals(block, flags)
    for h, sizes, part in parts(held):
        own = window_starts(sizes)
        key, doc = representatives(h, sizes)[own], ids[np.repeat(part, sizes)[own]]
        new = np.r_[True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])]
        out.append((key[new].view(np.int64), doc[new]))
    (symbol,), low, more = least_of([np.concatenate([k for k, _ in out])], np.concatenate([d for _, d in out]))
    return pd.DataFrame({"symbol": symbol, "low": low, "more": more})


def find_suspects(block: pd.DataFrame, flags: pd.DataFrame) -> pd.DataFrame:
    """h1, h2, low, more of the windows that a shared symbol represents."""
    out = [tuple(np.zeros(0, np.int64) for _ in range(3))]
    shared = np.sort(flags.loc[flags["kind"] == 1, "a"].to_numpy(np.int64))
    ids, held = originals(block, flags) if len(shared) else (np.zeros(0, np.int64), [])
    for h, sizes, part in parts(held):
        key = representatives(h, sizes).view(np.int64)
        hit = window_starts(sizes) & (shared[np.minimum(np.searchsorted(shared, key), len(shared) - 1)] == key)
        at = np.flatnonzero(hit)
        h1, h2 = window_digests(h)
        out.append((h1[at], h2[at], ids[np.repeat(part, sizes)[at]]))
    (h1, h2), low, more = least_of([np.concatenate([x[i] for x in out]) for i in (0, 1)], np.concatenate([x[2] for x in out]))
    return pd.DataFrame({"h1": h1, "h2": h2, "low": low, "more": more})


def covered(held: list[list[bytes]], ids: list[int], flags: pd.DataFrame) -> dict[int, list[list[int]]]:
    """[start, end) stretches of each document, by its place in held, that repeated windows cover."""
    again = flags[flags["kind"] == 2]
    least = dict(zip(zip(again["a"].tolist(), again["b"].tolist(), strict=True), again["c"].tolist(), strict=True))
    first, spans = np.unique(again["a"].to_numpy(np.int64)), {}
    reached: dict[int, int] = {}  # words of a document in the parts before
    for h, sizes, part in parts(held) if len(first) else ():
        begins = np.r_[0, np.cumsum(sizes)[:-1]]
        base = []
        for k, n in zip(part.tolist(), sizes.tolist(), strict=True):
            base.append(reached.get(k, 0))
            reached[k] = base[-1] + n - WINDOW + 1
        h1 = window_hashes(h, 0).view(np.int64)
        inside = window_starts(sizes)[: len(h1)]
        maybe = np.flatnonzero(inside & (first[np.minimum(np.searchsorted(first, h1), len(first) - 1)] == h1))
        if not len(maybe):
            continue
        h2 = (window_hashes(h, 1) >> np.uint64(33)).astype(np.int64)
        place = np.searchsorted(begins, maybe, side="right") - 1
        for i, p, a, b in zip(maybe.tolist(), place.tolist(), h1[maybe].tolist(), h2[maybe].tolist(), strict=True):
            k = int(part[p])
            if least.get((a, b), ids[k]) < ids[k]:
                start = i - int(begins[p]) + base[p]
                own = spans.setdefault(k, [])
                if own and start <= own[-1][1]:
                    own[-1][1] = start + WINDOW
                else:
                    own.append([start, start + WINDOW])
    return spans


def remove(block: pd.DataFrame, flags: pd.DataFrame) -> pd.DataFrame:
    """The result's rows for a block's documents."""
    copies = set(zip(flags.loc[flags["kind"] == 0, "a"], flags.loc[flags["kind"] == 0, "b"], strict=True))
    ids, held = block["doc"].tolist(), [words(t) for t in block["text"]]
    is_copy = [(d, h) in copies for d, h in zip(ids, block["text_hash"], strict=True)]
    spans = covered([[] if c else w for w, c in zip(held, is_copy, strict=True)], ids, flags)
    rows = []
    for k, (doc, w) in enumerate(zip(ids, held, strict=True)):
        own = ([[0, len(w)]] if len(w) >= WINDOW else []) if is_copy[k] else spans.get(k, [])
        kept, at, gone, glue = hashlib.sha256(), 0, 0, b""
        for start, end in [*own, [len(w), len(w)]]:
            if start > at:
                kept.update(glue + b" ".join(w[at:start]))
                glue = b" "
            gone, at = gone + end - start, end
        rows.append((doc, len(w), gone, kept.hexdigest(), [{"start": s, "stop": e} for s, e in own]))
    return pd.DataFrame(rows, columns=["doc", "n_words", "n_removed", "kept_sha256", "removed"])


def dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, removed) for each row of docs; removed: (start, stop) in words.

    A word is removed if a window of 13 words covers it that also starts in a document with a smaller doc_id, as the
    documents came. Rows that share an id are not smaller than each other; null ids are larger than all others, ids
    less than 2**63 - 1; null text has no words, a text of fewer than 13 words keeps them. Whole texts that a smaller id
    has as well are known by their hash and take no part in the search; long texts are cut into overlapping parts. Other
    columns are not read, so that their names may clash with the result's; an empty table gives an empty one.
    """
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    ids = materialize(texts.select("doc", F.xxhash64("text").alias("text_hash"), F.unhex(F.md5("text")).alias("md"), F.length("text").alias("chars")), "ids")
    count = max(1, math.ceil((ids.agg(F.sum("chars")).first()[0] or 0) / BLOCK_CHARS))
    block = F.pmod(F.xxhash64("doc"), F.lit(count)).cast("int").alias("block")
    # written, so that the join below has a shuffle of its own on either side and AQE can split a very common text
    least = materialize(ids.groupBy("md").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most"), "least")
    copies = ids.join(least, "md").where("doc > least").select(block, F.lit(0).alias("kind"), F.col("doc").alias("a"), F.col("text_hash").alias("b"), F.lit(0).cast("long").alias("c"))
    copies = materialize(copies, "copies")
    dealt = texts.select(block, "doc", F.xxhash64("text").alias("text_hash"), "text").groupBy("block")
    none = F.lit(0).cast("long")

    # a row's least document tells its block, and with `more` whether the block holds a document above the corpus's least
    seen = dealt.cogroup(copies.groupBy("block")).applyInPandas(find_symbols, "symbol long, low long, more boolean")
    least = F.min("low").over(Window.partitionBy("symbol"))
    others = F.max("low").over(Window.partitionBy("symbol")) > least
    any_more = F.max("more").over(Window.partitionBy("symbol"))
    shared = seen.select("symbol", "low", (others | any_more).alias("shared")).where("shared")
    at = lambda doc: F.pmod(F.xxhash64(doc), F.lit(count)).cast("int").alias("block")
    shared = shared.select(at("low"), F.lit(1).alias("kind"), F.col("symbol").alias("a"), none.alias("b"), none.alias("c"))

    windows = dealt.cogroup(copies.unionByName(shared).groupBy("block")).applyInPandas(find_suspects, "h1 long, h2 long, low long, more boolean")
    windows = windows.select("h1", "h2", "low", "more", F.min("low").over(Window.partitionBy("h1", "h2")).alias("least"))
    repeated = windows.where("more or low > least").select(at("low"), F.lit(2).alias("kind"), F.col("h1").alias("a"), F.col("h2").alias("b"), F.col("least").alias("c"))

    schema = "doc long, n_words long, n_removed long, kept_sha256 string, removed array<struct<start:long,stop:long>>"
    out = dealt.cogroup(copies.unionByName(repeated).groupBy("block")).applyInPandas(remove, schema)
    return out.select(F.nullif("doc", F.lit(NULL_ID)).alias("doc_id"), "n_words", "n_removed", "kept_sha256", "removed")
