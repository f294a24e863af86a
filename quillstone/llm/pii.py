"""Personal data: patterns for e-mails, addresses, cards and phones, then information-theoretic sanitisation.

The pattern matches are the protected entities. Over the whole corpus it is counted in how many documents an entity
occurs, a term occurs, and both occur with the term near the entity. A term's disclosure of an entity is their pointwise
mutual information over the entity's own information, 1 where the term gives the entity away wholly. Every entity and pair is
estimated, with a prior of independence worth PRIOR_DOCS documents, so that small counts need a large corpus. Terms that
disclose at least GENERALISE of any entity are generalised to their class, and those that disclose at least REMOVE are
removed: wherever they occur, in the whole text of every document.
"""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

KINDS = ("email", "ip", "card", "phone")
GENERALISE, REMOVE = 0.8, 0.95
#: The share of a term's documents that hold an entity is estimated as if so many more documents held the term, and the
#: entity as often among them as anywhere. A pair of one document then discloses GENERALISE from 1,024 documents on.
PRIOR_DOCS = 3
#: Words on each side of an entity that may disclose it.
NEAR_WORDS = 8
#: So many terms at most are sent to the executors, and counted by a task at a time; beyond it they are joined instead.
BROADCAST_TERMS = 200_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ASTRAL = re.compile("[\U00010000-\U0010ffff]")
TERMS = "array<struct<start:int,stop:int,removed:boolean>>"
SCANNED = """uid_doc string, n_email long, n_ip long, n_card long, n_phone long, base string,
    entities array<struct<entity:long,kind:string>>, contexts array<struct<entity:long,term:string,start:int,stop:int>>"""


def _key() -> Column:
    """A row's id, ":" and its text's hash."""
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.xxhash64("text").cast("string"))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each match begins at the left end of the local characters before an @ that are not part of the match before it."""
    done = 0
    for m in _HOST.finditer(text) if "@" in text else ():
        start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            done = m.end()


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            yield m.span()


FINDERS = {"email": emails, "ip": ips, "card": cards, "phone": phones}


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed, then start."""
    return [(kind, *span) for kind in KINDS for span in FINDERS[kind](text)]


def _hash(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


@cache
def _term(most: int) -> re.Pattern:
    """A term: a run of at least three letters and marks, up to the code point most."""
    held = [c for c in range(most + 1) if unicodedata.category(chr(c))[0] in "LM"]
    first = [c for c, before in zip(held, [-2, *held], strict=False) if c != before + 1]
    last = [c for c, after in zip(held, [*held[1:], -2], strict=True) if after != c + 1]
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(first, last, strict=True)) + "]{3,}")


def term_pattern(text: str) -> re.Pattern:
    """The pattern of terms; texts without characters beyond 16 bits have a quicker one that finds the same in them."""
    return _term(sys.maxunicode if _ASTRAL.search(text) else 0xFFFF)


def terms_of(text: str) -> set[str]:
    """The distinct terms of a text in lower case, as contexts() has them."""
    return {w.lower() for w in set(term_pattern(text).findall(text))}


def outside_of(spans: list[tuple[str, int, int]]) -> Callable[[re.Match], bool]:
    """Whether a match is outside all spans."""
    starts, ends = [], []  # of the spans' union
    for s, e in sorted((s, e) for _, s, e in spans):
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    return lambda m: (k := bisect_left(starts, m.end())) == 0 or ends[k - 1] <= m.start()


def occurrences(text: str, rules: dict[str, bool]) -> list[tuple[int, int, bool]]:
    """(start, end, removed) of each term of rules in the text, outside the pattern spans; rules: term to whether it is removed."""
    found = [(m, w) for m in term_pattern(text).finditer(text) if (w := m[0].lower()) in rules]
    outside = outside_of(base_spans(text)) if found else None
    return [(m.start(), m.end(), rules[w]) for m, w in found if outside(m)]


def contexts(text: str, spans: list[tuple[str, int, int]]) -> tuple[list, list]:
    """Entities of a text and the terms near them that are outside all spans: [(entity, kind)], [(entity, term, start, end)]."""
    entities, near = {}, []
    outside = outside_of(spans)
    words = list(term_pattern(text).finditer(text)) if spans else []
    begins, stops = [m.start() for m in words], [m.end() for m in words]
    for kind, start, end in spans:
        value = text[start:end].lower()
        entity = _hash(f"{kind}:{value if kind in ('email', 'ip') else re.sub('[^0-9]', '', value)}")
        entities[entity] = kind
        before, after = bisect_right(stops, start), bisect_left(begins, end)
        close = (*words[max(0, before - NEAR_WORDS) : before], *words[after : after + NEAR_WORDS])
        near += [(entity, m[0].lower(), m.start(), m.end()) for m in close if outside(m)]
    return list(entities.items()), list(dict.fromkeys(near))


def scan(docs: DataFrame) -> DataFrame:
    """Base spans, entities and contexts of each row of docs, with a row id: one pass, nothing shuffled; null text is empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, text in zip(b["doc"], b["text"], strict=True):
                spans = base_spans(text or "")
                n = Counter(s[0] for s in spans)
                entities, near = contexts(text or "", spans) if spans else ([], [])
                rows.append((doc, *(n[k] for k in KINDS), ",".join(f"{k}:{s}:{e}" for k, s, e in spans), entities, near))
            yield pd.DataFrame(rows, columns=["uid_doc", *(f"n_{k}" for k in KINDS), "base", "entities", "contexts"])

    return docs.select(_key().alias("doc"), "text").mapInPandas(run, SCANNED).withColumn("uid", F.monotonically_increasing_id())


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n): in how many rows of docs each term of the table terms occurs."""
    wanted = [r[0] for r in terms.limit(BROADCAST_TERMS + 1).collect()]
    many = len(wanted) > BROADCAST_TERMS
    own = None if many else frozenset(wanted)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        table = lambda: pd.DataFrame(list(seen.items()), columns=["term", "n"]).astype({"n": "int64"})
        for b in batches:
            for t in b["text"]:
                found = terms_of(t)
                seen.update(found if own is None else own.intersection(found))
                if len(seen) > BROADCAST_TERMS:
                    yield table()
                    seen.clear()
        yield table()

    counts = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInPandas(run, "term string, n long")
    if many:
        counts = counts.join(terms, "term", "left_semi")
    return counts.groupBy("term").agg(F.sum("n").alias("n"))


def disclosures(docs: DataFrame, scanned: DataFrame) -> DataFrame:
    """(entity, term, disclosure) of at least GENERALISE, from counts over all documents."""
    pairs = scanned.select("uid", F.explode("contexts").alias("c")).select("uid", "c.entity", "c.term").distinct()
    pairs = materialize(pairs.groupBy("entity", "term").agg(F.count("*").alias("n_both")), "pairs")
    n_entity = scanned.select(F.explode("entities.entity").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity"))
    n_term = term_counts(docs, pairs.select("term").distinct()).withColumnRenamed("n", "n_term")
    total = F.lit(float(scanned.count()))
    joined = pairs.join(n_entity, "entity").join(n_term, "term")
    information = F.log(total / F.col("n_entity"))
    anywhere = F.col("n_entity") / total
    given = (F.col("n_both") + PRIOR_DOCS * anywhere) / (F.greatest("n_term", "n_both") + PRIOR_DOCS)
    shared = F.log(given / anywhere)
    out = joined.select("entity", "term", F.coalesce(F.try_divide(shared, information), F.lit(0.0)).alias("disclosure"))
    return materialize(out.where(F.col("disclosure") >= GENERALISE), "disclosures")


def term_rules(docs: DataFrame, scanned: DataFrame) -> tuple[DataFrame, dict[str, bool] | None]:
    """(term, removed) of the disclosing terms, also as a dictionary where they are at most BROADCAST_TERMS."""
    rules = disclosures(docs, scanned).groupBy("term").agg((F.max("disclosure") >= REMOVE).alias("removed"))
    some = rules.limit(BROADCAST_TERMS + 1).collect()
    return rules, dict(map(tuple, some)) if len(some) <= BROADCAST_TERMS else None


def term_spans(docs: DataFrame, rules: DataFrame, own: dict[str, bool] | None) -> DataFrame:
    """(doc, terms) for each id and text of docs with disclosing terms, as in spans(); rules and own from term_rules()."""
    texts = docs.where("text is not null").select(_key().alias("doc"), "text")

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = pd.DataFrame({"doc": b["doc"], "term": [list(terms_of(text)) for text in b["text"]]})
            yield found.explode("term").dropna(subset="term")

    if own is None:
        said = texts.mapInPandas(words, "doc string, term string").join(rules, "term").groupBy("doc").agg(F.map_from_entries(F.collect_set(F.struct("term", "removed"))).alias("_rules"))
        texts = texts.join(said, "doc")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            each = [own] * len(b) if own is not None else map(dict, b["_rules"])
            rows = [(doc, found) for doc, text, r in zip(b["doc"], b["text"], each, strict=True) if (found := occurrences(text, r))]
            yield pd.DataFrame(rows, columns=["doc", "terms"])

    out = texts.mapInPandas(run, f"doc string, terms {TERMS}")
    return materialize(out.groupBy("doc").agg(F.first("terms").alias("terms")), "terms")


def spans(docs: DataFrame) -> DataFrame:
    """For each row of docs: doc (its id, ":" and its text's hash), n_email, n_ip, n_card, n_phone, base and terms.

    base is the pattern spans as "kind:start:end", terms an array of (start, stop, removed) of disclosing terms, sorted,
    disjoint from each other and from base. An empty or null text has nothing.
    """
    scanned = materialize(scan(docs), "scanned")
    terms = term_spans(docs, *term_rules(docs, scanned)).withColumnRenamed("doc", "uid_doc")
    out = scanned.drop("entities", "contexts").join(terms, "uid_doc", "left")
    return out.select(F.col("uid_doc").alias("doc"), *(f"n_{k}" for k in KINDS), "base", F.coalesce("terms", F.array().cast(TERMS)).alias("terms"))


def report(docs: DataFrame) -> DataFrame:
    """op7's digest columns for each row of docs.

    Null text is empty and has nothing; equal rows have equal spans; long texts are searched whole. Other columns are not
    read, so that their names may clash with the result's; an empty table gives an empty one.
    """
    found = spans(docs)
    terms = F.array_join(F.transform("terms", lambda t: F.concat(F.lit("term:"), t.start, F.lit(":"), t.stop)), ",")
    everything = F.concat_ws(",", F.nullif("base", F.lit("")), F.nullif(terms, F.lit("")))
    doc_id = F.nullif(F.substring_index("doc", ":", 1), F.lit("")).cast("long")
    return found.select(doc_id.alias("doc_id"), *(f"n_{k}" for k in KINDS), F.sha2("base", 256).alias("base_sha256"), everything.alias("spans"), F.size("terms").cast("long").alias("n_terms"))


def replace(text: str, terms: list[dict]) -> str:
    """The sanitised text: entities become [KIND], disclosing terms their class or nothing."""
    marks = [(s, e, f"[{k.upper()}]") for k, s, e in base_spans(text)]
    for t in terms:
        word = text[t["start"] : t["stop"]]
        marks.append((t["start"], t["stop"], "" if t["removed"] else "[NAME]" if word[:1].isupper() else "[WORD]"))
    out, at = [], 0
    for start, end, mark in sorted(marks):
        if start >= at:
            out += [text[at:start], mark]
            at = end
        elif end > at:  # kinds may overlap: what sticks out goes too
            at = end
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame) -> DataFrame:
    """docs with personal data replaced in text; other columns, rows and null texts stay, and n_chars, where there is one, is counted anew.

    Up to BROADCAST_TERMS disclosing terms are sent to the executors; beyond it, a table of the documents that hold one is joined.
    """

    scanned = materialize(scan(docs), "scanned")
    rules, own = term_rules(docs, scanned)

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else replace(t, [dict(zip(("start", "stop", "removed"), x, strict=True)) for x in occurrences(t, own)]) for t in texts], dtype=object)

    @F.pandas_udf("string")
    def joined(texts: pd.Series, terms: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else replace(t, [] if x is None else list(x)) for t, x in zip(texts, terms, strict=True)], dtype=object)

    if own is not None:
        out = docs.withColumn("text", cleaned("text"))
    else:
        found = term_spans(docs, rules, own).select(F.col("doc").alias("_doc"), F.col("terms").alias("_terms"))
        out = docs.join(found, _key() == F.col("_doc"), "left").withColumn("text", joined("text", "_terms"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
