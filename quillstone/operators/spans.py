"""Typed spans in texts: rules, gazetteers and a structural heuristic give candidates, the longest win.

One Arrow pass, row by row and without a shuffle: rules keep their regex flavour, one automaton finds all phrases of the
gazetteers at once, and what overlaps is resolved there too, so that only entities come back.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import legal
from ..functions.arrow import lists

SPAN = "struct<label:string,text:string,start:int,end:int,ord:int>"
SPANS = f"array<{SPAN}>"
ENTITIES = "array<struct<label:string,text:string,start:int,end:int>>"
LABELS = ("SECTION_REF", "NOTIFICATION", "DATE", "MONEY")
#: A model of organisations sees so many characters of a text.
MODEL_CHARS = 100_000
Candidate = tuple[str, str, int, int]
Model = Callable[[str], Iterable[tuple[int, int]]]


def rules(ruleset: str = "standard") -> list[tuple[str, str, int, str]]:
    """(label, id, priority, pattern) of the standard or the builtin set."""
    if ruleset == "standard":
        return list(legal.PATTERNS)
    if ruleset != "builtin":
        raise ValueError(f"no rule set {ruleset!r}")
    changed = ((label, name, p, legal.BUILTIN_CHANGES.get(name, pattern)) for label, name, p, pattern in legal.PATTERNS)
    return [r for r in changed if r[3] is not None]


def read_rules(source: str) -> list[tuple[str, str, int, str]]:
    """Rules of a YAML text: label -> list of {id, pattern, priority}; 99 without a priority, patterns that do not compile are left out."""
    out = []
    for label, entries in (yaml.safe_load(source) or {}).items():
        for e in entries or []:
            try:
                re.compile(e["pattern"])
            except re.error:
                continue
            out.append((label.upper(), e.get("id", "?"), int(e.get("priority", 99)), e["pattern"]))
    return out


def rules_table(spark: SparkSession, own: Iterable[tuple[str, str, int, str]]) -> DataFrame:
    return spark.createDataFrame(list(own), "label string, id string, priority int, pattern string")


def acts() -> list[str]:
    return sorted({*legal.ACTS, *legal.RULES}, key=lambda p: (-len(p), p))


def organisations() -> list[str]:
    return sorted({*legal.COURTS, *legal.TRIBUNALS, *legal.REGULATORS, *legal.AUTHORITIES}, key=lambda p: (-len(p), p))


#: A rule is tried only on texts that hold one of these; every match of it does. Rules without an entry are always tried.
ANCHORS = {
    "const_article": ["Article"], "clause_subsec_sec": ["Clause"], "clause_sec": ["Clause"], "proviso_sec": ["roviso"], "explanation_sec": ["xplanation"], "subsec_sec": ["Sub"], "order_rule": ["Order"],
    "schedule": ["Schedule"], "sec_with_sub": ["ection"], "sec_plain": ["ection"], "rule_plain": ["Rule"], "chapter": ["Chapter"], "para": ["para"], "so": ["S.O."], "gsr": ["G.S.R."], "circular": ["Circular"],
    "instruction": ["Instruction"], "letter": ["Letter"], "fno": ["No"], "press": ["Press"], "notif_no": ["Notification"], "order_no": ["Order"], "cbdt_ref": ["CB"], "wef": ["w.e.f"], "iso": ["-"],
    "dd_mm_yyyy_dash": ["-"], "dd_mm_yyyy_slash": ["/"], "dd_mm_yyyy_dot": ["."], "fy": ["F"], "ay": ["A"], "inr_crore_lakh": ["Rs", "INR", "₹"], "crore_lakh_words": ["crore", "lakh", "arab", "thousand"], "numeral_crore": ["rupee"],
    "usd": ["USD"], "eur": ["EUR"], "gbp": ["GBP"], "rupee_sym": ["₹"], "rs_plain": ["Rs"],
    **dict.fromkeys(("dd_month_yyyy", "month_dd_yyyy", "month_year"), ["uary", "March", "April", "May", "June", "July", "August", "ember", "October"]),
}
#: The same as patterns, for rules whose literals are in most texts.
GATES = {"dd_mm_yyyy_dash": r"-\d{1,2}-\d{4}", "dd_mm_yyyy_slash": r"/\d{1,2}/\d{4}", "dd_mm_yyyy_dot": r"\.\d{1,2}\.\d{4}"}


def led(pattern: str) -> str:
    """`(?<!\\w)pattern`, where possible with the look behind after the first characters: a search then skips to these."""
    if m := re.match(r"(?:[A-Za-z]+|\[[A-Za-z]+\])(?![?*+{])", pattern):
        return rf"{m[0]}(?<!\w{m[0]}){pattern[m.end():]}"
    if m := re.match(r"\\d(\{4\}|\{1,2\}|\+)(?![?+])", pattern):
        rest = {"{4}": r"\d{3}", "{1,2}": r"\d?", "+": r"\d*"}[m[1]]
        return rf"\d(?<!\w\d){rest}{pattern[m.end():]}"
    if (m := re.match(r"\(\?:([A-Za-z₹][^()|\[\]]*(?:\|[A-Za-z₹][^()|\[\]]*)*)\)(?![?*+{])", pattern)) and not re.search(r"(?:^|\|).[?*+{]", m[1]):
        first = "|".join(rf"{a[0]}(?<!\w{a[0]}){a[1:]}" for a in m[1].split("|"))
        return f"(?:{first}){pattern[m.end():]}"
    return rf"(?<!\w){pattern}"


class Finder:
    """Finds candidates (label, text, start, end), in the order of emission: rules by label and priority, acts, the act heuristic, organisations, the model's."""

    def __init__(self, own_rules: list, gazetteers: dict[str, list[str]], heuristic: str | None, model: Model | None = None) -> None:
        import ahocorasick

        self.model = model
        order = {label: i for i, label in enumerate(dict.fromkeys([*LABELS, *(r[0] for r in own_rules)]))}
        ranked = sorted(own_rules, key=lambda r: (order[r[0]], r[2]))
        own = {(r[1], r[3]) for s in ("standard", "builtin") for r in rules(s)}
        self.rules = []
        for label, name, _, pattern in ranked:
            known = (name, pattern) in own
            gate = re.compile(GATES[name]).search if known and name in GATES else None
            start = led(pattern) if known else rf"(?<!\w){pattern}"
            self.rules.append((label, re.compile(rf"{start}(?!\w)"), ANCHORS.get(name) if known else None, gate))
        self.anchors = {a for r in self.rules for a in r[2] or ()}
        self.heuristic = re.compile(heuristic) if heuristic else None
        self.automaton, self.phrases = None, []
        known: dict[str, list[int]] = {}
        for label, phrases in gazetteers.items():
            for p in phrases:
                known.setdefault(p, []).append(len(self.phrases))
                self.phrases.append((label, p))
        if known:
            self.automaton = ahocorasick.Automaton()
            for p, numbers in known.items():
                self.automaton.add_word(p, numbers)
            self.automaton.make_automaton()

    def _phrases(self, text: str) -> dict[str, list]:
        found: dict[str, list] = {}
        for last, numbers in self.automaton.iter(text) if self.automaton else ():
            for number in numbers:
                label, phrase = self.phrases[number]
                start, end = last + 1 - len(phrase), last + 1
                if not text[start - 1 : start].isalpha() and not text[end : end + 1].isalpha():
                    found.setdefault(label, []).append((number, start, end, phrase))
        return {label: [(label, p, s, e) for _, s, e, p in sorted(hits)] for label, hits in found.items()}

    def __call__(self, text: str) -> Iterator[tuple[str, str, int, int]]:
        def matches(label: str, pattern: re.Pattern) -> Iterator[tuple[str, str, int, int]]:
            for m in pattern.finditer(text):
                if own := m[0].strip():
                    yield label, own, m.start(), m.start() + len(own)

        held = {a: a in text for a in self.anchors}
        for label, pattern, anchors, gate in self.rules:
            if (anchors is None or any(held[a] for a in anchors)) and (gate is None or gate(text)):
                yield from matches(label, pattern)
        named = self._phrases(text)
        yield from named.pop("ACT_NAME", ())
        if self.heuristic:
            yield from matches("ACT_NAME", self.heuristic)
        for hits in named.values():
            yield from hits
        yield from self._modelled(text) if self.model else ()

    def _modelled(self, text: str) -> list[Candidate]:
        """The model's organisations; a text on which it fails has none."""
        try:
            found = [(int(s), int(e)) for s, e in self.model(text[:MODEL_CHARS])]
        except Exception:  # noqa: BLE001 - whatever a model raises, the other candidates of the text stay
            return []
        return [("ORG", own, s, e) for s, e in found if (own := text[s:e].strip())]


def resolve(candidates: Iterable[Candidate]) -> list[Candidate]:
    """Candidates without overlaps, by start: longer ones win, then the label's priority, then the order of emission.

    Greedy: what has been rejected blocks nothing. Spans that touch do not overlap. Accepted spans are kept sorted, so that
    a candidate is compared with its two neighbours only.
    """
    starts: list[int] = []
    taken: list[Candidate] = []
    for c in sorted(candidates, key=lambda c: (c[2] - c[3], legal.LABEL_PRIORITY.get(c[0], 99))):
        at = bisect_left(starts, c[2])
        if (at == 0 or taken[at - 1][3] <= c[2]) and (at == len(taken) or c[3] <= taken[at][2]):
            starts.insert(at, c[2])
            taken.insert(at, c)
    return taken


def finder(own_rules: list | None = None, gazetteers: dict[str, list[str]] | None = None, heuristic: str | None = legal.ACT_PATTERN, model: Model | None = None, resolved: bool = True):
    """A function from a text column to its entities, ENTITIES, or, unresolved, to its candidates, SPANS; a null text has none.

    model: a function from a text to (start, end) of organisations, called on the executors; by default there is none.
    """
    own_rules = rules() if own_rules is None else own_rules
    gazetteers = {"ACT_NAME": acts(), "ORG": organisations()} if gazetteers is None else gazetteers
    kinds = {"label": pa.string(), "text": pa.string(), "start": pa.int32(), "end": pa.int32()} | ({} if resolved else {"ord": pa.int32()})

    @F.arrow_udf(ENTITIES if resolved else SPANS)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        find_in = Finder(own_rules, gazetteers, heuristic, model)
        for texts in batches:
            every = (resolve(find_in(x or "")) if resolved else [(*c, i) for i, c in enumerate(find_in(x or ""))] for x in texts.to_pylist())
            yield lists(every, kinds)

    return find


def candidates(docs: DataFrame, key: str, text: str = "text", **options) -> DataFrame:
    """One row for each candidate of docs: key, label, span_text, start, end, ord."""
    found = docs.select(key, finder(**options, resolved=False)(F.col(text)).alias("c"))
    return found.select(key, F.inline_outer("c")).where("start is not null").withColumnRenamed("text", "span_text")


def annotate(docs: DataFrame, key: str, text: str = "text", **options) -> DataFrame:
    """key and entities, array<struct<label, text, start, end>>, for each row of docs, also where there are none."""
    return docs.select(key, finder(**options)(F.col(text)).alias("entities"))


def entities(annotated: DataFrame, key: str) -> DataFrame:
    """One row for each entity: key, label, span_text, start, end."""
    # an inner generator would have the optimizer compute the array again, for a filter on its size
    return annotated.select(key, F.inline_outer("entities")).where("start is not null").withColumnRenamed("text", "span_text")
