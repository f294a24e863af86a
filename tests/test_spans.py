import random
import re

import pytest

from quillstone.functions import legal
from quillstone.operators import spans

CASES = {
    "SECTION_REF": [
        ("see Section 44 here", "Section 44"), ("Section 7B was added", "Section 7B"), ("Section 3(4)(c) says", "Section 3(4)(c)"), ("by section 12 (3) too", "section 12 (3)"),
        ("Sub-section (2) of Section 9 holds", "Sub-section (2) of Section 9"), ("Clause (d) of Section 11(2) lists", "Clause (d) of Section 11(2)"),
        ("Clause (c) of Sub-section (4) of Section 8A", "Clause (c) of Sub-section (4) of Section 8A"), ("second proviso to Section 14", "second proviso to Section 14"),
        ("Proviso to Sub-section (1) of Section 6", "Proviso to Sub-section (1) of Section 6"), ("Explanation 3 to Section 5(2)", "Explanation 3 to Section 5(2)"), ("explanation to Section 5", "explanation to Section 5"),
        ("the Second Schedule to the Act", "Second Schedule to the Act"), ("IVth Schedule", "IVth Schedule"), ("Order V Rule 20 applies", "Order V Rule 20"), ("Rule 8D(2) too", "Rule 8D(2)"),
        ("Chapter XII-B", "Chapter XII-B"), ("Chapter 4", "Chapter 4"), ("Article 19(1) of the Constitution", "Article 19(1) of the Constitution"), ("paragraph 6(b)", "paragraph 6(b)"), ("para 11", "para 11"),
        ("xSection 5", None), ("rule 7 of", None), ("Section 5b", None), ("Sectional 5", None),
    ],
    "NOTIFICATION": [
        ("in S.O. 77(E) of", "S.O. 77(E)"), ("G.S.R. 8 and", "G.S.R. 8"), ("CBIC Notification No. 4/2021", "CBIC Notification No. 4/2021"), ("Circular No. 5 of 2018", "Circular No. 5 of 2018"), ("Instruction No 9/2020", "Instruction No 9/2020"),
        ("F. No. 12/3-TPL", "F. No. 12/3-TPL"), ("Press Release No. 11/2", "Press Release No. 11/2"), ("Notification No. 3/2020 dated 1.2.2020", "Notification No. 3/2020 dated 1.2.2020"), ("Order No. 7/AB", "Order No. 7/AB"),
        ("Letter No. 5/x dated", "Letter No. 5/x dated"), ("no number", None),
    ],
    "DATE": [
        ("on 2021-12-31.", "2021-12-31"), ("on 1-2-2020", "1-2-2020"), ("on 01/02/2020", "01/02/2020"), ("on 1.12.2020", "1.12.2020"), ("3rd May 2011", "3rd May 2011"), ("May 3, 2011", "May 3, 2011"), ("in June, 2015", "June, 2015"),
        ("F.Y. 2019-20", "F.Y. 2019-20"), ("AY 2020–21", "AY 2020–21"), ("w.e.f 1.4.2020", "w.e.f 1.4.2020"), ("12021-12-31", None),
    ],
    "MONEY": [
        ("Rs. 2,50,000 and", "Rs. 2,50,000"), ("Rs.75", "Rs.75"), ("INR 5 Crore", "INR 5 Crore"), ("Rs 3.5 lakh", "Rs 3.5 lakh"), ("₹900", "₹900"), ("1.25 Lakh rupee", "1.25 Lakh rupee"), ("USD 40,000.50", "USD 40,000.50"),
        ("EUR 7", "EUR 7"), ("GBP 12", "GBP 12"), ("of Rs. 1,00,000, paid", "Rs. 1,00,000,"), ("900", None),
    ],
    "ACT_NAME": [
        ("the Patents Act, 1970 and", "Patents Act, 1970"), ("the Customs Tariff Act, 1975", "Customs Tariff Act, 1975"), ("the Code on Wages, 2019", "Code on Wages, 2019"), ("SEBI (Prohibition of Insider Trading) Regulations, 2015", "SEBI (Prohibition of Insider Trading) Regulations, 2015"),
        ("the Lighthouse Keepers Act, 1931", "Lighthouse Keepers Act, 1931"), ("Quarry Safety Rules 1999", "Quarry Safety Rules 1999"), ("Finance Act, 2021", "Finance Act, 2021"), ("the Income Tax Act says", "Income Tax Act"), ("an Act of 1999", None),
    ],
    "ORG": [
        ("the Kerala High Court ruled", "Kerala High Court"), ("the High Court of Madras", "High Court of Madras"), ("by NCLAT.", "NCLAT"), ("the World Bank", "World Bank"), ("the GST Council met", "GST Council"), ("the Law Commission of India", "Law Commission of India"),
        ("RBI2 said", "RBI"), ("RBIs", None), ("xRBI", None), ("Small Industries Development Bank of India", "Small Industries Development Bank of India"),
    ],
}


def extract(spark, texts, **options):
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    got = {r.k: [tuple(e) for e in r.entities] for r in spans.annotate(rows, "k", **options).collect()}
    return [got[i] for i in range(len(texts))]


@pytest.mark.parametrize("label", CASES)
def test_cases(spark, label):
    found = extract(spark, [t for t, _ in CASES[label]])
    for (text, want), got in zip(CASES[label], found, strict=True):
        own = [t for name, t, _, _ in got if name == label]
        assert (own == [] if want is None else want in own), (text, want, got)
        assert all(text[s:e] == t for _, t, s, e in got)


def test_sentences_with_many_kinds(spark):
    text = (
        "By G.S.R. 45(E) of 19 December 2017 the Ministry of Finance, under proviso to Section 2(1)(a) of the Limitation Act, 1963, "
        "set a fee of ₹4,51,664 for FY 2019-20; the Patna High Court agreed on 31-03-2024."
    )
    plain = "The firm grew this year and its report was long."
    a, b, c = extract(spark, [text, plain, ""])
    assert {e[0] for e in a} == set(legal.LABEL_PRIORITY) and b == c == []
    assert all(x[3] <= y[2] for x, y in zip(a, a[1:], strict=False))


def test_null_text(spark):
    assert extract(spark, [None]) == [[]]


def model(candidates):
    taken, out = set(), []
    for c in sorted(candidates, key=lambda c: (c[2] - c[3], legal.LABEL_PRIORITY.get(c[0], 99))):
        if not taken & set(range(c[2], c[3])):
            taken |= set(range(c[2], c[3]))
            out.append(c[:4])
    return sorted(out, key=lambda c: c[2])


def test_resolver_against_a_sequential_model():
    rng = random.Random(0)
    for _ in range(300):
        own = []
        for i in range(rng.randint(0, 12)):
            s = rng.randint(0, 30)
            own.append((rng.choice([*legal.LABEL_PRIORITY, "OTHER"]), f"t{i}", s, s + rng.randint(1, 9)))
        assert spans.resolve(own) == model(own)


def test_many_candidates_in_one_text(spark):
    text = "by Section 5(1) of the Companies Act, 2013 on 2020-01-02 " * 20_000
    (got,) = extract(spark, [text])
    assert len(got) == 60_000 and got[-1][0] == "DATE"


def zeta(text):
    if "broken" in text:
        raise RuntimeError("no model")
    return [m.span() for m in re.finditer(r"Zeta \w+", text)]


def test_a_model_adds_organisations(spark):
    long = "x" * spans.MODEL_CHARS
    got = extract(spark, ["paid by Zeta Corp to the Reserve Bank of India", "broken Zeta Corp and NCLAT", f"{long} Zeta Corp", None], model=zeta)
    assert [[e[1] for e in own] for own in got] == [["Zeta Corp", "Reserve Bank of India"], ["NCLAT"], [], []]


def test_anchors_lose_no_match():
    texts = [t for cases in CASES.values() for t, _ in cases]
    for ruleset in ("standard", "builtin"):
        own = spans.rules(ruleset)
        finder = spans.Finder(own, {}, None)
        for text in texts:
            want = {(label, m[0].strip(), m.start()) for label, _, _, p in own for m in re.finditer(rf"(?<!\w){p}(?!\w)", text) if m[0].strip()}
            assert {c[:3] for c in finder(text)} == want


def test_rule_sets(spark):
    assert len(spans.rules()) == 41 and len(spans.rules("builtin")) == 38
    assert len(spans.acts()) == 104 and len(spans.organisations()) == 144
    with pytest.raises(ValueError):
        spans.rules("none")
    own = spans.read_rules("shop:\n - {id: a, pattern: 'aisle \\d+', priority: 1}\n - {id: bad, pattern: '('}\n - {id: b, pattern: 'bay'}\nempty:\n")
    assert [(r[0], r[1], r[2]) for r in own] == [("SHOP", "a", 1), ("SHOP", "b", 99)]
    assert spans.rules_table(spark, own).count() == 2
    got = extract(spark, ["aisle 5 bay"], own_rules=own, gazetteers={"COLOUR": ["red"]}, heuristic=None)
    assert [e[:2] for e in got[0]] == [("SHOP", "aisle 5"), ("SHOP", "bay")]


def test_candidates_keep_all_matches(spark):
    rows = spark.createDataFrame([(1, "Section 5(1) of the Companies Act, 2013")], "k int, text string")
    own = [r.span_text for r in spans.candidates(rows, "k").collect()]
    assert {"Section 5(1)", "Section 5", "Companies Act, 2013"} <= set(own)


def test_searches_begin_with_what_a_rule_looks_for():
    rng = random.Random(3)
    pieces = [t for cases in CASES.values() for t, _ in cases] + ["x", " ", "_", "9", "é", "Rs", "-", "12", "S", "₹"]
    texts = ["".join(rng.choice(pieces)[rng.choice([0, 0, 1, 3]):] for _ in range(30)) for _ in range(60)]
    own = {p for ruleset in ("standard", "builtin") for _, _, _, p in spans.rules(ruleset)}
    for p in own:
        a, b = re.compile(rf"(?<!\w){p}(?!\w)"), re.compile(rf"{spans.led(p)}(?!\w)")
        assert [[m.span() for m in a.finditer(t)] for t in texts] == [[m.span() for m in b.finditer(t)] for t in texts], p
    assert sum(spans.led(p).startswith("(?<!") for p in own) <= 4
    finder = spans.Finder(spans.rules(), {}, None)
    for text in texts:
        assert {c[:3] for c in finder(text)} == {(label, m[0].strip(), m.start()) for label, _, _, p in spans.rules() for m in re.finditer(rf"(?<!\w){p}(?!\w)", text)}
