import hashlib
import re

import pytest
from hypothesis import given
from hypothesis import strategies as st

from quillstone.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(s):
        odd, even = s[::-1][::2], s[::-1][1::2]
        return (sum(map(int, odd)) + sum(sum(divmod(2 * int(c), 10)) for c in even)) % 10 == 0

    keep = {
        "email": (EMAIL, lambda m: True),
        "ip": (IP, lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (CARD, lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        "phone": (PHONE, lambda m: 9 <= len(digits(m)) <= 15),
    }
    return [(k, *m.span()) for k, (p, ok) in keep.items() for m in p.finditer(text) if ok(m[0])]


@given(st.text(st.sampled_from("a1@.-+ (4é9%"), max_size=60))
def test_spans_follow_the_patterns(text):
    assert pii.base_spans(text) == plain(text)


@pytest.mark.parametrize("text", ["x.y@z.com@q.org", "@a.b c@d.e", "1.2.3.4.5.6.7.8", "256.1.1.1 000255.1.1.1", "4111 1111-1111 1111 x 4111111111111112", "+1 (017) 555-7713 +12345678", "a" * 50_000 + "@b.cc", "9" * 50_000])
def test_particular_texts(text):
    assert pii.base_spans(text) == plain(text)


def test_a_run_without_at_signs_is_linear():
    assert pii.base_spans("a.b-" * 500_000 + " 1." * 100_000 + " @b.cc" * 100_000) == []


NAMES = ("Zarqon", "Marvax", "Trillo")


def corpus():
    rows = [(i, f"meeting with {NAMES[i % 3]} near the pier and then call mail.{i % 3}@example.com about Quibble today word{i} other{i}") for i in range(9)]
    rows += [(100 + i, f"common words today about the pier and then call number {i}") for i in range(300)]
    return [*rows, (1000, None), (1001, ""), (None, "write a@b.cc"), (1002, "1.2.3.4 " * 3000)]


def test_report(spark):
    rows = [*corpus(), corpus()[0]]
    got = pii.report(spark.createDataFrame([(*r, 1, "d") for r in rows], "doc_id long, text string, term int, doc string")).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for doc_id, text in rows:
        r, spans = by_id[doc_id], plain(text or "")
        base = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in spans) for k in pii.KINDS)
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and r.spans.startswith(base)
    text, terms = rows[0][1], re.findall(r"term:(\d+):(\d+)", by_id[0].spans)
    found = {text[int(s) : int(e)] for s, e in terms}
    # the name that goes with one entity only discloses it; a word shared by all three, common words and words of one document do not
    assert found == {"Zarqon"}


def test_counting_terms_by_join_agrees(spark, monkeypatch):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    terms = spark.createDataFrame([("quibble",), ("today",), ("absent",)], "term string")
    few = sorted(map(tuple, pii.term_counts(docs, terms).collect()))
    monkeypatch.setattr(pii, "BROADCAST_TERMS", 1)
    assert sorted(map(tuple, pii.term_counts(docs, terms).collect())) == few == [("quibble", 9), ("today", 309)]


def test_sanitise(spark):
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in corpus()], "doc_id long, text string, n_chars long")
    out = pii.sanitise(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(corpus()) and got[1000].text is None and got[1001].text == "" and got[None].text == "write [EMAIL]"
    assert "@" not in got[0].text and "[EMAIL]" in got[0].text and "Zarqon" not in got[0].text and got[0].n_chars == len(got[0].text)
    assert all(got[i].text == t for i, t in corpus() if i and 100 <= i < 400)


def test_overlapping_kinds_go_whole():
    assert pii.replace("x +378282246310005 now", []) == "x [PHONE] now"  # also a card from the second character on


def test_empty_table(none):
    assert pii.report(none).count() == 0 and pii.sanitise(none).count() == 0


def test_pairs_of_one_and_two_documents_disclose(spark):
    rows = [(0, "write to Vorpel at once.rare@example.com about common words"), *((i, "Jubjub has twice.rare@example.com with common words") for i in (1, 2))]
    rows += [(i, f"common words about number {i}") for i in range(3, 2000)]
    got = {r.doc_id: pii.replace(rows[r.doc_id][1], [t.asDict() for t in r.terms]) for r in pii.spans(spark.createDataFrame(rows, "doc_id long, text string")).selectExpr("cast(substring_index(doc, ':', 1) as long) as doc_id", "terms").collect()}
    assert "Vorpel" not in got[0] and "[EMAIL]" in got[0] and all("Jubjub" not in got[i] and "[EMAIL]" in got[i] for i in (1, 2))
    assert "common words" in got[0] and got[1].endswith("common words") and all(got[i] == rows[i][1] for i in range(3, 2000))


MARKED = ("Zoe\u0308lika", "\u0915\u093f\u0924\u093e\u092c", "\u0e17\u0e35\u0e48\u0e19\u0e35\u0e48", "\U00011103\U00011127\U00011103\U00011128", "\u0391\u03a3.\u0392\u0393\u0394", "\u0130zmir", "Ⅷabc")


def test_terms_hold_marks_and_no_numerals():
    assert pii.terms_of(" ".join(MARKED)) == {*(m.lower() for m in MARKED[:4]), "\u03b2\u03b3\u03b4", "\u0130zmir".lower(), "abc"}
    for word in MARKED[:4]:
        text = f"{word} a@b.cc and more"
        assert [(t, text[s:e]) for _, t, s, e in pii.contexts(text, pii.base_spans(text))[1]][0] == (word.lower(), word)


def test_both_counting_paths_find_accented_and_indic_terms(spark, monkeypatch):
    rows = [(i, f"{word} wrote entity{i}@example.com about common words") for i, word in enumerate(MARKED[:4])]
    docs = spark.createDataFrame([*rows, *((i, "common words") for i in range(10, 1500))], "doc_id long, text string")
    few = {r.doc: r.terms for r in pii.spans(docs).where("size(terms) > 0").collect()}
    monkeypatch.setattr(pii, "BROADCAST_TERMS", 1)
    assert few == {r.doc: r.terms for r in pii.spans(docs).where("size(terms) > 0").collect()}
    assert all(rows[int(d.split(":")[0])][1][t[0].start : t[0].stop] == MARKED[int(d.split(":")[0])] for d, t in few.items()) and len(few) == 4


def test_terms_are_replaced_in_whole_texts_and_in_other_documents(spark, monkeypatch):
    far = "Vorpel begins " + "common words " * 60 + "signed Vorpel once@example.com"
    rows = [(0, far), (1, "common words of vorpel alone"), *((i, "common words signed begins") for i in range(2, 4000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    want = {0: far.replace("Vorpel", "[NAME]").replace("once@example.com", "[EMAIL]"), 1: "common words of [WORD] alone"}
    assert got == dict(rows) | want
    report = sorted(map(tuple, pii.report(docs).collect()))
    monkeypatch.setattr(pii, "BROADCAST_TERMS", 0)
    assert got == {r.doc_id: r.text for r in pii.sanitise(docs).collect()} and report == sorted(map(tuple, pii.report(docs).collect()))
    assert [r[-1] for r in report[:2]] == [2, 1]
