import random

import pytest
from pyspark.sql import functions as F

from quillstone.operators import chunks, sections
from quillstone.functions import text as T
from quillstone.plans import pipeline


def model_blocks(text):
    """Blocks with heading paths, by a stack."""
    out, stack, page, at = [], [], 1, 0
    for line in text.split("\n")[: -1 if text.endswith("\n") else None] if text else []:
        import re

        start, at = at, at + len(line) + 1
        if m := re.match(r"<!--\s*page\s+(\d+)\s*-->", line.strip()):
            page = int(m[1])
        elif m := re.match(r"^(#{1,4})\s+(.+)$", line):
            level = len(m[1])
            stack = [h for h in stack if h[0] < level] + [(level, m[2].strip())]
        elif line.strip():
            out.append((line.strip(), page, start, start + len(line), [h for _, h in stack if h]))
    return out


def model_chunks(blocks, least, most, overlap):
    count = lambda t: max(1, int(len(t.split()) / 0.75))
    out, texts, meta, path = [], [], [], []

    def flush():
        nonlocal texts, meta
        text = " ".join(texts).strip()
        out.append((path, meta[0][0], meta[0][1], meta[-1][2], count(text), text))
        words = text.split()
        texts, meta = [" ".join(words[-overlap:]) if len(words) > overlap else text], meta[-1:]

    for text, page, start, end, own in blocks:
        if own != path and texts and count(" ".join(texts)) >= least:
            flush()
        path = own
        texts.append(text)
        meta.append((page, start, end))
        if count(" ".join(texts)) >= most:
            flush()
    if texts:
        flush()
    return out


def random_document(rng):
    lines = []
    for _ in range(rng.randint(0, 40)):
        kind = rng.random()
        if kind < 0.2:
            lines.append("#" * rng.randint(1, 5) + f" Head {rng.randint(0, 5)}" + " " * rng.randint(0, 2))
        elif kind < 0.3:
            lines.append(f"  <!-- page {rng.randint(1, 9)} --> rest")
        elif kind < 0.4:
            lines.append(rng.choice(["", "   ", "\t"]))
        else:
            lines.append(" " * rng.randint(0, 2) + " ".join(f"w{rng.randint(0, 99)}" for _ in range(rng.choice([1, 5, 20, 60]))))
    return "\n".join(lines) + rng.choice(["", "\n"])


@pytest.fixture(scope="module")
def documents():
    rng = random.Random(8)
    return [random_document(rng) for _ in range(60)] + ["", "one", "\n", "# only a heading", "x " * 700, "y " * 700 + "\n# h\nz"]


def test_blocks(spark, documents):
    df = spark.createDataFrame(list(enumerate(documents)), "d int, text string")
    got = {}
    for r in sections.blocks(df, "d").orderBy("d", "n").collect():
        got.setdefault(r.d, []).append((r.block, r.page_no, r.char_start, r.char_end, r.section_path))
    assert got == {i: b for i, t in enumerate(documents) if (b := model_blocks(t))}


@pytest.mark.parametrize(("least", "most", "overlap"), [(20, 60, 10), (40, 90, 5), (chunks.LEAST, chunks.MOST, chunks.OVERLAP)])
def test_chunks(spark, documents, least, most, overlap):
    df = spark.createDataFrame(list(enumerate(documents)), "d int, text string")
    got = {}
    for r in chunks.chunk(df, "d", least=least, most=most, overlap=overlap).orderBy("d", "n").collect():
        got.setdefault(r.d, []).append((r.section_path, r.page_no, r.char_start, r.char_end, r.token_estimate, r.chunk_text))
    assert got == {i: c for i, t in enumerate(documents) if (c := model_chunks(model_blocks(t), least, most, overlap))}


def test_a_document_that_ends_full_repeats_its_tail(spark):
    df = spark.createDataFrame([(1, "w " * 700)], "d int, text string")
    got = chunks.chunk(df, "d").orderBy("n").collect()
    assert [r.token_estimate for r in got] == [933, 74] and got[1].chunk_text == " ".join(["w"] * 56)


def test_histogram_has_every_bin(spark):
    got = {r.bin: (r.n, r.share) for r in chunks.histogram(spark.createDataFrame([(399,), (400,), (800,), (801,)], "token_estimate int")).collect()}
    assert got == {"< 400": (1, 25.0), "400–600": (1, 25.0), "600–800": (1, 25.0), "> 800": (1, 25.0)}
    assert sum(r.n for r in chunks.histogram(spark.createDataFrame([], "token_estimate int")).collect()) == 0


def test_text_functions(spark):
    texts = ["b-c d1e", " x y\x1c ", "", "Straße 12", "one  two\nthree", "ÉCOLE d'été"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(T.title_case(F.col("t")).alias("title"), T.strip(F.col("t")).alias("strip"), T.count_tokens(F.col("t")).alias("n")).collect()
    assert [(r.title, r.strip, r.n) for r in got] == [(t.title(), t.strip(), max(1, int(len(t.split()) / 0.75))) for t in texts]


def test_markdown_and_pdf_cleaning(spark):
    md = "a  \n\n\n\nb\n [Home](/x) \n[a longer title that goes on and on and on and on and on and on x](/y)\nend  "
    row = spark.createDataFrame([(md, "ﬁne\t “ﬂow” it’s ")], "m string, p string").select(T.clean_markdown(F.col("m")).alias("m"), T.clean_pdf_text(F.col("p")).alias("p")).first()
    assert "Home" not in row.m and "longer" in row.m and "\n\n\n" not in row.m.split("b")[0] and row.m.endswith("end") and row.p == "fine \"flow\" it's"


def test_language(spark):
    df = spark.createDataFrame([("the cat and the dog are in the house of the king",), ("der Hund und die Katze sind nicht in dem Haus von",), ("kurz",)], "t string")
    assert [r[0] for r in df.select(T.detect_language(F.col("t"), "stop words")).collect()] == ["en", "de", "en"]
    assert {r[0] for r in df.select(T.detect_language(F.col("t"))).collect()} == {"en"}


def test_lines_end_like_splitlines(spark):
    text = "# H\rc\r\nfoo \x0bbar\x0c\n\n<!-- page 3 -->\x85x\u2028## G\u2029\x1cend\r"
    got = sections.lines(spark.createDataFrame([(1, text), (2, ""), (3, None), (4, "\n")], "k int, text string"), "k").orderBy("k", "n").collect()
    want, at = [], 0
    for raw in text.splitlines(keepends=True):
        want.append((raw.removesuffix("\n"), at, at + len(raw.removesuffix("\n"))))
        at += len(raw)
    assert [(r.line, r.char_start, r.char_end) for r in got if r.k == 1] == want
    assert [(r.k, r.line) for r in got if r.k > 1] == [(4, "")]
    blocks = {r.block: (r.page_no, r.section_path) for r in sections.blocks(spark.createDataFrame([(1, text)], "k int, text string"), "k").collect()}
    assert blocks == {"c": (1, ["H"]), "foo": (1, ["H"]), "bar": (1, ["H"]), "x": (3, ["H"]), "end": (3, ["H", "G"])}


def test_a_document_of_very_many_lines(spark):
    df = spark.createDataFrame([(1, "# Head\n" + "some words of a line\n" * 100_000)], "doc_id int, text string")
    assert sections.blocks(df, "doc_id").count() == 100_000
    own = chunks.chunk(df, "doc_id").orderBy("n").collect()
    assert sum(len(r.chunk_text.split()) for r in own) == 500_000 + 56 * (len(own) - 1)


def test_chunks_need_no_shuffle(spark):
    own = chunks.chunk(spark.createDataFrame([(1, "a b\nc")], "d int, text string").repartition(1), "d")
    assert own._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1  # the test's own


def test_records_of_one_text_have_its_chunks_each(spark):
    text = "# H\n" + "some words of a line\n" * 150
    docs = spark.createDataFrame([("u", "h", "T", text), ("v", "h", "T", text)], "url string, url_hash string, title string, text string")
    got = pipeline.chunk_documents(docs).collect()
    assert sorted((r.url, r.chunk_id, len(r.text.split())) for r in got) == [(u, f"h:{n:04d}", k) for u in "uv" for n, k in ((1, 675), (2, 131))]


def test_a_pass_over_a_text_gives_the_blocks_of_the_windows(spark):
    text = "# H\rc\r\nfoo \x0bbar\x0c\n\n <!-- page 3 -->\x85x\u2028## G\u2029\x1cend\r#### D\n##  \n# \u00a0\nlast \u3000"
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "k int, text string")
    want = [(r.block, r.page_no, r.char_start, r.char_end, r.section_path) for r in sections.blocks(df, "k").orderBy("k", "n").collect()]
    assert list(sections.blocks_of(text)) == want
