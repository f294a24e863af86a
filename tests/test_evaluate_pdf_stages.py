import json
import random

import pytest

from pyspark.sql import functions as F

from quillstone.operators import evaluate, pdf, summary
from quillstone.plans import pipeline
from quillstone.sources import files

LABELS = ["A", "B", "C"]


def random_spans(rng, n):
    out = []
    for _ in range(rng.randint(0, n)):
        s = rng.randint(0, 25)
        out.append((rng.choice(LABELS), f" x{rng.randint(0, 4)} ", s, s + rng.randint(1, 8)))
    return out


def test_counts_against_sequential_models(spark):
    rng = random.Random(3)
    pairs = [(sorted(random_spans(rng, 6), key=lambda e: (e[2], e[3], e[0])), random_spans(rng, 6)) for _ in range(120)]
    rows = lambda side: spark.createDataFrame([(k, i, *e) for k, p in enumerate(pairs) for i, e in enumerate(p[side])], "k int, ord int, label string, span_text string, start int, end int")
    pred, gold = rows(0), rows(1)
    strict = {x: [0, 0, 0] for x in LABELS}
    partial = {x: [0, 0, 0] for x in LABELS}
    for p, g in pairs:
        ps, gs = {(e[0], e[1].strip()) for e in p}, {(e[0], e[1].strip()) for e in g}
        for key in ps | gs:
            strict[key[0]][0 if key in ps & gs else 1 if key in ps else 2] += 1
        taken = set()
        for label, _, s, e in p:
            hit = next((i for i, o in enumerate(g) if i not in taken and o[0] == label and max(0, min(e, o[3]) - max(s, o[2])) / (o[3] - o[2]) >= 0.5), None)
            partial[label][1 if hit is None else 0] += 1
            taken |= {hit} - {None}
        for i, o in enumerate(g):
            partial[o[0]][2] += i not in taken
    get = lambda df: {r.label: [r.tp, r.fp, r.fn] for r in df.collect()}
    assert get(evaluate.strict_counts(pred, gold, "k")) == strict
    assert get(evaluate.partial_counts(pred, gold, "k")) == partial
    whole = {r.scope: r for r in evaluate.report(pred, gold, "k", "partial").collect()}
    tp, fp, fn = partial["A"]
    assert whole["A"].precision == round(tp / (tp + fp), 4) and whole["macro"].f1 == round(sum(whole[x].f1 for x in LABELS) / 3, 4)
    assert whole["micro"].recall == round(sum(v[0] for v in partial.values()) / sum(len(g) for _, g in pairs), 4)


def test_evaluation_of_nothing(spark):
    none = spark.createDataFrame([], "k int, label string, span_text string, start int, end int, ord int")
    assert {r.scope: (r.precision, r.f1) for r in evaluate.report(none, none, "k").collect()} == {"macro": (0.0, 0.0), "micro": (0.0, 0.0)}


SPAN = "doc_id long, page_no int, page_width double, block_no int, line_no int, span_no int, kind int, x0 double, y0 double, x1 double, y1 double, size double, text string"


def span(block, text, size=10.0, x=50.0, y=0.0, page=1, kind=0, line=0, no=0):
    return (1, page, 600.0, block, line, no, kind, float(x), float(y), x + 100.0, y + 12.0, size, text)


def test_pdf_pages(spark):
    rows = [
        span(0, "Title", 16.0, y=0), span(1, "first ", y=14), span(1, "part", y=14, no=1), span(2, "x", y=28), span(3, "ﬁgures far below", y=80), span(4, "Sub", 12.5, y=94), span(5, "picture", kind=1, y=95), span(6, "minor", 11.5, y=108),
        span(0, "left 2", x=0, y=50, page=2), span(1, "left 1", x=60, y=5, page=2), span(2, "right 2", x=310, y=60, page=2), span(3, "right 1", x=410, y=1, page=2), span(0, "image only", kind=1, page=3),
    ]
    (row,) = pdf.markdown(spark.createDataFrame(rows, SPAN)).collect()
    first = "\n<!-- page 1 -->\n\n\n# Title\n\nfirst part\n\nfigures far below\n\n## Sub\n\n\n### minor\n"
    assert row.text == first + "\n\n<!-- page 2 -->\n\nleft 1\n\nleft 2\nright 1\n\nright 2"


def test_modal_size_prefers_the_first_seen(spark):
    rows = [span(0, "a", 12.0), span(1, "b", 9.0), span(2, "c", 9.04), span(3, "d", 12.0), span(4, "e", 20.0)]
    assert [r.modal for r in pdf.modal_sizes(spark.createDataFrame(rows, SPAN)).collect()] == [12.0]
    ratios = spark.createDataFrame([(15.0,), (12.5,), (11.5,), (11.4,)], "s double").select(pdf.heading_level(F.col("s"), F.lit(10.0)).alias("l"), pdf.heading_level(F.col("s"), F.lit(0.0)).alias("z"))
    assert [(r.l, r.z) for r in ratios.collect()] == [(1, None), (2, None), (3, None), (None, None)]


def test_pdf_titles(spark):
    df = spark.createDataFrame([("  Meta ", "# H", "f"), ("", "x\n# Head one\ny", "f"), (None, "none", "a-file_name")], "m string, t string, s string")
    assert [r[0] for r in df.select(pdf.title(F.col("m"), F.col("t"), F.col("s"))).collect()] == ["Meta", "Head one", "A File Name"]


def test_stages_from_files_to_reports(spark, tmp_path):
    root = str(tmp_path)
    (tmp_path / "raw").mkdir()
    page = "<html><title>Duty</title><body><h1>Duty</h1><p>Under Section 5 of the Companies Act, 2013 the Reserve Bank of India fixed Rs. 500 on 2020-01-02. " + "word " * 60 + "</p></body></html>"
    (tmp_path / "raw" / "abc.html").write_text(page, encoding="utf-8")
    (tmp_path / "crawl_index").mkdir()
    index = [{"url": "https://s.org/duty", "status": 200, "content_type": "text/html", "used_js": False, "timestamp": "t", "path_to_raw": "data/raw/abc.html"}, {"url": "https://s.org/lost", "path_to_raw": "data/raw/none.html"}]
    (tmp_path / "crawl_index" / "part.json").write_text("\n".join(map(json.dumps, index)) + "\n\n", encoding="utf-8")
    text = "by Section 9 of 2020-01-02"
    (tmp_path / "gold").mkdir()
    (tmp_path / "gold" / "g.json").write_text(json.dumps({"text": text, "entities": [{"label": "SECTION_REF", "text": "Section 9", "start": 3, "end": 12}, {"label": "MONEY", "text": "zzz", "start": 0, "end": 2}]}), encoding="utf-8")
    (tmp_path / "raw" / "bad.html").write_bytes(b"<p>caf\xe9</p>")
    assert {r.html for r in files.read_html(spark, f"{root}/raw").collect()} >= {"<p>caf\ufffd</p>"}
    with pytest.raises(SystemExit):
        pipeline.main([root, "nothing"])
    assert pipeline.main([root, "--skip-crawl"]) == {"parse": 1, "chunk": 1, "annotate": 1, "evaluate": 1}
    (chunk,) = files.read_jsonl(spark, f"{root}/chunks", "chunks").collect()
    assert chunk.chunk_id.endswith(":0001") and chunk.section_path == ["Duty"] and chunk.title == "Duty"
    (entities,) = files.read_jsonl(spark, f"{root}/annotations", "annotations").collect()
    assert [e.label for e in entities.entities] == ["SECTION_REF", "ACT_NAME", "ORG", "MONEY", "DATE"]
    report = json.loads("".join(r.value for r in spark.read.text(f"{root}/evaluation_report").collect()))
    assert report["strict"]["per_label"]["SECTION_REF"]["tp"] == 1 and report["partial"]["per_label"]["MONEY"]["fn"] == 1 and report["strict"]["per_label"]["DATE"]["fp"] == 1
    assert [report["strict"][k] for k in ("mode", "total_gold", "total_pred", "total_tp")] == ["strict", 2, 2, 1] and list(report["strict"]["per_label"]) == ["DATE", "MONEY", "SECTION_REF"]
    assert report["strict"]["micro"] == {"precision": 0.5, "recall": 0.5, "f1": 0.5}
    page = pipeline.summary_stage(spark, root)
    assert "<h2>Chunks</h2>" in page and "400–600" in page
    assert files.read_jsonl(spark, f"{root}/nowhere", "chunks", tolerant=True).count() == 0


def test_crawl_and_both_branches_of_parse(spark, tmp_path):
    root = str(tmp_path)
    page = "<html><title>{0}</title><body><h1>{0}</h1><p>" + "Under Section 5 of the Companies Act, 2013. " * 4 + "</p>{1}</body></html>"
    body = lambda name, links="": page.format(name, links).encode()
    empty = "<html><body>" + "<script></script>" * 5 + "</body></html>"
    site = [
        ("https://s.org", 200, "text/html", body("Home", "<a href='/b'>b</a><a href='/file.pdf'>f</a><a href='/no/x'>x</a><a href='/js'>j</a><a href='/dl'>d</a><a href='/short'>s</a>"), None),
        ("https://s.org/b", 404, "text/html", body("B"), None), ("https://s.org/file.pdf", 200, "application/pdf", b"%PDF", None), ("https://s.org/no/x", 200, "text/html", body("X"), None),
        ("https://s.org/js", 200, "text/html", empty.encode(), body("Rendered").decode()), ("https://s.org/dl", 200, "application/pdf", b"%PDF", None), ("https://s.org/short", 200, "text/html", b"<p>x</p>", None),
    ]
    spark.createDataFrame(site, "url string, status int, content_type string, content binary, rendered string").write.parquet(f"{root}/site")
    spark.createDataFrame([("https://s.org", 0, "*", 0, "/no", False)], "base string, entry int, agent string, ord int, path_prefix string, allow boolean").write.parquet(f"{root}/robots")
    (tmp_path / "seeds.json").write_text('{"home": "https://s.org/"}')
    assert pipeline.crawl_stage(spark, root) == 5
    index = {r.url: r for r in files.read_jsonl(spark, f"{root}/crawl_index", "crawl_index").collect()}
    assert set(index) == {"https://s.org", "https://s.org/file.pdf", "https://s.org/js", "https://s.org/dl", "https://s.org/short"}
    assert [u for u, r in index.items() if r.used_js] == ["https://s.org/js"] and index["https://s.org/dl"].path_to_raw.endswith(".pdf")
    raw = {r.path: bytes(r.content) for r in files.read_raw(spark, f"{root}/raw").collect()}
    assert raw[index["https://s.org/js"].path_to_raw] == body("Rendered") and raw[index["https://s.org/dl"].path_to_raw] == b"%PDF"
    rows = []
    for n in (1, 2):  # the second PDF has no spans: nothing could be read
        for block, (size, text) in enumerate([(20.0, "Order")] if n == 1 else []):
            rows.append((index["https://s.org/file.pdf"].path_to_raw, None, 1, 600.0, block, 0, 0, 0, 10.0, 10.0, 90.0, 30.0, size, text))
        rows += [(index["https://s.org/file.pdf"].path_to_raw, None, n, 600.0, 5 + i, 0, 0, 0, 10.0, 60.0 + i * 20, 90.0, 70.0 + i * 20, 10.0, f"words of page {n} and Section {n}{i} of it") for i in range(4)]
    schema = "path string, title string, page_no int, page_width double, block_no long, line_no int, span_no int, kind int, x0 double, y0 double, x1 double, y1 double, size double, text string"
    spark.createDataFrame(rows, schema).write.parquet(f"{root}/pdf_spans")
    assert pipeline.main([root, "parse", "chunk", "annotate"]) == {"parse": 3, "chunk": 3, "annotate": 3}
    docs = {r.url: r for r in files.read_jsonl(spark, f"{root}/normalized_index", "normalized_index").collect()}
    assert {u: (r.source_type, r.title) for u, r in docs.items()} == {"https://s.org": ("html", "Home"), "https://s.org/js": ("html", "Rendered"), "https://s.org/file.pdf": ("pdf", "Order")}
    assert all(r.path_to_text == f"normalized/{r.url_hash}.md" and r.url_hash in index[u].path_to_raw for u, r in docs.items())
    (own,) = [r for r in files.read_jsonl(spark, f"{root}/chunks", "chunks").collect() if r.url.endswith("file.pdf")]
    assert own.page_no == 1 and own.section_path == ["Order"] and "page 2 and Section 23" in own.text


def test_crawl_parses_only_pages_it_reaches(spark, tmp_path, monkeypatch):
    root, parsed, links = str(tmp_path), [], pipeline.html.links
    to = {0: "<a href='/1'>1</a><a href='/2'>2</a>", 1: "<a href='/3'>3</a>", 50: "<a href='/51'>51</a>"}
    site = [(f"https://s.org/{i}", 200, "text/html", f"<p>{to.get(i, '')}</p>".encode(), None) for i in range(100)]
    spark.createDataFrame(site, "url string, status int, content_type string, content binary, rendered string").write.parquet(f"{root}/site")
    (tmp_path / "seeds.json").write_text('{"home": "https://s.org/0"}')

    def recorded(pages):
        parsed.append({r.url for r in pages.collect()})
        return links(pages)

    monkeypatch.setattr(pipeline.html, "links", recorded)
    assert pipeline.crawl_stage(spark, root) == 4
    assert parsed == [{"https://s.org/0"}, {"https://s.org/1", "https://s.org/2"}, {"https://s.org/3"}]


def test_seeds_keep_their_order(spark, tmp_path):
    (tmp_path / "seeds.json").write_text('{"b": "https://b", "a": "https://a"}')
    assert [(r.name, r.url) for r in files.read_seeds(spark, str(tmp_path / "seeds.json")).orderBy("ord").collect()] == [("b", "https://b"), ("a", "https://a")]


def test_summaries(spark):
    index = spark.createDataFrame([("u", 200, "t", True, "s", "a.html"), ("v", 200, "t", False, "s", "b.pdf"), ("w", 200, "t", None, "s", None)], files.SCHEMAS["crawl_index"])
    assert tuple(summary.composition(index).first()) == (3, 1, 1, 1, 0)
    colors = spark.createDataFrame([(0.7,), (0.4,), (0.39,), (2.0,)], "v double").select(summary.bar_color(F.col("v")))
    assert [r[0] for r in colors.collect()] == ["#22c55e", "#f59e0b", "#ef4444", "#22c55e"]
