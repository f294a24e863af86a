import json

from quillstone.functions import sql
from quillstone.operators import spans
from quillstone.streaming import annotate

TEXTS = ["Section 5 of the Companies Act, 2013", "plain", "by the Reserve Bank of India for Rs. 7 on 2020-01-01"]


def write(folder, name, first):
    folder.mkdir(exist_ok=True)
    rows = [{"chunk_id": f"{name}:{i}", "url": "u", "title": "t", "section_path": [], "page_no": 1, "char_start": 0, "char_end": 1, "token_estimate": 1, "text": t} for i, t in enumerate(TEXTS[first:])]
    (folder / f"{name}.json").write_text("\n".join(map(json.dumps, rows)))


def test_files_are_annotated_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / x) for x in ("in", "out", "state"))
    for name, first in (("a", 0), ("b", 1)):
        write(tmp_path / "in", name, first)
        annotate.run(spark, source, target, checkpoint).awaitTermination()
    got = {r.chunk_id: [e.label for e in r.entities] for r in spark.read.schema("chunk_id string, entities array<struct<label:string>>").json(target).collect()}
    assert got == {"a:0": ["SECTION_REF", "ACT_NAME"], "a:1": [], "a:2": ["ORG", "MONEY", "DATE"], "b:0": [], "b:1": ["ORG", "MONEY", "DATE"]}


def test_pages_come_once(spark, tmp_path):
    (tmp_path / "p").mkdir()
    rows = [{"url": u, "timestamp": f"2024-01-01T0{i}:00:00+00:00"} for i, u in enumerate(["x", "y", "x"])]
    (tmp_path / "p" / "1.json").write_text("\n".join(map(json.dumps, rows)))
    pages = annotate.fresh_pages(spark.readStream.schema("url string, timestamp string").json(str(tmp_path / "p")))
    query = pages.writeStream.format("memory").queryName("fresh").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.url for r in spark.table("fresh").collect()) == ["x", "y"]


def test_the_table_function_agrees(spark):
    sql.register(spark)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "sid int, text string")
    df.createOrReplaceTempView("texts")
    got = {tuple(r) for r in spark.sql("SELECT * FROM extract_spans(TABLE(SELECT sid, text FROM texts))").collect()}
    want = {(str(r.sid), r.label, r.span_text, r.start, r.end) for r in spans.entities(spans.annotate(df, "sid"), "sid").collect()}
    assert got == want and len(got) == 5
