import pathlib

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry
from quillstone.plans import queries

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def database(folder):
    con = duckdb.connect()
    for p in pathlib.Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.fixture(scope="module")
def db():
    return {folder: database(folder) for folder in (SF, LARGER)}


def plain(v):
    return None if pd.isna(v) else round(float(v), 6) if isinstance(v, (int, float, np.number)) and not isinstance(v, bool) else str(v)


#: One line of the smallest table is there twice, and SQL over sentence ids counts its pair of spans four times; these use the larger one.
DOUBLED = {"annotations", "annotations_file", "eval_partial", "gold_file", "report_file"}


@pytest.mark.parametrize("name", queries.SQL)
def test_queries_match_their_sql(spark, db, name):
    folder = LARGER if name in DOUBLED else SF
    got = queries.QUERIES[name](spark, folder).toPandas()
    want = db[folder].execute(queries.SQL[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = lambda df: sorted(str([plain(v) for v in r]) for r in df[columns].itertuples(index=False))
    assert rows(got) == rows(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(queries.QUERIES) <= set(entry.queries())


def test_each_page_of_a_repeated_url_is_a_document(spark, tmp_path):
    page = "<html><title>{0}</title><body><h1>{0}</h1><p>" + "words of a page " * 9 + "</p></body></html>"
    urls = [f"https://a.org/{x}" for x in "xxyxx"]
    pd.DataFrame({"page_id": [0, 1, 2, 3, 3], "url": urls, "html": [page.format(t) for t in ("First", "Second", "Other", "Third", "Third")]}).to_parquet(tmp_path / "pages.parquet")
    got = queries.QUERIES["normalized_index"](spark, str(tmp_path)).toPandas()
    want = database(tmp_path).execute(queries.SQL["normalized_index"]).df()
    rows = lambda df: sorted(map(tuple, df[sorted(df.columns)].values))
    assert rows(got) == rows(want) and set(got.title) == {"First", "Second", "Other", "Third"}
