import glob
import os

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
QUICK = ["clean_text", "font_styles", "figure_labels", "document_stats", "classify_adaptive", "label_to_page", "article_ranges", "toc_entries", "reading_order", "upserted_chunks", "caption_windows", "flags_by_issue", "vector_topk"]


def plain(v):
    if v is None or isinstance(v, float) and v != v:
        return "None"
    return str(round(v, 6) + 0.0) if isinstance(v, float) else str(v)


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 60


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", QUICK)
def test_same_rows_as_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for p in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    rel = con.sql(entry.oracle_sql()[name])
    cols = sorted(rel.columns)
    want = sorted(tuple(plain(r[rel.columns.index(c)]) for c in cols) for r in rel.fetchall())
    df = entry.queries()[name](spark, FOLDER)
    assert sorted(df.columns) == cols
    assert sorted(tuple(plain(r[c]) for c in cols) for r in df.collect()) == want


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert rows and all(r.prompt.endswith(r.prompt.split("Question: ")[-1]) and r.est_tokens > 0 for r in rows)
