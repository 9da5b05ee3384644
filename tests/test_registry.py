"""The driver's contract, and each query against its SQL in DuckDB on the smallest data."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in Path(DATA).glob("*.parquet"):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return ""
    return repr(round(float(v), 6)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    got = entry.queries()[name](spark, DATA)
    want = duck.sql(entry.oracle_sql()[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    order = [want.columns.index(c) for c in cols]
    a = sorted(tuple(plain(r[c]) for c in cols) for r in got.collect())
    b = sorted(tuple(plain(r[i]) for i in order) for r in want.fetchall())
    assert a == b


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_rows_only_queries(spark):
    assert entry.queries()["paragraphs_split_model"](spark, DATA).count() > 0
    assert entry.queries()["result_tree_json"](spark, DATA).count() > 0


def test_table_run_filter_sees_whole_lines(spark, tmp_path):
    texts = ["a line of prose first\n" * 3 + "\n".join(f"name of the row {i}  first  second" for i in range(3)) + "\nthe last line of prose"]
    spark.createDataFrame([(1, "s", t) for t in texts], "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [r.line for r in entry.queries()["table_run_filter_whole"](spark, str(tmp_path)).orderBy("line_no").collect()]
    assert got == ["the last line of prose"]
