"""Each registered query of the library against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from mergewell.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')")
    return con


def plain(df):
    df = df[sorted(df.columns)]
    text = lambda v: "" if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA else (f"{v:.9g}" if isinstance(v, float) else str(v))
    return sorted(tuple(text(v) for v in r) for r in df.astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, duck, name):
    got = catalogue.queries()[name](spark, SF).toPandas()
    if name in catalogue.oracle_sql():
        want = duck.execute(catalogue.oracle_sql()[name]).df()
        assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
        strip = lambda rows: [tuple(v[:-2] if v.endswith(".0") else v for v in r) for r in rows]
        assert strip(plain(got)) == strip(plain(want))


def test_entry(spark):
    assert set(entry.entry(spark).columns) == {"left_id", "right_id", "blocking_key", "score", "priority"}
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_allowed_domains_has_no_cap(spark, tmp_path):
    urls = [f"https://WWW.h{i}.example.com/p" for i in range(10_050)] + ["http://www.example.com", "http://api.a.example.com/", "http://www.a.example.org/"]
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    got = catalogue.queries()["allowed_domains"](spark, str(tmp_path)).toPandas()
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert plain(got) == plain(con.execute(catalogue.oracle_sql()["allowed_domains"]).df()) and got.allowed.sum() == 10_051


def test_scores_are_rounded_once(spark, tmp_path):
    """Rounded to four places first, the score of this pair would end one higher than its SQL says."""
    parts = [(13476, 'new widget', 'Brand#23', 'STANDARD', 45), (24987, 'cold widget', 'Brand#23', 'STANDARD', 45), (37602, 'cold widget', 'Brand#8', 'SMALL', 7), (53541, 'cold plate', 'Brand#8', 'SMALL', 7)]
    columns = "p_partkey long, p_name string, p_brand string, p_type string, p_size int"
    spark.createDataFrame(parts, columns).write.parquet(f"{tmp_path}/part.parquet")
    got = catalogue.queries()["candidate_edges"](spark, str(tmp_path)).toPandas()
    con = duckdb.connect()
    con.execute(f"create view part as select * from read_parquet('{tmp_path}/part.parquet/*.parquet')")
    assert plain(got) == plain(con.execute(catalogue.oracle_sql()["candidate_edges"]).df()) and len(got) == 2
