"""The driver contract: entry smoke, query/oracle key consistency, and a
few queries against their SQL on the smallest tables."""

import duckdb

import __spark_entry__ as entry
from tabscore.sources.tables import TEST_TABLES

from .conftest import SF001


def test_entry_profile(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 11
    assert df.columns == ["Column_Name", "Data_Type", "Min_Value", "Max_Value", "Unique_Values_Count",
                          "Missing_Values_Count", "Mean_Value", "Std_Dev", "Sample_Values"]


def test_oracle_keys_are_queries():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)


def test_some_queries_match_sql(spark):
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    q, o = entry.queries(), entry.oracle_sql()
    for name in ["h2_clock_columns", "j3_stratified_split", "k11_average_precision", "d16_chi2_cramers_v"]:
        got = sorted(tuple(r) for r in q[name](spark, SF001).select(*sorted(q[name](spark, SF001).columns)).collect())
        res = con.execute(o[name])
        cols = [d[0] for d in res.description]
        rows = res.fetchall()
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        want = sorted(tuple(r[i] for i in order) for r in rows)
        assert got == want, name
