"""Roles (B1, B2, C1, C2, D12, L1) — the reference's own spec tests — and the
profile (D7) against DuckDB's naive per-column form."""

import duckdb
import pytest

from tabscore.operators import profile as prof
from tabscore.operators import roles as rl
from tabscore.plans import fixtures as fx

from .conftest import SF001


def test_cardinality_split(spark):
    df = spark.createDataFrame([("a", "x", "p"), ("b", "y", "p"), ("a", "z", "p"), ("b", "w", "p")],
                               "col1 string, col2 string, col3 string")
    hot, cat = prof.split_by_cardinality(df, ["col1", "col2", "col3"], 2)
    assert "col1" in hot and "col3" in hot and "col2" in cat


def test_role_map_keys(spark):
    p = prof.profile(fx.wide(spark, SF001), skip=fx.WIDE_PROFILE_SKIP, keep_ordinal=True)
    rt = rl.assign_roles(p, fx.WIDE_ROLES, fx.WIDE_SKIP_REASONS, fx.WIDE_LEAKAGE)
    m = rl.role_map(rt, order_col="ordinal")
    for key in ["num", "cat", "hot", "tgt", "dat"]:
        assert key in m
    # later role wins: l_linenumber is listed as num and hot
    roles = {r["Column_Name"]: r["Role"] for r in rt.collect()}
    assert roles["l_linenumber"] == "hot" and roles["l_tax"] == "num" and roles["returned"] == "tgt"
    assert rl.target_column(rt, order_col="ordinal") == "returned"


def test_drop_skipped(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    out, kept = rl.drop_skipped(df, ["b", "not_there"], {"num": ["a", "b"], "cat": ["c"]})
    assert "b" not in kept["num"] and kept["cat"] == ["c"] and out.columns == ["a", "c"]


def test_pipeline_shape():
    from tabscore.operators import model
    two = model.build_pipeline(model.classifier(), model.preprocessor(["feature1"]))
    assert "preprocessor" in two.named_steps and "classifier" in two.named_steps


def test_schema_from_roles(spark):
    p = prof.profile(fx.wide(spark, SF001), skip=fx.WIDE_PROFILE_SKIP, keep_ordinal=True)
    rt = rl.assign_roles(p, fx.WIDE_ROLES, fx.WIDE_SKIP_REASONS, fx.WIDE_LEAKAGE)
    num = rl.columns_by_role(rt, "num", fx.WIDE_SKIP_ADDITIONAL, order_col="ordinal")
    schema = rl.struct_from_fields(rl.schema_fields(rt, rl.role_mapping(rt, num + ["returned"])))
    assert [(f.name, f.dataType.simpleString()) for f in schema.fields] == [
        ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double")]


def _duck(sql):
    con = duckdb.connect()
    for t in ("lineitem", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con.execute(sql).fetchall()


@pytest.mark.parametrize("table,kinds", [("lineitem", fx.LINEITEM_KINDS), ("orders", fx.ORDERS_KINDS)])
def test_profile_equals_naive_sql(spark, table, kinds):
    got = prof.profile(spark.read.parquet(f"{SF001}/{table}.parquet"), digits=6).collect()
    want = _duck(fx.profile_sql(table, kinds))
    assert sorted(tuple(r) for r in got) == sorted(tuple(r) for r in want)


def test_profile_edge_columns(spark):
    df = spark.createDataFrame(
        [(None, 1.0, "", float("nan"), 1), (None, 1.0, "x", -0.0, 2), (None, 1.0, None, 0.0, 3)],
        "all_null double, const double, s string, odd double, `__index_level_0__` long")
    rows = {r["Column_Name"]: r for r in prof.profile(df, skip=["__index_level_0__ "]).collect()}
    assert "__index_level_0__" not in rows
    assert rows["all_null"]["Unique_Values_Count"] == 0 and rows["all_null"]["Missing_Values_Count"] == 3
    assert rows["const"]["Std_Dev"] == 0.0 and rows["const"]["Sample_Values"] == "1"
    assert rows["s"]["Unique_Values_Count"] == 2 and rows["s"]["Min_Value"] == ""
    # -0.0 and 0.0 are one value; NaN is a value of its own
    assert rows["odd"]["Unique_Values_Count"] == 2


def test_profile_approx_counts_close(spark):
    df = spark.read.parquet(f"{SF001}/lineitem.parquet")
    exact = {r["Column_Name"]: r["Unique_Values_Count"] for r in prof.profile(df).collect()}
    approx = {r["Column_Name"]: r["Unique_Values_Count"] for r in prof.profile(df, approx=True).collect()}
    for c, n in exact.items():
        assert abs(approx[c] - n) <= max(2, 0.03 * n)


def test_profile_approx_exact_fields_equal(spark):
    """approx=True changes only the distinct counts: min/max, missing,
    mean, std and the sample strings equal the exact profile."""
    from tabscore.plans import fixtures as fx
    df = fx.wide(spark, SF001)
    ex = {r["Column_Name"]: r.asDict() for r in prof.profile(df, digits=6).collect()}
    ap = {r["Column_Name"]: r.asDict() for r in prof.profile(df, digits=6, approx=True).collect()}
    assert ex.keys() == ap.keys()
    for c in ex:
        ex[c].pop("Unique_Values_Count"), ap[c].pop("Unique_Values_Count")
        assert ap[c] == ex[c], c


def test_merged_states_equal_the_whole_profile(spark, tmp_path):
    """Parts profiled alone and merged give the profile of all rows: exact fields as the exact profile, distinct counts as the approximate one."""
    from decimal import Decimal

    from pyspark.sql import functions as F
    rows = [(2020 + i % 3, i % 7 if i % 5 else None, float(i % 11) / 4 if i % 4 else None, f"v{i % 900:04d}", Decimal(i % 13) / 10, i % 2 == 0, None) for i in range(3000)]
    df = spark.createDataFrame(rows, "year int, a long, b double, s string, d decimal(5,1), f boolean, nothing string")
    path = str(tmp_path / "states")
    prof.profile_states(df, "year").write.partitionBy("year").parquet(path)
    grown = df.unionByName(df.where("year = 2021").withColumns({"a": F.lit(99).cast("long"), "s": F.lit("zz")}))
    prof.profile_states(grown.where("year = 2021"), "year").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)
    fields = [f for f in df.schema.fields if f.name != "year"]
    got = prof.merge_states(spark.read.parquet(path), fields, digits=9).collect()
    flat = grown.drop("year")
    exact, approx = (prof.profile(flat, digits=9, approx=x).collect() for x in (False, True))
    keep = [c for c in prof.PROFILE_SCHEMA.names if c != "Unique_Values_Count"]
    assert [[r[c] for c in keep] for r in got] == [[r[c] for c in keep] for r in exact] == [[r[c] for c in keep] for r in approx]
    assert [r.Unique_Values_Count for r in got] == [r.Unique_Values_Count for r in approx]
    assert all(abs(g.Unique_Values_Count - e.Unique_Values_Count) <= 0.03 * e.Unique_Values_Count for g, e in zip(got, exact))


def test_every_footer_is_checked(spark, tmp_path):
    """One file with another type, one without a column, one with a further column: the diff names each."""
    from tabscore.sources import tables as tb
    base = str(tmp_path)
    good = spark.range(5).selectExpr("id", "cast(id as double) x")
    good.coalesce(1).write.parquet(f"{base}/2019.parquet")
    good.coalesce(1).write.parquet(f"{base}/2020.parquet")
    assert tb.scan_files(spark, [f"{base}/*.parquet"], expected=good.schema).count() == 10
    spark.range(5).selectExpr("id", "cast(id as string) x").coalesce(1).write.parquet(f"{base}/2021.parquet")
    spark.range(5).selectExpr("id").coalesce(1).write.parquet(f"{base}/2022.parquet")
    good.selectExpr("*", "1 AS more").coalesce(1).write.parquet(f"{base}/2023.parquet")
    with pytest.raises(ValueError, match="schema mismatch") as e:
        tb.scan_files(spark, [f"{base}/*.parquet"], expected=good.schema)
    said = str(e.value)
    assert "changed x (expected double, found string)" in said and "missing x" in said and "extra more" in said
    assert "2021.parquet" in said and "2022.parquet" in said and "2023.parquet" in said and "2019.parquet" not in said


def test_profile_of_every_kind_of_column(spark):
    """Times, dates, decimals and booleans travel in slots of their own and come out as text; text ends come with the distinct values."""
    rows = [("b", "2020-01-02 03:04:05", 1.5, True, 0.0), ("a", "2019-05-06 00:00:00", 2.25, False, -0.0), (None, None, None, None, float("nan")), ("a", "2019-05-06 00:00:00", 1.5, True, 1.0)]
    df = spark.createDataFrame(rows, "s string, at string, n double, b boolean, x double").selectExpr(
        "s", "cast(at as timestamp) as t", "cast(at as timestamp_ntz) as z", "cast(at as date) as y", "cast(n as decimal(6,2)) as n", "b", "x", "cast(null as string) as none")
    got = {r["Column_Name"]: r for r in prof.profile(df).collect()}
    at = "2019-05-06 00:00:00+00, 2020-01-02 03:04:05+00"
    assert {c: got[c]["Sample_Values"] for c in got} == {"s": "a, b", "t": at, "z": at, "y": "2019-05-06, 2020-01-02", "n": "1.50, 2.25", "b": "false, true", "x": "0, 1, NaN", "none": None}
    assert {c: got[c]["Unique_Values_Count"] for c in got} == {"s": 2, "t": 2, "z": 2, "y": 2, "n": 2, "b": 2, "x": 3, "none": 0}
    assert [(got[c]["Min_Value"], got[c]["Max_Value"]) for c in ("s", "z", "y", "none")] == [
        ("a", "b"), ("2019-05-06 00:00:00+00", "2020-01-02 03:04:05+00"), ("2019-05-06", "2020-01-02"), (None, None)]
