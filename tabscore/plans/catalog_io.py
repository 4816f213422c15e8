"""Registered queries, part 3: scans, loads and sinks.

Each query writes what it needs into a fresh folder under the shared
checkpoint folder (``session.work_path``) and reads it back, so the check is
on what a reader of the written data sees.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tabscore.operators import profile as prof
from tabscore.operators import roles as rl
from tabscore.operators import sampling as smp
from tabscore.operators.runs import RUN_METRICS_SCHEMA, append_metric
from tabscore.plans import fixtures as fx
from tabscore.plans import stored
from tabscore.plans.catalog import ORACLE, register
from tabscore.session import work_path
from tabscore.sources import tables as tb

ORDERS_YEAR_SQL = "SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders"


def _table_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def _orders_year(spark, sf):
    return tb.read_table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))


def _yearly_files(spark, sf) -> str:
    base = work_path(spark, "orders_by_year")
    tb.write_yearly_files(tb.read_table(spark, sf, "orders"), "o_orderdate", base)
    return base


@register("a1_multi_file_scan", ORDERS_YEAR_SQL)
def a1_multi_file_scan(spark, sf):
    base = _yearly_files(spark, sf)
    df = tb.scan_files(spark, [f"{base}/year=*/*.parquet"], year_pattern=r"year=(\d{4})")
    return df.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                     "o_orderpriority", "year")


@register("a1_scan_nan", """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) AS n, count_if(o_orderkey % 7 <> 0) AS n_price,
MAX(CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END) AS top FROM orders GROUP BY 1""")
def a1_scan_nan(spark, sf):
    """Files with NaN prices: the scan yields NULL, so counts and maxima are of numbers only."""
    o = tb.read_table(spark, sf, "orders")
    base = work_path(spark, "a1_nan")
    price = F.when(F.col("o_orderkey") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice"))
    tb.write_yearly_files(o.withColumn("o_totalprice", price), "o_orderdate", base)
    df = tb.scan_files(spark, [f"{base}/year=*/*.parquet"], year_pattern=r"year=(\d{4})")
    return df.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.count("o_totalprice").alias("n_price"), F.max("o_totalprice").alias("top"))


@register("a2_schema_check", "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) AS n FROM orders GROUP BY 1")
def a2_schema_check(spark, sf):
    base = _yearly_files(spark, sf)
    expected = tb.read_table(spark, sf, "orders").schema
    df = tb.scan_files(spark, [f"{base}/year=*/*.parquet"], year_pattern=r"year=(\d{4})", expected=expected)
    return df.groupBy("year").agg(F.count(F.lit(1)).alias("n"))


@register("a2_file_footers", " UNION ALL ".join(f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, '{c}' AS column_name, '{t}' AS data_type, COUNT(*) AS n_rows
FROM orders GROUP BY 1""" for c, t in (("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
                                       ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"))))
def a2_file_footers(spark, sf):
    """Every footer of the yearly files: columns, types and rows."""
    found = tb.footers(spark, [f"{_yearly_files(spark, sf)}/year=*/*.parquet"])
    year = F.regexp_extract("file", r"year=(\d{4})", 1).cast("int").alias("year")
    return found.groupBy(year, "column_name", "data_type").agg(F.sum("n_rows").alias("n_rows"))


def _released(spark, table: str, path: str, columns):
    """The rows of an external table, whose catalog entry is dropped: readers
    of the result read its files."""
    rows = spark.read.parquet(path).select(*columns)
    spark.sql(f"DROP TABLE {table}")
    return rows


@register("a3_full_refresh", ORDERS_YEAR_SQL)
def a3_full_refresh(spark, sf):
    t, path = _table_name("orders_load"), work_path(spark, "a3")
    o = _orders_year(spark, sf)
    tb.load_full_refresh(o, t, ["year"], path=path)
    # One-year refresh with the same rows: dynamic overwrite keeps it idempotent.
    tb.load_full_refresh(o.where(F.col("year") == 1996), t, ["year"], dynamic=True, path=path)
    if spark.table(t).count() != o.count():
        raise AssertionError("the refreshed table does not hold the rows")
    return _released(spark, t, path, o.columns)


@register("a4_create_or_replace", ORDERS_YEAR_SQL)
def a4_create_or_replace(spark, sf):
    t, path = _table_name("orders_all"), work_path(spark, "a4")
    o = _orders_year(spark, sf)
    base = _yearly_files(spark, sf)
    years = sorted(r.year for r in spark.read.parquet(base).select("year").distinct().collect())
    raw = tb.read_table(spark, sf, "orders").schema
    parts = [spark.read.schema(raw).parquet(f"{base}/year={y}").withColumn("year", F.lit(y)) for y in years]
    tb.create_or_replace(tb.union_all(parts[:3]), t, path)
    tb.create_or_replace(tb.union_all(parts), t, path + "_v2")
    return _released(spark, t, path + "_v2", o.columns)


@register("a5_create_strict", ORDERS_YEAR_SQL)
def a5_create_strict(spark, sf):
    t, path = _table_name("orders_copy"), work_path(spark, "a5")
    out = tb.create_strict(_orders_year(spark, sf), t, path)
    try:
        tb.create_strict(_orders_year(spark, sf), t, path + "_again")
    except Exception:  # noqa: BLE001 - the second create must fail
        pass
    else:
        raise AssertionError("strict create replaced an existing table")
    return _released(spark, t, path, out.columns)


@register("a6_column_scan", "SELECT o_orderkey AS __index_level_0__, o_totalprice AS \"total price\" FROM orders")
def a6_column_scan(spark, sf):
    o = tb.read_table(spark, sf, "orders").withColumnRenamed("o_orderkey", "__index_level_0__") \
        .withColumnRenamed("o_totalprice", "total price")
    return tb.select_columns(o, ["__index_level_0__", "total price"])


@register("a7_csv_read", "SELECT * FROM customer")
def a7_csv_read(spark, sf):
    c = tb.read_table(spark, sf, "customer")
    path = work_path(spark, "a7")
    tb.write_csv(c, path)
    return tb.read_csv(spark, path, c.schema)


@register("a8_csv_write", fx.profile_sql("orders", fx.ORDERS_KINDS))
def a8_csv_write(spark, sf):
    p = prof.profile(tb.read_table(spark, sf, "orders"), digits=6)
    path = work_path(spark, "a8")
    tb.write_csv(p, path, single_file=True)
    return tb.read_csv(spark, path, prof.PROFILE_SCHEMA)


@register("a9_rows_per_file", ORACLE["f5_first_per_class"])
def a9_rows_per_file(spark, sf):
    rows = smp.first_per_class(tb.read_table(spark, sf, "orders"), "o_orderpriority", 5, ["o_orderkey"]) \
        .select("o_orderkey", "o_orderpriority")
    path = work_path(spark, "a9")
    tb.export_rows(rows, "o_orderpriority", path)
    back = spark.read.option("header", True).schema("o_orderkey long").csv(path)
    back = back.withColumn("_file", F.col("_metadata.file_path"))
    per_file = back.groupBy("_file").count()
    if per_file.where(F.col("count") != 1).count():
        raise AssertionError("a file holds more than one row")
    return back.select("o_orderkey", F.col("o_orderpriority"))


@register("a10_json_artifact", ORACLE["k16_role_mapping"])
def a10_json_artifact(spark, sf):
    num, tgt, rt = stored.feature_names(spark, sf)
    m = rl.role_mapping(rt, num + [tgt])
    path = work_path(spark, "a10")
    tb.write_json(m, path, single_file=True)
    return tb.read_json(spark, path, "ordinal int, `column` string, role string")


@register("a11_append_metrics", f"SELECT * FROM {fx.RUN_METRICS_SQL}")
def a11_append_metrics(spark, sf):
    t, path = _table_name("run_metrics"), work_path(spark, "a11")
    m = fx.run_metrics(spark, sf).withColumn("_part", F.pmod(F.hash("pipeline_uri"), F.lit(2)))
    append_metric(m.where(F.col("_part") == 0), t, path)
    append_metric(m.where(F.col("_part") == 1), t, path)
    return _released(spark, t, path, [f.name for f in RUN_METRICS_SCHEMA.fields])


_TYPE_CASE = ("CASE WHEN data_type IN ('BIGINT', 'INTEGER', 'SMALLINT', 'TINYINT') THEN 'INTEGER' "
              "WHEN data_type IN ('DOUBLE', 'FLOAT') THEN 'FLOAT' WHEN data_type = 'VARCHAR' THEN 'STRING' "
              "WHEN data_type = 'BOOLEAN' THEN 'BOOLEAN' WHEN data_type LIKE 'TIMESTAMP%' THEN 'TIMESTAMP' "
              "ELSE data_type END")


@register("a12_catalog_schema", f"""SELECT CAST(ordinal_position - 1 AS INTEGER) AS ordinal, column_name,
{_TYPE_CASE} AS data_type FROM information_schema.columns WHERE table_name = 'lineitem'""")
def a12_catalog_schema(spark, sf):
    return tb.schema_table(tb.read_table(spark, sf, "lineitem"))


@register("a13_json_records", "SELECT * FROM orders")
def a13_json_records(spark, sf):
    o = tb.read_table(spark, sf, "orders")
    path = work_path(spark, "a13")
    o.select(F.to_json(F.struct(*o.columns)).alias("value")).write.mode("overwrite").text(path)
    return tb.read_json(spark, path, o.schema)


@register("a14_prediction_sink", f"""SELECT o_orderkey, o_orderstatus, score, CAST(score >= 0.5 AS INTEGER) AS prediction, sink
FROM {fx.ORDERS_SQL}, (VALUES ('parquet'), ('csv'), ('json')) t(sink)""")
def a14_prediction_sink(spark, sf):
    """Written once as Parquet, then as CSV and JSON from there; all three are read back."""
    o = fx.orders_t(spark, sf).select("o_orderkey", "o_orderstatus", "score")
    scored = o.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    path = work_path(spark, "a14")
    scored.write.parquet(path + "/parquet")
    first = spark.read.parquet(path + "/parquet")
    tb.write_csv(first, path + "/csv")
    tb.write_json(first, path + "/json")
    back = {"parquet": first, "csv": tb.read_csv(spark, path + "/csv", scored.schema), "json": tb.read_json(spark, path + "/json", scored.schema)}
    return tb.union_all([df.select(*scored.columns, F.lit(name).alias("sink")) for name, df in back.items()])
