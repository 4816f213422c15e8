"""Stand-ins on the driver's test tables, each with its SQL twin.

* ``wide``: ``lineitem`` as the wide fact table, with a boolean target
  (``returned``), two ``hhmm`` clock columns and a time-block column.
* ``orders_t``: ``orders`` with a three-valued target ``done`` (NULL for
  status 'P') and a deterministic score.
* ``scored_lines``: ``lineitem`` with a 0/1 label and two deterministic
  scores (one with many distinct values, one with heavy ties).
* ``run_metrics``: ``events`` mapped onto the run-metrics schema.

The derived columns use only integer arithmetic followed by the same
double operations on both sides, so both engines compute identical values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscore.sources.tables import read_table

# Role configuration for the ``wide`` stand-in (our own).
WIDE_ROLES = {
    "tgt": ["returned"],
    "dat": ["l_shipdate"],
    "num": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax"],
    "hot": ["l_linenumber", "l_linestatus"],
    "cat": ["l_returnflag"],
}
WIDE_SKIP_REASONS = {"id": ["l_orderkey", "l_partkey"], "time_stamp": ["l_shipdate"]}
WIDE_LEAKAGE = {"true": ["l_returnflag"]}
WIDE_SKIP_ADDITIONAL = ["l_orderkey", "l_partkey", "l_suppkey", "not_a_column"]
WIDE_CLOCK = ["ship_hhmm", "arr_hhmm"]
WIDE_BLOCKS = ["ship_blk"]
WIDE_PROFILE_SKIP = WIDE_CLOCK + WIDE_BLOCKS


def wide(spark: SparkSession, sf: str) -> DataFrame:
    li = read_table(spark, sf, "lineitem")
    h = F.col("l_orderkey") % 24
    return li.withColumns({
        "returned": F.col("l_returnflag") == "R",
        "ship_hhmm": F.when(F.col("l_linenumber") == 7, F.lit(None).cast("double"))
                      .otherwise(((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 2500).cast("double")),
        "arr_hhmm": ((F.col("l_partkey") * 13 + F.col("l_suppkey")) % 2500).cast("double")
                    + F.col("l_discount") * 5,
        "ship_blk": F.when(F.col("l_linenumber") == 6, F.format_string("%04d", h * 100))
                     .when((h == 23) & (F.col("l_linenumber") == 1), F.lit("2300-2400"))
                     .otherwise(F.format_string("%04d-%04d", h * 100, h * 100 + 59)),
    })


WIDE_SQL = """(SELECT *,
  l_returnflag = 'R' AS returned,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST((l_orderkey * 7 + l_linenumber) % 2500 AS DOUBLE) END AS ship_hhmm,
  CAST((l_partkey * 13 + l_suppkey) % 2500 AS DOUBLE) + l_discount * 5 AS arr_hhmm,
  CASE WHEN l_linenumber = 6 THEN printf('%04d', (l_orderkey % 24) * 100)
       WHEN l_orderkey % 24 = 23 AND l_linenumber = 1 THEN '2300-2400'
       ELSE printf('%04d-%04d', (l_orderkey % 24) * 100, (l_orderkey % 24) * 100 + 59) END AS ship_blk
FROM lineitem)"""


def orders_t(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders")
    frac = ((F.col("o_orderkey") * 7919) % 100003).cast("double") / 100003.0
    return o.withColumns({
        "done": F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("boolean"))
                 .otherwise(F.col("o_orderstatus") == "F"),
        "score": (frac + F.when(F.col("o_orderstatus") == "F", F.lit(0.3)).otherwise(F.lit(0.0))) / 1.3,
    })


ORDERS_SQL = """(SELECT *,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus = 'F' END AS done,
  (CAST((o_orderkey * 7919) % 100003 AS DOUBLE) / 100003.0
    + CASE WHEN o_orderstatus = 'F' THEN 0.3 ELSE 0.0 END) / 1.3 AS score
FROM orders)"""


def scored_lines(spark: SparkSession, sf: str) -> DataFrame:
    li = read_table(spark, sf, "lineitem")
    frac = ((F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729) % 100003).cast("double") / 100003.0
    is_r = F.col("l_returnflag") == "R"
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        is_r.cast("int").alias("label"),
        ((frac + F.when(is_r, F.lit(0.25)).otherwise(F.lit(0.0))) / 1.25).alias("score"),
        F.least(F.greatest(F.col("l_discount") * 10, F.lit(0.0)), F.lit(1.0)).alias("score_ties"))


SCORED_SQL = """(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(l_returnflag = 'R' AS INTEGER) AS label,
  (CAST((l_orderkey * 7919 + l_linenumber * 104729) % 100003 AS DOUBLE) / 100003.0
    + CASE WHEN l_returnflag = 'R' THEN 0.25 ELSE 0.0 END) / 1.25 AS score,
  least(greatest(l_discount * 10, 0.0), 1.0) AS score_ties
FROM lineitem)"""


def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "events")
    return e.select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.concat(F.lit("proj_"), (F.col("user_id") % 3).cast("string")).alias("project_name"),
        F.lit("gbt").alias("model_name"),
        F.col("event_type").alias("metric_name"),
        F.col("value").cast("double").alias("metric_value"),
        F.concat(F.lit("runs/"), F.col("event_id").cast("string")).alias("pipeline_uri"))


RUN_METRICS_SQL = """(SELECT CAST(ts AS TIMESTAMPTZ) AS "timestamp",
  'proj_' || CAST(user_id % 3 AS VARCHAR) AS project_name, 'gbt' AS model_name,
  event_type AS metric_name, CAST(value AS DOUBLE) AS metric_value,
  'runs/' || CAST(event_id AS VARCHAR) AS pipeline_uri
FROM events)"""


# -- SQL text helpers for the oracle (DuckDB dialect) --------------------------

def sql_double_text(x: str) -> str:
    return (f"CASE WHEN {x} = floor({x}) AND abs({x}) < 1e15 THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) "
            f"ELSE CAST({x} AS VARCHAR) END")


def sql_text(x: str, kind: str) -> str:
    if kind == "double":
        return sql_double_text(x)
    if kind == "ts":
        return f"strftime({x}, '%Y-%m-%d %H:%M:%S') || '+00'"
    if kind == "bool":
        return f"CASE WHEN {x} THEN 'true' WHEN NOT {x} THEN 'false' END"
    return f"CAST({x} AS VARCHAR)"


KIND_TYPE = {"int": "INTEGER", "double": "FLOAT", "string": "STRING", "bool": "BOOLEAN", "ts": "TIMESTAMP"}

LINEITEM_KINDS = [("l_orderkey", "int"), ("l_partkey", "int"), ("l_suppkey", "int"), ("l_linenumber", "int"),
                  ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"),
                  ("l_tax", "double"), ("l_returnflag", "string"), ("l_linestatus", "string"),
                  ("l_shipdate", "ts")]
WIDE_KINDS = LINEITEM_KINDS + [("returned", "bool")]
ORDERS_KINDS = [("o_orderkey", "int"), ("o_custkey", "int"), ("o_orderstatus", "string"),
                ("o_totalprice", "double"), ("o_orderdate", "ts"), ("o_orderpriority", "string")]


def sql_round(x: str) -> str:
    return f"ROUND({x} + 1e-9, 6)"


def profile_sql(table: str, kinds: list[tuple[str, str]], samples: int = 5, with_ordinal: bool = False) -> str:
    """The per-column UNION ALL profile (the naive form) as DuckDB SQL."""
    arms = []
    for i, (c, k) in enumerate(kinds):
        q = f'"{c}"'
        numeric = k in ("int", "double")
        mean = sql_round(f"AVG({q})") if numeric else "CAST(NULL AS DOUBLE)"
        std = sql_round(f"STDDEV_SAMP({q})") if numeric else "CAST(NULL AS DOUBLE)"
        ordcol = f"{i} AS ordinal, " if with_ordinal else ""
        arms.append(
            f"SELECT {ordcol}'{c}' AS Column_Name, '{KIND_TYPE[k]}' AS Data_Type, "
            f"{sql_text(f'MIN({q})', k)} AS Min_Value, {sql_text(f'MAX({q})', k)} AS Max_Value, "
            f"COUNT(DISTINCT {q}) AS Unique_Values_Count, COUNT(*) - COUNT({q}) AS Missing_Values_Count, "
            f"{mean} AS Mean_Value, {std} AS Std_Dev, "
            f"(SELECT string_agg({sql_text('v', k)}, ', ' ORDER BY v) FROM "
            f"(SELECT DISTINCT {q} AS v FROM {table} WHERE {q} IS NOT NULL ORDER BY v LIMIT {samples})) "
            f"AS Sample_Values FROM {table}")
    return "\nUNION ALL\n".join(arms)
