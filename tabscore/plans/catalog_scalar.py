"""Registered queries, part 4: scalar functions (H5-H10, H12), the per-column
aggregate union (G3), row-aligned label and features (C4) and the metric
evaluator (I3).

Each is a projection or one global aggregate over a whole test table, so it
runs inside one whole-stage-codegen stage with no shuffle (G3 and I3 add one
partial aggregate per task).
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabscore.functions import hashing, stamps
from tabscore.functions import text as tx
from tabscore.operators import features, model
from tabscore.operators import profile as prof
from tabscore.plans import catalog_stats  # noqa: F401  (registers k13 first)
from tabscore.plans import fixtures as fx
from tabscore.plans.catalog import ORACLE, R6, _frac_sql, _stats_sql, register
from tabscore.sources.tables import read_table

# ------------------------------------------------------------------ G3


@register("g3_union_column_aggregates", _stats_sql(
    "lineitem", fx.LINEITEM_KINDS,
    ["Min_Value", "Max_Value", "Missing_Values_Count", "Mean_Value", "Std_Dev"]))
def g3_union_column_aggregates(spark, sf):
    # The SQL twin is the naive form: one aggregate per column, UNION ALL.
    # Here one global aggregate computes every column's stats in one scan
    # and is then exploded into one row per column.
    return prof.column_stats(read_table(spark, sf, "lineitem"), digits=6).drop("ordinal", "Data_Type")


# ------------------------------------------------------------------ H5: floor, mod, arithmetic

@register("h5_floor_mod", f"""SELECT l_orderkey, l_linenumber, l_partkey,
CAST(floor(l_extendedprice / 100) AS BIGINT) AS price_hundreds,
l_orderkey % 100 AS key_mod,
((l_orderkey - 3000) % 7 + 7) % 7 AS key_pmod,
{R6('l_quantity * l_tax')} AS qty_tax,
{R6('l_extendedprice - l_extendedprice * l_discount')} AS net_price,
{R6('l_extendedprice / l_quantity')} AS unit_price,
l_linenumber + 1 AS next_line
FROM lineitem""")
def h5_floor_mod(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.floor(F.col("l_extendedprice") / 100).cast("bigint").alias("price_hundreds"),
        (F.col("l_orderkey") % 100).alias("key_mod"),
        F.pmod(F.col("l_orderkey") - 3000, F.lit(7)).cast("bigint").alias("key_pmod"),
        tx.round6(F.col("l_quantity") * F.col("l_tax")).alias("qty_tax"),
        tx.round6(F.col("l_extendedprice") - F.col("l_extendedprice") * F.col("l_discount")).alias("net_price"),
        tx.round6(F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        (F.col("l_linenumber") + 1).alias("next_line"))


# ------------------------------------------------------------------ H6: CASE WHEN, first match wins

@register("h6_case_when", """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount,
CASE WHEN l_quantity >= 40 THEN 'bulk' WHEN l_quantity >= 20 THEN 'medium'
     WHEN l_discount > 0.05 THEN 'discounted' WHEN l_returnflag = 'R' THEN 'returned'
     ELSE 'small' END AS band
FROM lineitem""")
def h6_case_when(spark, sf):
    li = read_table(spark, sf, "lineitem")
    band = (F.when(F.col("l_quantity") >= 40, "bulk")
             .when(F.col("l_quantity") >= 20, "medium")
             .when(F.col("l_discount") > 0.05, "discounted")
             .when(F.col("l_returnflag") == "R", "returned")
             .otherwise("small"))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", band.alias("band"))


# ------------------------------------------------------------------ H7: SPLIT + OFFSET (0-based)

@register("h7_split_offset", """SELECT o_orderkey, o_orderpriority,
string_split(o_orderpriority, '-')[1] AS part0,
string_split(o_orderpriority, '-')[2] AS part1,
string_split(o_orderpriority, '-')[3] AS part2,
CAST(len(string_split(o_orderpriority, '-')) AS INTEGER) AS n_parts
FROM orders""")
def h7_split_offset(spark, sf):
    o = read_table(spark, sf, "orders")
    parts = F.split(F.col("o_orderpriority"), "-")
    # get() is 0-based and NULL past the end (the warehouse's SAFE_OFFSET).
    return o.select("o_orderkey", "o_orderpriority",
                    F.get(parts, 0).alias("part0"), F.get(parts, 1).alias("part1"),
                    F.get(parts, 2).alias("part2"), F.size(parts).alias("n_parts"))


# ------------------------------------------------------------------ H8: casts
# FLOAT → INT rounds halves away from zero (DuckDB's own double cast rounds
# halves to even, so its twin spells out round()).

@register("h8_casts", """SELECT o_orderkey,
CAST(string_split(o_orderpriority, '-')[1] AS DOUBLE) AS priority_f,
TRY_CAST(string_split(o_orderpriority, '-')[2] AS DOUBLE) AS priority_word_f,
CAST(round(o_totalprice) AS BIGINT) AS price_i,
CAST(round(-o_totalprice) AS BIGINT) AS neg_price_i,
CAST(o_orderkey AS VARCHAR) AS key_s,
CAST(o_orderstatus = 'F' AS VARCHAR) AS done_s
FROM orders""")
def h8_casts(spark, sf):
    o = read_table(spark, sf, "orders")
    parts = F.split(F.col("o_orderpriority"), "-")
    return o.select(
        "o_orderkey",
        F.get(parts, 0).cast("double").alias("priority_f"),         # bad text raises (ANSI)
        F.get(parts, 1).try_cast("double").alias("priority_word_f"),  # bad text → NULL
        tx.int_half_away(F.col("o_totalprice")).alias("price_i"),
        tx.int_half_away(-F.col("o_totalprice")).alias("neg_price_i"),
        F.col("o_orderkey").cast("string").alias("key_s"),
        (F.col("o_orderstatus") == "F").cast("string").alias("done_s"))


# ------------------------------------------------------------------ H9: FORMAT, PARSE_TIME, EXTRACT

_H9_T = "CAST(round(arr_hhmm) AS BIGINT)"
_H9_TXT = f"printf('%02d:%02d', {_H9_T} // 100, {_H9_T} % 100)"


@register("h9_format_parse_extract", f"""SELECT l_orderkey, l_linenumber, l_partkey, arr_hhmm,
{_H9_TXT} AS hhmm_text,
strftime(try_strptime({_H9_TXT}, '%H:%M'), '%H:%M:%S') AS parsed_time,
CAST(hour(try_strptime({_H9_TXT}, '%H:%M')) AS BIGINT) AS hour_part,
CAST(minute(try_strptime({_H9_TXT}, '%H:%M')) AS BIGINT) AS minute_part
FROM {fx.WIDE_SQL}""")
def h9_format_parse_extract(spark, sf):
    """All rows; a text that is no time of day parses to NULL."""
    ti = F.round("arr_hhmm").cast("bigint")
    txt = F.format_string("%02d:%02d", F.floor(ti / 100).cast("bigint"), F.pmod(ti, F.lit(100)))
    ts = F.try_to_timestamp(txt, F.lit("HH:mm"))
    return fx.wide(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "arr_hhmm",
                                     txt.alias("hhmm_text"), F.date_format(ts, "HH:mm:ss").alias("parsed_time"),
                                     F.hour(ts).cast("bigint").alias("hour_part"),
                                     F.minute(ts).cast("bigint").alias("minute_part"))


# ------------------------------------------------------------------ H10: seeded uniform draws

@register("h10_seeded_uniform", f"""SELECT o_orderkey, {_frac_sql('o_orderkey')} AS u,
CAST(floor({_frac_sql('o_orderkey')} * 10) AS INTEGER) AS decile FROM orders""")
def h10_seeded_uniform(spark, sf):
    # RAND() re-expressed as a seeded per-key draw: the same value whatever
    # the partitioning or a task retry (``rand(seed)`` depends on both).
    o = read_table(spark, sf, "orders")
    return o.select("o_orderkey", hashing.unit_fraction(["o_orderkey"]).alias("u"),
                    hashing.hash_bucket(["o_orderkey"], 10).alias("decile"))


# ------------------------------------------------------------------ H12: ISO UTC text, dated folders

@register("h12_run_stamp", """SELECT event_id,
strftime(ts, '%Y-%m-%dT%H:%M:%S')
  || CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE '.' || strftime(ts, '%f') END
  || '+00:00' AS iso_timestamp,
'results/' || strftime(ts, '%Y-%m-%d') AS results_dir
FROM events""")
def h12_run_stamp(spark, sf):
    e = read_table(spark, sf, "events")
    return e.select("event_id", stamps.iso_utc("ts").alias("iso_timestamp"),
                    stamps.dated_dir("results", "ts").alias("results_dir"))


# ------------------------------------------------------------------ C4: label beside features

_C4_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("c4_label_with_features", f"""SELECT l_orderkey, l_linenumber, l_partkey,
{', '.join(_C4_FEATURES)}, CAST(returned AS INTEGER) AS label FROM {fx.WIDE_SQL}""")
def c4_label_with_features(spark, sf):
    return features.xy_frame(fx.wide(spark, sf), _C4_FEATURES, "returned",
                             keys=["l_orderkey", "l_linenumber", "l_partkey"])


# ------------------------------------------------------------------ I3: metric functions as an Evaluator

@register("i3_metric_evaluator", ORACLE["k13_composite"])
def i3_metric_evaluator(spark, sf):
    s = fx.scored_lines(spark, sf)
    scored = s.select("label", array_to_vector(F.array(1.0 - F.col("score"), F.col("score"))).alias("probability"))
    c = model.CompositeEvaluator().frame(scored)
    return c.select(*[tx.round6(F.col(x)).alias(x) for x in ("fbeta", "average_precision", "composite")])

