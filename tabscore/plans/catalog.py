"""Registered queries and their DuckDB oracle SQL.

Every query takes ``(spark, sf_dir)``, reads the driver's tables (or frames
Spark derives from them) and returns a DataFrame.  Computed doubles are
rounded with ``round(x + 1e-9, 6)`` on both sides so that summation order
cannot change the comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscore.functions import clock
from tabscore.functions import text as tx
from tabscore.operators import profile as prof
from tabscore.operators import roles as rl
from tabscore.operators import sampling as smp
from tabscore.plans import fixtures as fx
from tabscore.plans import ranks, stored
from tabscore.session import work_path
from tabscore.sources.tables import read_table, select_columns, union_all, write_yearly_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


R6 = fx.sql_round


def _view_name(prefix: str) -> str:
    """A per-call temp view name, so concurrent calls never share a view."""
    import uuid
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


# ---------------------------------------------------------------- D: profile

@register("d7_profile_lineitem", fx.profile_sql("lineitem", fx.LINEITEM_KINDS))
def d7_profile_lineitem(spark, sf):
    return prof.profile(read_table(spark, sf, "lineitem"), digits=6)


@register("d7_profile_orders", fx.profile_sql("orders", fx.ORDERS_KINDS))
def d7_profile_orders(spark, sf):
    return prof.profile(read_table(spark, sf, "orders"), digits=6)


@register("d7_profile_merged", f"""SELECT Column_Name, Data_Type, Min_Value, Max_Value, Missing_Values_Count, Mean_Value, Std_Dev, Sample_Values, TRUE AS distinct_close
FROM ({fx.profile_sql('orders', fx.ORDERS_KINDS)})""")
def d7_profile_merged(spark, sf):
    """States by year, stored; one year is profiled again and replaces its rows; the profile comes from the merged states."""
    o = read_table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    path = work_path(spark, "d7")
    prof.profile_states(o, "year").write.partitionBy("year").parquet(path)
    (prof.profile_states(o.where("year = 1997"), "year").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("year").parquet(path))
    fields = [f for f in o.schema.fields if f.name != "year"]
    merged = prof.merge_states(spark.read.parquet(path), fields, digits=6)
    exact = prof.distinct_counts(o, [f.name for f in fields])
    close = F.abs(F.col("Unique_Values_Count") - F.col("n_unique")) <= 0.03 * F.col("n_unique")
    return merged.join(exact, "Column_Name").withColumn("distinct_close", close).drop("Unique_Values_Count", "n_unique")


@register("d7_profile_wide", fx.profile_sql(fx.WIDE_SQL, fx.WIDE_KINDS))
def d7_profile_wide(spark, sf):
    # Clock and block columns are skipped, as in the reference's profile.
    return prof.profile(fx.wide(spark, sf), skip=[c + " " for c in fx.WIDE_PROFILE_SKIP], digits=6)


def _stats_sql(table, kinds, cols):
    arms = []
    for c, k in kinds:
        numeric = k in ("int", "double")
        parts = {"Min_Value": f"{fx.sql_text(f'MIN({c})', k)}", "Max_Value": f"{fx.sql_text(f'MAX({c})', k)}",
                 "Missing_Values_Count": f"COUNT(*) - COUNT({c})",
                 "Mean_Value": R6(f"AVG({c})") if numeric else "CAST(NULL AS DOUBLE)",
                 "Std_Dev": R6(f"STDDEV_SAMP({c})") if numeric else "CAST(NULL AS DOUBLE)"}
        arms.append(f"SELECT '{c}' AS Column_Name, " + ", ".join(f"{parts[x]} AS {x}" for x in cols)
                    + f" FROM {table}")
    return " UNION ALL ".join(arms)


@register("d1_min_max_text", _stats_sql("orders", fx.ORDERS_KINDS, ["Min_Value", "Max_Value"]))
def d1_min_max_text(spark, sf):
    return prof.column_stats(read_table(spark, sf, "orders")).select("Column_Name", "Min_Value", "Max_Value")


@register("d2_count_distinct", " UNION ALL ".join(
    f"SELECT '{c}' AS Column_Name, COUNT(DISTINCT {c}) AS n_unique FROM lineitem" for c, _ in fx.LINEITEM_KINDS))
def d2_count_distinct(spark, sf):
    df = read_table(spark, sf, "lineitem")
    return prof.distinct_counts(df, df.columns)


_WIDE_ALL = fx.WIDE_KINDS + [("ship_hhmm", "double"), ("arr_hhmm", "double"), ("ship_blk", "string")]


@register("d3_missing_count", _stats_sql(fx.WIDE_SQL, _WIDE_ALL, ["Missing_Values_Count"]))
def d3_missing_count(spark, sf):
    return prof.column_stats(fx.wide(spark, sf)).select("Column_Name", "Missing_Values_Count")


@register("d4_d5_mean_std", _stats_sql("lineitem", [x for x in fx.LINEITEM_KINDS if x[1] in ("int", "double")], ["Mean_Value", "Std_Dev"]))
def d4_d5_mean_std(spark, sf):
    df = read_table(spark, sf, "lineitem")
    df = df.select(*[f.name for f in df.schema.fields if tx.is_numeric_name(tx.type_name(f.dataType))])
    return prof.column_stats(df, digits=6).select("Column_Name", "Mean_Value", "Std_Dev")


@register("d6_sample_values", " UNION ALL ".join(
    f"SELECT '{c}' AS Column_Name, (SELECT string_agg({fx.sql_text('v', k)}, ', ' ORDER BY v) FROM "
    f"(SELECT DISTINCT {c} AS v FROM orders WHERE {c} IS NOT NULL ORDER BY v LIMIT 5)) AS Sample_Values"
    for c, k in fx.ORDERS_KINDS))
def d6_sample_values(spark, sf):
    return prof.sample_values(read_table(spark, sf, "orders"))


def _decimal_sql(c: str) -> str:
    return f"CAST({c} AS DECIMAL(12, 2))"


@register("d6_samples_decimal", f"""SELECT 'price' AS Column_Name, (SELECT string_agg(CAST(v AS VARCHAR), ', ' ORDER BY v) FROM
(SELECT DISTINCT {_decimal_sql('l_extendedprice')} - 20000 AS v FROM lineitem ORDER BY v LIMIT 5)) AS Sample_Values
UNION ALL SELECT 'rate' AS Column_Name, (SELECT string_agg(CAST(v AS VARCHAR), ', ' ORDER BY v) FROM
(SELECT DISTINCT CAST(l_discount AS DECIMAL(5, 4)) AS v FROM lineitem ORDER BY v LIMIT 5)) AS Sample_Values""")
def d6_samples_decimal(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return prof.sample_values(li.select((F.col("l_extendedprice").cast("decimal(12,2)") - F.lit(20000)).cast("decimal(13,2)").alias("price"),
                                        F.col("l_discount").cast("decimal(5,4)").alias("rate")))


@register("d8_value_counts", """SELECT o_orderpriority, COUNT(*) AS "count" FROM orders
WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority""")
def d8_value_counts(spark, sf):
    return prof.value_counts(read_table(spark, sf, "orders"), "o_orderpriority")


@register("d9_class_ratio", f"""SELECT CAST(count_if(done IS TRUE) AS BIGINT) AS n_pos, CAST(count_if(done IS FALSE) AS BIGINT) AS n_neg,
count_if(done IS FALSE) / greatest(count_if(done IS TRUE), 1) AS pos_weight FROM {fx.ORDERS_SQL}""")
def d9_class_ratio(spark, sf):
    return prof.class_ratio(fx.orders_t(spark, sf), "done")


@register("d11_distinct_values", "SELECT DISTINCT l_linestatus, l_returnflag FROM lineitem")
def d11_distinct_values(spark, sf):
    return read_table(spark, sf, "lineitem").select("l_linestatus", "l_returnflag").distinct()


_CARD_COLS = ["o_orderstatus", "o_orderpriority", "o_custkey"]


@register("d12_cardinality_split", " UNION ALL ".join(
    f"SELECT '{c}' AS Column_Name, COUNT(DISTINCT {c}) AS n_unique, "
    f"CASE WHEN COUNT(DISTINCT {c}) <= 5 THEN 'hot' ELSE 'cat' END AS role FROM orders" for c in _CARD_COLS))
def d12_cardinality_split(spark, sf):
    return prof.cardinality_roles(read_table(spark, sf, "orders"), _CARD_COLS, k=5)


@register("d13_shape", """SELECT COUNT(*) AS n_rows, (SELECT CAST(COUNT(*) AS INTEGER) FROM information_schema.columns
WHERE table_name = 'orders') AS n_columns FROM orders""")
def d13_shape(spark, sf):
    return prof.shape(read_table(spark, sf, "orders"))


# ------------------------------------------------------------------ H / I: clock

def _ttm_sql(x: str) -> str:
    r = f"round({x})"
    return (f"CASE WHEN {x} IS NULL OR isnan({x}) THEN NULL WHEN {r} = 2400 THEN 0 "
            f"WHEN {r} < 0 OR {r} > 2400 THEN NULL WHEN {r} % 100 >= 60 THEN NULL "
            f"ELSE CAST(floor({r} / 100) * 60 + {r} % 100 AS BIGINT) END")


@register("h1_time_to_minutes", f"""SELECT l_orderkey, l_linenumber, l_partkey, ship_hhmm,
{_ttm_sql('ship_hhmm')} AS ship_minutes FROM {fx.WIDE_SQL}""")
def h1_time_to_minutes(spark, sf):
    w = fx.wide(spark, sf)
    return w.select("l_orderkey", "l_linenumber", "l_partkey", "ship_hhmm",
                    clock.time_to_minutes("ship_hhmm").alias("ship_minutes"))


@register("h2_clock_columns", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ship_hhmm,
{_ttm_sql('ship_hhmm')} AS ship_hhmm_minutes, arr_hhmm, {_ttm_sql('arr_hhmm')} AS arr_hhmm_minutes
FROM {fx.WIDE_SQL}""")
def h2_clock_columns(spark, sf):
    w = fx.wide(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *fx.WIDE_CLOCK)
    return clock.with_minutes(w, fx.WIDE_CLOCK)


def _blk_sql(c: str) -> str:
    a = f"TRY_CAST(string_split({c}, '-')[1] AS DOUBLE)"
    b = f"TRY_CAST(string_split({c}, '-')[2] AS DOUBLE)"
    return (f"{_ttm_sql(a)} AS {c}_minutes_start, {_ttm_sql(b)} AS {c}_minutes_finish, "
            f"{_ttm_sql(b)} - {_ttm_sql(a)} AS {c}_minutes_elapsed")


@register("h3_time_blocks", f"""SELECT l_orderkey, l_linenumber, l_partkey, ship_blk, {_blk_sql('ship_blk')}
FROM {fx.WIDE_SQL}""")
def h3_time_blocks(spark, sf):
    w = fx.wide(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "ship_blk")
    return clock.with_block_minutes(w, fx.WIDE_BLOCKS)


@register("h4_clock_parse", f"""SELECT l_orderkey, l_linenumber, l_partkey, arr_hhmm,
CASE WHEN round(arr_hhmm) = 2400 THEN NULL ELSE {_ttm_sql('arr_hhmm')} END AS arr_minutes FROM {fx.WIDE_SQL}""")
def h4_clock_parse(spark, sf):
    # The parse form covers what parses as a clock value; 24:00 and values off the clock are NULL.
    ok = clock.time_to_minutes("arr_hhmm").isNotNull() & (F.round("arr_hhmm") != 2400)
    return fx.wide(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "arr_hhmm",
                                     clock.clock_via_parse(F.when(ok, F.col("arr_hhmm"))).alias("arr_minutes"))


@register("i1_sql_function", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, arr_hhmm,
{_ttm_sql('arr_hhmm')} AS arr_minutes FROM {fx.WIDE_SQL}""")
def i1_sql_function(spark, sf):
    clock.register_sql_functions(spark)
    view = _view_name("wide_lines")
    fx.wide(spark, sf).createOrReplaceTempView(view)
    return spark.sql("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, arr_hhmm, "
                     f"time_to_minutes(arr_hhmm) AS arr_minutes FROM {view}")


@register("h13_strip_prefix", f"""SELECT pipeline_uri, regexp_replace(pipeline_uri, '^runs/', '') AS run_id,
ends_with(pipeline_uri, '0') AS ends_zero FROM {fx.RUN_METRICS_SQL}""")
def h13_strip_prefix(spark, sf):
    m = fx.run_metrics(spark, sf)
    return m.select("pipeline_uri", tx.strip_prefix(F.col("pipeline_uri"), "runs/").alias("run_id"),
                    F.col("pipeline_uri").endswith("0").alias("ends_zero"))


# ------------------------------------------------------------------ roles (B, C, K16, L1)

def _role_values(lists, name):
    rows, i = [], 0
    for v, cols in lists.items():
        for c in cols:
            rows.append(f"('{c}', '{v}', {i})")
            i += 1
    return (f"(SELECT Column_Name, arg_max({name}, o) AS {name} FROM (VALUES {', '.join(rows)}) "
            f"AS t(Column_Name, {name}, o) GROUP BY Column_Name)")


ROLE_TABLE_SQL = f"""(SELECT p.*, coalesce(r.Role, 'unk') AS Role,
  coalesce(s.Skip_reason_phik, 'unk') AS Skip_reason_phik, coalesce(d.Data_leakage, 'unk') AS Data_leakage
FROM ({fx.profile_sql(fx.WIDE_SQL, fx.WIDE_KINDS, with_ordinal=True)}) p
LEFT JOIN {_role_values(fx.WIDE_ROLES, 'Role')} r USING (Column_Name)
LEFT JOIN {_role_values(fx.WIDE_SKIP_REASONS, 'Skip_reason_phik')} s USING (Column_Name)
LEFT JOIN {_role_values(fx.WIDE_LEAKAGE, 'Data_leakage')} d USING (Column_Name))"""


@register("c1_role_lookup", f"SELECT * EXCLUDE (ordinal) FROM {ROLE_TABLE_SQL}")
def c1_role_lookup(spark, sf):
    return stored.role_table(spark, sf).drop("ordinal")


@register("c2_role_invert", f"SELECT Column_Name, Role, ordinal IS NOT NULL AS in_table FROM {_role_values(fx.WIDE_ROLES, 'Role')} r "
          f"LEFT JOIN (SELECT Column_Name, ordinal FROM {ROLE_TABLE_SQL}) t USING (Column_Name)")
def c2_role_invert(spark, sf):
    known = stored.stored_roles(spark, sf).select("Column_Name", F.lit(True).alias("in_table"))
    return rl.invert(spark, fx.WIDE_ROLES, "Role").join(known, "Column_Name", "left").withColumn("in_table", F.coalesce("in_table", F.lit(False)))


@register("c3_scalar_subquery", """SELECT 'l_returnflag' AS Column_Name, COUNT(DISTINCT l_returnflag) AS n_unique,
(SELECT string_agg(v, ', ' ORDER BY v) FROM (SELECT DISTINCT l_returnflag AS v FROM lineitem
  WHERE l_returnflag IS NOT NULL ORDER BY v LIMIT 5)) AS Sample_Values FROM lineitem""")
def c3_scalar_subquery(spark, sf):
    view = _view_name("lineitem_c3")
    read_table(spark, sf, "lineitem").createOrReplaceTempView(view)
    return spark.sql(f"""SELECT 'l_returnflag' AS Column_Name, COUNT(DISTINCT l_returnflag) AS n_unique,
      (SELECT listagg(v, ', ') WITHIN GROUP (ORDER BY v) FROM (SELECT DISTINCT l_returnflag AS v
        FROM {view} WHERE l_returnflag IS NOT NULL ORDER BY v LIMIT 5)) AS Sample_Values
      FROM {view}""")


# num minus skip, profile order: l_quantity, l_extendedprice, l_discount, l_tax (l_linenumber is 'hot').
_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("b1_role_projection", f"SELECT {', '.join(_FEATURES)}, returned FROM {fx.WIDE_SQL}")
def b1_role_projection(spark, sf):
    num, tgt, _ = stored.feature_names(spark, sf)
    return select_columns(fx.wide(spark, sf), num + [tgt])


@register("b2_drop_skipped", f"SELECT * EXCLUDE (l_orderkey, l_partkey, l_suppkey) FROM {fx.WIDE_SQL}")
def b2_drop_skipped(spark, sf):
    df, _ = rl.drop_skipped(fx.wide(spark, sf), fx.WIDE_SKIP_ADDITIONAL, fx.WIDE_ROLES)
    return df


@register("b3_is_true", f"SELECT o_orderkey, o_orderstatus FROM {fx.ORDERS_SQL} WHERE done IS TRUE")
def b3_is_true(spark, sf):
    return fx.orders_t(spark, sf).where(F.col("done").eqNullSafe(F.lit(True))).select("o_orderkey", "o_orderstatus")


@register("b3_is_false", f"SELECT o_orderkey, o_orderstatus FROM {fx.ORDERS_SQL} WHERE done IS FALSE")
def b3_is_false(spark, sf):
    return fx.orders_t(spark, sf).where(F.col("done").eqNullSafe(F.lit(False))).select("o_orderkey", "o_orderstatus")


@register("b4_not_null", f"SELECT l_orderkey, l_linenumber, ship_hhmm FROM {fx.WIDE_SQL} WHERE ship_hhmm IS NOT NULL")
def b4_not_null(spark, sf):
    return fx.wide(spark, sf).na.drop(subset=["ship_hhmm"]).select("l_orderkey", "l_linenumber", "ship_hhmm")


@register("b5_conjunctive_filter", f"""SELECT * FROM {fx.RUN_METRICS_SQL}
WHERE project_name = 'proj_1' AND metric_name = 'click'""")
def b5_conjunctive_filter(spark, sf):
    m = fx.run_metrics(spark, sf)
    return m.where((F.col("project_name") == "proj_1") & (F.col("metric_name") == "click"))


@register("b6_parameterised_predicate", f"""SELECT metric_name, metric_value, pipeline_uri FROM {fx.RUN_METRICS_SQL}
WHERE project_name = 'proj_2'""")
def b6_parameterised_predicate(spark, sf):
    view = _view_name("run_metrics_b6")
    fx.run_metrics(spark, sf).createOrReplaceTempView(view)
    return spark.sql(f"SELECT metric_name, metric_value, pipeline_uri FROM {view} "
                     "WHERE project_name = :project_name", args={"project_name": "proj_2"})


@register("b7_set_membership", """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 10)""")
def b7_set_membership(spark, sf):
    small = read_table(spark, sf, "part").where(F.col("p_size") < 10).select(F.col("p_partkey").alias("l_partkey"))
    # Left-semi join: Catalyst broadcasts the key list only when its measured
    # size is under the broadcast threshold; otherwise it shuffles both sides.
    return read_table(spark, sf, "lineitem").join(small, "l_partkey", "left_semi") \
        .select("l_orderkey", "l_linenumber", "l_partkey")


def _frac_sql(key: str, seed: int = 42) -> str:
    return (f"CAST(('0x' || substr(md5(concat_ws(':', '{seed}', CAST({key} AS VARCHAR))), 1, 8)) AS BIGINT)"
            f" / 4294967296.0")


def _md5_sql(key: str, seed: int = 42) -> str:
    return f"md5(concat_ws(':', '{seed}', CAST({key} AS VARCHAR)))"


@register("b8_bernoulli_sample", f"SELECT * FROM orders WHERE {_frac_sql('o_orderkey')} < 0.1")
def b8_bernoulli_sample(spark, sf):
    return smp.hash_fraction(read_table(spark, sf, "orders"), 0.1, ["o_orderkey"])


@register("b11_probability_cut", f"SELECT l_orderkey, l_linenumber, score, CAST(score >= 0.3 AS INTEGER) AS pred FROM {fx.SCORED_SQL}")
def b11_probability_cut(spark, sf):
    s = fx.scored_lines(spark, sf)
    return s.select("l_orderkey", "l_linenumber", "score", (F.col("score") >= 0.3).cast("int").alias("pred"))


@register("b12_casts", f"""SELECT l_orderkey, l_linenumber, CAST(returned AS TINYINT) AS returned_i8,
CAST(l_linenumber AS DOUBLE) AS linenumber_f, CAST(l_linenumber AS VARCHAR) AS linenumber_s,
TRY_CAST(ship_blk AS DOUBLE) AS blk_num FROM {fx.WIDE_SQL}""")
def b12_casts(spark, sf):
    w = fx.wide(spark, sf)
    return w.select("l_orderkey", "l_linenumber", F.col("returned").cast("tinyint").alias("returned_i8"),
                    F.col("l_linenumber").cast("double").alias("linenumber_f"),
                    F.col("l_linenumber").cast("string").alias("linenumber_s"),
                    F.col("ship_blk").try_cast("double").alias("blk_num"))


@register("b13_typed_nulls", """SELECT 'price' AS Column_Name, ROUND(AVG(o_totalprice) + 1e-9, 6) AS Mean_Value,
CAST(NULL AS DOUBLE) AS Std_Dev FROM orders
UNION ALL SELECT 'status' AS Column_Name, CAST(NULL AS DOUBLE) AS Mean_Value, CAST(NULL AS DOUBLE) AS Std_Dev
FROM (SELECT COUNT(*) AS n FROM orders)""")
def b13_typed_nulls(spark, sf):
    o = read_table(spark, sf, "orders")
    a = o.agg(F.lit("price").alias("Column_Name"), tx.round6(F.avg("o_totalprice")).alias("Mean_Value"),
              F.lit(None).cast("double").alias("Std_Dev"))
    b = o.agg(F.lit("status").alias("Column_Name"), F.lit(None).cast("double").alias("Mean_Value"),
              F.lit(None).cast("double").alias("Std_Dev"), F.count(F.lit(1)).alias("_n")).drop("_n")
    return a.unionByName(b)


@register("b14_skip_table", f"""SELECT DISTINCT Column_Name, reason FROM (
  SELECT Column_Name, 'Skip_reason_phik:' || Skip_reason_phik AS reason FROM {ROLE_TABLE_SQL} WHERE Skip_reason_phik <> 'unk'
  UNION ALL SELECT Column_Name, 'Data_leakage:' || Data_leakage AS reason FROM {ROLE_TABLE_SQL} WHERE Data_leakage <> 'unk'
  UNION ALL SELECT c AS Column_Name, 'config:skip_additional' AS reason
    FROM (VALUES {', '.join(f"('{c}')" for c in fx.WIDE_SKIP_ADDITIONAL)}) t(c))""")
def b14_skip_table(spark, sf):
    return rl.skip_table(stored.stored_roles(spark, sf), {"skip_additional": fx.WIDE_SKIP_ADDITIONAL})


@register("k16_role_mapping", f"""SELECT CAST(ordinal AS INTEGER) AS ordinal, Column_Name AS "column", Role AS role
FROM {ROLE_TABLE_SQL} WHERE Column_Name IN ({', '.join(f"'{c}'" for c in _FEATURES + ['returned'])})""")
def k16_role_mapping(spark, sf):
    num, tgt, rt = stored.feature_names(spark, sf)
    return rl.role_mapping(rt, num + [tgt])


@register("l1_schema_fields", f"""SELECT CAST(ordinal AS INTEGER) AS ordinal, Column_Name AS name,
CASE Data_Type WHEN 'INTEGER' THEN 'bigint' WHEN 'FLOAT' THEN 'double' WHEN 'STRING' THEN 'string'
  WHEN 'BOOLEAN' THEN 'boolean' WHEN 'TIMESTAMP' THEN 'timestamp' ELSE 'string' END AS spark_type,
TRUE AS required FROM {ROLE_TABLE_SQL} WHERE Column_Name IN ({', '.join(f"'{c}'" for c in _FEATURES)})""")
def l1_schema_fields(spark, sf):
    num, tgt, rt = stored.feature_names(spark, sf)
    return rl.schema_fields(rt, rl.role_mapping(rt, num + [tgt]))


@register("f7_sorted_names", f"""SELECT Column_Name, Role, row_number() OVER (ORDER BY Role, Column_Name) AS place
FROM {ROLE_TABLE_SQL} WHERE Role <> 'unk'""")
def f7_sorted_names(spark, sf):
    rt = stored.stored_roles(spark, sf)
    return ranks.with_place(rt.where(F.col("Role") != "unk").select("Column_Name", "Role").orderBy("Role", "Column_Name"))


# ------------------------------------------------------------------ F, G, J: order, sets, samples

@register("f1_random_top", f"SELECT * FROM orders ORDER BY {_md5_sql('o_orderkey')} LIMIT 100")
def f1_random_top(spark, sf):
    return smp.random_top(read_table(spark, sf, "orders"), 100, ["o_orderkey"])


@register("f2_top_runs", f"""SELECT * FROM {fx.RUN_METRICS_SQL} WHERE project_name = 'proj_0' AND metric_name = 'purchase'
ORDER BY metric_value DESC NULLS LAST, "timestamp", pipeline_uri LIMIT 5""")
def f2_top_runs(spark, sf):
    from tabscore.operators.runs import top_runs
    return top_runs(fx.run_metrics(spark, sf), "proj_0", "purchase", 5)


@register("f3_best_run", f"""SELECT pipeline_uri, metric_value FROM {fx.RUN_METRICS_SQL}
WHERE project_name = 'proj_1' AND metric_name = 'view'
ORDER BY metric_value DESC NULLS LAST, "timestamp", pipeline_uri LIMIT 1""")
def f3_best_run(spark, sf):
    from tabscore.operators.runs import best_run
    return best_run(fx.run_metrics(spark, sf), "proj_1", "view").select("pipeline_uri", "metric_value")


@register("f4_top_scores", f"SELECT o_orderkey, score FROM {fx.ORDERS_SQL} ORDER BY score DESC, o_orderkey LIMIT 5")
def f4_top_scores(spark, sf):
    return smp.top_by_score(fx.orders_t(spark, sf), "score", 5, ["o_orderkey"]).select("o_orderkey", "score")


@register("f5_first_per_class", f"""SELECT o_orderkey, o_orderpriority FROM (SELECT o_orderkey, o_orderpriority,
row_number() OVER (PARTITION BY o_orderpriority ORDER BY {_md5_sql('o_orderkey')}, o_orderkey) AS rn FROM orders) WHERE rn <= 5""")
def f5_first_per_class(spark, sf):
    return smp.first_per_class(read_table(spark, sf, "orders"), "o_orderpriority", 5, ["o_orderkey"]) \
        .select("o_orderkey", "o_orderpriority")


@register("f6_sort_desc", """SELECT o_orderpriority, n, row_number() OVER (ORDER BY n DESC, o_orderpriority) AS place
FROM (SELECT o_orderpriority, COUNT(*) AS n FROM orders GROUP BY o_orderpriority)""")
def f6_sort_desc(spark, sf):
    return ranks.with_place(read_table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
                            .orderBy(F.desc("n"), "o_orderpriority"))


@register("f8_hash_order", f"""SELECT o_orderkey, o_orderstatus, row_number() OVER (ORDER BY {_md5_sql('o_orderkey')}, o_orderkey) AS place
FROM orders""")
def f8_hash_order(spark, sf):
    return ranks.with_place(smp.hash_order(read_table(spark, sf, "orders"), ["o_orderkey"]).select("o_orderkey", "o_orderstatus"))


@register("f10_fallback_sample", f"""SELECT o_orderkey, grp AS "group" FROM (SELECT o_orderkey, grp,
row_number() OVER (PARTITION BY grp ORDER BY {_md5_sql('o_orderkey')}, o_orderkey) AS rn
FROM (SELECT o_orderkey, CASE WHEN score >= 0.5 THEN 'true' ELSE 'false' END AS grp FROM {fx.ORDERS_SQL})) WHERE rn <= 5""")
def f10_fallback_sample(spark, sf):
    o = fx.orders_t(spark, sf).withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    return smp.fallback_sample(o, "prediction", "score", "done", 5, ["o_orderkey"]).select("o_orderkey", "group")


@register("f10_fallback_actual", f"""SELECT o_orderkey, grp AS "group" FROM (SELECT o_orderkey, grp,
row_number() OVER (PARTITION BY grp ORDER BY {_md5_sql('o_orderkey')}, o_orderkey) AS rn
FROM (SELECT o_orderkey, 'false' AS grp FROM {fx.ORDERS_SQL} UNION ALL SELECT o_orderkey, 'actual_true' FROM {fx.ORDERS_SQL} WHERE done)) WHERE rn <= 5""")
def f10_fallback_actual(spark, sf):
    """No predicted positives and no scores: the third step."""
    o = fx.orders_t(spark, sf).withColumns({"prediction": F.lit(0), "score": F.lit(None).cast("double")})
    return smp.fallback_sample(o, "prediction", "score", "done", 5, ["o_orderkey"]).select("o_orderkey", "group")


@register("g1_union_years", "SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders")
def g1_union_years(spark, sf):
    """One frame per yearly file, as they lie in the raw layer: each arm reads its own year only."""
    path = work_path(spark, "g1")
    o = read_table(spark, sf, "orders")
    write_yearly_files(o, "o_orderdate", path)
    years = sorted(r.year for r in spark.read.parquet(path).select("year").distinct().collect())
    return union_all([spark.read.schema(o.schema).parquet(f"{path}/year={y}").withColumn("year", F.lit(y)) for y in years])


@register("g4_distinct", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def g4_distinct(spark, sf):
    return read_table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority").distinct()


def _class_top_sql(cond: str, n: int) -> str:
    return (f"(SELECT o_orderkey, done FROM {fx.ORDERS_SQL} WHERE {cond} "
            f"ORDER BY {_md5_sql('o_orderkey')}, o_orderkey LIMIT {n})")


@register("j1_balanced_sample", f"""SELECT * FROM {_class_top_sql('done IS TRUE', 1000 // 3)}
UNION ALL SELECT * FROM {_class_top_sql('done IS FALSE', 1000 - 1000 // 3)}""")
def j1_balanced_sample(spark, sf):
    o = fx.orders_t(spark, sf)
    return smp.balanced_sample(o, "done", 1000, ["o_orderkey"]).select("o_orderkey", "done")


@register("g2_union_samples", f"""SELECT * FROM {_class_top_sql('done IS TRUE', 50)}
UNION ALL SELECT * FROM {_class_top_sql('done IS FALSE', 100)}""")
def g2_union_samples(spark, sf):
    o = fx.orders_t(spark, sf).select("o_orderkey", "done")
    pos = smp.random_top(o.where(F.col("done").eqNullSafe(True)), 50, ["o_orderkey"])
    neg = smp.random_top(o.where(F.col("done").eqNullSafe(False)), 100, ["o_orderkey"])
    return union_all([pos, neg])


@register("j2_uniform_sample", f"SELECT o_orderkey FROM orders WHERE {_frac_sql('o_orderkey', 7)} < 0.05")
def j2_uniform_sample(spark, sf):
    return smp.hash_fraction(read_table(spark, sf, "orders"), 0.05, ["o_orderkey"], seed=7).select("o_orderkey")


def _quota_sql(p: float) -> str:
    return f"""(SELECT done, n_c, n_test, base + CASE WHEN rk <= n_test - SUM(base) OVER () THEN 1 ELSE 0 END AS quota
  FROM (SELECT done, n_c, n_test, (n_test * n_c) // n AS base,
    row_number() OVER (ORDER BY (n_test * n_c) % n DESC, CAST(done AS VARCHAR)) AS rk
    FROM (SELECT done, n_c, SUM(n_c) OVER () AS n, CAST(ceil({p} * SUM(n_c) OVER ()) AS BIGINT) AS n_test
      FROM (SELECT done, COUNT(*) AS n_c FROM {fx.ORDERS_SQL} WHERE done IS NOT NULL GROUP BY done))))"""


@register("j3_stratified_split", f"""SELECT o.o_orderkey, o.done, CASE WHEN o.rn <= q.quota THEN 'test' ELSE 'train' END AS split
FROM (SELECT o_orderkey, done, row_number() OVER (PARTITION BY done ORDER BY {_md5_sql('o_orderkey')}, o_orderkey) AS rn
  FROM {fx.ORDERS_SQL} WHERE done IS NOT NULL) o JOIN {_quota_sql(0.2)} q USING (done)""")
def j3_stratified_split(spark, sf):
    o = fx.orders_t(spark, sf).select("o_orderkey", "done")
    return smp.stratified_split(o, "done", 0.2, ["o_orderkey"])


@register("j3_split_repeated_keys", f"""WITH t AS (SELECT l_returnflag AS cls, COUNT(*) AS n FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY 1),
q AS (SELECT cls, n, (n_test * n) // total AS base, n_test, row_number() OVER (ORDER BY (n_test * n) % total DESC, cls) AS rk
  FROM (SELECT *, SUM(n) OVER () AS total, CAST(ceil(0.2 * SUM(n) OVER ()) AS BIGINT) AS n_test FROM t))
SELECT cls AS l_returnflag, CAST(n AS BIGINT) AS n_rows, CAST(base + CASE WHEN rk <= n_test - SUM(base) OVER () THEN 1 ELSE 0 END AS BIGINT) AS n_test FROM q""")
def j3_split_repeated_keys(spark, sf):
    """Keys repeat in ``lineitem``; the quotas hold all the same."""
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_partkey")
    s = smp.stratified_split(li, "l_returnflag", 0.2, ["l_orderkey", "l_linenumber"])
    return s.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("split") == "test").alias("n_test"))


@register("j4_stratified_folds", f"""SELECT o_orderkey, done, CAST((row_number() OVER (PARTITION BY done
ORDER BY {_md5_sql('o_orderkey')}, o_orderkey) - 1) % 3 AS INTEGER) AS fold FROM {fx.ORDERS_SQL} WHERE done IS NOT NULL""")
def j4_stratified_folds(spark, sf):
    o = fx.orders_t(spark, sf).select("o_orderkey", "done")
    return smp.stratified_folds(o, "done", 3, ["o_orderkey"])


@register("f9_distinct_limit", "SELECT DISTINCT l_returnflag FROM lineitem ORDER BY l_returnflag LIMIT 2")
def f9_distinct_limit(spark, sf):
    return read_table(spark, sf, "lineitem").select("l_returnflag").distinct().orderBy("l_returnflag").limit(2)


@register("h11_abs_fill", f"""SELECT l_orderkey, l_linenumber, abs(l_discount - 0.05) AS discount_gap,
coalesce(ship_hhmm, -1.0) AS ship_filled FROM {fx.WIDE_SQL}""")
def h11_abs_fill(spark, sf):
    w = fx.wide(spark, sf)
    return w.select("l_orderkey", "l_linenumber", F.abs(F.col("l_discount") - 0.05).alias("discount_gap"),
                    F.coalesce(F.col("ship_hhmm"), F.lit(-1.0)).alias("ship_filled"))


@register("i2_frame_transform", f"""SELECT l_linenumber, l_quantity, {_ttm_sql('ship_hhmm')} AS ship_hhmm_minutes,
{_ttm_sql('arr_hhmm')} AS arr_hhmm_minutes FROM {fx.WIDE_SQL}""")
def i2_frame_transform(spark, sf):
    """The frame-level preprocessing steps chained with ``DataFrame.transform``."""
    out = (fx.wide(spark, sf)
           .transform(lambda d: clock.with_minutes(d, fx.WIDE_CLOCK))
           .transform(lambda d: rl.drop_skipped(d, fx.WIDE_SKIP_ADDITIONAL, fx.WIDE_ROLES)[0]))
    return out.select("l_linenumber", "l_quantity", "ship_hhmm_minutes", "arr_hhmm_minutes")
