"""Registered queries, part 4: model, scoring, runs and streams (D14, K3-K9,
K15, K17, L2-L4, A15, M1, M2).

The training set is the reference's shape: a 10,000-row class-balanced
sample (one third positives) of the wide table, 80/20 stratified holdout, 3
trials × 3 folds, 100 rounds.  The run is written once per source
(``plans.stored``); the queries read its tables, and score with the model and
threshold of the best run in the registry.  Scores come from a Catalyst expression; the
scoring queries compare them, row by row, with the node table walked in arrays.
"""

from __future__ import annotations

import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscore.functions import text as tx
from tabscore.operators import boosting as bo
from tabscore.operators import features as feat
from tabscore.operators import metrics as met
from tabscore.operators import model as mdl
from tabscore.operators import roles as rl
from tabscore.operators import runs
from tabscore.operators import sampling as smp
from tabscore.operators import scoring
from tabscore.plans import fixtures as fx
from tabscore.plans import stored
from tabscore.plans.catalog import _FEATURES, register
from tabscore.plans.stored import KEYS
from tabscore.session import work_path
from tabscore.sources import tables as tb
from tabscore.streaming import scoring_stream as st

R6 = fx.sql_round


@register("k3_assemble", f"""SELECT l_orderkey, l_linenumber, l_partkey, {R6('coalesce(ship_hhmm, AVG(ship_hhmm) OVER ())')} AS f0,
{R6('coalesce(arr_hhmm, AVG(arr_hhmm) OVER ())')} AS f1, CAST(ship_hhmm IS NULL AS DOUBLE) AS f2, CAST(arr_hhmm IS NULL AS DOUBLE) AS f3
FROM {fx.WIDE_SQL}""")
def k3_assemble(spark, sf):
    from pyspark.ml import Pipeline
    w = fx.wide(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "ship_hhmm", "arr_hhmm")
    stages = feat.assembler(["ship_hhmm", "arr_hhmm"], impute=True, output="features", strategy="mean")
    out = Pipeline(stages=stages).fit(w).transform(w).withColumn("v", vector_to_array("features"))
    return out.select("l_orderkey", "l_linenumber", "l_partkey", *[tx.round6(F.col("v")[i]).alias(f"f{i}") for i in range(4)])


@register("k4_categorical", """SELECT l_orderkey, l_linenumber, l_partkey,
CAST(CASE l_linestatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS DOUBLE) AS l_linestatus__idx,
CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 ELSE 3 END AS DOUBLE) AS l_returnflag__idx,
CAST(l_linestatus = 'F' AS DOUBLE) AS is_f, CAST(l_linestatus = 'O' AS DOUBLE) AS is_o
FROM lineitem""")
def k4_categorical(spark, sf):
    from pyspark.ml import Pipeline
    li = tb.read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_linestatus", "l_returnflag")
    stages = feat.categorical_stages(["l_returnflag"], ["l_linestatus"])
    out = Pipeline(stages=stages).fit(li).transform(li)
    hot = next(s for s in stages if s.hasParam("outputCols") and "OneHot" in type(s).__name__).getOutputCols()[0]
    v = vector_to_array(hot)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_linestatus__idx", "l_returnflag__idx", v[0].alias("is_f"), v[1].alias("is_o"))


@register("k6_gbt_fit")
def k6_gbt_fit(spark, sf):
    """Test rows as the final fit scored them."""
    return spark.read.parquet(f"{stored.trained_run(spark, sf)}/test_scored")


_SPLIT_COLS = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


def _first_split_sql() -> str:
    one = """SELECT '{c}' AS feature, t AS threshold, n AS n_left, nn - n AS n_right, round(gain, 4) AS gain FROM (
  SELECT t, n, nn, g * g / (h + 1) + (gg - g) * (gg - g) / (hh - h + 1) - gg * gg / (hh + 1) AS gain,
    row_number() OVER (ORDER BY gain DESC, t) AS r FROM (
    SELECT t, SUM(n) OVER w AS n, SUM(g) OVER w AS g, SUM(n) OVER w * 0.25 AS h, SUM(n) OVER () AS nn, SUM(g) OVER () AS gg, SUM(n) OVER () * 0.25 AS hh FROM (
      SELECT CAST({c} AS DOUBLE) AS t, COUNT(*) AS n, SUM(0.5 - CAST(returned AS INTEGER)) AS g FROM {w} GROUP BY ALL) WINDOW w AS (ORDER BY t))
  WHERE n < nn) WHERE r = 1"""
    return " UNION ALL ".join(one.format(c=c, w=fx.WIDE_SQL) for c in _SPLIT_COLS)


@register("k6_first_split", _first_split_sql())
def k6_first_split(spark, sf):
    """The best first split of each feature alone: threshold, rows on both sides and gain."""
    w = fx.wide(spark, sf).select(*_SPLIT_COLS, F.col("returned").cast("double").alias("label"))
    rows = []
    for c in _SPLIT_COLS:
        model = bo.HistBoost(inputCols=[c], rounds=1, num_leaves=2, max_depth=1, min_data_in_leaf=1).fit(w)
        top, left, right = (model.nodes[i] for i in (0, 1, 2))
        rows.append((c, top[3], left[9], right[9], round(top[8], 4)))
    return spark.createDataFrame(rows, "feature string, threshold double, n_left long, n_right long, gain double")


@register("k7_two_stage")
def k7_two_stage(spark, sf):
    """The two stages applied to the wide table one after the other: the number of the preprocessor's columns and the classifier's score."""
    num, tgt, _ = stored.feature_names(spark, sf)
    model, _ = stored.best_model(spark, sf)
    rows = fx.wide(spark, sf).select(*KEYS, *[c for c in num if c not in KEYS])
    for stage in model.stages[:-1]:
        rows = stage.transform(rows)
    out = model.stages[-1].transform(rows)
    return out.select(*KEYS, F.size(F.array(*model.stages[-1].getInputCols())).alias("n_features"), "probability")


_Z_COLS = ["l_quantity", "l_extendedprice", "ship_hhmm"]


@register("k7_scaler_stage", f"""SELECT l_orderkey, l_linenumber, l_partkey, {', '.join(f"{R6(f'({c} - m_{c}) / s_{c}')} AS {c}__std" for c in _Z_COLS)}
FROM {fx.WIDE_SQL}, (SELECT {', '.join(f"AVG({c}) AS m_{c}, STDDEV_POP({c}) AS s_{c}" for c in _Z_COLS)} FROM {fx.WIDE_SQL})""")
def k7_scaler_stage(spark, sf):
    """The population scaler as an ML stage: fitted, saved, loaded, and applied by the loaded pipeline."""
    from pyspark.ml import Pipeline, PipelineModel
    w = fx.wide(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", *_Z_COLS)
    path = work_path(spark, "k7")
    Pipeline(stages=mdl.preprocessor(_Z_COLS)).fit(w).write().overwrite().save(path)
    out = PipelineModel.load(path).transform(w)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", *[tx.round6(F.col(c)).alias(c) for c in mdl.scaled(_Z_COLS)])


@register("k8_search")
def k8_search(spark, sf):
    """Scores of every trial and fold."""
    return spark.read.parquet(f"{stored.trained_run(spark, sf)}/fold_scores")


@register("d14_fold_means")
def d14_fold_means(spark, sf):
    t = mdl.fold_means(spark.read.parquet(f"{stored.trained_run(spark, sf)}/fold_scores"))
    best = t.orderBy(F.desc("mean_score"), "trial").first()["trial"]  # a row per trial
    return t.select("trial", "mean_score", (F.col("trial") == best).alias("best"))


def _d14_sql() -> str:
    arms = " UNION ALL ".join(f"""SELECT {t} AS trial, l_orderkey % 3 AS fold, {s} > 0.5 AS p, label = 1 AS y FROM {fx.SCORED_SQL}""" for t, s in enumerate(("score", "score_ties")))
    f2 = "5.0 * COUNT(*) FILTER (p AND y) / (5.0 * COUNT(*) FILTER (p AND y) + 4.0 * COUNT(*) FILTER (y AND NOT p) + COUNT(*) FILTER (p AND NOT y))"
    return f"SELECT trial, {R6('AVG(f2)')} AS mean_score FROM (SELECT trial, fold, {f2} AS f2 FROM ({arms}) GROUP BY trial, fold) GROUP BY trial"


@register("d14_fold_score_means", _d14_sql())
def d14_fold_score_means(spark, sf):
    """Mean over three folds of the F2 of two given scores (the trials)."""
    rows = fx.scored_lines(spark, sf)
    parts = []
    for t, s in enumerate(("score", "score_ties")):
        for f in range(3):
            one = met.fbeta(rows.where(F.col("l_orderkey") % 3 == f), "label", s, 2.0, 0.5, strict=True)
            parts.append(one.select(F.lit(t).alias("trial"), F.lit(f).alias("fold"), F.lit(s).alias("params"), F.col("fbeta").alias("score")))
    return mdl.fold_means(tb.union_all(parts)).select("trial", tx.round6(F.col("mean_score")).alias("mean_score"))


_ALL_KEYS = f"SELECT {', '.join(KEYS)}, TRUE AS by_threshold FROM {fx.WIDE_SQL}"


def _scored(spark, sf, extra=(), only=None):
    """The wide table scored with the best run and its threshold; ``only``: keys of the rows to score, few enough to send to every task."""
    num, _, _ = stored.feature_names(spark, sf)
    model, threshold = stored.best_model(spark, sf)
    rows = fx.wide(spark, sf).select(*KEYS, *[c for c in num if c not in KEYS], *extra)
    if only is not None:
        rows = rows.join(F.broadcast(only), KEYS, "left_semi")
    return scoring.score(rows, model, threshold), threshold


def _walked(scored, model, name="walked"):
    """P(class 1) of every row from the model's node table, walked in arrays batch by batch: the score of the expression, made another way."""
    made, cols = bo.Walk(model.stages[-1].nodes), model.stages[-1].getInputCols()

    @F.pandas_udf("double")
    def walk(x: pd.DataFrame) -> pd.Series:
        return pd.Series(made(x.to_numpy(dtype=float, na_value=float("nan"))))

    rows = scored
    for stage in model.stages[:-1]:
        rows = stage.transform(rows)
    return rows.withColumn(name, walk(F.struct(*cols)))


def _checked(spark, sf, scored):
    """Row identity, and whether probability and prediction are those of the walked node table."""
    model, threshold = stored.best_model(spark, sf)
    rows = _walked(scored, model)
    same = F.abs(F.col("probability") - F.col("walked")) <= 1e-12
    return rows.select(*KEYS, (same & ((F.col("prediction") == 1) == (F.col("walked") >= F.lit(threshold)))).alias("by_threshold"))


@register("k9_predict", _ALL_KEYS)
def k9_predict(spark, sf):
    return _checked(spark, sf, _scored(spark, sf)[0])


# A small ensemble over the wide table: splits at values, at a missing value, and one that sends missing values left.
_ENSEMBLE_COLS = ["l_quantity", "ship_hhmm", "l_discount", "l_extendedprice"]
_ENSEMBLE = [
    (0, 0, 0, 24.5, False, 1, 2, None, 3.0, 0), (0, 1, None, None, None, None, None, -0.4, None, 0), (0, 2, 1, 1200.0, True, 3, 4, None, 2.0, 0),
    (0, 3, None, None, None, None, None, 0.3, None, 0), (0, 4, None, None, None, None, None, 0.1, None, 0),
    (1, 0, 1, float("inf"), False, 1, 2, None, 1.0, 0), (1, 1, 2, 0.05, False, 3, 4, None, 0.5, 0), (1, 2, None, None, None, None, None, 0.6, None, 0),
    (1, 3, None, None, None, None, None, 0.25, None, 0), (1, 4, None, None, None, None, None, -0.15, None, 0),
    (2, 0, 3, 30000.5, True, 1, 2, None, 0.25, 0), (2, 1, None, None, None, None, None, -0.2, None, 0), (2, 2, None, None, None, None, None, 0.05, None, 0),
]
_RAW_SQL = """(CASE WHEN l_quantity <= 24.5e0 THEN -0.4e0 WHEN ship_hhmm IS NULL OR ship_hhmm <= 1200e0 THEN 0.3e0 ELSE 0.1e0 END
+ CASE WHEN ship_hhmm IS NULL THEN 0.6e0 WHEN l_discount <= 0.05e0 THEN 0.25e0 ELSE -0.15e0 END
+ CASE WHEN l_extendedprice IS NULL OR l_extendedprice <= 30000.5e0 THEN -0.2e0 ELSE 0.05e0 END)"""


@register("k9_ensemble_expression", f"SELECT {', '.join(KEYS)}, {R6(f'1e0 / (1e0 + exp(-{_RAW_SQL}))')} AS probability FROM {fx.WIDE_SQL}")
def k9_ensemble_expression(spark, sf):
    """A written-out ensemble, compiled to an expression, over the wide table."""
    model = bo.HistBoostModel(_ENSEMBLE_COLS, _ENSEMBLE)
    return model.transform(fx.wide(spark, sf)).select(*KEYS, tx.round6(F.col("probability")).alias("probability"))


@register("k15_split_counts", f"""SELECT feature_name, splits, gain, visits FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (l_quantity > 24.5e0 OR l_quantity IS NULL) AS high,
  COUNT(ship_hhmm) AS present FROM {fx.WIDE_SQL}), LATERAL (VALUES ('l_quantity', 1, 3.0e0, n), ('ship_hhmm', 2, 3.0e0, high + n), ('l_discount', 1, 0.5e0, present),
  ('l_extendedprice', 1, 0.25e0, n)) t(feature_name, splits, gain, visits)""")
def k15_split_counts(spark, sf):
    """Splits and gain of the written-out ensemble by feature, and the rows that pass them."""
    return bo.split_visits(fx.wide(spark, sf), _ENSEMBLE, _ENSEMBLE_COLS)


@register("k14_tuned_threshold")
def k14_tuned_threshold(spark, sf):
    base = stored.trained_run(spark, sf)
    m = stored.run_table(spark, base, "run_metrics").groupBy("run_id").pivot("key", ["f2_default", "f2_score"]).agg(F.first("value"))
    return stored.run_table(spark, base, "runs").join(m, "run_id").select(
        "optimal_threshold", F.col("f2_default").alias("f2_at_default"), m["f2_score"].alias("f2_at_threshold"))


@register("k15_importances", f"""SELECT c AS feature_name, TRUE AS in_range FROM (VALUES {', '.join(f"('{c}')" for c in _FEATURES)}) t(c)""")
def k15_importances(spark, sf):
    """Every feature has a share of the gain within [0, 1], the shares add up to 1, and its splits are those of the loaded model's nodes."""
    imp = tb.read_csv(spark, f"{stored.best_run(spark, sf)}/feature_importances", "feature_name string, importance double, gain_share double")
    model, _ = stored.best_model(spark, sf)
    off = abs(imp.agg(F.sum("gain_share")).first()[0] - 1)
    nodes = model.stages[-1].node_table(spark).where("left is not null").groupBy(F.regexp_replace("feature_name", "__std$", "").alias("feature_name")).agg(F.count("*").alias("n"))
    same = F.col("importance") == F.coalesce("n", F.lit(0))
    return imp.join(nodes, "feature_name", "left").select("feature_name", (F.col("gain_share").between(0, 1) & same & F.lit(off < 1e-6)).alias("in_range"))


@register("f3_best_of_runs", "SELECT TRUE AS several, TRUE AS is_best, TRUE AS in_registry FROM (SELECT COUNT(*) AS n FROM lineitem)")
def f3_best_of_runs(spark, sf):
    """Two trained runs in the registry; the best is the one with the higher stored metric, and its record is there."""
    base = stored.best_run(spark, sf)
    own = stored.scores(spark).where(F.col("project_name") == stored.project(stored.source_mark(spark, sf, "lineitem")))
    r = own.agg(F.count_distinct("pipeline_uri").alias("n"), F.max("metric_value").alias("top"), F.max(F.when(F.col("pipeline_uri") == f"{base}/model", F.col("metric_value"))).alias("own"))
    kept = stored.run_table(spark, base, "run_artifacts").count()
    return r.select((F.col("n") >= 2).alias("several"), (F.col("top") == F.col("own")).alias("is_best"), F.lit(kept == 4).alias("in_registry"))


@register("k17_run_record", """SELECT * FROM (VALUES ('artifact', 'model'), ('artifact', 'feature_importances'), ('artifact', 'columns_roles'), ('artifact', 'model_metadata'),
('metric', 'f2_score'), ('metric', 'f2_default'), ('param', 'num_leaves'), ('param', 'learning_rate'), ('param', 'max_depth'), ('param', 'min_data_in_leaf'), ('param', 'rounds'),
('param', 'skip_additional_columns'), ('param', 'num_features_used'), ('param', 'optimal_threshold'), ('model_type', 'hist_boost_pipeline'), ('target', 'returned'), ('run', 'threshold agrees')) t(part, "key")""")
def k17_run_record(spark, sf):
    """The run's tables read back: names of artefacts, metrics and parameters, and metadata by column."""
    base = stored.trained_run(spark, sf)
    read = lambda name: stored.run_table(spark, base, name)
    meta, params = read("runs"), read("run_params")
    same = meta.join(params.where("key = 'optimal_threshold'"), "run_id").where(F.col("value").cast("double") == F.col("optimal_threshold"))
    parts = [read("run_artifacts").select(F.lit("artifact").alias("part"), F.col("name").alias("key")), read("run_metrics").select(F.lit("metric"), "key"),
             params.select(F.lit("param"), "key"), meta.select(F.lit("model_type"), "model_type"), meta.select(F.lit("target"), "target_column"),
             same.select(F.lit("run"), F.lit("threshold agrees"))]
    return tb.union_all(parts, by_name=False)


_N_SAMPLE = stored.SAMPLE_SIZE // 3


@register("a15_model_artifact", f"""SELECT n_test, n_test AS n_same FROM (SELECT CAST(ceil(0.2 * (least(count_if(returned), {_N_SAMPLE})
  + least(count_if(NOT returned), {stored.SAMPLE_SIZE - _N_SAMPLE}))) AS BIGINT) AS n_test FROM {fx.WIDE_SQL})""")
def a15_model_artifact(spark, sf):
    """The best run's model, loaded, scores the run's test rows as the run did: all rows of the test part agree."""
    was = spark.read.parquet(f"{stored.best_run(spark, sf)}/test_scored").select(*KEYS, F.col("probability").alias("before"))
    # The run's sample bounds its test rows: their keys go to the wide table, so only its rows of the test part are scored.
    scored, _ = _scored(spark, sf, only=was.select(*KEYS))
    both = was.join(scored.select(*KEYS, "probability"), KEYS, "left")
    return both.agg(F.count(F.lit(1)).alias("n_test"), F.count_if(F.abs(F.col("probability") - F.col("before")) < 1e-9).alias("n_same"))


# L2: JSON records derived from orders; every 97th has text in a number, every
# 89th misses a field, every 83rd has a fraction in an integer field, and all
# carry an extra field (ignored).
RECORD_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderstatus string"


def _records(spark, sf):
    o = tb.read_table(spark, sf, "orders")
    k = F.col("o_orderkey")
    total = F.when(k % 97 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    cust = F.when(k % 83 == 0, F.lit("12.5")).otherwise(F.col("o_custkey").cast("string"))
    m = F.create_map(F.lit("o_orderkey"), k.cast("string"), F.lit("o_totalprice"), total,
                     F.lit("o_orderstatus"), F.col("o_orderstatus"), F.lit("note"), F.lit("extra"))
    full = F.map_concat(m, F.create_map(F.lit("o_custkey"), cust))
    rec = F.when(k % 89 == 0, m).otherwise(full)
    return o.select(F.to_json(rec).alias("value"))


@register("l2_validate", """SELECT o_orderkey, CASE WHEN ok THEN o_custkey END AS o_custkey, CASE WHEN ok THEN o_totalprice END AS o_totalprice,
CASE WHEN ok THEN o_orderstatus END AS o_orderstatus, errors FROM (SELECT *, errors = '' AS ok FROM (SELECT *, concat_ws('; ',
  CASE WHEN o_orderkey % 89 = 0 THEN 'o_custkey: missing' WHEN o_orderkey % 83 = 0 THEN 'o_custkey: not a bigint: 12.5' END,
  CASE WHEN o_orderkey % 97 = 0 THEN 'o_totalprice: not a double: n/a' END) AS errors FROM orders))""")
def l2_validate(spark, sf):
    """Typed values of valid records, and the errors of the others."""
    schema = T._parse_datatype_string(RECORD_SCHEMA)
    valid, rejected = scoring.validate(_records(spark, sf), schema)
    key = F.get_json_object("value", "$.o_orderkey").cast("bigint")
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields[1:]]
    return valid.withColumn("errors", F.lit("")).unionByName(
        rejected.select(key.alias("o_orderkey"), *none, F.array_join("errors", "; ").alias("errors")))


@register("l3_batch_score", _ALL_KEYS)
def l3_batch_score(spark, sf):
    """F3 → load → stored threshold → scores written and read back."""
    scored, _ = _scored(spark, sf)
    path = work_path(spark, "l3")
    scored.write.parquet(path)
    return _checked(spark, sf, spark.read.parquet(path))


@register("l4_sample_rows")
def l4_sample_rows(spark, sf):
    """Rows as a reader of the exported files sees them."""
    num, tgt, _ = stored.feature_names(spark, sf)
    model, threshold = stored.best_model(spark, sf)
    w = fx.wide(spark, sf).where(F.col(tgt).isNotNull())
    pick = smp.random_top(w.select(*KEYS, *[c for c in num if c not in KEYS], tgt), 1000, KEYS)
    scored = scoring.score(pick, model, threshold)
    rows = smp.fallback_sample(scored, "prediction", "probability", tgt, 5, KEYS).drop("probability", "prediction")
    path = work_path(spark, "l4")
    tb.export_rows(rows, "group", path)
    return spark.read.option("header", True).schema(T.StructType([f for f in rows.schema.fields if f.name != "group"])).csv(path)


@register("l1_record_schema_check", f"""SELECT c AS name, 'double' AS spark_type, n FROM (VALUES {', '.join(f"('{c}')" for c in _FEATURES)}) t(c),
(SELECT COUNT(*) AS n FROM lineitem)""")
def l1_record_schema_check(spark, sf):
    """The record schema folded from the stored roles reads the wide table's records: each field's type, and the records that hold it."""
    num, tgt, rt = stored.feature_names(spark, sf)
    schema = rl.struct_from_fields(rl.schema_fields(rt, rl.role_mapping(rt, num + [tgt])))
    recs = fx.wide(spark, sf).select(F.to_json(F.struct(*num)).alias("value"))
    valid, _ = scoring.validate(recs, schema)
    counts = valid.agg(*[F.count(tx.col(f.name)).alias(f.name) for f in schema.fields])
    rows = F.array(*[F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("spark_type"), F.col(f.name).alias("n")) for f in schema.fields])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


#: Batches of the scored stream; their files grow in number with the records.
STREAM_BATCHES = 4


@register("m1_score_stream", f"""SELECT {', '.join(KEYS)}, l_orderkey % 89 <> 0 AS scored FROM {fx.WIDE_SQL}""")
def m1_score_stream(spark, sf):
    """Records as JSON-lines files, every 89th order's without a field: scored and rejected records together are the input's, and scores are
    those of the walked node table."""
    num, _, _ = stored.feature_names(spark, sf)
    model, threshold = stored.best_model(spark, sf)
    w = fx.wide(spark, sf).select(*KEYS, *[c for c in num if c not in KEYS])
    in_dir = work_path(spark, "m1_in")
    missing = F.when(F.col("l_orderkey") % 89 != 0, F.col("l_quantity")).alias("l_quantity")
    lines = w.select(F.to_json(F.struct(*[missing if c == "l_quantity" else c for c in w.columns])).alias("value"))
    files = max(STREAM_BATCHES, lines.rdd.getNumPartitions())
    lines.repartition(files).write.text(in_dir)
    out, rejected, ck = work_path(spark, "m1_out"), work_path(spark, "m1_rejected"), work_path(spark, "m1_ck")
    q = st.score_stream(spark, in_dir, w.schema, model, out, rejected, ck, threshold, max_files_per_trigger=-(-files // STREAM_BATCHES))
    q.awaitTermination()
    kinds = {f.name: f.dataType for f in w.schema.fields}
    back = spark.read.parquet(rejected).select(*[F.get_json_object("value", f"$.{k}").cast(kinds[k]).alias(k) for k in KEYS], F.lit(False).alias("scored"))
    right = (F.abs(F.col("probability") - F.col("walked")) <= 1e-12) & ((F.col("prediction") == 1) == (F.col("walked") >= F.lit(threshold)))
    return _walked(spark.read.parquet(out), model).select(*KEYS, right.alias("scored")).unionByName(back)


@register("m2_metrics_stream", f"SELECT event_type, COUNT(*) AS n, {R6('AVG(value)')} AS mean_value, MAX(value) AS max_value FROM events GROUP BY event_type")
def m2_metrics_stream(spark, sf):
    e = tb.read_table(spark, sf, "events")
    src_dir = work_path(spark, "m2_in")
    e.repartition(4).write.mode("overwrite").parquet(src_dir)
    out = work_path(spark, "m2_out")
    for run in ("first", "second"):  # two runs with checkpoints of their own append to one table
        src = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(src_dir)
        st.metrics_stream(spark, src, out, work_path(spark, "m2_ck"), ["event_type"], "value", run_id=run, project="events").awaitTermination()
    both = st.merged_metrics(st.read_sink(spark, out))
    one, two = (both.where(F.col("run_id") == r) for r in ("first", "second"))
    kept = one.join(two.select("grp", F.col("n").alias("again")), "grp").where(F.col("n") == F.col("again"))
    return kept.select(F.col("grp").alias("event_type"), "n", tx.round6(F.col("mean_value")).alias("mean_value"), "max_value")
