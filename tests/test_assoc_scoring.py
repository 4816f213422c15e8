"""Association (D10, D15-D18), validation (L2) and the streaming form (M2)."""

import numpy as np
import pytest
from pyspark.sql import types as T

from tabscore.operators import assoc, scoring


def test_phik_bounds():
    rng = np.random.default_rng(0)
    indep = np.outer([100, 200, 300], [50, 150, 100]).astype(float) / 600
    assert assoc.phik_from_table(indep) == 0.0
    diag = np.diag([300.0, 300.0, 300.0])
    assert assoc.phik_from_table(diag) > 0.95
    noisy = rng.poisson(np.diag([80, 80, 80]) + 20).astype(float)
    assert 0.0 < assoc.phik_from_table(noisy) < 1.0


def test_chi2_and_cramers_v_against_numpy(spark):
    rows = [("a", "x")] * 30 + [("a", "y")] * 10 + [("b", "x")] * 5 + [("b", "y")] * 25
    df = spark.createDataFrame(rows, "u string, v string")
    t = assoc.chi2_table(assoc.contingency(df, [], ["u", "v"])).first()
    obs = np.array([[30, 10], [5, 25]], dtype=float)
    exp = np.outer(obs.sum(1), obs.sum(0)) / obs.sum()
    chi2 = ((obs - exp) ** 2 / exp).sum()
    assert t["chi2"] == pytest.approx(chi2) and t["cramers_v"] == pytest.approx(np.sqrt(chi2 / 70))


def test_histogram_constant_and_density(spark):
    df = spark.createDataFrame([(True, 1.0), (True, 1.0), (False, 1.0)], "y boolean, x double")
    h = assoc.class_histogram(df, ["x"], "y", bins=10).collect()
    assert all(r["bin"] == 0 for r in h)
    assert {r["class"]: r["density"] for r in h} == {True: 1.0, False: 1.0}


SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType())])


def test_validate_negative_cases(spark):
    recs = spark.createDataFrame([('{"a": 1, "b": 2.5}',), ('{"a": 1}',), ('{"a": "x", "b": 1}',),
                                  ('{"a": 12.5, "b": 1}',), ('{"a": 2, "b": 3, "c": 9}',), ("not json",)],
                                 "value string")
    valid, rejected = scoring.validate(recs, SCHEMA)
    assert sorted(tuple(r) for r in valid.collect()) == [(1, 2.5), (2, 3.0)]
    errs = [r["errors"] for r in rejected.collect()]
    assert len(errs) == 4 and all(errs)
    with pytest.raises(ValueError):
        scoring.validate(recs, SCHEMA, fail_fast=True)


def test_metrics_stream_idempotent_total(spark, tmp_path):
    from pyspark.sql import functions as F
    from tabscore.streaming.scoring_stream import metrics_stream
    src_dir = str(tmp_path / "in")
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("v"))
    df.repartition(4).write.parquet(src_dir)
    src = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src_dir)
    out = str(tmp_path / "out")
    q = metrics_stream(spark, src, out, str(tmp_path / "ck"), ["g"], "v")
    q.awaitTermination()
    from tabscore.streaming.scoring_stream import merged_metrics, read_sink
    got = {r.grp: r.n for r in merged_metrics(read_sink(spark, out)).collect()}
    assert got == {"0": 34, "1": 33, "2": 33}


def test_sinks_keep_runs_apart_and_replace_replayed_batches(spark, tmp_path):
    from tabscore.operators.runs import RUN_METRICS_SCHEMA, top_runs
    from tabscore.streaming import scoring_stream as st
    src_dir, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(60).selectExpr("id % 2 AS g", "cast(id AS double) AS v").repartition(3).write.parquet(src_dir)
    schema = spark.read.parquet(src_dir).schema

    def run(name, ck):
        src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src_dir)
        st.metrics_stream(spark, src, out, str(tmp_path / ck), ["g"], "v", run_id=name, project="p").awaitTermination()
    run("1", "ck1")
    run("2", "ck2")
    want = {(r, g): (30, 29.0 + int(g), 58.0 + int(g)) for r in "12" for g in "01"}

    def totals():
        return {(r.run_id, r.grp): (r.n, round(r.mean_value, 6), r.max_value) for r in st.merged_metrics(st.read_sink(spark, out)).collect()}
    assert totals() == want
    # a lost checkpoint replays all batches of run 2: they replace their rows
    run("2", "ck3")
    assert totals() == want
    rows = st.read_sink(spark, out)
    assert [f.name for f in RUN_METRICS_SCHEMA.fields] == rows.columns[:6]
    assert top_runs(rows, "p", "0/max", 1).first().metric_value == 58.0


def test_score_stream_splits_valid_and_rejected(spark, tmp_path):
    """M1 with a rejected sink: every record lands once, valid ones scored,
    invalid ones kept with their errors."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.sql import types as T

    from tabscore.streaming.scoring_stream import score_stream
    train = spark.createDataFrame([(float(i), float(i % 2)) for i in range(40)], "x double, label double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"),
                             LogisticRegression(maxIter=5)]).fit(train)
    src = tmp_path / "in"
    src.mkdir()
    for part in range(3):
        lines = [f'{{"k": {part * 10 + i}, "x": {i}.5}}' for i in range(5)] + [f'{{"k": {part}, "x": "bad"}}', "not json"]
        (src / f"p{part}.json").write_text("\n".join(lines) + "\n")
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("x", T.DoubleType())])
    out, rej = str(tmp_path / "out"), str(tmp_path / "rej")
    q = score_stream(spark, str(src), schema, model, out, rej, str(tmp_path / "ck"), 0.5, max_files_per_trigger=1)
    q.awaitTermination()
    scored = spark.read.parquet(out)
    assert scored.count() == 15 and {"probability", "prediction"} <= set(scored.columns)
    again = score_stream(spark, str(src), schema, model, out, rej, str(tmp_path / "ck2"), 0.5, max_files_per_trigger=2, run_id="later")
    again.awaitTermination()
    assert {r.run_id: r["count"] for r in spark.read.parquet(out).groupBy("run_id").count().collect()} == {"stream": 15, "later": 15}
    rej_all = spark.read.parquet(rej)
    assert rej_all.count() == 12
    rejected = rej_all.where("run_id = 'stream'").collect()
    assert len(rejected) == 6 and all(len(r["errors"]) == 1 for r in rejected)


def test_log_run_appends(spark, tmp_path):
    from tabscore.operators import runs
    root = str(tmp_path / "runs")
    for i in range(2):
        rec = runs.run_record(spark, f"r{i}", {"depth": 4}, {"f2_score": 0.5 + i}, {"model": f"m{i}"}, {"k": i})
        paths = runs.log_run(spark, rec, root)
    assert sorted(paths) == ["run_artifacts", "run_metrics", "run_params", "runs"]
    got = sorted((r["run_id"], r["value"]) for r in spark.read.parquet(paths["run_metrics"]).collect())
    assert got == [("r0", 0.5), ("r1", 1.5)]


def test_malformed_json_line_fails_the_read(spark, tmp_path):
    from tabscore.sources import tables as tb
    (tmp_path / "r.json").write_text('{"a": 1, "b": 2.0}\n{"a": 1, "b"\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        tb.read_json(spark, str(tmp_path / "r.json"), "a long, b double").collect()


def test_phik_keeps_the_rest_as_a_category(spark):
    rows = [("a", "b", f"v{i % 300}", "xy"[i % 2], 1 + i % 5) for i in range(1200)]
    ct = spark.createDataFrame(rows, "a string, b string, va string, vb string, n long")
    out = assoc.phik_table(ct, values=10).collect()
    assert len(out) == 1 and 0.0 <= out[0]["phik"] <= 1.0


def test_phik_hand_worked():
    """Two equal halves with correlation r: P(both low) = 1/4 + asin(r) / 2 pi, so the χ² of n rows is
    n (2 asin(r) / pi)²; with the pedestal of one degree of freedom the value comes back."""
    n, r = 100_000, 0.6
    low = n * (0.25 + np.arcsin(r) / (2 * np.pi))
    table = np.array([[low, n / 2 - low], [n / 2 - low, low]])
    chi2 = n * (2 * np.arcsin(r) / np.pi) ** 2
    back = np.sin(np.pi / 2 * np.sqrt((chi2 - 1) / n))
    assert assoc.phik_from_table(table) == pytest.approx(back, abs=1e-6)


def test_histogram_and_samples_with_nan_and_decimals(spark):
    from decimal import Decimal
    from tabscore.operators import profile as prof
    df = spark.createDataFrame([(True, 1.0), (True, float("nan")), (False, 3.0)], "y boolean, x double")
    assert sum(r["n"] for r in assoc.class_histogram(df, ["x"], "y", bins=4).collect()) == 2
    vals = [Decimal(x) for x in ("10", "2.5", "-3", "100.2", "30", "9.1", "4")]
    d = spark.createDataFrame([(v,) for v in vals], "d decimal(10,1)")
    assert prof.sample_values(d).first()["Sample_Values"] == "-3.0, 2.5, 4.0, 9.1, 10.0"
    assert prof.profile(d).first()["Sample_Values"] == prof.profile(d, approx=True).first()["Sample_Values"] == "-3.0, 2.5, 4.0, 9.1, 10.0"


def test_a_record_is_parsed_once(spark, tmp_path):
    """Neither the valid nor the rejected records are parsed again for every field that is checked."""
    spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": "y"}',), ("no",), (None,)], "value string").write.text(str(tmp_path / "in"))
    parts = scoring.validate(spark.read.text(str(tmp_path / "in")), T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())]))
    assert [p._jdf.queryExecution().optimizedPlan().toString().count("from_json(") for p in parts] == [1, 1]
    assert [p.count() for p in parts] == [1, 3]


def test_contingency_of_many_bins_columns_and_kinds(spark):
    """More binned columns than one long holds, and whole numbers, booleans and text, some missing, as categories."""
    import collections
    import math
    import random
    draw = random.Random(5)
    num = [f"x{k}" for k in range(9)]
    rows = [[float(draw.randrange(300)) for _ in num]
            + [draw.choice([None, 3, -4]), draw.choice([None, True, False]), draw.choice([None, "", "u"])] for _ in range(400)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in num) + ", i int, b boolean, s string")
    got = {(r["a"], r["b"], r["va"], r["vb"]): r["n"] for r in assoc.contingency(df, num, ["i", "b", "s"], bins=300).collect()}
    names = [*num, "i", "b", "s"]

    def code(k, v):
        if v is None:
            return None
        if k >= len(num):
            return {True: "true", False: "false"}[v] if isinstance(v, bool) else str(v)
        known = [r[k] for r in rows]
        return str(min(math.floor((v - min(known)) / (max(known) - min(known)) * 300), 299))
    coded = [[code(k, v) for k, v in enumerate(r)] for r in rows]
    want = collections.Counter((names[i], names[j], r[i], r[j]) for r in coded for i in range(len(names)) for j in range(i + 1, len(names)) if r[i] is not None and r[j] is not None)
    assert got == want
