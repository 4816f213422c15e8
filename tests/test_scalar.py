"""Scalar functions (H8 casts, H12 stamps), row-aligned label frame (C4) and
the metric evaluator (I3)."""

import datetime as dt

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabscore.functions import stamps
from tabscore.functions import text as tx
from tabscore.operators import features, metrics, model

HALF_CASES = [(None, None), (0.0, 0), (0.4, 0), (0.5, 1), (1.5, 2), (2.5, 3), (-0.5, -1),
              (-2.5, -3), (-2.4, -2), (425192.5, 425193), (0.49999999999999994, 0), (7.0, 7)]


def test_int_half_away(spark):
    df = spark.createDataFrame([(v,) for v, _ in HALF_CASES], "x double")
    got = [r["i"] for r in df.select(tx.int_half_away(F.col("x")).alias("i")).collect()]
    assert got == [i for _, i in HALF_CASES]


def test_int_half_away_overflow_raises(spark):
    df = spark.createDataFrame([(1e30,)], "x double")
    with pytest.raises(Exception):
        df.select(tx.int_half_away(F.col("x"))).collect()


def test_iso_utc_matches_python(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    vals = [dt.datetime(2024, 1, 1, 0, 0, 7, 179575), dt.datetime(2024, 3, 9, 23, 59, 59),
            dt.datetime(2024, 12, 31, 1, 2, 3, 5)]
    df = spark.createDataFrame([(v,) for v in vals], "t timestamp_ntz")
    rows = df.select(stamps.iso_utc("t").alias("s"), stamps.dated_dir("results/", "t").alias("d")).collect()
    want = [v.replace(tzinfo=dt.timezone.utc).isoformat() for v in vals]
    assert [r["s"] for r in rows] == want
    assert [r["d"] for r in rows] == ["results/" + v.strftime("%Y-%m-%d") for v in vals]


def test_run_date_argument_wins(spark):
    assert stamps.run_date(spark, "2024-05-06") == "2024-05-06"
    assert len(stamps.run_date(spark)) == 10


def test_xy_frame_keeps_rows_aligned(spark):
    df = spark.createDataFrame([(i, float(i) * 2, i % 3 == 0) for i in range(50)], "k long, x double, y boolean")
    out = features.xy_frame(df.repartition(7), ["x"], "y", keys=["k"])
    assert out.columns == ["k", "x", "label"]
    assert all(r["x"] == r["k"] * 2 and r["label"] == int(r["k"] % 3 == 0) for r in out.collect())


def test_evaluator_frame_equals_composite(spark):
    rows = [(i % 2, (i * 37 % 101) / 101.0) for i in range(400)]
    s = spark.createDataFrame(rows, "label int, p1 double")
    want = metrics.composite(s, "label", "p1").first()
    scored = s.select("label", array_to_vector(F.array(1.0 - F.col("p1"), F.col("p1"))).alias("probability"))
    ev = model.CompositeEvaluator()
    got = ev.frame(scored).first()
    assert got["composite"] == pytest.approx(want["composite"], abs=1e-12)
    assert ev.evaluate(scored) == pytest.approx(want["composite"], abs=1e-12)
