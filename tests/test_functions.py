"""Clock conversion (H1-H4, I1) and value text (D1) edge cases."""

import pytest
from pyspark.sql import functions as F

from tabscore.functions import clock
from tabscore.functions import text as tx

CLOCK_CASES = [(None, None), (0.0, 0), (5.0, 5), (959.0, 599), (2359.0, 1439), (2400.0, 0),
               (2401.0, None), (-5.0, None), (2365.0, None), (1230.5, 751), (1229.4, 749),
               (float("nan"), None), (-0.4, 0), (2399.6, 0)]


def test_time_to_minutes_edges(spark):
    df = spark.createDataFrame([(v,) for v, _ in CLOCK_CASES], "t double")
    got = [r["m"] for r in df.select(clock.time_to_minutes("t").alias("m")).collect()]
    assert got == [m for _, m in CLOCK_CASES]


def test_sql_function_matches_column_form(spark):
    clock.register_sql_functions(spark)
    df = spark.createDataFrame([(v,) for v, _ in CLOCK_CASES], "t double")
    df.createOrReplaceTempView("clock_cases")
    got = [r["m"] for r in spark.sql("SELECT time_to_minutes(t) AS m FROM clock_cases").collect()]
    assert got == [m for _, m in CLOCK_CASES]


def test_strict_raises_on_invalid(spark):
    df = spark.createDataFrame([(2400.0,)], "t double")
    with pytest.raises(Exception):
        df.select(clock.time_to_minutes("t", strict=True)).collect()
    ok = spark.createDataFrame([(1230.0,)], "t double").select(clock.time_to_minutes("t", strict=True)).first()[0]
    assert ok == 750


def test_clock_via_parse(spark):
    df = spark.createDataFrame([(0.0,), (959.0,), (2359.0,)], "t double")
    assert [r[0] for r in df.select(clock.clock_via_parse("t")).collect()] == [0, 599, 1439]


def test_blocks(spark):
    df = spark.createDataFrame([("0600-0659",), ("2300-2400",), ("0600",), (None,)], "blk string")
    out = clock.with_block_minutes(df, ["blk"]).collect()
    assert [(r.blk_minutes_start, r.blk_minutes_finish, r.blk_minutes_elapsed) for r in out] == [
        (360, 419, 59), (1380, 0, -1380), (360, None, None), (None, None, None)]
    with pytest.raises(Exception):
        clock.with_block_minutes(df.where(F.col("blk") == "0600"), ["blk"], strict=True).collect()


def test_double_text(spark):
    df = spark.createDataFrame([(316.0,), (0.04,), (-2.0,), (1e7,), (914.44,)], "x double")
    got = [r[0] for r in df.select(tx.double_text(F.col("x"))).collect()]
    assert got == ["316", "0.04", "-2", "10000000", "914.44"]
