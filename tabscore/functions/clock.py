"""Clock-time conversion: ``hhmm`` numbers and ``'hhmm-hhmm'`` blocks to
minutes after midnight (H1-H4), as Column expressions and as a SQL function
(I1).  All of it is Catalyst expressions: no Python worker is involved.

Rules for ``hhmm`` (a double):
  NULL → NULL; the value is first rounded half away from zero to a whole
  number t; t = 2400 → 0; t < 0 or t > 2400 → NULL; t mod 100 ≥ 60 → NULL;
  else floor(t / 100) * 60 + t mod 100.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscore.functions.text import col


def round_half_away(t: Column) -> Column:
    """Round a double to a whole number (bigint), halves away from zero (the
    warehouse's FLOAT → INT cast), in plain arithmetic: ``t - floor(t)`` is
    exact, so the comparison with 0.5 is too.  Callers keep ``t`` inside the
    clock domain first, where halves away from zero and halves up agree
    except below zero, and (-0.5, 0) rounds to 0 either way."""
    fl = F.floor(t)
    return fl + F.when(t - fl >= 0.5, F.lit(1)).otherwise(F.lit(0))


def time_to_minutes(c: Column | str, strict: bool = False) -> Column:
    """H1 (lenient, invalid → NULL) or H4 (``strict=True``: invalid raises).

    Written so the rounded value is referenced only a few times: the
    generated code stays small enough for the JIT (an earlier form that
    repeated the rounding in every branch ran 10x slower inside whole-stage
    codegen)."""
    t = (col(c) if isinstance(c, str) else c).cast("double")
    r = round_half_away(t)
    outside = F.isnan(t) | (t <= -0.5) | (t >= 2400.5)   # rounds below 0 or above 2400
    value = ((r / 100).cast("bigint") * 60 + r % 100).cast("bigint")
    if strict:
        err = F.raise_error(F.concat(F.lit("invalid clock value: "), t.cast("string"))).cast("bigint")
        return (F.when(t.isNull(), F.lit(None).cast("bigint"))
                 .when(outside, err)
                 .when((r == 2400) | (r % 100 >= 60), err)
                 .otherwise(value))
    return (F.when(t.isNull() | outside, F.lit(None).cast("bigint"))
             .when(r == 2400, F.lit(0).cast("bigint"))
             .when(r % 100 >= 60, F.lit(None).cast("bigint"))
             .otherwise(value))


def clock_via_parse(c: Column | str) -> Column:
    """H4 literal form: ``format '%02d:%02d'`` → parse as time → hour*60+minute.
    Raises (ANSI) for hour 24 or minutes ≥ 60, like the warehouse's PARSE_TIME."""
    t = (col(c) if isinstance(c, str) else c).cast("double")
    ti = F.round(t).cast("bigint")
    txt = F.when(ti.isNotNull(), F.format_string("%02d:%02d", F.floor(ti / 100).cast("bigint"), F.pmod(ti, F.lit(100))))
    ts = F.to_timestamp(txt, "HH:mm")
    return (F.hour(ts) * 60 + F.minute(ts)).cast("bigint")


def with_minutes(df: DataFrame, columns: list[str], suffix: str = "_minutes",
                 strict: bool = False) -> DataFrame:
    """H2: add ``<col>_minutes`` beside each clock column."""
    return df.withColumns({c + suffix: time_to_minutes(c, strict) for c in columns})


def block_minutes(c: Column | str, strict: bool = False) -> tuple[Column, Column, Column]:
    """H3: ``'0600-0659'`` → (start, finish, elapsed) minutes.  Over-midnight
    blocks keep a negative elapsed.  Lenient: a missing or bad part → NULL;
    strict: raises."""
    blk = col(c) if isinstance(c, str) else c
    parts = F.split(blk, "-")
    if strict:
        a, b = F.element_at(parts, 1).cast("double"), F.element_at(parts, 2).cast("double")
    else:
        a = F.get(parts, 0).try_cast("double")
        b = F.get(parts, 1).try_cast("double")
    start, finish = time_to_minutes(a, strict), time_to_minutes(b, strict)
    return start, finish, finish - start


def with_block_minutes(df: DataFrame, columns: list[str], strict: bool = False) -> DataFrame:
    """H3 for several block columns: ``<col>_minutes_start/_finish/_elapsed``."""
    out = {}
    for c in columns:
        s, f, e = block_minutes(c, strict)
        out[c + "_minutes_start"] = s
        out[c + "_minutes_finish"] = f
        out[c + "_minutes_elapsed"] = e
    return df.withColumns(out)


TIME_TO_MINUTES_SQL = """
CREATE OR REPLACE TEMPORARY FUNCTION time_to_minutes(t DOUBLE) RETURNS BIGINT RETURN
  CASE
    WHEN t IS NULL OR isnan(t) OR t <= -0.5 OR t >= 2400.5 THEN NULL
    WHEN floor(t) + IF(t - floor(t) >= 0.5, 1, 0) = 2400 THEN 0
    WHEN (floor(t) + IF(t - floor(t) >= 0.5, 1, 0)) % 100 >= 60 THEN NULL
    ELSE (floor(t) + IF(t - floor(t) >= 0.5, 1, 0)) DIV 100 * 60
         + (floor(t) + IF(t - floor(t) >= 0.5, 1, 0)) % 100
  END
"""


def register_sql_functions(spark: SparkSession) -> None:
    """``time_to_minutes(t)`` as a session SQL function (inlined by
    Catalyst, so codegen and constant folding apply)."""
    spark.sql(TIME_TO_MINUTES_SQL)
