"""Run stamps.  ISO-8601 UTC text of an instant and date-stamped
output folders, as Column expressions (the session time zone is UTC).

The run date is a job argument; ``current_timestamp()`` is only the default,
so a re-run of a failed job writes to the same folder.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tabscore.functions.text import col


def iso_utc(c: Column | str) -> Column:
    """Text like Python's ``datetime.isoformat()`` of an aware UTC instant:
    ``2024-01-01T00:00:07.179575+00:00``, with the fraction only when it is
    not zero."""
    t = col(c) if isinstance(c, str) else c
    frac = F.date_format(t, "SSSSSS")
    return F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(frac == "000000", F.lit("")).otherwise(F.concat(F.lit("."), frac)),
                    F.lit("+00:00"))


def now_iso() -> Column:
    """ISO text of the query's start instant (one value per query)."""
    return iso_utc(F.current_timestamp())


def dated_dir(base: str, c: Column | str) -> Column:
    """``<base>/<yyyy-MM-dd>`` for an instant or date column."""
    t = col(c) if isinstance(c, str) else c
    return F.concat(F.lit(base.rstrip("/") + "/"), F.date_format(t, "yyyy-MM-dd"))


def run_date(spark: SparkSession, arg: str | None = None) -> str:
    """The job's run date: the argument when given, else today's UTC date."""
    if arg:
        return arg
    return spark.range(1).select(F.date_format(F.current_date(), "yyyy-MM-dd")).first()[0]
