"""Value-to-text rules shared by the profile, samples and exports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Warehouse type names used in the profile's Data_Type column.
TYPE_NAMES = {
    "integer": "INTEGER",
    "float": "FLOAT",
    "numeric": "NUMERIC",
    "string": "STRING",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "date": "DATE",
}

NUMERIC_TYPE_NAMES = ("INTEGER", "FLOAT", "NUMERIC")


def type_name(dt: T.DataType) -> str:
    """Warehouse type name of a Spark type (INTEGER, FLOAT, STRING, ...)."""
    if isinstance(dt, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return TYPE_NAMES["integer"]
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return TYPE_NAMES["float"]
    if isinstance(dt, T.DecimalType):
        return TYPE_NAMES["numeric"]
    if isinstance(dt, T.StringType):
        return TYPE_NAMES["string"]
    if isinstance(dt, T.BooleanType):
        return TYPE_NAMES["boolean"]
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return TYPE_NAMES["timestamp"]
    if isinstance(dt, T.DateType):
        return TYPE_NAMES["date"]
    return dt.simpleString().upper()


def is_numeric_name(name: str) -> bool:
    return name in NUMERIC_TYPE_NAMES


def quote(name: str) -> str:
    """Backtick-quote a column name for ``F.col`` / SQL text."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quote(name))


def double_text(c: Column) -> Column:
    """Doubles print like the warehouse: integral values without ``.0``."""
    integral = (c == F.floor(c)) & (F.abs(c) < F.lit(1e15))
    return F.when(integral, c.cast("bigint").cast("string")).otherwise(c.cast("string"))


def value_text(c: Column, dt: T.DataType) -> Column:
    """Text form of a typed value (min/max/sample strings)."""
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return double_text(c.cast("double"))
    if isinstance(dt, T.BooleanType):
        return F.when(c, F.lit("true")).when(~c, F.lit("false"))
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        # Session time zone is UTC; the +00 offset is written as a literal so
        # that timestamp and timestamp_ntz print alike.
        return F.concat(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit("+00"))
    if isinstance(dt, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    return c.cast("string")


def round6(c: Column, digits: int | None = 6) -> Column:
    """Stable rounding for cross-engine comparison: ``round(x + 1e-9, d)``."""
    if digits is None:
        return c
    return F.round(c + F.lit(1e-9), digits)


def strip_prefix(c: Column, prefix: str) -> Column:
    """Remove a leading scheme/prefix (``gs://`` and the like)."""
    import re
    return F.regexp_replace(c, "^" + re.escape(prefix), "")


def int_half_away(c: Column) -> Column:
    """H8: the warehouse's FLOAT → INT cast, which rounds halves away from
    zero (Spark's own cast truncates).  ``|x| - floor(|x|)`` is exact, so the
    half test is too; ANSI mode raises on overflow, as the warehouse does."""
    a = F.abs(c)
    fl = F.floor(a)
    whole = fl + F.when(a - fl >= 0.5, F.lit(1)).otherwise(F.lit(0))
    return F.when(c < 0, -whole).otherwise(whole).cast("bigint")
