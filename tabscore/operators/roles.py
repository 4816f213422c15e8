"""Column roles (B1, B2, B9, B14, C1, C2, D17 lookup, K16, L1).

A role configuration is a mapping ``{role: [column, ...]}``.  It becomes a
small table (one row per listed column), inverted with "later role wins", and
left-joined onto a profile.  Its size is bounded by the number of listed
names, so broadcasting it is safe.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROLE_KEYS = ("num", "cat", "hot", "tgt", "dat")
DEFAULT = "unk"


def lists_table(spark: SparkSession, lists: Mapping[str, Sequence[str]], value_name: str) -> DataFrame:
    """``{value: [columns]}`` → ``(Column_Name, <value_name>, _ord)`` rows; the
    ordinal is the position in the mapping's iteration order."""
    rows, i = [], 0
    for value, cols in lists.items():
        for c in cols:
            rows.append((c, value, i))
            i += 1
    schema = T.StructType([T.StructField("Column_Name", T.StringType()),
                           T.StructField(value_name, T.StringType()),
                           T.StructField("_ord", T.IntegerType())])
    return spark.createDataFrame(rows, schema)


def invert(spark: SparkSession, lists: Mapping[str, Sequence[str]], value_name: str) -> DataFrame:
    """Column → value; a column listed more than once takes the value it
    was listed with last."""
    t = lists_table(spark, lists, value_name)
    return t.groupBy("Column_Name").agg(F.max_by(value_name, "_ord").alias(value_name))


def assign_roles(profile: DataFrame, roles: Mapping[str, Sequence[str]],
                 skip_reasons: Mapping[str, Sequence[str]] | None = None,
                 leakage: Mapping[str, Sequence[str]] | None = None,
                 default: str = DEFAULT) -> DataFrame:
    """Profile + ``Role``, ``Skip_reason_phik``, ``Data_leakage`` (default
    ``'unk'``)."""
    spark = profile.sparkSession
    out = profile
    for lists, name in ((roles, "Role"), (skip_reasons or {}, "Skip_reason_phik"),
                        (leakage or {}, "Data_leakage")):
        inv = invert(spark, lists, name)
        out = (out.join(F.broadcast(inv), "Column_Name", "left")
                  .withColumn(name, F.coalesce(F.col(name), F.lit(default))))
    return out


def columns_by_role(role_table: DataFrame, role: str = "num", skip: Iterable[str] = (),
                    order_col: str | None = None, sort_names: bool = False) -> list[str]:
    """B1: names with ``Role = role`` in table order (or sorted by name), minus
    ``skip``.  The role table has one row per source column."""
    skip = set(skip)
    t = role_table.where(F.col("Role") == role)
    if order_col:
        t = t.orderBy(order_col)
    names = [r["Column_Name"] for r in t.select("Column_Name", *([order_col] if order_col else [])).collect()]
    if sort_names:
        names = sorted(names)
    return [n for n in names if n not in skip]


def target_column(role_table: DataFrame, order_col: str | None = None) -> str:
    """B1: the first column with role ``tgt``."""
    names = columns_by_role(role_table, "tgt", order_col=order_col)
    if not names:
        raise ValueError("no column has role 'tgt'")
    return names[0]


def role_map(role_table: DataFrame, order_col: str | None = None) -> dict[str, list[str]]:
    """B1: ``{role: [names sorted]}`` with all five keys present."""
    return {k: columns_by_role(role_table, k, order_col=order_col, sort_names=True) for k in ROLE_KEYS}


def drop_skipped(df: DataFrame, skip: Iterable[str], roles: Mapping[str, Sequence[str]]
                 ) -> tuple[DataFrame, dict[str, list[str]]]:
    """B2: drop skip columns from the frame (absent names ignored) and from
    every role list."""
    skip = list(skip)
    kept = {k: [c for c in cols if c not in set(skip)] for k, cols in roles.items()}
    return df.drop(*[c for c in skip if c in df.columns]), kept


def flagged(role_table: DataFrame, flag_cols: Sequence[str] = ("Skip_reason_phik", "Phik_high_target", "Data_leakage"),
            default: str = DEFAULT) -> DataFrame:
    """Rows where any flag column differs from the default."""
    cond = F.lit(False)
    for c in flag_cols:
        cond = cond | (F.col(c) != F.lit(default))
    return role_table.where(cond)


def skip_table(role_table: DataFrame, extra: Mapping[str, Sequence[str]] | None = None,
               flag_cols: Sequence[str] = ("Skip_reason_phik", "Data_leakage"),
               default: str = DEFAULT) -> DataFrame:
    """One ``(Column_Name, reason)`` table from the flag columns and extra
    lists (e.g. post-event columns), one row per column and reason."""
    spark = role_table.sparkSession
    parts = []
    for c in flag_cols:
        parts.append(role_table.where(F.col(c) != F.lit(default))
                     .select("Column_Name", F.concat(F.lit(c + ":"), F.col(c)).alias("reason")))
    if extra:
        t = lists_table(spark, extra, "reason").select("Column_Name", F.concat(F.lit("config:"), F.col("reason")).alias("reason"))
        parts.append(t)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def role_mapping(role_table: DataFrame, used: Iterable[str], order_col: str = "ordinal") -> DataFrame:
    """``(ordinal, column, role)`` for the used columns, in table order."""
    used = list(used)
    return (role_table.where(F.col("Column_Name").isin(used))
            .select(F.col(order_col).cast("int").alias("ordinal"), F.col("Column_Name").alias("column"),
                    F.col("Role").alias("role")))


# Profile type name → record field type.
FIELD_TYPES = {"INTEGER": "bigint", "FLOAT": "double", "STRING": "string",
               "BOOLEAN": "boolean", "TIMESTAMP": "timestamp"}


def schema_fields(role_table: DataFrame, mapping: DataFrame) -> DataFrame:
    """L1: the scoring-record fields: columns of the role mapping except the
    target, in profile order, with a Spark type per profile type (unknown →
    string); all required."""
    m = mapping.where(F.col("role") != "tgt").select(F.col("column").alias("Column_Name"))
    tmap = F.create_map(*[x for k, v in FIELD_TYPES.items() for x in (F.lit(k), F.lit(v))])
    return (role_table.join(F.broadcast(m), "Column_Name", "left_semi")
            .select(F.col("ordinal").cast("int").alias("ordinal"), F.col("Column_Name").alias("name"),
                    F.coalesce(F.element_at(tmap, F.col("Data_Type")), F.lit("string")).alias("spark_type"),
                    F.lit(True).alias("required")))


def struct_from_fields(fields: DataFrame) -> T.StructType:
    """L1: fold the field table (bounded by the column count) into a schema."""
    rows = fields.orderBy("ordinal").collect()
    return T.StructType([T.StructField(r["name"], T._parse_datatype_string(r["spark_type"]), True)
                         for r in rows])
