"""Table profile: one row per column (D1-D7), value counts (D8), distinct
values (D11), cardinality split (D12) and row counts (D13).

Plan shape for ``profile`` (two column-pruned reads, no per-column unions):

* one global aggregate with ``count, min, max, avg, stddev_samp`` for every
  column: each task emits one partial row, so the shuffle is one row per task.
  Smallest and largest text are left out of it: Spark has no mutable buffer for
  text, and one such aggregate makes all of them run row by row, uncompiled;
* one ``unpivot`` of all columns to ``(ordinal, typed value)`` followed by a
  ``distinct``, which combines map-side.  The distinct table feeds the distinct
  count and the ends of text columns (a partial ``groupBy(ordinal)``) and the
  five smallest sample values (values stay typed — long, double, time or text —
  until after the distinct, so only distinct values are formatted)
  (``row_number`` limited per column, which Spark runs as a partial
  ``WindowGroupLimit`` before its shuffle).  No column's values ever meet in
  one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscore.functions import text as tx

PROFILE_SCHEMA = T.StructType([
    T.StructField("Column_Name", T.StringType()),
    T.StructField("Data_Type", T.StringType()),
    T.StructField("Min_Value", T.StringType()),
    T.StructField("Max_Value", T.StringType()),
    T.StructField("Unique_Values_Count", T.LongType()),
    T.StructField("Missing_Values_Count", T.LongType()),
    T.StructField("Mean_Value", T.DoubleType()),
    T.StructField("Std_Dev", T.DoubleType()),
    T.StructField("Sample_Values", T.StringType()),
])


def _profiled_fields(df: DataFrame, skip: Iterable[str]) -> list[T.StructField]:
    # Names in the skip list are trimmed: a trailing space must not keep a
    # column in the profile by accident.
    skip_set = {s.strip() for s in skip}
    return [f for f in df.schema.fields if f.name.strip() not in skip_set]


def _stats(df: DataFrame, fields: Sequence[T.StructField], digits: int | None, text_ends: bool = True) -> DataFrame:
    """One-row typed aggregate → one row per column (ordinal, stats...); ``text_ends=False``: text columns without their
    smallest and largest value."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, f in enumerate(fields):
        c = tx.col(f.name)
        aggs.append(F.count(c).alias(f"c{i}"))
        if text_ends or not isinstance(f.dataType, T.StringType):
            aggs += [F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
        if tx.is_numeric_name(tx.type_name(f.dataType)):
            aggs += [F.avg(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"s{i}")]
    one = df.agg(*aggs)
    rows = []
    for i, f in enumerate(fields):
        numeric = tx.is_numeric_name(tx.type_name(f.dataType))
        mean = tx.round6(F.col(f"m{i}"), digits) if numeric else F.lit(None).cast("double")
        std = tx.round6(F.col(f"s{i}"), digits) if numeric else F.lit(None).cast("double")
        lo, hi = ((tx.value_text(F.col(f"{end}{i}"), f.dataType) if f"{end}{i}" in one.columns else F.lit(None).cast("string")) for end in ("lo", "hi"))
        rows.append(F.struct(
            F.lit(i).alias("ordinal"),
            F.lit(f.name).alias("Column_Name"),
            F.lit(tx.type_name(f.dataType)).alias("Data_Type"),
            lo.alias("Min_Value"),
            hi.alias("Max_Value"),
            (F.col("n") - F.col(f"c{i}")).alias("Missing_Values_Count"),
            mean.cast("double").alias("Mean_Value"),
            std.cast("double").alias("Std_Dev"),
        ))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _slot(dt: T.DataType) -> str:
    """Which field of the unpivoted struct carries a column: ``i`` (integral
    and boolean, exact as long), ``x`` (floating point), ``d`` (decimals,
    exact) or ``s`` (text form: strings, timestamps, dates)."""
    if isinstance(dt, (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.BooleanType)):
        return "i"
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return "x"
    if isinstance(dt, T.DecimalType):
        return "d"
    return "s"


def _decimal_slot(fields: Sequence[T.StructField]) -> str:
    """One decimal type that holds every decimal column's values exactly as
    far as 38 digits allow (integer digits first)."""
    kinds = [f.dataType for f in fields if isinstance(f.dataType, T.DecimalType)]
    whole = max([k.precision - k.scale for k in kinds], default=1)
    scale = min(max([k.scale for k in kinds], default=0), 38 - whole)
    return f"decimal({whole + scale},{scale})"


def long_values(df: DataFrame, fields: Sequence[T.StructField] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Unpivot every column to ``(ordinal, i, x, d, s)`` with the value in its
    typed slot (the others NULL); rows with a NULL value are dropped.  Values
    stay typed until after the distinct, so only distinct values are ever
    formatted as text.  ``keep``: columns that stay beside them."""
    fields = list(fields if fields is not None else df.schema.fields)
    packed, wide = [], _decimal_slot(fields)
    for n, f in enumerate(fields):
        c, slot = tx.col(f.name), _slot(f.dataType)
        i = (c.cast("int") if isinstance(f.dataType, T.BooleanType) else c).cast("bigint") if slot == "i" \
            else F.lit(None).cast("bigint")
        x = c.cast("double") if slot == "x" else F.lit(None).cast("double")
        s_ = tx.value_text(c, f.dataType) if slot == "s" else F.lit(None).cast("string")
        d = (c if slot == "d" else F.lit(None)).cast(wide)
        packed.append(F.struct(i.alias("i"), x.alias("x"), d.alias("d"), s_.alias("s")).alias(str(n)))
    return (df.select(*[tx.col(k) for k in keep], *packed).unpivot([tx.col(k) for k in keep], [str(n) for n in range(len(fields))], "ordinal", "p")
            .select(*[tx.col(k) for k in keep], F.col("ordinal").cast("int").alias("ordinal"), "p.i", "p.x", "p.d", "p.s")
            .where(F.col("i").isNotNull() | F.col("x").isNotNull() | F.col("d").isNotNull() | F.col("s").isNotNull()))


def distinct_values(df: DataFrame, fields: Sequence[T.StructField] | None = None) -> DataFrame:
    """Distinct typed ``(ordinal, i, x, d, s)`` per column; combines map-side.  Only the typed slots that a column needs take part,
    as plain columns of one unpivot, and time stamps and dates are formatted when they are distinct."""
    fields = list(fields if fields is not None else df.schema.fields)
    raw = {T.TimestampType: "t", T.TimestampNTZType: "z", T.DateType: "y"}
    types = {"i": "bigint", "x": "double", "d": _decimal_slot(fields), "s": "string", "t": "timestamp", "z": "timestamp_ntz", "y": "date"}
    slot = [raw.get(type(f.dataType), _slot(f.dataType)) for f in fields]
    used = [k for k in types if k in slot]
    columns = [F.lit(None).cast(types[k]).alias(f"no_{k}") for k in used]
    for n, f in enumerate(fields):
        c = tx.col(f.name)
        if slot[n] == "i" and isinstance(f.dataType, T.BooleanType):
            c = c.cast("int")
        c = tx.value_text(c, f.dataType) if slot[n] == "s" else c.cast(types[slot[n]])
        columns += [c.alias(f"c{n}"), F.lit(n).alias(f"n{n}")]
    each = ", ".join(f"(n{n}, {', '.join(f'c{n}' if k == slot[n] else f'no_{k}' for k in used)}) AS a{n}" for n in range(len(fields)))
    # the name column of an unpivot is text, so the number goes along as a value
    long = df.sparkSession.sql(f"SELECT * FROM {{df}} UNPIVOT INCLUDE NULLS ((ordinal, {', '.join(used)}) FOR _name IN ({each}))", df=df.select(*columns))
    found = long.select("ordinal", *used).where(reduce(or_, [F.col(k).isNotNull() for k in used])).distinct()
    text = [F.col("s")] if "s" in used else []
    text += [tx.value_text(F.col(k), kind()) for kind, k in raw.items() if k in used]
    value = {"s": F.coalesce(*text, F.lit(None).cast("string"))} | {k: F.col(k) if k in used else F.lit(None).cast(types[k]) for k in ("i", "x", "d")}
    return found.select("ordinal", *[value[k].alias(k) for k in ("i", "x", "d", "s")])


def _text(fields: Sequence[T.StructField], at: str = ""):
    """Text of a distinct typed value (``at``: the struct that holds it)."""
    i, x, d, s = (F.col(at + c) for c in ("i", "x", "d", "s"))
    bools = [n for n, f in enumerate(fields) if isinstance(f.dataType, T.BooleanType)]
    i_txt = i.cast("string")
    if bools:
        i_txt = F.when(F.col("ordinal").isin(bools), F.when(i == 1, F.lit("true")).otherwise(F.lit("false"))) \
                 .otherwise(i_txt)
    out = F.when(i.isNotNull(), i_txt).when(x.isNotNull(), tx.double_text(x))
    for n, f in enumerate(fields):
        if isinstance(f.dataType, T.DecimalType):
            out = out.when(F.col("ordinal") == n, d.cast(f.dataType).cast("string"))
    return out.otherwise(s)


def _typed_order():
    """Typed order of a column's values: each is in one slot only."""
    return [F.col(c).asc_nulls_last() for c in ("i", "x", "d", "s")]


def _joined(top: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    """``(ordinal, Sample_Values)`` of ranked values ``(ordinal, rn, i, x, d, s)``, a few per column."""
    pairs = F.sort_array(F.collect_list(F.struct("rn", "v")))
    return (top.select("ordinal", "rn", _text(fields).alias("v")).groupBy("ordinal")
            .agg(F.array_join(F.transform(pairs, lambda p: p["v"]), ", ").alias("Sample_Values")))


def column_stats(df: DataFrame, skip: Iterable[str] = (), digits: int | None = None) -> DataFrame:
    """Per column min/max text, missing count, mean and sample std
    from one global aggregate."""
    return _stats(df, _profiled_fields(df, skip), digits)


def sample_values(df: DataFrame, skip: Iterable[str] = (), samples: int = 5) -> DataFrame:
    """The ``samples`` smallest distinct values per column, joined."""
    fields = _profiled_fields(df, skip)
    names = F.array(*[F.lit(f.name) for f in fields])
    top = _smallest(distinct_values(df, fields), samples)
    return (_joined(top, fields).select(F.element_at(names, F.col("ordinal") + 1).alias("Column_Name"), "Sample_Values"))


def _smallest(values: DataFrame, samples: int) -> DataFrame:
    """The smallest distinct values per column with their rank."""
    w = Window.partitionBy("ordinal").orderBy(*_typed_order())
    return values.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= samples)


def smallest_values(df: DataFrame, fields: Sequence[T.StructField], samples: int = 5) -> DataFrame:
    """D6 without a distinct table: ``(ordinal, Sample_Values)`` with the
    ``samples`` smallest distinct values of every column.  A
    ``dense_rank <= samples`` per column in the typed order runs as a partial
    ``WindowGroupLimit`` in every task before the shuffle, so at most
    ``samples`` distinct values per column and task are moved, however many
    distinct values a column has.  Only those values are formatted."""
    w = Window.partitionBy("ordinal").orderBy(*_typed_order())
    top = long_values(df, fields).withColumn("rn", F.dense_rank().over(w)).where(F.col("rn") <= samples).distinct()
    return _joined(top, fields)


def profile(df: DataFrame, skip: Iterable[str] = (), samples: int = 5,
            approx: bool = False, digits: int | None = None,
            keep_ordinal: bool = False) -> DataFrame:
    """One row per column with type, min/max text, distinct and missing
    counts, mean and sample std (numerics only) and the ``samples`` smallest
    distinct values joined with ``', '``."""
    fields = _profiled_fields(df, skip)
    if not fields:
        return df.sparkSession.createDataFrame([], PROFILE_SCHEMA)
    df = df.select(*[tx.col(f.name) for f in fields])
    if approx:
        # No distinct table: nothing data-sized is shuffled.  The states of
        # one part hold a sketch and a few values per column and task.
        states = profile_states(df.withColumn("_part", F.lit(0)), "_part", samples=samples)
        return merge_states(states, fields, samples, digits, keep_ordinal)
    # The ends of text columns come with the distinct counts, so neither the
    # global aggregate runs uncompiled nor a branch reads the input once more.
    dv = distinct_values(df, fields)
    sample_txt = _joined(_smallest(dv, samples), fields)
    uniques = dv.groupBy("ordinal").agg(F.count(F.lit(1)).alias("Unique_Values_Count"), F.min("s").alias("_lo"), F.max("s").alias("_hi"))
    return _assemble(_stats(df, fields, digits, text_ends=False), uniques, sample_txt, keep_ordinal)


def _assemble(stats: DataFrame, uniques: DataFrame, sample_txt: DataFrame,
              keep_ordinal: bool) -> DataFrame:
    """Join the per-column parts (each at most one row per column); ends that ``stats`` lacks come with ``uniques``."""
    out = stats.join(uniques, "ordinal", "left")
    if "_lo" in uniques.columns:
        out = out.withColumns({"Min_Value": F.coalesce("Min_Value", "_lo"), "Max_Value": F.coalesce("Max_Value", "_hi")})
    out = (out.join(sample_txt, "ordinal", "left")
           .select("ordinal", "Column_Name", "Data_Type", "Min_Value", "Max_Value",
                   F.coalesce("Unique_Values_Count", F.lit(0)).cast("bigint").alias("Unique_Values_Count"),
                   F.col("Missing_Values_Count").cast("bigint").alias("Missing_Values_Count"),
                   "Mean_Value", "Std_Dev", "Sample_Values"))
    out = out.orderBy("ordinal")
    return out if keep_ordinal else out.drop("ordinal")


#: log2 of the registers of a stored distinct-count sketch (16,384: a standard error of 0.8 %).
SKETCH_LOG = 14


def profile_states(df: DataFrame, part: str, skip: Iterable[str] = (), samples: int = 5) -> DataFrame:
    """D7 in parts that can be stored and merged: a row per value of ``part`` and column, with count, smallest and largest value,
    mean, sum of squared deviations, a distinct-count sketch and the ``samples`` smallest distinct values; and a row per part
    with ordinal -1 and its number of rows.  A refreshed part is profiled alone and replaces its rows."""
    fields = _profiled_fields(df, [*skip, part])
    long = long_values(df, fields, [part])
    numeric = [n for n, f in enumerate(fields) if tx.is_numeric_name(tx.type_name(f.dataType))]
    x = F.when(F.col("ordinal").isin(numeric), F.coalesce(F.col("i").cast("double"), "x", F.col("d").cast("double")))
    slots = ("i", "x", "d", "s")
    state = long.groupBy(tx.col(part), "ordinal").agg(
        F.count(F.lit(1)).alias("n"), F.struct(*[F.min(c).alias(c) for c in slots]).alias("lo"), F.struct(*[F.max(c).alias(c) for c in slots]).alias("hi"),
        F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2"), F.hll_sketch_agg(F.xxhash64(*slots), SKETCH_LOG).alias("sketch"))
    w = Window.partitionBy(tx.col(part), "ordinal").orderBy(*_typed_order())
    few = long.withColumn("rn", F.dense_rank().over(w)).where(F.col("rn") <= samples).distinct()
    few = few.groupBy(tx.col(part).alias("_few_part"), F.col("ordinal").alias("_few_ordinal")).agg(F.collect_list(F.struct(*slots)).alias("smallest"))
    rows = df.groupBy(tx.col(part)).agg(F.count(F.lit(1)).alias("n")).withColumn("ordinal", F.lit(-1))
    same = tx.col(part).eqNullSafe(F.col("_few_part")) & (F.col("ordinal") == F.col("_few_ordinal"))
    return state.join(few, same, "left").drop("_few_part", "_few_ordinal").unionByName(rows, allowMissingColumns=True)


def merge_states(states: DataFrame, fields: Sequence[T.StructField], samples: int = 5, digits: int | None = None, keep_ordinal: bool = False) -> DataFrame:
    """The profile of all parts from their stored states; ``fields``: the profiled columns.  Only states are read: a few rows per part.
    Distinct counts are the sketches' estimate, all other fields are exact."""
    mean = F.sum(F.col("n") * F.col("mean")) / F.sum(F.when(F.col("mean").isNotNull(), F.col("n")))
    own = states.where("ordinal >= 0")
    slots = ("i", "x", "d", "s")
    means = own.groupBy("ordinal").agg(mean.alias("mean_all"))
    merged = own.join(F.broadcast(means), "ordinal").groupBy("ordinal").agg(  # a row per column
        F.sum("n").alias("c"), F.struct(*[F.min(f"lo.{c}").alias(c) for c in slots]).alias("lo"), F.struct(*[F.max(f"hi.{c}").alias(c) for c in slots]).alias("hi"),
        F.first("mean_all").alias("mean"), F.sum(F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("mean_all"), 2)).alias("m2"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("Unique_Values_Count"))
    top = _smallest(own.select("ordinal", F.inline("smallest")).distinct(), samples)
    spark = states.sparkSession
    names = spark.createDataFrame([(n, f.name, tx.type_name(f.dataType)) for n, f in enumerate(fields)], "ordinal int, Column_Name string, Data_Type string")
    total = states.where("ordinal = -1").agg(F.sum("n").alias("rows")).first()["rows"] or 0
    present = F.coalesce("c", F.lit(0))
    stats = names.join(merged, "ordinal", "left").select(
        "ordinal", "Column_Name", "Data_Type", _text(fields, "lo.").alias("Min_Value"), _text(fields, "hi.").alias("Max_Value"),
        (F.lit(total) - present).alias("Missing_Values_Count"), tx.round6(F.col("mean"), digits).alias("Mean_Value"),
        tx.round6(F.when(F.col("c") > 1, F.sqrt(F.col("m2") / (F.col("c") - 1))), digits).alias("Std_Dev"), "Unique_Values_Count")
    return _assemble(stats.drop("Unique_Values_Count"), stats.select("ordinal", "Unique_Values_Count"), _joined(top, fields), keep_ordinal)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts per value, most frequent first, NULLs dropped."""
    c = tx.col(column)
    return (df.where(c.isNotNull()).groupBy(c.alias(column))
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.col(tx.quote(column))))


def class_ratio(df: DataFrame, target: str) -> DataFrame:
    """n_pos, n_neg and the positive weight ``n_neg / max(n_pos, 1)``."""
    t = tx.col(target)
    return (df.agg(F.count_if(t.eqNullSafe(F.lit(True))).alias("n_pos"),
                   F.count_if(t.eqNullSafe(F.lit(False))).alias("n_neg"))
            .withColumn("pos_weight", F.col("n_neg") / F.greatest(F.col("n_pos"), F.lit(1))))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact distinct count per column, ``(Column_Name, n_unique)``, through the
    unpivot plan (no ``Expand`` of all columns per row)."""
    fields = [df.schema[c] for c in columns]
    names = F.array(*[F.lit(c) for c in columns])
    return (distinct_values(df, fields).groupBy("ordinal").agg(F.count(F.lit(1)).alias("n_unique"))
            .select(F.element_at(names, F.col("ordinal") + 1).alias("Column_Name"), "n_unique"))


def cardinality_roles(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """D12 as a table: ``nunique <= k`` → ``hot``, else ``cat``."""
    return (distinct_counts(df, columns)
            .withColumn("role", F.when(F.col("n_unique") <= k, F.lit("hot")).otherwise(F.lit("cat"))))


def split_by_cardinality(df: DataFrame, columns: Sequence[str], k: int) -> tuple[list[str], list[str]]:
    """(hot, cat) name lists, in the given column order."""
    roles = {r["Column_Name"]: r["role"] for r in cardinality_roles(df, columns, k).collect()}
    hot = [c for c in columns if roles.get(c, "hot") == "hot"]
    cat = [c for c in columns if roles.get(c) == "cat"]
    return hot, cat


def shape(df: DataFrame) -> DataFrame:
    """Row and column counts as one row."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))
