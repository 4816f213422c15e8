"""Record validation and batch scoring (L2, L3, L4).

Records arrive as JSON text (one record per row, column ``value``).  They
are parsed once to ``map<string,string>`` so a missing field, a text in a
numeric field and a fraction in an integer field are all detectable per
field with ``try_cast``; extra fields are ignored.  A record with any error
is rejected whole, with the list of errors.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscore.functions.text import col


def validate(records: DataFrame, schema: T.StructType, value_col: str = "value",
             fail_fast: bool = False) -> tuple[DataFrame, DataFrame]:
    """L2: ``(valid, rejected)``.  ``valid`` has the schema's typed columns;
    ``rejected`` keeps the raw text and an ``errors`` array.  With
    ``fail_fast`` any invalid record raises."""
    # A generated column: a filter on its fields is not moved below it, where the record would be parsed again for every field.
    m = F.explode(F.array(F.from_json(col(value_col), "map<string,string>")))
    parsed = records.select("*", m.alias("_m"))
    errs, typed = [], []
    for f in schema.fields:
        raw = F.try_element_at(F.col("_m"), F.lit(f.name))
        # try_cast refuses '12.5' for an integer field and text for a number.
        val = raw.try_cast(f.dataType)
        typed.append(val.alias(f.name))
        errs.append(F.when(raw.isNull(), F.lit(f"{f.name}: missing"))
                     .when(val.isNull(), F.concat(F.lit(f"{f.name}: not a {f.dataType.simpleString()}: "), raw)))
    checked = parsed.select("*", F.filter(F.array(*errs), lambda e: e.isNotNull()).alias("errors"),
                            *[t.alias("_t_" + f.name) for t, f in zip(typed, schema.fields)])
    ok = F.col("_m").isNotNull() & (F.size("errors") == 0)
    valid = checked.where(ok).select(*[F.col("_t_" + f.name).alias(f.name) for f in schema.fields])
    rejected = checked.where(~ok).select(col(value_col), F.when(F.col("_m").isNull(), F.array(F.lit("not a JSON object")))
                                         .otherwise(F.col("errors")).alias("errors"))
    if fail_fast:
        first = rejected.select("errors").first()
        if first is not None:
            raise ValueError(f"invalid record: {first['errors']}")
    return valid, rejected


def score(df: DataFrame, model: PipelineModel, threshold: float = 0.5,
          keep: list[str] | None = None) -> DataFrame:
    """L3: all input columns + ``probability`` of class 1 + ``prediction`` at
    the model's stored threshold (``>=``)."""
    from tabscore.operators.model import with_score

    cols = keep or df.columns
    out = with_score(model.transform(df), "_p1")
    return out.select(*[col(c) for c in cols], F.col("_p1").alias("probability"),
                      (F.col("_p1") >= F.lit(threshold)).cast("int").alias("prediction"))
