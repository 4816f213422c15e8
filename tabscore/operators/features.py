"""Feature preparation (K1, K2, K3, K4, K5).

Scalers are fit with one global aggregate (one partial row per task) and
applied as plain column expressions, so the transform stays in whole-stage
codegen and never joins statistics back onto the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscore.functions.text import col


def fit_standard(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """K1 fit: mean and *population* std per column (NULLs skipped)."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.avg(col(c)).alias(f"m{i}"), F.stddev_pop(col(c)).alias(f"s{i}")]
    r = df.agg(*aggs).first()
    return {c: (r[f"m{i}"], r[f"s{i}"]) for i, c in enumerate(cols)}


def standardize(df: DataFrame, cols: Sequence[str], params: dict | None = None,
                suffix: str = "") -> DataFrame:
    """K1: ``(x - mean) / std``; a zero (or undefined) std divides by 1; NULLs
    stay NULL."""
    params = params or fit_standard(df, cols)
    out = {}
    for c in cols:
        m, s = params[c]
        m = 0.0 if m is None else float(m)
        s = 1.0 if not s else float(s)
        out[c + suffix] = (col(c) - F.lit(m)) / F.lit(s)
    return df.withColumns(out)


def fit_minmax(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.min(col(c)).alias(f"lo{i}"), F.max(col(c)).alias(f"hi{i}")]
    r = df.agg(*aggs).first()
    return {c: (r[f"lo{i}"], r[f"hi{i}"]) for i, c in enumerate(cols)}


def minmax(df: DataFrame, cols: Sequence[str], params: dict | None = None, suffix: str = "") -> DataFrame:
    """K2: ``(x - min) / (max - min)``; a constant column maps to 0."""
    params = params or fit_minmax(df, cols)
    out = {}
    for c in cols:
        lo, hi = params[c]
        if lo is None or hi is None or hi == lo:
            out[c + suffix] = F.when(col(c).isNotNull(), F.lit(0.0))
        else:
            out[c + suffix] = (col(c) - F.lit(float(lo))) / F.lit(float(hi) - float(lo))
    return df.withColumns(out)


def class_weight(df: DataFrame, target: str, weight_col: str = "weight") -> DataFrame:
    """K5: weight = n_neg / max(n_pos, 1) for positives, 1 for negatives."""
    t = col(target).cast("boolean")
    r = df.agg(F.count_if(t).alias("p"), F.count_if(~t).alias("n")).first()
    ratio = float(r["n"]) / max(int(r["p"]), 1)
    return df.withColumn(weight_col, F.when(t, F.lit(ratio)).otherwise(F.lit(1.0)))


def assembler(features: Sequence[str], impute: bool = True, output: str = "features", strategy: str = "median"):
    """K3: ``Imputer`` (median by default, with missing flags) + ``VectorAssembler``.
    Spark trees have no missing-value branch, so NULLs are imputed and a 0/1
    missing flag per column keeps the information."""
    from pyspark.ml.feature import Imputer, SQLTransformer, VectorAssembler

    stages, cols = [], list(features)
    if impute:
        flags = ", ".join(f"CAST(`{c}` IS NULL AS DOUBLE) AS `{c}__missing`" for c in features)
        stages.append(SQLTransformer(statement=f"SELECT *, {flags} FROM __THIS__"))
        stages.append(Imputer(inputCols=list(features), outputCols=[c + "__imp" for c in features],
                              strategy=strategy))
        cols = [c + "__imp" for c in features] + [c + "__missing" for c in features]
    stages.append(VectorAssembler(inputCols=cols, outputCol=output, handleInvalid="error"))
    return stages


def categorical_stages(cat_cols: Sequence[str], hot_cols: Sequence[str]):
    """K4: ``StringIndexer(handleInvalid='keep')`` for every categorical and a
    one-hot encoder for the low-cardinality ``hot`` ones."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer

    cols = list(cat_cols) + list(hot_cols)
    stages = [StringIndexer(inputCols=cols, outputCols=[c + "__idx" for c in cols], handleInvalid="keep",
                            stringOrderType="alphabetAsc")]
    if hot_cols:
        stages.append(OneHotEncoder(inputCols=[c + "__idx" for c in hot_cols],
                                    outputCols=[c + "__ohe" for c in hot_cols], handleInvalid="keep"))
    return stages


def xy_frame(df: DataFrame, features: Sequence[str], target: str, label: str = "label",
             keys: Sequence[str] = ()) -> DataFrame:
    """C4: features and label side by side, row-aligned by construction.
    Both come from one projection of the same rows, so no row id and no
    positional join is needed (a ``monotonically_increasing_id`` pairing
    would depend on partitioning)."""
    return df.select(*[col(k) for k in keys], *[col(c) for c in features],
                     col(target).cast("int").alias(label))
