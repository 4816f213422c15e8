"""Samples and splits on the seeded md5 order.

All random choices are md5 of ``seed:key``, so results are reproducible and
identical in the SQL oracle.  None of these operators moves a whole class, or
more than the requested number of rows, into one task (see ``plans.ranks``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabscore.functions.hashing import order_hash, unit_fraction
from tabscore.functions.text import col
from tabscore.plans import ranks


def hash_fraction(df: DataFrame, p: float, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Keep a row when its md5 fraction is below ``p`` (Bernoulli
    sample, reproducible, pushed into the scan stage; no shuffle)."""
    return df.where(unit_fraction(keys, seed) < F.lit(float(p)))


def random_top(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """``ORDER BY md5(seed:key) LIMIT n`` (exact, distributed)."""
    return ranks.smallest_by_hash(df, n, keys, seed)


def hash_order(df: DataFrame, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """F8: a reproducible global shuffle order (range-partitioned sort)."""
    return df.orderBy(order_hash(keys, seed), *[col(k) for k in keys])


def balanced_sample(df: DataFrame, target: str, n: int | None, keys: Sequence[str],
                    pos_share: float = 1 / 3, seed: int = 42) -> DataFrame:
    """``n * pos_share`` (floored) rows with ``target IS TRUE`` and the rest
    with ``target IS FALSE``, each the smallest md5 of its class; NULL labels
    are in neither part.  ``n=None`` returns all labelled rows."""
    t = col(target)
    labelled = df.where(t.isNotNull())
    if n is None:
        return labelled
    pos = int(math.floor(n * pos_share)) if pos_share != 1 / 3 else n // 3
    neg = n - pos
    return ranks.smallest_by_hash(labelled, {(True,): pos, (False,): neg}, keys, seed,
                                  class_cols=[target])


def test_quota(totals: DataFrame, test_size: float) -> DataFrame:
    """J3 quotas ``(_k, _q)`` from class totals ``(_k, n)``: ``ceil(p * n)`` test
    rows in all; each class gets ``floor(n_test * n_c / n)`` plus one for the
    largest remainders (ties by class value).  The table has one row per class, and so has the window over it."""
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = totals.withColumn("total", F.sum("n").over(whole).cast("decimal(19,0)"))
    t = t.withColumn("n_test", F.ceil(F.lit(float(test_size)) * F.col("total").cast("double")).cast("decimal(19,0)"))
    t = t.withColumns({"base": F.expr("cast((n_test * n) div total as bigint)"), "rem": F.expr("(n_test * n) % total")})
    rank = F.row_number().over(Window.orderBy(F.desc("rem"), F.to_json("_k")))
    extra = F.col("n_test").cast("bigint") - F.sum("base").over(whole)
    return t.withColumns({"rank": rank, "extra": extra}).select(
        "_k", (F.col("base") + F.when(F.col("rank") <= F.col("extra"), 1).otherwise(0)).alias("_q"))


def stratified_split(df: DataFrame, target: str, test_size: float, keys: Sequence[str],
                     seed: int = 42, split_col: str = "split", exact: bool = True) -> DataFrame:
    """Exact per-class holdout (quotas from ``test_quota``); within a
    class, the test rows are the smallest md5.  NULL labels are dropped.
    ``exact=False`` takes the md5 fraction instead: the share holds in
    expectation, in one projection without a shuffle, for very large tables."""
    labelled = df.where(col(target).isNotNull())
    if not exact:
        test = unit_fraction(keys, seed) < F.lit(float(test_size))
        return labelled.withColumn(split_col, F.when(test, F.lit("test")).otherwise(F.lit("train")))
    flagged = ranks.split_by_quota(labelled, [target], keys, lambda t: test_quota(t, test_size), seed,
                                   flag_col="_test")
    return (flagged.withColumn(split_col, F.when(F.col("_test"), F.lit("test")).otherwise(F.lit("train")))
                   .drop("_test"))


def stratified_folds(df: DataFrame, target: str, k: int, keys: Sequence[str], seed: int = 42,
                     fold_col: str = "fold", exact: bool = True) -> DataFrame:
    """fold = (rank in class - 1) mod k, rank by md5; every class is spread
    evenly over the folds (sizes differ by at most one).  ``exact=False``
    takes the fold from the md5 fraction instead: balanced only in
    expectation, but a pure projection with no shuffle."""
    if not exact:
        return (df.where(col(target).isNotNull())
                  .withColumn(fold_col, F.floor(unit_fraction(keys, seed) * k).cast("int")))
    ranked = ranks.rank_in_class(df.where(col(target).isNotNull()), [target], keys, seed,
                                 rank_col="_rk")
    return ranked.withColumn(fold_col, F.pmod(F.col("_rk") - 1, F.lit(k)).cast("int")).drop("_rk")


def first_per_class(df: DataFrame, class_col: str, n: int, keys: Sequence[str],
                    seed: int = 42) -> DataFrame:
    """the first ``n`` rows of each class in md5 order.  A per-class
    dyadic cut on the md5 keeps about 2n rows per class before anything is
    ranked (a window per class alone would take n rows per class from every
    input task into one task)."""
    return ranks.smallest_per_class(df, [class_col], n, keys, seed)


def top_by_score(df: DataFrame, score: str, n: int, keys: Sequence[str]) -> DataFrame:
    """the ``n`` highest scores (key as tie-break); TakeOrderedAndProject."""
    return df.orderBy(F.desc(col(score)), *[col(k) for k in keys]).limit(n)


def fallback_sample(df: DataFrame, prediction: str, score: str, label: str, n: int,
                    keys: Sequence[str], seed: int = 42) -> DataFrame:
    """n examples per group with the three-step fallback: predicted
    positives; if there are none, the highest scores (``high_prob_true``); if
    no row has a score, actual positives (``actual_true``).
    The md5-ordered groups are exact top-n picks by dyadic cut (about 2n
    rows ranked per group), the score-ordered one a plain top-n, so no group
    is ranked whole in one task."""
    has = df.agg(F.count_if(col(prediction) == 1).alias("pos"), F.count(col(score)).alias("scores")).first()
    negs = ranks.smallest_by_hash(df.where(col(prediction) == 0), n, keys, seed) \
        .withColumn("group", F.lit("false"))
    if has["pos"]:
        pos = ranks.smallest_by_hash(df.where(col(prediction) == 1), n, keys, seed) \
            .withColumn("group", F.lit("true"))
    elif has["scores"]:
        pos = (df.where(col(score).isNotNull())
                 .orderBy(col(score).desc(), order_hash(keys, seed), *[col(k) for k in keys])
                 .limit(n).withColumn("group", F.lit("high_prob_true")))
    else:
        pos = ranks.smallest_by_hash(df.where(col(label).cast("int") == 1), n, keys, seed) \
            .withColumn("group", F.lit("actual_true"))
    return pos.unionByName(negs)
