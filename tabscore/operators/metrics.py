"""Score metrics as DataFrame → DataFrame aggregates.

Input: one row per scored example with a 0/1 (or boolean) ``label`` and a
probability ``score``.  Nothing is collected except the one-row results.

* F-beta: three conditional counts in one aggregate.
* Average precision (step sum over distinct scores) and PR-AUC (trapezoid
  with the end point R=0, P=1): first ``groupBy(score)``, then running
  true/false positive counts in descending score order
  (``plans.ranks.running_sums_desc``, no single-task window).  Both reduce to
  sums of row-local terms: AP = Σ tp_i·P_i / T and
  AUC = Σ tp_i/T · (P_i + P_{i-1}) / 2, where P_{i-1} comes from the running
  counts minus the row's own counts.
* Threshold sweep: one grid bin per row and a partial count per bin; the
  per-threshold counts are sums over the small bin table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscore.functions.text import col
from tabscore.plans.ranks import running_sums_desc

# The sweep grid is 0.05 + i * 0.05 for i = 0..17 (0.05 … 0.90).
SWEEP_START = 0.05
SWEEP_STEP = 0.05
SWEEP_COUNT = 18


def sweep_grid() -> list[float]:
    return [SWEEP_START + i * SWEEP_STEP for i in range(SWEEP_COUNT)]


def _pos(label: str) -> Column:
    return col(label).cast("int") == 1


def _fbeta_expr(tp: Column, fp: Column, fn: Column, beta: float) -> Column:
    b2 = float(beta) ** 2
    den = (1 + b2) * tp + b2 * fn + fp
    return F.when(den == 0, F.lit(0.0)).otherwise(((1 + b2) * tp) / den)


def confusion(scored: DataFrame, label: str, score: str, threshold: float = 0.5,
              strict: bool = False) -> DataFrame:
    """tp, fp, fn, tn at one threshold (``>=``, or ``>`` with ``strict``)."""
    s = col(score)
    pred = (s > F.lit(threshold)) if strict else (s >= F.lit(threshold))
    y = _pos(label)
    return scored.agg(F.count_if(pred & y).alias("tp"), F.count_if(pred & ~y).alias("fp"),
                      F.count_if(~pred & y).alias("fn"), F.count_if(~pred & ~y).alias("tn"))


def fbeta(scored: DataFrame, label: str, score: str, beta: float = 2.0,
          threshold: float = 0.5, strict: bool = False) -> DataFrame:
    """``(1+β²)TP / ((1+β²)TP + β²FN + FP)``, 0 when the denominator is 0."""
    c = confusion(scored, label, score, threshold, strict)
    return c.select(_fbeta_expr(F.col("tp"), F.col("fp"), F.col("fn"), beta).alias("fbeta"))


def fbetas(scored: DataFrame, label: str, score: str, cuts: dict[str, tuple[float, bool]],
           beta: float = 2.0) -> DataFrame:
    """K10 at several thresholds in one pass: ``cuts`` maps an output name to
    ``(threshold, strict)``; one row with one F-beta column per name."""
    y, s = _pos(label), col(score)
    aggs, outs = [], []
    for i, (name, (t, strict)) in enumerate(cuts.items()):
        pred = (s > F.lit(t)) if strict else (s >= F.lit(t))
        aggs += [F.count_if(pred & y).alias(f"tp{i}"), F.count_if(pred & ~y).alias(f"fp{i}"),
                 F.count_if(~pred & y).alias(f"fn{i}")]
        outs.append(_fbeta_expr(F.col(f"tp{i}"), F.col(f"fp{i}"), F.col(f"fn{i}"), beta).alias(name))
    return scored.agg(*aggs).select(*outs)


# Buckets of the distinct scores, cut at their own quantiles: scores of rare
# events, squeezed into a sliver of [0, 1], still fill all buckets evenly.
CURVE_BUCKETS = 4096


def _curve(scored: DataFrame, label: str, score: str) -> DataFrame:
    y = _pos(label)
    per_score = scored.groupBy(col(score).cast("double").alias("s")).agg(
        F.count_if(y).alias("tp"), F.count_if(~y).alias("fp"))
    return running_sums_desc(per_score, "s", ["tp", "fp"], buckets=CURVE_BUCKETS)


def curve_metrics(scored: DataFrame, label: str, score: str, beta: float = 2.0,
                  threshold: float = 0.5) -> DataFrame:
    """K11 + K12 (+ the F-beta of the predicted label, score strictly above
    ``threshold``) in one aggregate over the distinct-score curve."""
    c = _curve(scored, label, score)
    prec = F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp"))
    prev_tp = F.col("cum_tp") - F.col("tp")
    prev_n = prev_tp + F.col("cum_fp") - F.col("fp")
    prev_prec = F.when(prev_n == 0, F.lit(1.0)).otherwise(prev_tp / prev_n)
    above = F.col("s") > F.lit(threshold)
    agg = c.agg(F.sum("tp").alias("T"),
                F.sum(F.col("tp") * prec).alias("ap_num"),
                F.sum(F.col("tp") * (prec + prev_prec) / 2.0).alias("auc_num"),
                F.sum(F.when(above, F.col("tp")).otherwise(0)).alias("ptp"),
                F.sum(F.when(above, F.col("fp")).otherwise(0)).alias("pfp"))
    return agg.select(
        F.when(F.col("T") > 0, F.col("ap_num") / F.col("T")).otherwise(F.lit(0.0)).alias("average_precision"),
        F.when(F.col("T") > 0, F.col("auc_num") / F.col("T")).otherwise(F.lit(0.0)).alias("pr_auc"),
        _fbeta_expr(F.coalesce("ptp", F.lit(0)), F.coalesce("pfp", F.lit(0)),
                    F.coalesce(F.col("T") - F.col("ptp"), F.lit(0)), beta).alias("fbeta"))


def average_precision(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Step-wise AP over distinct scores (ties form one step)."""
    return curve_metrics(scored, label, score).select("average_precision")


def pr_auc(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Trapezoid area under the precision-recall curve."""
    return curve_metrics(scored, label, score).select("pr_auc")


def composite(scored: DataFrame, label: str, score: str, beta: float = 2.0,
              w_f: float = 0.7, w_ap: float = 0.3, threshold: float = 0.5) -> DataFrame:
    """``0.7 * F2 + 0.3 * AP``; the F-beta uses the predicted label
    (probability strictly above 0.5, as argmax over two classes does)."""
    m = curve_metrics(scored, label, score, beta, threshold)
    return m.select("fbeta", "average_precision",
                    (F.lit(w_f) * F.col("fbeta") + F.lit(w_ap) * F.col("average_precision")).alias("composite"))


def threshold_sweep(scored: DataFrame, label: str, score: str, beta: float = 2.0,
                    grid: Sequence[float] | None = None) -> DataFrame:
    """K14 (table form): one row per threshold with counts and F-beta; a
    threshold where every row gets the same predicted class is not eligible.

    Each row is placed once in its grid bin (the number of thresholds it
    reaches, a short CASE ladder) and counted per ``(bin, label)`` with a
    partial aggregate; the per-threshold counts are then sums over at most
    ``2 × (len(grid) + 1)`` rows."""
    grid = list(grid) if grid is not None else sweep_grid()
    s, y = col(score), _pos(label)
    ladder = F.lit(0)
    for i, t in enumerate(grid):          # bin = number of thresholds t_i <= score
        ladder = F.when(s >= F.lit(t), F.lit(i + 1)).otherwise(ladder)
    bins = scored.groupBy(ladder.alias("bin")).agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))
    aggs = [F.sum("pos").alias("P"), F.sum(F.col("pos") + F.col("neg")).alias("n")]
    for i in range(len(grid)):
        hit = F.col("bin") > i
        aggs += [F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias(f"tp{i}"),
                 F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias(f"fp{i}")]
    one = bins.agg(*aggs)
    rows = [F.struct(F.lit(i).alias("i"), F.lit(t).alias("threshold"),
                     F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp"),
                     (F.col("P") - F.col(f"tp{i}")).alias("fn"),
                     ((F.col(f"tp{i}") + F.col(f"fp{i}") > 0) &
                      (F.col(f"tp{i}") + F.col(f"fp{i}") < F.col("n"))).alias("eligible"))
            for i, t in enumerate(grid)]
    long = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return long.withColumn("score", _fbeta_expr(F.col("tp"), F.col("fp"), F.col("fn"), beta))


def best_threshold(scored: DataFrame, label: str, score: str, beta: float = 2.0,
                   grid: Sequence[float] | None = None, metric: str = "f2") -> DataFrame:
    """The first threshold with the strictly highest F-beta among the
    eligible ones; ``(0.5, 0.0)`` when none scores above 0."""
    if metric not in ("f1", "f2"):
        raise ValueError(f"unknown metric {metric!r}; use 'f1' or 'f2'")
    beta = 1.0 if metric == "f1" else beta
    sw = threshold_sweep(scored, label, score, beta, grid)
    best = sw.where(F.col("eligible") & (F.col("score") > 0)).agg(
        F.min_by(F.struct("threshold", "score"), F.struct(-F.col("score"), F.col("i"))).alias("b"))
    return best.select(F.coalesce(F.col("b.threshold"), F.lit(0.5)).alias("threshold"),
                       F.coalesce(F.col("b.score"), F.lit(0.0)).alias("score"))
