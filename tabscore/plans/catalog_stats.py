"""Registered queries, part 2: histograms, association, scaling, metrics
(D10, D15-D18, B10, K1, K2, K5, K10-K14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabscore.functions import text as tx
from tabscore.operators import assoc, features, metrics
from tabscore.plans import fixtures as fx
from tabscore.operators import roles as rl
from tabscore.plans import stored
from tabscore.plans.catalog import ROLE_TABLE_SQL, register

R6 = fx.sql_round
W = fx.WIDE_SQL

HIST_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "ship_hhmm", "arr_hhmm"]


def _hist_sql(bins: int = 100) -> str:
    long = " UNION ALL ".join(
        f"SELECT returned AS cls, '{c}' AS \"column\", CAST({c} AS DOUBLE) AS x FROM {W} "
        f"WHERE returned IS NOT NULL AND {c} IS NOT NULL" for c in HIST_COLS)
    return f"""WITH long AS ({long}),
rng AS (SELECT "column", min(x) AS lo, max(x) AS hi FROM long GROUP BY "column"),
b AS (SELECT l."column", cls, lo, hi, CAST(CASE WHEN hi - lo = 0 THEN 0
        ELSE least(floor((x - lo) / (hi - lo) * {bins}), {bins - 1}) END AS INTEGER) AS bin
      FROM long l JOIN rng USING ("column")),
c AS (SELECT "column", cls, bin, lo, hi, COUNT(*) AS n,
        CASE WHEN hi - lo = 0 THEN 1.0 ELSE (hi - lo) / {bins} END AS width FROM b GROUP BY ALL)
SELECT "column", cls AS class, bin, {R6('lo + bin * width')} AS bin_start, n,
  {R6('n / (SUM(n) OVER (PARTITION BY "column", cls) * width)')} AS density FROM c"""


@register("d10_class_histogram", _hist_sql())
def d10_class_histogram(spark, sf):
    h = assoc.class_histogram(fx.wide(spark, sf), HIST_COLS, "returned", bins=100)
    return h.withColumn("bin_start", tx.round6(F.col("bin_start"))).withColumn("density", tx.round6(F.col("density")))


@register("d10_histogram_nan", _hist_sql().replace(fx.WIDE_SQL, f"(SELECT * REPLACE (CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END AS l_quantity) FROM {fx.WIDE_SQL})"))
def d10_histogram_nan(spark, sf):
    """NaN values count as missing."""
    w = fx.wide(spark, sf).withColumn("l_quantity", F.when(F.col("l_linenumber") == 3, F.lit(float("nan"))).otherwise(F.col("l_quantity")))
    h = assoc.class_histogram(w, HIST_COLS, "returned", bins=100)
    return h.withColumn("bin_start", tx.round6(F.col("bin_start"))).withColumn("density", tx.round6(F.col("density")))


A_NUM = stored.ASSOC_NUM
A_CAT = stored.ASSOC_CAT
A_ALL = A_NUM + A_CAT
A_PAIRS = [(A_ALL[i], A_ALL[j]) for i in range(len(A_ALL)) for j in range(i + 1, len(A_ALL))]


def _ct_sql(bins: int = 10) -> str:
    rng = ", ".join(f"min({c}) AS lo{i}, max({c}) AS hi{i}" for i, c in enumerate(A_NUM))
    codes = ", ".join(
        [f"CAST(CAST(least(floor((CAST({c} AS DOUBLE) - lo{i}) / (hi{i} - lo{i}) * {bins}), {bins - 1}) AS INTEGER) "
         f"AS VARCHAR) AS {c}" for i, c in enumerate(A_NUM)] +
        [f"CAST({c} AS VARCHAR) AS {c}" for c in A_CAT])
    arms = " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, {a} AS va, {b} AS vb, COUNT(*) AS n FROM c "
        f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY {a}, {b}" for a, b in A_PAIRS)
    return f"""WITH r AS (SELECT {rng} FROM {W}), c AS (SELECT {codes} FROM {W}, r) {arms}"""


@register("d15_contingency", _ct_sql())
def d15_contingency(spark, sf):
    return assoc.contingency(fx.wide(spark, sf), A_NUM, A_CAT, bins=10)


def _chi2_sql(rounded: bool = True) -> str:
    chi2 = R6('chi2') if rounded else 'chi2'
    return f"""WITH ct AS ({_ct_sql()}),
t AS (SELECT *, SUM(n) OVER (PARTITION BY a, b) AS NN, SUM(n) OVER (PARTITION BY a, b, va) AS ra,
        SUM(n) OVER (PARTITION BY a, b, vb) AS rb FROM ct),
g AS (SELECT a, b, CAST(first(NN) AS BIGINT) AS n, SUM(n * n / (ra * rb / NN)) - first(NN) AS chi2,
        COUNT(DISTINCT va) AS r, COUNT(DISTINCT vb) AS c FROM t GROUP BY a, b)
SELECT a, b, n, r, c, {chi2} AS chi2, (r - 1) * (c - 1) AS dof,
  {R6('CASE WHEN least(r, c) - 1 <= 0 THEN 0.0 ELSE sqrt(chi2 / n / (least(r, c) - 1)) END')} AS cramers_v FROM g"""


def _chi2(spark, sf):
    ct = assoc.contingency(fx.wide(spark, sf), A_NUM, A_CAT, bins=10)
    return assoc.chi2_table(assoc.stored_cells(ct))


@register("d16_chi2_cramers_v", _chi2_sql())
def d16_chi2_cramers_v(spark, sf):
    t = _chi2(spark, sf)
    return t.withColumn("chi2", tx.round6(F.col("chi2"))).withColumn("cramers_v", tx.round6(F.col("cramers_v")))


def _phik_sql() -> str:
    """The solver of ``assoc.phik_table`` written out: the same quadrature, quantiles and section search, pass by pass."""
    def bounds(v, i, h):
        return f"""SELECT a, b, {i}, p{i}, q{i}, {assoc.ppf_sql('cum')} AS {h} FROM (SELECT a, b, row_number() OVER o AS {i}, m / SUM(m) OVER (PARTITION BY a, b) AS p{i},
  lead(m) OVER o / SUM(m) OVER (PARTITION BY a, b) AS q{i}, SUM(m) OVER (o ROWS UNBOUNDED PRECEDING) / SUM(m) OVER (PARTITION BY a, b) AS cum
  FROM (SELECT a, b, {v}, CAST(SUM(n) AS DOUBLE) AS m FROM ct GROUP BY ALL) WINDOW o AS (PARTITION BY a, b ORDER BY TRY_CAST({v} AS DOUBLE) NULLS LAST, {v})) WHERE q{i} IS NOT NULL"""
    ctes = [f"ct AS ({_ct_sql()})", f"obs AS (SELECT a, b, n, chi2 - (r - 1) * (c - 1) AS goal FROM ({_chi2_sql(rounded=False)}))",
            f"corners AS (SELECT * FROM ({bounds('va', 'i', 'h')}) JOIN ({bounds('vb', 'j', 'k')}) USING (a, b))",
            f"s0 AS (SELECT a, b, n, goal, 0e0 AS lo, {assoc.PHIK_TOP}e0 AS hi, FALSE AS full_ FROM obs WHERE goal > 0)"]
    cells = "[" + ", ".join(f"{{'i': i + {x}, 'j': j + {y}, 'd': {'' if x == y else '-'}q, 'e': {'qi' if x else 'pi'} * {'qj' if y else 'pj'}}}" for x in (0, 1) for y in (0, 1)) + "]"
    for t in range(assoc.PHIK_PASSES):
        points = assoc.PHIK_POINTS + (t == 0)
        ctes += [f"p{t} AS (SELECT a, b, p, lo + (hi - lo) * p / {assoc.PHIK_POINTS + 1}e0 AS rho FROM s{t}, range(1, {points + 1}) x(p))",
                 f"q{t} AS (SELECT a, b, p, unnest({cells}) AS u FROM (SELECT *, {assoc.corner_sql('h', 'k', 'rho')} AS q FROM corners JOIN p{t} USING (a, b)))",
                 f"""x{t} AS (SELECT a, b, p, SUM(d * d / e) AS s FROM (SELECT a, b, p, u.i, u.j, SUM(u.d) AS d, MIN(u.e) AS e FROM q{t} GROUP BY ALL) GROUP BY a, b, p)""",
                 f"""s{t + 1} AS (SELECT a, b, n, goal, greatest(lo, coalesce(MAX(rho) FILTER (s * n < goal), lo)) AS lo, least(hi, coalesce(MIN(rho) FILTER (s * n >= goal), hi)) AS hi,
  {'COUNT(*) FILTER (s * n >= goal) = 0' if t == 0 else 'bool_or(full_)'} AS full_ FROM s{t} JOIN p{t} USING (a, b) JOIN x{t} USING (a, b, p) GROUP BY a, b, n, goal, lo, hi)"""]
    return f"""WITH {', '.join(ctes)} SELECT a, b, {R6('CASE WHEN z.goal IS NULL THEN 0e0 WHEN full_ THEN 1e0 ELSE (lo + hi) / 2 END')} AS phik
FROM obs LEFT JOIN s{assoc.PHIK_PASSES} z USING (a, b)"""


@register("d16_phik", _phik_sql())
def d16_phik(spark, sf):
    ct = assoc.contingency(fx.wide(spark, sf), A_NUM, A_CAT, bins=10)
    return assoc.phik_table(ct).withColumn("phik", tx.round6(F.col("phik")))


def _matrix(spark, sf):
    w = fx.wide(spark, sf)
    return assoc.association_matrix(w, A_NUM, A_CAT, bins=10, method="cramers_v") \
        .withColumn("value", tx.round6(F.col("value")))


_V_SQL = f"(SELECT a, b, cramers_v AS v FROM ({_chi2_sql()}))"


_K_SQL = f"(SELECT a, b, phik AS v FROM ({_phik_sql()}))"


def _flag_sql(cut: float, values: str = _V_SQL) -> str:
    return f"""(SELECT CASE WHEN a = 'returned' THEN b ELSE a END AS Column_Name, 'true' AS Phik_high_target FROM {values}
WHERE (a = 'returned') <> (b = 'returned') AND abs(v) > {cut})"""


@register("d17_flag_high", f"""SELECT Column_Name, Role, coalesce(Phik_high_target, 'unk') AS Phik_high_target
FROM {ROLE_TABLE_SQL} LEFT JOIN {_flag_sql(stored.HIGH, _K_SQL)} USING (Column_Name)""")
def d17_flag_high(spark, sf):
    """The flag as a column of the role table: ``l_returnflag`` makes the target, the others don't."""
    return stored.stored_roles(spark, sf).select("Column_Name", "Role", "Phik_high_target")


@register("b9_sentinel_or", f"""SELECT Column_Name, Skip_reason_phik, coalesce(Phik_high_target, 'unk') AS Phik_high_target, Data_leakage
FROM {ROLE_TABLE_SQL} LEFT JOIN {_flag_sql(stored.HIGH, _K_SQL)} USING (Column_Name)
WHERE Skip_reason_phik <> 'unk' OR coalesce(Phik_high_target, 'unk') <> 'unk' OR Data_leakage <> 'unk'""")
def b9_sentinel_or(spark, sf):
    return rl.flagged(stored.stored_roles(spark, sf)).select("Column_Name", "Skip_reason_phik", "Phik_high_target", "Data_leakage")


@register("b10_abs_threshold", f"SELECT * FROM {_flag_sql(0.005)}")
def b10_abs_threshold(spark, sf):
    return assoc.flag_high(_matrix(spark, sf), "returned", 0.005)


@register("d18_unique_pairs", f"SELECT least(a, b) AS column_a, greatest(a, b) AS column_b, v AS value FROM {_V_SQL}")
def d18_unique_pairs(spark, sf):
    return assoc.unique_pairs(_matrix(spark, sf))


# ------------------------------------------------------------------ K1 / K2 / K5

SCALE_COLS = ["l_quantity", "l_extendedprice", "ship_hhmm"]


@register("k1_standardize", f"""SELECT l_orderkey, l_linenumber, l_partkey, """ + ", ".join(
    f"{R6(f'({c} - AVG({c}) OVER ()) / coalesce(nullif(STDDEV_POP({c}) OVER (), 0), 1)')} AS {c}" for c in SCALE_COLS)
    + f" FROM {W}")
def k1_standardize(spark, sf):
    w = fx.wide(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", *SCALE_COLS)
    out = features.standardize(w, SCALE_COLS)
    return out.withColumns({c: tx.round6(F.col(c)) for c in SCALE_COLS})


@register("k2_minmax", f"""SELECT l_orderkey, l_linenumber, l_partkey, """ + ", ".join(
    f"{R6(f'CASE WHEN MAX({c}) OVER () = MIN({c}) OVER () THEN 0.0 ELSE ({c} - MIN({c}) OVER ()) / (MAX({c}) OVER () - MIN({c}) OVER ()) END')} AS {c}"
    for c in SCALE_COLS) + f" FROM {W}")
def k2_minmax(spark, sf):
    w = fx.wide(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", *SCALE_COLS)
    out = features.minmax(w, SCALE_COLS)
    return out.withColumns({c: tx.round6(F.col(c)) for c in SCALE_COLS})


@register("k5_class_weights", f"""SELECT o_orderkey, done, CASE WHEN done THEN
  (SELECT count_if(NOT done) / greatest(count_if(done), 1) FROM {fx.ORDERS_SQL} WHERE done IS NOT NULL) ELSE 1.0 END AS weight
FROM {fx.ORDERS_SQL} WHERE done IS NOT NULL""")
def k5_class_weights(spark, sf):
    o = fx.orders_t(spark, sf).where(F.col("done").isNotNull()).select("o_orderkey", "done")
    return features.class_weight(o, "done")


# ------------------------------------------------------------------ K10 - K14

S = fx.SCORED_SQL


def _fb_sql(tp, fp, fn, beta=2.0):
    b2 = beta * beta
    return f"CASE WHEN ({1 + b2} * {tp} + {b2} * {fn} + {fp}) = 0 THEN 0.0 ELSE {1 + b2} * {tp} / ({1 + b2} * {tp} + {b2} * {fn} + {fp}) END"


@register("k10_fbeta", f"""SELECT {R6(_fb_sql('tp', 'fp', 'fn'))} AS fbeta FROM (SELECT
count_if(score >= 0.5 AND label = 1) AS tp, count_if(score >= 0.5 AND label = 0) AS fp,
count_if(score < 0.5 AND label = 1) AS fn FROM {S})""")
def k10_fbeta(spark, sf):
    return metrics.fbeta(fx.scored_lines(spark, sf), "label", "score", beta=2.0, threshold=0.5) \
        .select(tx.round6(F.col("fbeta")).alias("fbeta"))


@register("k10_f1_ties", f"""SELECT {R6(_fb_sql('tp', 'fp', 'fn', 1.0))} AS fbeta FROM (SELECT
count_if(score_ties >= 0.3 AND label = 1) AS tp, count_if(score_ties >= 0.3 AND label = 0) AS fp,
count_if(score_ties < 0.3 AND label = 1) AS fn FROM {S})""")
def k10_f1_ties(spark, sf):
    return metrics.fbeta(fx.scored_lines(spark, sf), "label", "score_ties", beta=1.0, threshold=0.3) \
        .select(tx.round6(F.col("fbeta")).alias("fbeta"))


def _curve_sql(score: str) -> str:
    return f"""(SELECT s, tp, fp, SUM(tp) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS ctp,
  SUM(fp) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS cfp
  FROM (SELECT {score} AS s, count_if(label = 1) AS tp, count_if(label = 0) AS fp FROM {S} GROUP BY {score}))"""


def _ap_sql(score: str) -> str:
    return f"SELECT {R6('SUM(tp * ctp / (ctp + cfp)) / SUM(tp)')} AS average_precision FROM {_curve_sql(score)}"


@register("k11_average_precision", _ap_sql("score"))
def k11_average_precision(spark, sf):
    return metrics.average_precision(fx.scored_lines(spark, sf), "label", "score") \
        .select(tx.round6(F.col("average_precision")).alias("average_precision"))


@register("k11_average_precision_ties", _ap_sql("score_ties"))
def k11_average_precision_ties(spark, sf):
    return metrics.average_precision(fx.scored_lines(spark, sf), "label", "score_ties") \
        .select(tx.round6(F.col("average_precision")).alias("average_precision"))


def _auc_sql(score: str) -> str:
    prev = "CASE WHEN ctp - tp + cfp - fp = 0 THEN 1.0 ELSE (ctp - tp) / (ctp - tp + cfp - fp) END"
    return (f"SELECT {R6(f'SUM(tp * (ctp / (ctp + cfp) + {prev}) / 2.0) / SUM(tp)')} AS pr_auc "
            f"FROM {_curve_sql(score)}")


@register("k12_pr_auc", _auc_sql("score"))
def k12_pr_auc(spark, sf):
    return metrics.pr_auc(fx.scored_lines(spark, sf), "label", "score") \
        .select(tx.round6(F.col("pr_auc")).alias("pr_auc"))


@register("k12_pr_auc_ties", _auc_sql("score_ties"))
def k12_pr_auc_ties(spark, sf):
    return metrics.pr_auc(fx.scored_lines(spark, sf), "label", "score_ties") \
        .select(tx.round6(F.col("pr_auc")).alias("pr_auc"))


@register("k13_composite", f"""WITH f AS (SELECT {_fb_sql('tp', 'fp', 'fn')} AS fbeta FROM (SELECT
  count_if(score > 0.5 AND label = 1) AS tp, count_if(score > 0.5 AND label = 0) AS fp,
  count_if(score <= 0.5 AND label = 1) AS fn FROM {S})),
ap AS (SELECT SUM(tp * ctp / (ctp + cfp)) / SUM(tp) AS average_precision FROM {_curve_sql('score')})
SELECT {R6('fbeta')} AS fbeta, {R6('average_precision')} AS average_precision,
  {R6('0.7 * fbeta + 0.3 * average_precision')} AS composite FROM f, ap""")
def k13_composite(spark, sf):
    c = metrics.composite(fx.scored_lines(spark, sf), "label", "score")
    return c.select(*[tx.round6(F.col(x)).alias(x) for x in ("fbeta", "average_precision", "composite")])


RARE = "score * score * score * 0.002"


@register("k11_rare_scores", _ap_sql(f"({RARE})"))
def k11_rare_scores(spark, sf):
    """Scores squeezed into the lowest 0.2 % of the range."""
    rare = fx.scored_lines(spark, sf).withColumn("score", F.expr(RARE))
    return metrics.average_precision(rare, "label", "score").select(tx.round6(F.col("average_precision")).alias("average_precision"))


def _sweep_sql(score: str, beta: float = 2.0) -> str:
    t = "(CAST(0.05 AS DOUBLE) + i * CAST(0.05 AS DOUBLE))"
    return f"""(SELECT i, {t} AS threshold,
  count_if({score} >= {t} AND label = 1) AS tp, count_if({score} >= {t} AND label = 0) AS fp,
  count_if({score} < {t} AND label = 1) AS fn,
  count_if({score} >= {t}) > 0 AND count_if({score} >= {t}) < COUNT(*) AS eligible
FROM {S}, range(18) g(i) GROUP BY i)"""


@register("k14_threshold_sweep", f"""SELECT CAST(i AS INTEGER) AS i, {R6('threshold')} AS threshold, tp, fp, fn, eligible,
{R6(_fb_sql('tp', 'fp', 'fn'))} AS score FROM {_sweep_sql('score')}""")
def k14_threshold_sweep(spark, sf):
    sw = metrics.threshold_sweep(fx.scored_lines(spark, sf), "label", "score")
    return sw.withColumn("threshold", tx.round6(F.col("threshold"))).withColumn("score", tx.round6(F.col("score")))


_FB = _fb_sql("tp", "fp", "fn")
_BEST_SQL = f"""WITH sw AS (SELECT i, threshold, {_FB} AS sc FROM {_sweep_sql('score_ties')} WHERE eligible AND {_FB} > 0)
SELECT {R6("coalesce((SELECT threshold FROM sw ORDER BY sc DESC, i LIMIT 1), 0.5)")} AS threshold,
{R6("coalesce((SELECT sc FROM sw ORDER BY sc DESC, i LIMIT 1), 0.0)")} AS score"""


@register("k14_best_threshold", _BEST_SQL)
def k14_best_threshold(spark, sf):
    b = metrics.best_threshold(fx.scored_lines(spark, sf), "label", "score_ties")
    return b.select(tx.round6(F.col("threshold")).alias("threshold"), tx.round6(F.col("score")).alias("score"))
