"""Score metrics (K10-K14) on hand-worked tables."""

import pytest

from tabscore.operators import metrics

# (y, p) with ties; AP = 1/3·1/2 + 1/3·2/3 + 1/3·3/5 = 0.588889
SCORES = [(1, .9), (0, .9), (1, .6), (0, .4), (1, .4), (0, .1)]


@pytest.fixture
def scored(spark):
    return spark.createDataFrame(SCORES, "y int, p double")


def test_average_precision_with_ties(scored):
    ap = metrics.average_precision(scored, "y", "p").first()[0]
    assert ap == pytest.approx(1 / 3 * 1 / 2 + 1 / 3 * 2 / 3 + 1 / 3 * 3 / 5)


def test_pr_auc_trapezoid(scored):
    # curve points (R, P): (0, 1), (1/3, 1/2), (2/3, 2/3), (1, 3/5), (1, 1/2)
    pts = [(0, 1), (1 / 3, 1 / 2), (2 / 3, 2 / 3), (1, 3 / 5), (1, 1 / 2)]
    want = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(pts, pts[1:]))
    assert metrics.pr_auc(scored, "y", "p").first()[0] == pytest.approx(want)


def test_fbeta(scored):
    # threshold 0.5 (>=): tp=2, fp=1, fn=1 → F2 = 5·2 / (5·2 + 4·1 + 1)
    assert metrics.fbeta(scored, "y", "p", 2.0, 0.5).first()[0] == pytest.approx(10 / 15)
    # zero denominator → 0
    none = scored.where("y = 0")
    assert metrics.fbeta(none, "y", "p", 2.0, 0.95).first()[0] == 0.0


def test_threshold_sweep_grid_and_best(scored):
    grid = metrics.sweep_grid()
    assert len(grid) == 18 and grid[0] == 0.05 and abs(grid[-1] - 0.9) < 1e-12
    sw = {r["i"]: r for r in metrics.threshold_sweep(scored, "y", "p").collect()}
    # 0.95 is not in the grid; at 0.05 every row is predicted positive → not eligible
    assert not sw[0]["eligible"]
    best = metrics.best_threshold(scored, "y", "p").first()
    table = [(r["threshold"], r["score"]) for i, r in sorted(sw.items()) if r["eligible"] and r["score"] > 0]
    top = max(s for _, s in table)
    assert best["threshold"] == next(t for t, s in table if s == top)
    with pytest.raises(ValueError):
        metrics.best_threshold(scored, "y", "p", metric="auc")


def test_composite(scored):
    r = metrics.composite(scored, "y", "p").first()
    # F2 of p > 0.5: tp=2, fp=1, fn=1
    assert r["fbeta"] == pytest.approx(10 / 15)
    assert r["composite"] == pytest.approx(0.7 * 10 / 15 + 0.3 * r["average_precision"])


def test_running_sums_match_pandas(spark):
    import numpy as np
    import pandas as pd
    from tabscore.plans.ranks import running_sums_desc
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"s": rng.random(5000).round(4), "v": rng.integers(0, 5, 5000)})
    g = pdf.groupby("s", as_index=False)["v"].sum()
    want = g.sort_values("s", ascending=False).assign(cum_v=lambda d: d["v"].cumsum())
    got = running_sums_desc(spark.createDataFrame(g), "s", ["v"], buckets=16).toPandas()
    m = want.merge(got, on="s", suffixes=("", "_g"))
    assert len(m) == len(g) and (m["cum_v"] == m["cum_v_g"]).all()


def test_fbetas_one_pass_equals_single(spark):
    from tabscore.operators import metrics as m
    rows = [(i % 3 == 0, (i * 29 % 97) / 97.0) for i in range(300)]
    s = spark.createDataFrame(rows, "y boolean, p double")
    both = m.fbetas(s, "y", "p", {"a": (0.5, True), "b": (0.3, False)}, 2.0).first()
    assert both["a"] == pytest.approx(m.fbeta(s, "y", "p", 2.0, 0.5, strict=True).first()[0])
    assert both["b"] == pytest.approx(m.fbeta(s, "y", "p", 2.0, 0.3).first()[0])
