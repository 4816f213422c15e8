"""Histogram boosting against a plain version that splits one leaf at a time; scores as expressions; the ML stages."""

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tabscore.operators import boosting as bo
from tabscore.operators import model as mdl

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(4)
    n = 900
    x = rng.normal(size=(n, 3)).round(2)
    x[:, 1] = rng.integers(0, 4, n)
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] == 2)).astype(float)
    y[rng.random(n) < 0.1] = 1
    miss = rng.random(n) < 0.15
    y[miss] = (rng.random(miss.sum()) < 0.8).astype(float)
    rows = [(None if miss[i] else float(x[i, 0]), float(x[i, 1]), float(x[i, 2]), float(y[i]), 1.0 + (i % 2), i % 3, i) for i in range(n)]
    return spark.createDataFrame(rows, "a double, b double, c double, label double, weight double, fold int, k int").repartition(3).cache()


def codes_of(rows, edges):
    return np.array([[0 if r[c] is None else 1 + sum(r[c] > e for e in es) for c, es in zip(COLS, edges)] for r in rows])


def plain_tree(codes, g, h, fit):
    """One leaf at a time, by largest gain; every split tried one by one.  Returns {node: row numbers} of the leaves and their values."""
    def best(rows, depth):
        if depth >= fit.max_depth:
            return None
        top, G, H = None, g[rows].sum(), h[rows].sum()
        for f in range(codes.shape[1]):
            for b in range(1, bo.BINS + 1):
                for miss_left in (False, True):
                    c = codes[rows, f]
                    go = np.where(c == 0, miss_left, c <= b)
                    left, right = rows[go], rows[~go]
                    if min(len(left), len(right)) < fit.min_data_in_leaf or min(h[left].sum(), h[right].sum()) < fit.min_hessian:
                        continue
                    gain = sum(g[s].sum() ** 2 / (h[s].sum() + fit.l2) for s in (left, right)) - G ** 2 / (H + fit.l2)
                    if gain > 1e-12 and (top is None or gain > top[0] + 1e-9):
                        top = (gain, left, right)
        return top
    leaves = [(np.arange(len(codes)), 0)]
    known = [best(*leaves[0])]
    while len(leaves) < fit.num_leaves and any(known):
        i = max((i for i in range(len(leaves)) if known[i]), key=lambda i: known[i][0])
        _, left, right = known.pop(i)
        depth = leaves.pop(i)[1] + 1
        leaves += [(left, depth), (right, depth)]
        known += [best(left, depth), best(right, depth)]
    value = np.zeros(len(codes))
    for rows, _ in leaves:
        value[rows] = -g[rows].sum() / (h[rows].sum() + fit.l2) * fit.learning_rate
    return value, sorted(len(r) for r, _ in leaves)


@pytest.mark.parametrize("parts", [None, 2, 20])
def test_shared_passes_equal_plain_trees(frame, parts):
    fits = [bo.Fit(0, num_leaves=6, max_depth=3, min_data_in_leaf=15, learning_rate=0.3), bo.Fit(-1, num_leaves=9, max_depth=8, min_data_in_leaf=30), bo.Fit(2, num_leaves=2)]
    ensembles, edges, state = bo.fit_many(frame, COLS, fits, rounds=3, parts=parts)
    rows = sorted(frame.collect(), key=lambda r: r.k)
    codes, y, w, fold = codes_of(rows, edges), *(np.array([r[k] for r in rows]) for k in ("label", "weight", "fold"))
    for fit, trees in zip(fits, ensembles):
        at, score = np.flatnonzero(fold != fit.held_out), np.zeros(len(rows))
        for t in trees:
            p = 1 / (1 + np.exp(-score[at]))
            value, sizes = plain_tree(codes[at], (p - y[at]) * w[at], p * (1 - p) * w[at], fit)
            leaf = t.leaves(codes)
            assert t.value[leaf[at]] == pytest.approx(value, abs=1e-9)
            assert sorted(t.n[t.left < 0].tolist()) == sizes and len(sizes) <= fit.num_leaves
            score += t.value[leaf]
    got = np.concatenate(state.map(lambda b: b.scores).collect())
    want = np.stack([sum(t.value[t.leaves(codes)] for t in trees) for trees in ensembles], 1)
    assert np.sort(got, 0) == pytest.approx(np.sort(want, 0), abs=1e-9)
    state.unpersist()


def test_fits_in_tasks_equal_shared_passes(frame):
    fits = [bo.Fit(0, num_leaves=6, max_depth=3, min_data_in_leaf=15, learning_rate=0.3), bo.Fit(-1, num_leaves=9, max_depth=8, min_data_in_leaf=30)]
    shared, edges, state = bo.fit_many(frame, COLS, fits, rounds=4, parts=1)
    each, edges_2, scored = bo.fit_each(frame, COLS, fits, rounds=4)
    assert edges == edges_2
    for a, b in zip(shared, each):
        for t, u in zip(a, b):
            assert all((getattr(t, k) == getattr(u, k)).all() for k in ("feature", "bin", "missing_left", "left", "right", "n"))
            assert t.value == pytest.approx(u.value, abs=1e-9)
    held = sorted(x for b in state.collect() for x in b.scores[b.fold == 0, 0].tolist())
    assert sorted(r.raw for r in scored.collect()) == pytest.approx(held, abs=1e-9)
    state.unpersist()


def test_expression_equals_walked_arrays(frame, spark):
    model = bo.HistBoost(inputCols=COLS, weightCol="weight", rounds=12, num_leaves=12, max_depth=7).fit(frame)
    odd = spark.createDataFrame([(None, None, None), (float("nan"), 1.0, float("inf")), (-1e300, 2.0, None)], "a double, b double, c double")
    both = frame.select(*COLS).unionByName(odd)
    got = model.transform(both).collect()
    x = np.array([[np.nan if r[c] is None else r[c] for c in COLS] for r in got])
    assert [r.probability for r in got] == pytest.approx(bo.score_arrays(model.nodes, x).tolist(), abs=1e-12)
    learned = model.transform(frame).select(F.avg(((F.col("probability") > 0.5).cast("int") == F.col("label")).cast("int"))).first()[0]
    assert learned > 0.8


def test_written_ensemble(spark):
    nodes = [(0, 0, 0, 1.5, True, 1, 2, None, 9.0, 10), (0, 1, None, None, None, None, None, -0.5, None, 4), (0, 2, 1, math.inf, False, 3, 4, None, 2.0, 6),
             (0, 3, None, None, None, None, None, 0.25, None, 3), (0, 4, None, None, None, None, None, 2.0, None, 3), (1, 0, None, None, None, None, None, 0.125, None, 10)]
    rows = [(1.5, 0.0), (1.6, 0.0), (2.0, None), (None, None), (float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    assert [r[0] for r in df.select(bo.raw_column(nodes, ["a", "b"])).collect()] == [-0.375, 0.375, 2.125, -0.375, -0.375]
    assert df.select(bo.score_column([], ["a", "b"])).first()[0] == 0.5


def test_pipeline_is_saved_and_loaded(frame, spark, tmp_path):
    two = mdl.build_pipeline(mdl.classifier({"num_leaves": 8}, "weight", COLS, rounds=5), mdl.preprocessor(COLS))
    fitted = two.pipeline.fit(frame)
    fitted.write().overwrite().save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m"))
    assert [type(s).__name__ for s in back.stages] == ["PopulationScalerModel", "HistBoostModel"]
    a, b = ({r.k: r.probability for r in m.transform(frame).collect()} for m in (fitted, back))
    assert a == b
    pipe = Pipeline(stages=[bo.PopulationScaler(inputCols=["b"], outputCols=["b__std"])])
    pipe.write().overwrite().save(str(tmp_path / "p"))
    z = Pipeline.load(str(tmp_path / "p")).fit(frame).transform(frame).agg(F.avg("b__std"), F.stddev_pop("b__std")).first()
    assert z[0] == pytest.approx(0, abs=1e-9) and z[1] == pytest.approx(1)
    imp = mdl.importances(fitted, COLS).collect()
    assert {r.feature_name for r in imp} == set(COLS) and sum(r.gain_share for r in imp) == pytest.approx(1)
    assert sum(r.importance for r in imp) == sum(1 for n in fitted.stages[-1].nodes if n[5] is not None)


def test_search_scores_held_out_rows(frame):
    params = [{"num_leaves": 4, "max_depth": 2, "learning_rate": 0.2, "min_data_in_leaf": 20}, {"num_leaves": 12, "max_depth": 6, "learning_rate": 0.1, "min_data_in_leaf": 10}]
    res = mdl.search(frame, COLS, params, folds=3, rounds=4)
    inside = mdl.search(frame, COLS, params, folds=3, rounds=4, in_task=True)
    assert {(r.trial, r.fold): round(r.score, 6) for r in inside.fold_scores.collect()} == {(r.trial, r.fold): round(r.score, 6) for r in res.fold_scores.collect()}
    assert res.held_out.groupBy("trial", "fold").count().count() == 6 and res.held_out.count() == 2 * frame.count()
    alone = bo.HistBoost(inputCols=COLS, weightCol="weight", rounds=4, **params[1]).fit(frame.where("fold <> 1"))
    want = sorted(round(r.probability, 6) for r in alone.transform(frame.where("fold = 1")).collect())
    got = sorted(round(r.probability, 6) for r in res.held_out.where("trial = 1 and fold = 1").collect())
    # the bins of a fit alone are cut from its own rows only; nearly all rows score alike
    assert sum(abs(a - b) < 0.05 for a, b in zip(got, want)) > 0.9 * len(want)
    assert res.fold_scores.count() == 6 and len(res.models) == 2


def test_odd_training_frames(spark):
    shape = "a double, b double, c double, label double, weight double, fold int"
    one = spark.createDataFrame([(1.0, None, None, 1.0, 1.0, 0)] * 30, shape)
    model = bo.HistBoost(inputCols=COLS, rounds=2).fit(one)
    assert model.transform(one).first().probability > 0.5
    none = bo.HistBoost(inputCols=COLS, rounds=2).fit(one.limit(0))
    assert none.transform(one).first().probability == 0.5


def test_proposals_learn_from_earlier_trials():
    def score(p):
        return -abs(p["max_depth"] - 9) / 9 - abs(math.log(p["learning_rate"] / 0.05))
    history = []
    for _ in range(12):
        history += [(p, score(p)) for p in mdl.propose(history, 4, seed=3)]
    random_mean = np.mean([s for _, s in history[:12]])
    assert np.mean([s for _, s in history[-12:]]) > random_mean + 0.2
    for p, _ in history:
        assert all(lo <= p[k] <= hi for k, (lo, hi) in mdl.SPACE.items())
    assert mdl.propose([], 2) == mdl.propose([], 2)


def test_walk_of_a_tree_with_many_leaves():
    """More leaves than a word has bits, values at thresholds, missing and infinite ones."""
    rng, rows, open_, n = np.random.default_rng(3), {}, [0], 1
    while len(open_) < 150:
        i = open_.pop(int(rng.integers(len(open_))))
        rows[i] = (0, i, int(rng.integers(3)), [0.25, 0.5, 0.75, math.inf][int(rng.integers(4))] + round(float(rng.random()), 2), bool(rng.random() < 0.5), n, n + 1, None, 1.0, 1)
        open_ += [n, n + 1]
        n += 2
    rows |= {i: (0, i, None, None, None, None, None, float(i), None, 1) for i in open_}
    nodes = [rows[i] for i in sorted(rows)] + [(1, 0, None, None, None, None, None, 0.5, None, 1)]
    x = np.round(rng.random((500, 3)) * 2, 2)
    x[::5, 0], x[::7, 1], x[3, 2], x[4, 2] = math.nan, math.nan, math.inf, -math.inf

    def value(row, i=0):
        _, _, f, threshold, missing_left, left, right, v, *_ = rows[i]
        if left is None:
            return v
        return value(row, left if (missing_left if math.isnan(row[f]) else row[f] <= threshold) else right)
    want = [1 / (1 + math.exp(-(value(r) / 100 + 0.5))) for r in x]
    scaled = [(*r[:7], r[7] / 100, *r[8:]) if r[7] is not None and r[0] == 0 else r for r in nodes]
    assert bo.Walk(scaled)(x).tolist() == pytest.approx(want, abs=1e-12)


def test_trees_are_compiled(spark):
    """No tree is an argument of a lambda function: those are interpreted, node by node."""
    nodes = [(k, *r) for k in range(3) for r in ((0, 0, 0.5, False, 1, 2, None, 1.0, 2), (1, None, None, None, None, None, 1.0, None, 1), (2, None, None, None, None, None, 2.0, None, 1))]
    df = spark.createDataFrame([(0.0,), (1.0,), (None,)], "a double").select(bo.raw_column(nodes, ["a"]).alias("raw"))
    plan = df._jdf.queryExecution().analyzed().toString()
    assert "CASE" not in plan[plan.index("aggregate("):].split("lambdafunction", 1)[0] and plan.count("CASE") == 3
    assert [r.raw for r in df.collect()] == [3.0, 6.0, 6.0]


def test_only_the_runs_test_rows_are_scored(spark, tmp_path, monkeypatch):
    """The stored test rows go to the wide table before it is scored, and all of them are found."""
    from tabscore.plans import catalog_ml as cm
    from tabscore.plans import fixtures as fx

    from .conftest import SF001
    model = PipelineModel([bo.HistBoostModel(cm._ENSEMBLE_COLS, cm._ENSEMBLE)])
    monkeypatch.setattr(cm.stored, "feature_names", lambda *_: (cm._ENSEMBLE_COLS, "returned", None))
    monkeypatch.setattr(cm.stored, "best_model", lambda *_: (model, 0.5))
    monkeypatch.setattr(cm.stored, "best_run", lambda *_: str(tmp_path))
    rows = model.transform(fx.wide(spark, SF001).where("l_orderkey % 50 = 0"))
    rows.select(*cm.KEYS, "probability").write.parquet(str(tmp_path / "test_scored"))
    n = rows.count()
    assert [tuple(r) for r in cm.a15_model_artifact(spark, SF001).collect()] == [(n, n)] and n > 0
    only = spark.read.parquet(str(tmp_path / "test_scored")).select(*cm.KEYS)
    assert cm._scored(spark, SF001, only=only)[0].count() == n < fx.wide(spark, SF001).count()
