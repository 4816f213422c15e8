"""Boosted-tree model: pipeline, search, final fit, threshold, importances
(K3-K9, K13-K15, K17, D14).

The prepared frame (label, weight, fold, split) is checkpointed once into the
shared checkpoint folder, so the many passes of the search read a short lineage
and survive executor loss.  All fits of a batch of trials (every fold of each
trial, and each trial on all training rows) grow side by side in shared passes
(``operators.boosting``); the scores of held-out rows come out of the same run.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabscore.functions.text import col
from tabscore.operators import boosting, metrics, sampling
from tabscore.plans import ranks
from tabscore.session import ensure_checkpoint_dir


@dataclass
class TwoStage:
    """K7: a pipeline with named stages ``preprocessor`` and ``classifier``."""
    pipeline: Pipeline
    named_steps: dict = field(default_factory=dict)


def scaled(numeric: Sequence[str]) -> list[str]:
    """Names of the standardised columns."""
    return [f"{c}__std" for c in numeric]


def preprocessor(numeric: Sequence[str]):
    """K1 as a pipeline stage: population standardisation.  Missing values stay missing; the trees have a branch for them."""
    return [boosting.PopulationScaler(inputCols=list(numeric), outputCols=scaled(numeric))]


def build_pipeline(classifier, preprocessor_stages) -> TwoStage:
    """K7: ``Pipeline(preprocessor..., classifier)`` with a name → stage map."""
    pre = list(preprocessor_stages)
    return TwoStage(Pipeline(stages=pre + [classifier]),
                    {"preprocessor": pre, "classifier": classifier})


# Boosting rounds of every fit unless the caller names others.
ROUNDS = 100


def classifier(params: dict | None = None, weight_col: str | None = "weight", numeric: Sequence[str] | None = None, rounds: int = ROUNDS) -> boosting.HistBoost:
    """K6: binary gradient-boosted trees on the standardised columns of ``numeric``."""
    return boosting.HistBoost(inputCols=scaled(numeric) if numeric else None, weightCol=weight_col, rounds=rounds, **(params or {}))


def with_score(scored: DataFrame, out: str = "p1") -> DataFrame:
    """K9: P(class 1) as a double column (from a double or from a class vector)."""
    p = F.col("probability")
    return scored.withColumn(out, p if dict(scored.dtypes)["probability"] == "double" else vector_to_array(p).getItem(1))


class CompositeEvaluator(Evaluator):
    """K13 as a Spark ML ``Evaluator``: ``0.7·F2 + 0.3·AP`` of the
    ``probability`` column (F2 of the predicted label)."""

    def __init__(self, beta: float = 2.0, w_f: float = 0.7, w_ap: float = 0.3):
        super().__init__()
        self.beta, self.w_f, self.w_ap = beta, w_f, w_ap

    def frame(self, dataset: DataFrame) -> DataFrame:
        """The metric as a one-row DataFrame (fbeta, average_precision,
        composite); ``evaluate`` reads its single value."""
        return metrics.composite(with_score(dataset), "label", "p1", self.beta, self.w_f, self.w_ap)

    def _evaluate(self, dataset: DataFrame) -> float:
        return float(self.frame(dataset).first()["composite"])

    def isLargerBetter(self) -> bool:
        return True


# The search space (leaves 20-100, learning rate 0.01-0.3 log, depth 3-12, minimum rows per leaf 10-100).
SPACE = {"num_leaves": (20, 100), "learning_rate": (0.01, 0.3), "max_depth": (3, 12), "min_data_in_leaf": (10, 100)}
LOG = {"learning_rate"}


def _unit(name: str, value: float, space: dict) -> float:
    lo, hi = space[name]
    return (math.log(value / lo) / math.log(hi / lo)) if name in LOG else (value - lo) / (hi - lo)


def _value(name: str, u: float, space: dict):
    lo, hi = space[name]
    return lo * (hi / lo) ** u if name in LOG else min(hi, lo + int(u * (hi - lo + 1)))


def draw_params(n_trials: int, seed: int = 42, space: dict | None = None) -> list[dict]:
    """K8: seeded random draws (log-uniform for the learning rate)."""
    space = space or SPACE
    rng = random.Random(seed)
    return [{name: _value(name, rng.random(), space) for name in space} for _ in range(n_trials)]


def propose(history: list[tuple[dict, float]], n: int, seed: int = 42, space: dict | None = None, startup: int = 10, candidates: int = 24) -> list[dict]:
    """K8: the next ``n`` trials, learned from earlier ``(params, score)``.  The first ``startup`` trials are random; then, of some draws
    around the best quarter's values, the one that is likeliest under the best and unlikeliest under the others (a
    Parzen estimate for each parameter)."""
    space = space or SPACE
    if len(history) < startup:
        return draw_params(n, seed + len(history), space)
    ranked = sorted(history, key=lambda x: -x[1])
    cut = max(1, math.ceil(len(ranked) / 4))
    rng = random.Random(seed * 1_000_003 + len(history))

    def density(u: float, points: list[float]) -> float:
        width = max(0.05, 1.0 / max(1, len(points)))
        return (1.0 + sum(math.exp(-((u - p) / width) ** 2 / 2) / width for p in points)) / (len(points) + 1)
    out = []
    for _ in range(n):
        one = {}
        for name in space:
            good, bad = ([_unit(name, p[name], space) for p, _ in part] for part in (ranked[:cut], ranked[cut:]))
            draws = [min(0.999999, max(0.0, rng.gauss(rng.choice(good), max(0.05, 1.0 / len(good) / 4)))) for _ in range(candidates)]
            one[name] = _value(name, max(draws, key=lambda u: density(u, good) / density(u, bad)), space)
        out.append(one)
    return out


def prepare(df: DataFrame, target: str, keys: Sequence[str], test_size: float = 0.2,
            folds: int = 3, seed: int = 42, checkpoint: bool = True) -> DataFrame:
    """label/weight/split/fold in one frame; NULL labels dropped; test rows
    get fold -1.  One ranking gives both: of a class, the ranks up to its
    quota are test, the others go round the folds (the same rows as
    ``stratified_split`` and ``stratified_folds``).  Checkpointed to the shared folder when asked."""
    labelled = df.where(col(target).isNotNull())
    key = F.struct(col(target).alias("c0"), F.lit(0).alias("_")).alias("_k")
    totals = labelled.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    quota = sampling.test_quota(totals, test_size)
    ranked = ranks.rank_in_class(labelled, [target], keys, seed, rank_col="_rk").withColumn("_k", key)
    both = (ranked.join(quota, "_k")
            .withColumn("split", F.when(F.col("_rk") <= F.col("_q"), F.lit("test")).otherwise(F.lit("train")))
            .withColumn("fold", F.when(F.col("split") == "test", F.lit(-1))
                        .otherwise(F.pmod(F.col("_rk") - F.col("_q") - 1, F.lit(folds))).cast("int"))
            .drop("_k", "_q", "_rk"))
    both = both.withColumn("label", col(target).cast("double"))
    if checkpoint:
        ensure_checkpoint_dir(df.sparkSession)
        both = both.checkpoint(eager=True)
    # K5 weights come from the training part only.  Counted after the
    # checkpoint, so the split and fold plans run once, not twice.
    r = both.where(F.col("split") == "train").agg(
        F.count_if(F.col("label") == 1.0).alias("p"), F.count_if(F.col("label") == 0.0).alias("n")).first()
    ratio = float(r["n"]) / max(int(r["p"]), 1)
    return both.withColumn("weight", F.when(F.col("label") == 1.0, F.lit(ratio)).otherwise(F.lit(1.0)))


@dataclass
class SearchResult:
    """``fold_scores``: (trial, fold, params, score).  ``held_out``: (trial, fold, label, p1) of every training row under the fit that
    hasn't seen it.  ``models``: each trial's fit on all training rows."""
    fold_scores: DataFrame
    held_out: DataFrame
    models: list[boosting.HistBoostModel]


def search(train: DataFrame, numeric: Sequence[str], params: list[dict], folds: int = 3, parallelism: int = 32,
           rounds: int = ROUNDS, evaluator: Evaluator | None = None, parts: int | None = None, in_task: bool = False, first: int = 0) -> SearchResult:
    """K8: cross-validate every parameter set on the ``fold`` column with any Spark ML evaluator (the composite one by
    default).  All folds of all trials, and each trial on all rows, grow in shared passes; ``parts``: tasks of a pass;
    ``in_task``: the rows fit in a task (a bounded sample), so each fit grows in one; ``first``: number of the first trial."""
    from concurrent.futures import ThreadPoolExecutor

    spark = train.sparkSession
    fits = [boosting.Fit(held_out=f, **p) for p in params for f in [*range(folds), -1]]
    rows = train.select(*[col(c) for c in numeric], "label", "weight", "fold")
    if in_task:
        ensembles, edges, scored = boosting.fit_each(rows, numeric, fits, rounds)
    else:
        ensembles, edges, state = boosting.fit_many(rows, numeric, fits, rounds, parts)

        def held(b):
            for i, fit in enumerate(fits):
                at = b.fold == fit.held_out
                if fit.held_out >= 0:
                    yield from ((i, y, s) for y, s in zip(b.y[at].tolist(), b.scores[at, i].tolist()))
        scored = spark.createDataFrame(state.flatMap(held), "fit int, label double, raw double").checkpoint(eager=True)
        state.unpersist()
    held_out = scored.select((F.lit(first) + F.floor(F.col("fit") / (folds + 1))).cast("int").alias("trial"), (F.col("fit") % (folds + 1)).alias("fold"),
                             "label", (1.0 / (1.0 + F.exp(-F.col("raw")))).alias("probability"))
    evaluator = evaluator or CompositeEvaluator()

    def run(job):
        i, f = job
        part = held_out.where((F.col("trial") == first + i) & (F.col("fold") == f))
        return first + i, f, json.dumps(params[i], sort_keys=True), float(evaluator.evaluate(part))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        results = list(pool.map(run, [(i, f) for i in range(len(params)) for f in range(folds)]))
    models = [boosting.HistBoostModel(list(numeric), boosting.node_rows(ensembles[i * (folds + 1) + folds], edges)) for i in range(len(params))]
    return SearchResult(spark.createDataFrame(results, "trial int, fold int, params string, score double"), held_out, models)


def fold_means(fold_scores: DataFrame) -> DataFrame:
    """``(trial, params, mean_score)`` from the fold scores."""
    return fold_scores.groupBy("trial", "params").agg(F.avg("score").alias("mean_score"))


def fit_final(train: DataFrame, numeric: Sequence[str], params: dict, weight: bool = True, rounds: int = ROUNDS) -> PipelineModel:
    """K6/K7: fit the two-stage pipeline on all training rows."""
    return build_pipeline(classifier(params, "weight" if weight else None, numeric, rounds), preprocessor(numeric)).pipeline.fit(train)


def importances(model: PipelineModel, numeric: Sequence[str]) -> DataFrame:
    """Importance of every feature by its number of splits, and its share of the gain, highest first."""
    spark = SparkSession.active()
    found = boosting.split_importances(model.stages[-1].node_table(spark), scaled(numeric))
    total = F.sum("gain").over(Window.partitionBy())  # a row per feature
    names = F.regexp_replace("feature_name", "__std$", "")
    return (found.select(names.alias("feature_name"), F.col("splits").cast("double").alias("importance"), F.coalesce(F.try_divide("gain", total), F.lit(0.0)).alias("gain_share"))
            .orderBy(F.desc("importance"), "feature_name"))


@dataclass
class TrainResult:
    model: PipelineModel
    best_params: dict
    fold_scores: DataFrame
    threshold: float
    f2_default: float
    f2_tuned: float
    test_scored: DataFrame


def train(df: DataFrame, numeric: Sequence[str], target: str, keys: Sequence[str],
          n_trials: int = 3, folds: int = 3, test_size: float = 0.2, seed: int = 42,
          parallelism: int = 32, rounds: int = ROUNDS, checkpoint: bool = True,
          evaluator: Evaluator | None = None, space: dict | None = None, parts: int | None = None, in_task: bool = False, batch: int = 8) -> TrainResult:
    """K8 → K6 → K14: search on the training folds, fit on all training rows,
    tune the threshold on a held-out fold, and report F2 on the test rows at 0.5 and at the tuned threshold.
    ``rounds``: boosting rounds of every fit; ``evaluator`` and ``space``: what the search maximises, and where; ``parts``:
    tasks of a pass; ``in_task``: the frame is a sample that a task holds; ``batch``: trials that grow side by side, the next batch being proposed from the scores so far.

    The final model is the best trial's fit on all training rows, and the threshold is tuned on the rows its first fold held out:
    both come out of the search's own passes."""
    prep = prepare(df.select(*keys, *[c for c in numeric if c not in keys], target), target, keys,
                   test_size, folds, seed, checkpoint)
    tr = prep.where(F.col("split") == "train")
    te = prep.where(F.col("split") == "test")
    scaler = preprocessor(numeric)[0].fit(tr)
    rows = scaler.transform(tr)
    params, found, history = [], [], []
    while len(params) < n_trials:
        some = propose(history, min(batch, n_trials - len(params)), seed, space)
        found.append((len(params), search(rows, scaled(numeric), some, folds, parallelism, rounds, evaluator, parts, in_task, first=len(params))))
        params += some
        means = {r["trial"]: r["mean_score"] for r in fold_means(found[-1][1].fold_scores).collect()}  # a row per trial
        history += [(p, means[found[-1][0] + i]) for i, p in enumerate(some)]
    best = max(range(n_trials), key=lambda i: (history[i][1], -i))
    first, res = next(x for x in reversed(found) if x[0] <= best)
    scores = found[0][1].fold_scores
    for _, more in found[1:]:
        scores = scores.unionByName(more.fold_scores)
    final = PipelineModel([scaler, res.models[best - first]])
    val = with_score(res.held_out.where((F.col("trial") == best) & (F.col("fold") == 0)))
    thr = metrics.best_threshold(val, "label", "p1").first()["threshold"]
    scored = with_score(final.transform(te))
    # Both test-part scores in one pass over the scored test rows.
    f2 = metrics.fbetas(scored, "label", "p1", {"default": (0.5, True), "tuned": (thr, False)}, 2.0).first()
    return TrainResult(final, {**params[best], "rounds": rounds}, scores, float(thr), float(f2["default"]), float(f2["tuned"]), scored)
