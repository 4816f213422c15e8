"""Results that are made once and read back: the role table and the training run.

Both live in the shared folder, named by a mark of their source (its files' paths, sizes and times) and one of their
settings and code, so a change of either gives a new one, and every query reads stored rows instead of profiling or
training again.  The folder stays the same from job to job, and so does the run registry: its tables are appended to by
every run and read by best-run queries.
"""

from __future__ import annotations

import hashlib
import inspect
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscore.operators import assoc, boosting, features, metrics
from tabscore.operators import model as mdl
from tabscore.operators import profile as prof
from tabscore.operators import roles as rl
from tabscore.operators import runs
from tabscore.operators import sampling as smp
from tabscore.plans import fixtures as fx
from tabscore.plans import ranks
from tabscore.session import shared_root
from tabscore.sources import tables as tb

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
SAMPLE_SIZE = 10_000
TRIALS, FOLDS = 3, 3
#: Rounds of the second, shorter run.
SHORT_ROUNDS = 10
#: Columns whose association with the target is flagged, and the cut.
ASSOC_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "ship_hhmm", "arr_hhmm"]
ASSOC_CAT = ["l_linenumber", "l_linestatus", "l_returnflag", "returned"]
HIGH = 0.85


def source_mark(spark: SparkSession, sf: str, table: str) -> str:
    """Hash of a table's file paths, sizes and modification times (no data column is read)."""
    files = spark.read.parquet(f"{sf.rstrip('/')}/{table}.parquet").select(
        F.xxhash64("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").alias("h")).distinct()
    return f"{files.agg(F.bit_xor('h')).first()[0] or 0:x}".replace("-", "m")


def settings_mark(*settings) -> str:
    """Hash of the settings and of the code that makes the results."""
    code = "".join(inspect.getsource(m) for m in (assoc, boosting, features, fx, mdl, metrics, prof, ranks, rl, smp))
    return hashlib.md5(f"{settings}{code}".encode()).hexdigest()[:12]


def once(spark: SparkSession, name: str, make: Callable[[str], None]) -> str:
    """Folder ``name`` below the shared folder, made by ``make(path)`` unless a finished one is there.  Two callers that make it at
    once write two folders; the note that is written last is the one that is read from then on."""
    root = shared_root(spark)
    note = f"{root}/notes/{name}"
    try:
        return spark.read.parquet(note).first()["path"]
    except AnalysisException:
        path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
        make(path)
        spark.createDataFrame([(path,)], "path string").write.mode("overwrite").parquet(note)
        return path


def role_table(spark: SparkSession, sf: str) -> DataFrame:
    """The profile of the wide table with roles, computed."""
    p = prof.profile(fx.wide(spark, sf), skip=fx.WIDE_PROFILE_SKIP, digits=6, keep_ordinal=True)
    return rl.assign_roles(p, fx.WIDE_ROLES, fx.WIDE_SKIP_REASONS, fx.WIDE_LEAKAGE)


def stored_roles(spark: SparkSession, sf: str) -> DataFrame:
    """The role table with the high-association flag (D17), read back from where it was written once."""
    def make(path: str) -> None:
        matrix = assoc.association_matrix(fx.wide(spark, sf), ASSOC_NUM, ASSOC_CAT, bins=10, method="phik")
        rl_table = assoc.add_flag(role_table(spark, sf), assoc.flag_high(matrix, "returned", HIGH))
        rl_table.coalesce(1).write.parquet(path)  # one row per source column
    mark = settings_mark(ASSOC_NUM, ASSOC_CAT, HIGH)
    return spark.read.parquet(once(spark, f"roles-{mark}-{source_mark(spark, sf, 'lineitem')}", make))


def feature_names(spark: SparkSession, sf: str) -> tuple[list[str], str, DataFrame]:
    """Numeric feature names, target name and the stored role table."""
    rt = stored_roles(spark, sf)
    num = rl.columns_by_role(rt, "num", skip=fx.WIDE_SKIP_ADDITIONAL, order_col="ordinal")
    return num, rl.target_column(rt, order_col="ordinal"), rt


def trained_run(spark: SparkSession, sf: str, rounds: int = mdl.ROUNDS) -> str:
    """Folder of the training run on the wide table: the balanced sample, search, final fit and everything K17 records,
    written once.  Below it: ``model``, ``fold_scores``, ``test_scored``, ``feature_importances``, ``columns_roles`` and
    ``model_metadata``; the run is appended to the registry."""
    source, mark = source_mark(spark, sf, "lineitem"), settings_mark(SAMPLE_SIZE, TRIALS, FOLDS, rounds, KEYS)

    def make(base: str) -> None:
        num, tgt, rt = feature_names(spark, sf)
        sample = smp.balanced_sample(fx.wide(spark, sf), tgt, SAMPLE_SIZE, KEYS)
        res = mdl.train(sample, num, tgt, KEYS, n_trials=TRIALS, folds=FOLDS, rounds=rounds, in_task=True)  # SAMPLE_SIZE bounds the rows
        res.model.write().overwrite().save(f"{base}/model")
        res.fold_scores.write.parquet(f"{base}/fold_scores")
        res.test_scored.select(*KEYS, "label", F.col("p1").alias("probability"), (F.col("p1") > 0.5).cast("int").alias("prediction")).write.parquet(f"{base}/test_scored")
        tb.write_csv(mdl.importances(res.model, num), f"{base}/feature_importances", single_file=True)
        tb.write_json(rl.role_mapping(rt, num + [tgt]), f"{base}/columns_roles", single_file=True)
        meta = {"model_type": "hist_boost_pipeline", "optimal_threshold": res.threshold, "feature_columns": num, "target_column": tgt, "f2_score": res.f2_tuned}
        tb.write_json(runs.metadata_row(spark, meta), f"{base}/model_metadata", single_file=True)
        artifacts = {n: f"{base}/{n}" for n in ("model", "feature_importances", "columns_roles", "model_metadata")}
        rec = runs.run_record(spark, base.rsplit("/", 1)[-1],
                              {**res.best_params, "skip_additional_columns": fx.WIDE_SKIP_ADDITIONAL, "num_features_used": len(num), "optimal_threshold": res.threshold},
                              {"f2_score": res.f2_tuned, "f2_default": res.f2_default}, artifacts, meta)
        rec["run_scores"] = runs.metric_row(spark, project(source), "hist_boost", "f2_score", res.f2_tuned, f"{base}/model")
        runs.log_run(spark, rec, registry(spark))
    return once(spark, f"run-{rounds}-{mark}-{source}", make)


def registry(spark: SparkSession) -> str:
    """Folder of the run tables: one for all jobs and runs."""
    return f"{shared_root(spark)}/registry"


def project(source: str) -> str:
    """A source's runs are one project."""
    return f"{runs.PROJECT_NAME}/{source}"


def run_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Rows of the run ``base`` in a run table."""
    return spark.read.parquet(f"{registry(spark)}/{name}").where(F.col("run_id") == base.rsplit("/", 1)[-1])


def scores(spark: SparkSession) -> DataFrame:
    """The run-metrics table of the registry."""
    return spark.read.parquet(f"{registry(spark)}/run_scores")


def best_run(spark: SparkSession, sf: str) -> str:
    """folder of the best among the source's runs (a full and a short one at least)."""
    trained_run(spark, sf)
    trained_run(spark, sf, SHORT_ROUNDS)
    return runs.best_pipeline_uri(scores(spark), project(source_mark(spark, sf, "lineitem"))).rsplit("/", 1)[0]


def best_model(spark: SparkSession, sf: str) -> tuple[PipelineModel, float]:
    """The best run's model, loaded, and the threshold that the run recorded."""
    base = best_run(spark, sf)
    return PipelineModel.load(f"{base}/model"), run_table(spark, base, "runs").first()["optimal_threshold"]
