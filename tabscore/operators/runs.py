"""Run tables: append, best runs, run records.

The run-metrics table has the fixed schema ``timestamp, project_name,
model_name, metric_name, metric_value, pipeline_uri``.  One project constant
is used for both writing and reading runs.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_METRICS_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("project_name", T.StringType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("metric_name", T.StringType()),
    T.StructField("metric_value", T.DoubleType()),
    T.StructField("pipeline_uri", T.StringType()),
])

PROJECT_NAME = "tabscore_project"


def _ranked(runs: DataFrame, project: str, metric: str) -> DataFrame:
    return (runs.where((F.col("project_name") == project) & (F.col("metric_name") == metric))
                .orderBy(F.col("metric_value").desc_nulls_last(), F.col("timestamp"), F.col("pipeline_uri")))


def top_runs(runs: DataFrame, project: str, metric: str = "f2_score", n: int = 5) -> DataFrame:
    """the ``n`` best runs of a project by metric (ties: older first)."""
    return _ranked(runs, project, metric).limit(n)


def best_run(runs: DataFrame, project: str, metric: str = "f2_score") -> DataFrame:
    """the single best run (one row)."""
    return _ranked(runs, project, metric).limit(1)


def best_pipeline_uri(runs: DataFrame, project: str, metric: str = "f2_score") -> str:
    """the best run's ``pipeline_uri``; error when the project has none."""
    row = best_run(runs, project, metric).select("pipeline_uri").first()
    if row is None:
        raise LookupError(f"no run found for project {project!r} and metric {metric!r}")
    return row["pipeline_uri"]


def metric_row(spark: SparkSession, project: str, model: str, metric: str, value: float,
               uri: str) -> DataFrame:
    """A one-row run-metrics frame stamped with the current UTC time."""
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    return spark.createDataFrame([(now, project, model, metric, float(value), uri)], RUN_METRICS_SCHEMA)


def append_metric(df: DataFrame, table: str, path: str | None = None) -> None:
    """Append rows to the run-metrics table; failures raise."""
    w = df.select(*[F.col(f.name).cast(f.dataType) for f in RUN_METRICS_SCHEMA.fields]).write.mode("append")
    if path:
        w = w.option("path", path)
    w.format("parquet").saveAsTable(table)


METADATA = "model_type string, optimal_threshold double, feature_columns array<string>, target_column string, f2_score double"


def metadata_row(spark: SparkSession, meta: dict) -> DataFrame:
    """A model's metadata as one row with typed columns."""
    return spark.createDataFrame([tuple(meta.get(f.name) for f in T._parse_datatype_string(METADATA).fields)], METADATA)


def run_record(spark: SparkSession, run_id: str, params: dict, metrics: dict, artifacts: dict,
               meta: dict) -> dict[str, DataFrame]:
    """A run as four small frames (runs, params, metrics, artifacts); the
    metadata are columns of ``runs``."""
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    runs = metadata_row(spark, meta).select(F.lit(run_id).alias("run_id"), F.lit(now).alias("created"), "*")
    p = spark.createDataFrame([(run_id, k, json.dumps(v, default=str)) for k, v in params.items()],
                              "run_id string, key string, value string")
    m = spark.createDataFrame([(run_id, k, float(v)) for k, v in metrics.items()],
                              "run_id string, key string, value double")
    a = spark.createDataFrame([(run_id, k, v) for k, v in artifacts.items()],
                              "run_id string, name string, uri string")
    return {"runs": runs, "run_params": p, "run_metrics": m, "run_artifacts": a}


def log_run(spark: SparkSession, record: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Append a run's frames (``run_record``) to the run tables below
    ``root``, one append-only Parquet folder per table, and return the folder
    of each.  ``root`` belongs in the shared folder, so the tables outlive
    the job and any executor."""
    paths = {}
    for name, df in record.items():
        path = f"{root.rstrip('/')}/{name}"
        df.write.mode("append").parquet(path)
        paths[name] = path
    return paths
