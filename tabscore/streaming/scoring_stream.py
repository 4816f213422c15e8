"""Structured Streaming forms (M1, M2).

M1: record files → validation → model → append sink.  Stateless, so the
checkpoint holds only source offsets; ``availableNow`` drains what is there
and stops, a processing-time trigger keeps running.

M2: per micro-batch metric rows of the run-metrics schema, appended through
``foreachBatch``.

Sinks are partitioned by ``(run_id, batch_id)``, and a batch overwrites only its own
partition: a batch replayed after a failure replaces its rows instead of
doubling them, and a run with a fresh checkpoint, whose batches count from 0
again, keeps the rows of the runs before it.  A run that goes on with its checkpoint must keep its ``run_id``.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscore.functions.text import col
from tabscore.operators.runs import RUN_METRICS_SCHEMA
from tabscore.operators.scoring import score, validate


def _put(rows: DataFrame, run_id: str, batch_id: int, path: str) -> None:
    """Rows of a batch in the batch's own partition."""
    (rows.withColumns({"run_id": F.lit(run_id), "batch_id": F.lit(batch_id)}).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "batch_id").parquet(path))


def read_sink(spark: SparkSession, path: str) -> DataFrame:
    """A sink's rows, the run's name as text whatever it looks like."""
    schema = spark.read.parquet(path).schema
    return spark.read.schema(T.StructType([T.StructField("run_id", T.StringType()) if f.name == "run_id" else f for f in schema])).parquet(path)


def score_stream(spark: SparkSession, in_dir: str, schema: T.StructType, model: PipelineModel,
                 out_dir: str, rejected_dir: str, checkpoint: str, threshold: float = 0.5,
                 available_now: bool = True, max_files_per_trigger: int | None = None, run_id: str = "stream"):
    """M1: score every JSON-lines record file that lands in ``in_dir``.  Invalid
    records go to ``rejected_dir`` with their errors: scored and rejected
    rows together are the input's."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.load(in_dir)

    def handle(batch: DataFrame, batch_id: int) -> None:
        # Scored and rejected rows are two writes of one batch: keep the
        # batch's lines so the files are read once (a lost block is re-read
        # from the source files by lineage).
        lines = batch.persist()
        try:
            valid, rejected = validate(lines, schema)
            _put(score(valid, model, threshold), run_id, batch_id, out_dir)
            _put(rejected, run_id, batch_id, rejected_dir)
        finally:
            lines.unpersist()

    w = raw.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def metric_rows(batch: DataFrame, group_cols: list[str], value_col: str, project: str, model: str, uri: str) -> DataFrame:
    """``n``, ``mean`` and ``max`` of a value by group as rows of the run-metrics schema; ``metric_name`` is the group's values and
    the statistic, joined by ``/``."""
    agg = batch.groupBy(*[col(c) for c in group_cols]).agg(F.count(F.lit(1)).cast("double").alias("n"), F.avg(col(value_col)).alias("mean"), F.max(col(value_col)).cast("double").alias("max"))
    group = F.concat_ws("/", *[F.coalesce(col(c).cast("string"), F.lit("null")) for c in group_cols])
    long = agg.select(group.alias("g"), F.inline(F.array(*[F.struct(F.lit(k).alias("stat"), F.col(k).alias("metric_value")) for k in ("n", "mean", "max")])))
    made = long.select(F.current_timestamp().alias("timestamp"), F.lit(project).alias("project_name"), F.lit(model).alias("model_name"),
                       F.concat_ws("/", "g", "stat").alias("metric_name"), "metric_value", F.lit(uri).alias("pipeline_uri"))
    return made.select(*[F.col(f.name).cast(f.dataType) for f in RUN_METRICS_SCHEMA.fields])


def metrics_stream(spark: SparkSession, source: DataFrame, out_dir: str, checkpoint: str,
                   group_cols: list[str], value_col: str, available_now: bool = True,
                   run_id: str = "stream", project: str = "stream", model: str = "", uri: str = ""):
    """M2: per micro-batch ``n / mean / max`` of a value by group, appended to a run-metrics table, idempotent on
    ``(run_id, batch_id)``."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        _put(metric_rows(batch, group_cols, value_col, project, model, uri), run_id, batch_id, out_dir)

    w = source.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def merged_metrics(rows: DataFrame) -> DataFrame:
    """Batches of each run and group put together: run_id, grp, n, mean_value, max_value."""
    cut = F.regexp_extract("metric_name", "^(.*)/([^/]*)$", 1).alias("grp")
    stat = F.regexp_extract("metric_name", "^(.*)/([^/]*)$", 2).alias("stat")
    wide = (rows.select("run_id", "batch_id", cut, stat, "metric_value").groupBy("run_id", "batch_id", "grp")
            .pivot("stat", ["n", "mean", "max"]).agg(F.first("metric_value")))
    return wide.groupBy("run_id", "grp").agg(F.sum("n").cast("long").alias("n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mean_value"), F.max("max").alias("max_value"))
