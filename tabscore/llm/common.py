"""Helpers the training-data operators share: table reading, shared folders and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscore.session import ensure_checkpoint_dir


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One table of an input folder, through Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def keep(df: DataFrame) -> DataFrame:
    """Cut the lineage: the rows go to the shared folder of ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges(u, v)``: one row ``(id, component_id)`` per vertex,
    ``component_id`` the smallest id it reaches.

    Alternating large-star and small-star rounds: every round is a map-side combined minimum per vertex and a
    join on the vertex, which AQE can split when one vertex holds most edges.  No component meets in one task or
    on the driver.  Rounds end when no edge moves; ``max_rounds`` only guards against a defect and raises.
    """
    def pairs(rows: DataFrame, *ends) -> DataFrame:
        """Each row's pairs as rows ``(u, v)``; the rows are read once, which a union of them is not."""
        return rows.select(F.explode(F.array(*[F.struct(u.alias("u"), v.alias("v")) for u, v in ends])).alias("x")).select("x.*")

    u, v, m = F.col("u"), F.col("v"), F.col("m")

    def star(e: DataFrame, large: bool) -> DataFrame:
        e = pairs(e, (u, v), (v, u)) if large else e
        low = e.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        both = e.join(low, "u")
        moved = both.where("v > u").select(v.alias("u"), m.alias("v")) if large else pairs(both, (v, m), (u, m))
        return moved.where("u != v").distinct()

    def mark(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    e = keep(edges.where(F.col("u") != F.col("v"))
             .select(F.greatest("u", "v").cast("long").alias("u"), F.least("u", "v").cast("long").alias("v")).distinct())
    before = mark(e)
    for _ in range(max_rounds):
        e = keep(star(star(e, True), False))
        now = mark(e)
        if now == before:
            return pairs(e, (u, v), (v, v)).select(u.alias("id"), v.alias("component_id")).distinct()
        before = now
    raise RuntimeError(f"components did not settle within {max_rounds} rounds")
