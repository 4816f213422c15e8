"""Scans, loads and sinks.

Writers go through ``DataFrameWriter``; every read takes an explicit schema or
the Parquet footer (never CSV/JSON inference).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscore.functions import text as tx

TEST_TABLES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver test table (Parquet) by name."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# -- A1 / A2: multi-file scan with a year taken from the file name ------------

def scan_files(spark: SparkSession, paths: Sequence[str], year_pattern: str = r"(\d{4})",
               expected: T.StructType | None = None) -> DataFrame:
    """A1: read many Parquet files in one scan; ``year`` is parsed from each
    file's name through the hidden ``_metadata`` column.  A2: with ``expected``
    every file's footer must hold that schema, else a diff that names the files is raised."""
    if expected is not None:
        check_files(footers(spark, paths), expected)
    df = spark.read.option("mergeSchema", "false").parquet(*paths)
    year = F.regexp_extract(F.col("_metadata.file_path"), year_pattern, 1).cast("int")
    return nan_to_null(df.select("*", year.alias("year")))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Floating-point NaN becomes NULL, the one missing value from here on (a
    projection within the scan's stage)."""
    return df.select(*[F.when(~F.isnan(tx.col(f.name)), tx.col(f.name)).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else tx.col(f.name)
                       for f in df.schema.fields])


def check_schema(actual: T.StructType, expected: T.StructType) -> None:
    """A2: fail with a readable diff when the read schema is not the expected one."""
    a = {f.name: f.dataType.simpleString() for f in actual.fields}
    e = {f.name: f.dataType.simpleString() for f in expected.fields}
    missing = sorted(set(e) - set(a))
    extra = sorted(set(a) - set(e))
    changed = sorted(k for k in set(a) & set(e) if a[k] != e[k])
    if missing or extra or changed:
        raise ValueError(f"schema mismatch: missing={missing} extra={extra} "
                         f"changed={[(k, e[k], a[k]) for k in changed]}")


def footers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """A2: ``(file, ordinal, column_name, data_type, n_rows)``, one row per file and column.  Files are listed by Spark and their footers
    read in tasks (a footer each, no data), so any number of files is checked side by side."""
    import json

    def read(batches):
        import pandas as pd
        import pyarrow.parquet as pq
        from pyarrow import fs
        from pyspark.sql.pandas.types import from_arrow_schema
        for batch in batches:
            rows = []
            for uri in batch["path"]:
                if "://" in uri or uri.startswith("file:"):
                    store, at = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))
                else:
                    store, at = fs.LocalFileSystem(), uri
                with store.open_input_file(at) as f:
                    footer = pq.ParquetFile(f)
                    n, own = footer.metadata.num_rows, (footer.metadata.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
                    # files that Spark wrote name its types; others are translated
                    schema = T.StructType.fromJson(json.loads(own)) if own else from_arrow_schema(footer.schema_arrow, prefer_timestamp_ntz=True)
                rows += [(uri, k, c.name, c.dataType.simpleString(), n) for k, c in enumerate(schema.fields)]
            yield pd.DataFrame(rows, columns=["file", "ordinal", "column_name", "data_type", "n_rows"])

    files = spark.read.format("binaryFile").load(list(paths)).select("path")
    return files.repartition(spark.sparkContext.defaultParallelism).mapInPandas(read, "file string, ordinal int, column_name string, data_type string, n_rows long")


def check_files(found: DataFrame, expected: T.StructType, shown: int = 20) -> None:
    """A2: fail with a readable diff that names files (the first ``shown`` differences) when a footer is not the expected schema."""
    want = found.sparkSession.createDataFrame([(f.name, f.dataType.simpleString()) for f in expected.fields], "column_name string, expected string")
    names = F.array(*[F.lit(f.name) for f in expected.fields])
    lost = found.groupBy("file").agg(F.collect_set("column_name").alias("has")).select("file", F.explode(F.array_except(names, "has")).alias("column_name"))
    missing = lost.select("file", F.lit("missing").alias("what"), "column_name", F.lit(None).cast("string").alias("expected"), F.lit(None).cast("string").alias("found"))
    other = (found.join(F.broadcast(want), "column_name", "left").where(~F.col("expected").eqNullSafe(F.col("data_type")))
             .select("file", F.when(F.col("expected").isNull(), "extra").otherwise("changed").alias("what"), "column_name", "expected", F.col("data_type").alias("found")))
    rows = missing.unionByName(other).orderBy("file", "what", "column_name").limit(shown).collect()
    if rows:
        raise ValueError("schema mismatch: " + "; ".join(f"{r.file}: {r.what} {r.column_name}" + (f" (expected {r.expected}, found {r.found})" if r.what == "changed" else "") for r in rows))


def write_yearly_files(df: DataFrame, date_col: str, path: str) -> DataFrame:
    """Split a table into one Parquet folder per year (the raw layer)."""
    (df.withColumn("year", F.year(tx.col(date_col)))
       .write.mode("overwrite").partitionBy("year").parquet(path))
    return df


# -- A3 / A4 / A5: table loads ---------------------------------------------------

def load_full_refresh(df: DataFrame, table: str, partition_by: Sequence[str] = (),
                      dynamic: bool = False, path: str | None = None) -> None:
    """A3: overwrite a catalog table; ``dynamic`` replaces only the partitions
    present in ``df`` (a one-year refresh).  NaN is loaded as NULL."""
    df = nan_to_null(df)
    spark = df.sparkSession
    if dynamic and spark.catalog.tableExists(table):
        # Written below the table's folder with the option of this one write:
        # ``insertInto`` would need a session setting that other callers see.
        if not partition_by:
            raise ValueError("a dynamic refresh needs partition columns")
        where = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == "Location").first()["data_type"]
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(*partition_by).parquet(where))
        spark.catalog.recoverPartitions(table)
        spark.catalog.refreshTable(table)
        return
    # No partitionOverwriteMode option here: it would be stored with the
    # table and override later dynamic refreshes.
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def _writer(df: DataFrame, mode: str, path: str | None):
    w = nan_to_null(df).write.mode(mode).format("parquet")
    return w.option("path", path) if path else w


def create_or_replace(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """A4: create-or-replace table as select (writer form; the session catalog
    refuses the SQL form)."""
    _writer(df, "overwrite", path).saveAsTable(table)
    return df.sparkSession.table(table)


def create_strict(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """A5: create table as select; fails if the table exists."""
    _writer(df, "errorifexists", path).saveAsTable(table)
    return df.sparkSession.table(table)


# -- A6 / A12: column-list scan and catalog schema -----------------------------

def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Project a name list (names quoted, so ``__index_level_0__`` and
    names with spaces work); Catalyst prunes the scan to these columns."""
    return df.select(*[tx.col(c) for c in columns])


def schema_table(df: DataFrame) -> DataFrame:
    """``(ordinal, column_name, data_type)`` rows from a frame's schema."""
    rows = [(i, f.name, tx.type_name(f.dataType)) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "ordinal int, column_name string, data_type string")


# -- G1 / G2: unions ---------------------------------------------------------------

def union_all(frames: Sequence[DataFrame], by_name: bool = True) -> DataFrame:
    """G1: UNION ALL of n frames; by name (missing columns are an error), or
    by position when ``by_name=False``."""
    if by_name:
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=False), frames)
    return reduce(lambda a, b: a.union(b), frames)


# -- A7 / A8 / A10 / A13 / A14: text formats -----------------------------------------

def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Header CSV with RFC-4180 quotes; fixed schema, malformed rows fail."""
    return (spark.read.schema(schema).option("header", True).option("escape", '"')
            .option("mode", "FAILFAST").csv(path))


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Header CSV.  ``single_file`` only for profile-size output."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str, single_file: bool = False) -> None:
    """JSON lines."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str,
              multi_line: bool = False) -> DataFrame:
    """JSON records with a fixed schema (no inference); a malformed
    record fails the read, as in ``read_csv``."""
    return spark.read.schema(schema).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)


def export_rows(df: DataFrame, label_col: str, path: str) -> None:
    """One CSV file per row, grouped into ``label=<value>`` folders."""
    (df.write.mode("overwrite").partitionBy(label_col).option("maxRecordsPerFile", 1)
       .option("header", True).csv(path))
