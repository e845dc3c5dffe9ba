"""Sinks: durable stages and appends (CTAS and INSERT ... SELECT)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from casework.session import checkpoint_dir


def append(df: DataFrame, path: str, fmt: str = "parquet",
           partition_by: list[str] | None = None) -> None:
    """``INSERT INTO t SELECT ...``: append rows to a table folder.

    Spark writes each task's output to a staging file and commits on job
    success, so a lost executor re-runs its tasks without duplicating rows.
    """
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def append_table(df: DataFrame, table: str) -> None:
    """Append to a catalog table by name (``insertInto`` keeps column order)."""
    df.write.mode("append").insertInto(table)


def materialize(spark: SparkSession, df: DataFrame, name: str, view: bool = True) -> DataFrame:
    """``CREATE TEMP TABLE x AS SELECT ...`` for a stage read by many jobs.

    The stage is written under the shared checkpoint folder
    (``spark.checkpoint.dir``) and read back, which cuts lineage: a lost
    executor later re-reads files instead of recomputing the stage. Every call
    has a folder of its own under the application's, so stages of one name
    never meet; ``view`` also registers it as a temporary view.
    """
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/stages/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    if view:
        out.createOrReplaceTempView(name)
    return out
