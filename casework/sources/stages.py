"""Stages that are found again, and removed at the end.

A stage is keyed by its normalised plan and by the files it reads (name, length,
time), so a second question, or a second run of a case, reads what the first
one wrote; a changed input is another key. Stages of a ``StageStore`` live under
one folder of the shared checkpoint folder until ``close`` (or the end of the
``with`` block) deletes them.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from casework.session import checkpoint_dir


def plan_key(df: DataFrame) -> str:
    """Digest of the canonical optimised plan, the schema and the input files."""
    plan = df._jdf.queryExecution().optimizedPlan().canonicalized().toString()
    spark, files = df.sparkSession, []
    for file in sorted(df.inputFiles()):
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
        files.append(f"{file}:{status.getLen()}:{status.getModificationTime()}")
    return hashlib.sha256("\n".join([plan, df.schema.json(), *files]).encode()).hexdigest()[:32]


class StageStore:
    """``with StageStore(spark, "case") as stages: t = stages.get("lines", lambda: ...)``

    ``keep=True`` leaves the stages for a later run under the same name; it
    finds them by their keys. A plan with a random or time-dependent part
    should not be staged this way: its key doesn't tell two results apart.
    """

    def __init__(self, spark: SparkSession, name: str, keep: bool = False):
        self.spark, self.keep = spark, keep
        self.folder = f"{checkpoint_dir(spark).rstrip('/')}/kept-stages/{name}"
        self.written: list[str] = []

    def _path(self, path: str):
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jpath, jpath.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def get(self, name: str, source: DataFrame, build=None) -> DataFrame:
        """The stage of ``build(source)`` (default: ``source`` itself), keyed by
        ``source``'s plan and files, and by ``name``, which stands for ``build``."""
        path = f"{self.folder}/{name}-{plan_key(source)}"
        done, fs = self._path(f"{path}/_SUCCESS")
        if not fs.exists(done):
            df = build(source) if build else source
            df.write.mode("overwrite").parquet(path)
            self.written.append(path)
        return self.spark.read.parquet(path)

    def close(self) -> None:
        """Delete the stages of this store."""
        folder, fs = self._path(self.folder)
        fs.delete(folder, True)

    def __enter__(self) -> "StageStore":
        return self

    def __exit__(self, *_) -> None:
        if not self.keep:
            self.close()


def drop_stages(spark: SparkSession) -> None:
    """Delete what ``materialize`` wrote for this application. Frames that still
    read a stage can't be used afterwards."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/stages/{spark.sparkContext.applicationId}")
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
