"""Appends that may run twice, and row ids that go on from one to the next.

A table folder holds one data folder per committed batch and a log of numbered
JSON entries. A batch is written to a folder of its own first and counts once
its entry stands in the log: creating the entry under the next number is the
only step that commits, and it fails if the number is taken. So a batch that
stopped half way leaves nothing that is read, a second run of the same batch id
changes nothing, and two writers can't take one number (on file systems whose
``create`` without overwrite is atomic, as HDFS and local ones are; on others
one writer at a time). All paths go through the Hadoop file system.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def entries(spark: SparkSession, path: str) -> list[dict]:
    """The committed batches in order: batch, folder, rows, last_id."""
    log, fs = _fs(spark, f"{path}/_log")
    if not fs.exists(log):
        return []
    out = []
    for status in sorted(fs.listStatus(log), key=lambda s: s.getPath().getName()):
        if status.getPath().getName().endswith(".json"):
            stream = fs.open(status.getPath())
            try:
                out.append(json.loads(bytes(stream.readAllBytes()).decode()))
            finally:
                stream.close()
    return out


def _commit(spark: SparkSession, path: str, number: int, entry: dict) -> bool:
    """Write entry ``number``; False if another writer has it."""
    target, fs = _fs(spark, f"{path}/_log/{number:012d}.json")
    body = json.dumps(entry).encode()
    try:
        stream = fs.create(target, False)
    except Exception as taken:
        if fs.exists(target):
            return False
        raise taken
    stream.write(bytearray(body))
    stream.close()
    return True


def append_once(df: DataFrame, path: str, batch: str, id_name: str | None = None, order: list[str] | None = None) -> dict:
    """Append ``df`` as batch ``batch``; returns its log entry.

    A batch id that is committed already changes nothing. With ``id_name`` and
    ``order``, rows get ids that go on after the highest committed one (by
    ``dense_ids``: no single-partition window); rows of earlier batches keep
    theirs. A writer that finds its number taken numbers its rows anew.
    """
    spark = df.sparkSession
    while True:
        done = entries(spark, path)
        for e in done:
            if e["batch"] == batch:
                return e
        folder = f"data-{uuid.uuid4().hex}"
        last = done[-1]["last_id"] if done else 0
        rows = df
        if id_name:
            from casework.operators.ranking import dense_ids

            rows = dense_ids(df, order or df.columns, id_name).withColumn(id_name, (F.col(id_name) + last).cast("bigint"))
        rows.write.parquet(f"{path}/{folder}")
        n = spark.read.schema(rows.schema).parquet(f"{path}/{folder}").count()
        entry = {"batch": batch, "folder": folder, "rows": n, "last_id": last + n, "schema": rows.schema.jsonValue()}
        if _commit(spark, path, len(done) + 1, entry):
            return entry
        stale, fs = _fs(spark, f"{path}/{folder}")
        fs.delete(stale, True)


def read_committed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all committed batches; an error if there is none."""
    done = entries(spark, path)
    if not done:
        raise FileNotFoundError(f"no batch is committed in {path}")
    schema = T.StructType.fromJson(done[-1]["schema"])
    return spark.read.schema(schema).parquet(*[f"{path}/{e['folder']}" for e in done])
