"""Append-with-contract as a Structured Streaming job.

``INSERT INTO ratings SELECT ...`` under NOT NULL / CHECK rules, run
continuously: new files landing in a source folder are tagged by the row
contract, valid rows are appended to the table folder and rejected rows
(with their reason) to a quarantine folder.

Both outputs use Spark's file sink, which records committed files in a
``_spark_metadata`` log, and each query keeps its offsets in a checkpoint
under the cluster's shared ``spark.checkpoint.dir``: a restarted or retried
micro-batch never appends a row twice, and a lost executor only re-runs its
tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from casework.operators.contract import REASON, Rule, tag_violations
from casework.session import checkpoint_dir


def start_contract_sink(spark: SparkSession, source: str, schema: T.StructType,
                        rules: Sequence[Rule], valid_path: str, rejected_path: str,
                        name: str = "contract_sink", fmt: str = "parquet",
                        available_now: bool = True,
                        processing_time: str | None = None) -> list[StreamingQuery]:
    """Start the two sink queries; returns them (call ``awaitTermination``).

    ``available_now=True`` processes everything present and stops (batch-like
    catch-up runs); otherwise the queries keep running on
    ``processing_time`` triggers.
    """
    base = checkpoint_dir(spark).rstrip("/")
    stream = spark.readStream.schema(schema).format(fmt).load(source)
    tagged = tag_violations(stream, rules)
    outputs = {
        "valid": (tagged.where(F.col(REASON).isNull()).drop(REASON), valid_path),
        "rejected": (tagged.where(F.col(REASON).isNotNull()), rejected_path),
    }
    queries = []
    for kind, (df, path) in outputs.items():
        w = (df.writeStream.format("parquet").outputMode("append")
             .option("path", path)
             .option("checkpointLocation", f"{base}/streams/{name}/{kind}")
             .queryName(f"{name}_{kind}"))
        if available_now:
            w = w.trigger(availableNow=True)
        elif processing_time:
            w = w.trigger(processingTime=processing_time)
        queries.append(w.start())
    return queries


def run_contract_sink(spark: SparkSession, *args, **kwargs) -> None:
    """Run ``start_contract_sink`` in catch-up mode and wait for it to finish."""
    for q in start_contract_sink(spark, *args, available_now=True, **kwargs):
        q.awaitTermination()
