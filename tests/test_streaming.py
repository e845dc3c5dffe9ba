"""Contract sink as a stream: incremental, exactly-once appends."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from casework.operators.contract import check, not_null
from casework.streaming import run_contract_sink

SCHEMA = T.StructType([T.StructField("order_id", T.IntegerType()),
                       T.StructField("runner_id", T.IntegerType()),
                       T.StructField("rating", T.IntegerType())])


def _rules():
    return not_null("order_id", "runner_id", "rating") + [
        check("rating between 0 and 5", F.col("rating").between(0, 5))]


def test_stream_appends_incrementally(spark, tmp_path):
    src, ok, bad = (str(tmp_path / d) for d in ("src", "ok", "bad"))
    # stream state lives in the shared spark.checkpoint.dir: one name per run
    name = f"t_ratings_{uuid.uuid4().hex[:12]}"
    spark.createDataFrame([(1, 1, 4), (2, 1, 9), (3, None, 2)], SCHEMA) \
        .write.mode("append").parquet(src)
    run_contract_sink(spark, src, SCHEMA, _rules(), ok, bad, name=name)
    assert sorted(r.order_id for r in spark.read.parquet(ok).collect()) == [1]
    assert sorted((r.order_id, r.reject_reason) for r in spark.read.parquet(bad).collect()) == [
        (2, "rating between 0 and 5"), (3, "runner_id is null")]
    # a second run only picks up the new file; nothing is appended twice
    spark.createDataFrame([(4, 2, 0), (5, 2, 5)], SCHEMA).write.mode("append").parquet(src)
    run_contract_sink(spark, src, SCHEMA, _rules(), ok, bad, name=name)
    run_contract_sink(spark, src, SCHEMA, _rules(), ok, bad, name=name)
    assert sorted(r.order_id for r in spark.read.parquet(ok).collect()) == [1, 4, 5]
    assert spark.read.parquet(bad).count() == 2
