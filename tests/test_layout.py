"""Bucketed layout: joins and per-key aggregates without an exchange."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from casework.sources import Tables, bucket_driver_tables

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_bucketed_join_has_no_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        names = bucket_driver_tables(spark, Tables(spark, SF), 8, prefix=f"t{uuid.uuid4().hex[:6]}_")
        li, od = spark.table(names["lineitem"]), spark.table(names["orders"])
        joined = li.join(od, "orderkey").groupBy("orderkey").agg(F.count(F.lit(1)).alias("n"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan.replace("AdaptiveSparkPlan", "")
        plain = Tables(spark, SF)
        want = plain.lineitem.join(plain.orders, plain.lineitem.l_orderkey == plain.orders.o_orderkey).count()
        assert joined.agg(F.sum("n")).first()[0] == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
