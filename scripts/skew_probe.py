"""Skew probe: how many rows does the busiest task read when one user holds a
third of the event log?

The probe input is the ``events`` table with every third event relabelled to
user 0 (written once to a scratch folder). Each operator runs next to the
plain window form it replaces; Spark's event log (written to the scratch
folder) gives the largest shuffle read of any single task per variant.

usage: python scripts/skew_probe.py [sf_dir] [scratch_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from casework.operators import (  # noqa: E402
    dense_ids, dense_rank_column, first_row_next, next_value, nth_per, state_at, top_with_ties, with_group_stats,
)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="skew-probe-")
    logs = os.path.join(scratch, "eventlog")
    os.makedirs(logs, exist_ok=True)
    spark = (SparkSession.builder.master("local[8]").appName("skew_probe")
             .config("spark.sql.shuffle.partitions", "32")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
             # skew thresholds scaled down with the data (defaults: 256 MB / 64 MB)
             .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "256KB")
             .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
             .config("spark.sql.autoBroadcastJoinThreshold", "-1")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", logs)
             .config("spark.eventLog.compress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    src = os.path.join(scratch, "events_hot")
    if not os.path.exists(src):
        ev = spark.read.parquet(f"{sf_dir}/events.parquet")
        # many files, as on a cluster: AQE splits a skewed partition by ranges
        # of map outputs, so a single-file input could never be split
        (ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0).cast("bigint"))
                       .otherwise(F.col("user_id")))
           .repartition(32).write.parquet(src))
    e = spark.read.parquet(src).withColumn("day", F.to_date("ts"))
    total = e.count()
    w_user = Window.partitionBy("user_id")
    # the hot user's third of the log squeezed into one hour (10:00 - 11:00)
    in_hour = F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(1), F.lit(10),
                                   (F.col("event_id") / 60).cast("int") % 60, F.col("event_id") % 60)
    eh = e.withColumn("ts", F.when(F.col("user_id") == 0, in_hour.cast(e.schema["ts"].dataType))
                      .otherwise(F.col("ts")))

    variants = {
        "first day per user: window dense_rank = 1":
            e.withColumn("r", F.dense_rank().over(w_user.orderBy("day"))).where("r = 1"),
        "first day per user: top_with_ties":
            top_with_ties(e, "day", by="user_id", largest=False),
        "second day per user: window dense_rank = 2":
            e.withColumn("r", F.dense_rank().over(w_user.orderBy("day"))).where("r = 2"),
        "second day per user: nth_per":
            nth_per(e, "user_id", "day", 2),
        "dense rank of day: window":
            e.withColumn("r", F.dense_rank().over(w_user.orderBy("day"))),
        "dense rank of day: dense_rank_column (distinct pairs)":
            dense_rank_column(e, ["user_id"], "day", "r"),
        "next event type: window lead":
            e.withColumn("n", F.lead("event_type").over(w_user.orderBy("ts", "event_id"))),
        "next event type: next_value (sort by range)":
            next_value(e, "user_id", ["ts", "event_id"], "event_type", "n"),
        "next event type, hot user in one hour: window lead":
            eh.withColumn("n", F.lead("event_type").over(w_user.orderBy("ts", "event_id"))),
        "next event type, hot user in one hour: next_value":
            next_value(eh, "user_id", ["ts", "event_id"], "event_type", "n"),
        "second event type per user: first_row_next":
            first_row_next(e, "user_id", ["ts", "event_id"], "event_type", "n"),
        "state at date: window lead + IS NULL":
            e.where(F.col("day") <= "2024-01-15").withColumn(
                "n", F.lead("event_id").over(w_user.orderBy("ts", "event_id"))).where("n IS NULL"),
        "state at date: state_at (max_by aggregate)":
            state_at(e, "user_id", "ts", "event_type", F.col("day") <= "2024-01-15", ["event_id"]),
        "average per user on every row: window avg":
            e.withColumn("a", F.avg("value").over(w_user)),
        "average per user on every row: with_group_stats":
            with_group_stats(e, ["user_id"], {"a": F.avg("value")}),
        "global row number: window row_number":
            e.withColumn("rid", F.row_number().over(Window.orderBy("event_id"))),
        "global row number: dense_ids":
            dense_ids(e, ["event_id"], "rid"),
        "row number by (user, event): window row_number":
            e.withColumn("rid", F.row_number().over(Window.orderBy("user_id", "event_id"))),
        "row number by (user, event): dense_ids (hot user split)":
            dense_ids(e, ["user_id", "event_id"], "rid"),
    }
    for name, df in variants.items():
        spark.sparkContext.setJobDescription(name)
        df.write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription(None)
    spark.stop()

    stage_to_desc, task_max = {}, defaultdict(int)
    for path in glob.glob(os.path.join(logs, "**", "events_*"), recursive=True):
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description")
                    for sid in ev.get("Stage IDs", []):
                        stage_to_desc[sid] = desc
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    rec = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    sid = ev["Stage ID"]
                    task_max[sid] = max(task_max[sid], rec)
    per_variant = defaultdict(int)
    for sid, rec in task_max.items():
        d = stage_to_desc.get(sid)
        if d:
            per_variant[d] = max(per_variant[d], rec)
    result = {"rows": total, "hot_user_rows": total // 3 + 1,
              "max_shuffle_rows_read_by_one_task": {k: per_variant.get(k, 0) for k in variants}}
    with open(os.path.join(scratch, "skew_probe.json"), "w") as f:
        json.dump(result, f)
    print(json.dumps(result, indent=1))


if __name__ == "__main__":
    main()
