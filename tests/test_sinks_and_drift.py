"""Appends that may run twice, schema drift, kept stages, rejects, date layout."""

import os

import pytest
from conftest import rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from casework.operators import parse_with_rejects
from casework.plans import delivery as dv
from casework.plans.cases import run_case
from casework.sources import SchemaDrift, StageStore, append_once, drop_stages, load_table, on_dates, read_committed, write_by_date
from casework.sources import ledger
from fixtures import CUSTOMER_ORDERS, PIZZA_NAMES, PIZZA_RECIPES, PIZZA_TOPPINGS, RUNNER_ORDERS, RUNNERS, frame


def test_a_batch_that_runs_twice_counts_once(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.range(5)
    first = append_once(df, path, "monday")
    assert append_once(df, path, "monday") == first
    append_once(spark.range(2), path, "tuesday")
    assert rows(read_committed(spark, path)) == sorted([(i,) for i in [0, 1, 2, 3, 4, 0, 1]], key=repr)


def test_a_writer_that_stops_before_its_commit_leaves_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    append_once(spark.range(3), path, "a")

    def stop(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(ledger, "_commit", stop)
        with pytest.raises(RuntimeError):
            append_once(spark.range(10), path, "b")
    assert read_committed(spark, path).count() == 3
    append_once(spark.range(10), path, "b")
    assert read_committed(spark, path).count() == 13


def test_a_taken_number_is_tried_again(spark, tmp_path, monkeypatch):
    path, real = str(tmp_path / "t"), ledger._commit

    def late(session, p, number, entry):
        if entry["batch"] == "mine" and number == 1:
            append_once(spark.range(4), path, "other", "id_no", ["id"])
        return real(session, p, number, entry)
    monkeypatch.setattr(ledger, "_commit", late)
    append_once(spark.range(3), path, "mine", "id_no", ["id"])
    got = rows(read_committed(spark, path), "id_no", "id")
    assert got == [(1, 0), (2, 1), (3, 2), (4, 3), (5, 0), (6, 1), (7, 2)]


def test_ids_go_on_and_earlier_ones_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    append_once(spark.range(0, 30), path, "a", "no", ["id"])
    before = rows(read_committed(spark, path))
    append_once(spark.range(100, 120), path, "b", "no", ["id"])
    append_once(spark.range(0), path, "empty", "no", ["id"])
    got = rows(read_committed(spark, path), "no", "id")
    assert sorted(r[0] for r in got) == list(range(1, 51))
    assert set(before) <= set(rows(read_committed(spark, path))) and (31, 100) in got


def test_nothing_committed(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_committed(spark, str(tmp_path / "none"))


@pytest.mark.parametrize("select", [["r_regionkey"], ["r_regionkey", "r_name as r_title"], ["cast(r_regionkey as long) r_regionkey", "r_name"]])
def test_missing_renamed_or_widened_column_raises(spark, tmp_path, select):
    good = spark.createDataFrame([(1, "ASIA")], "r_regionkey int, r_name string")
    path = str(tmp_path / "region.parquet")
    good.coalesce(1).write.parquet(path)
    assert load_table(spark, str(tmp_path), "region").count() == 1
    # one file of several is enough
    good.selectExpr(*select).coalesce(1).write.mode("append").parquet(path)
    with pytest.raises(SchemaDrift):
        load_table(spark, str(tmp_path), "region")


def test_further_columns_are_no_drift(spark, tmp_path):
    spark.createDataFrame([(1, "ASIA", 3)], "r_regionkey int, r_name string, more int").write.parquet(str(tmp_path / "region.parquet"))
    assert rows(load_table(spark, str(tmp_path), "region")) == [(1, "ASIA")]


def test_parse_with_rejects(spark):
    texts = ["20km", "23.4 km", "1.2.3", "km", "null", "", None, "1" * 21, "7"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, distance string")
    seen = Observation("parse")
    parsed, rejected = parse_with_rejects(df, {"km": "distance"}, observation=seen)
    got = {r.id: r.km for r in parsed.collect()}
    assert [got[i] is None for i in range(9)] == [False, False, True, True, True, True, True, True, False]
    assert {r.value: r.reason for r in rejected.collect()} == {"1.2.3": "several points", "km": "no number", "1" * 21: "too many digits"}
    assert seen.get == {"rows": 9, "rejected": 3}


def test_clean_deliveries_rejects(spark):
    rows_ = [(1, 1, "2020-01-01 18:15:34", "1.2.3", "32 minutes", ""), (2, 1, "null", "null", "null", "Customer Cancellation"), (3, 2, "x", "9km", "soon", None)]
    clean, rejected = dv.clean_deliveries_with_rejects(frame(spark, "runner_orders", rows_))
    assert sorted((r.order_id, r.column, r.value, r.reason) for r in rejected.collect()) == [(1, "distance", "1.2.3", "several points"), (3, "duration", "soon", "no number")]
    assert rows(clean, "order_id", "duration_min")[0][0] == 1 and clean.count() == 3


def test_quotients_are_rounded_once(spark):
    # 2.0049996 / 1: cut to six digits it is 2.005 and would round up
    df = spark.createDataFrame([(1, 1, "2020-01-01 00:00:00", "2.00499996", "60", None)], "order_id int, runner_id int, pickup_time string, distance string, duration string, cancellation string")
    out = dv.speed_per_delivery(dv.clean_deliveries(df)).first()
    assert str(out.speed_kmh) == "2.00"


def test_second_run_writes_no_stage_and_none_is_left(spark, tmp_path):
    data = {"customer_orders": CUSTOMER_ORDERS, "runner_orders": RUNNER_ORDERS, "runners": RUNNERS, "pizza_names": PIZZA_NAMES, "pizza_recipes": PIZZA_RECIPES, "pizza_toppings": PIZZA_TOPPINGS}
    for name, values in data.items():
        frame(spark, name, values).write.parquet(str(tmp_path / f"{name}.parquet"))
    with StageStore(spark, "twice") as stages:
        one = rows(run_case(spark, "delivery", str(tmp_path), stages=stages)["Q-C2-T1"])
        assert len(stages.written) == 1
        again = StageStore(spark, "twice")
        assert rows(run_case(spark, "delivery", str(tmp_path), stages=again)["Q-C2-T1"]) == one
        assert again.written == []
        frame(spark, "customer_orders", CUSTOMER_ORDERS[:2]).write.mode("append").parquet(str(tmp_path / "customer_orders.parquet"))
        more = run_case(spark, "delivery", str(tmp_path), stages=again)["Q-C2-T1"]
        assert len(again.written) == 1 and more.count() == len(CUSTOMER_ORDERS) + 2
        folder = stages.folder
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_drop_stages(spark):
    from casework.sources import materialize
    kept = materialize(spark, spark.range(3), "gone", view=False)
    folder = os.path.dirname(os.path.dirname(kept.inputFiles()[0].replace("file://", "")))
    assert os.path.isdir(folder)
    drop_stages(spark)
    assert not os.path.exists(folder)


def test_date_layout_prunes_at_run_time(spark, tmp_path):
    path = str(tmp_path / "events")
    df = spark.range(2000).select("id", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(id % 20 as int))").alias("ts"))
    write_by_date(df, path, "ts", "id")
    facts = spark.read.parquet(path)
    assert facts.count() == 2000 and len(facts.select("part_date").distinct().collect()) == 20
    days = spark.createDataFrame([(d, d % 7) for d in range(20)], "n int, weekday int").select(F.expr("date_add(date'2024-01-01', n)").alias("part_date"), "weekday")
    picked = on_dates(facts, days.where("weekday = 3"))
    assert "dynamicpruning" in picked._jdf.queryExecution().executedPlan().toString().lower()
    assert picked.count() == 300
    static = facts.where("part_date = date'2024-01-05'")
    assert "PartitionFilters: [isnotnull(part_date" in static._jdf.queryExecution().executedPlan().toString()
    assert len(static.inputFiles()) == len(facts.inputFiles()) and static.count() == 100
