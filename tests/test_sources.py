"""Typed sources, catalog names and durable stages."""

import uuid

import pytest
from conftest import rows
from fixtures import MENU, frame

from casework.sources import Tables, load_table, materialize
from casework.sources.tables import CASE_SCHEMAS


def test_csv_and_json_with_declared_schema(spark, tmp_path):
    menu = frame(spark, "menu", MENU)
    menu.write.option("header", "true").csv(str(tmp_path / "menu.csv"))
    menu.write.json(str(tmp_path / "menu.json"))
    for fmt in ("csv", "json"):
        got = load_table(spark, str(tmp_path), "menu", fmt=fmt)
        assert got.schema == CASE_SCHEMAS["menu"]
        assert rows(got) == rows(menu)


def test_parquet_tables_accessor(spark, tmp_path):
    frame(spark, "menu", MENU).write.parquet(str(tmp_path / "menu.parquet"))
    t = Tables(spark, str(tmp_path))
    assert t.menu.count() == 3 and t.menu is t.menu
    t.register_views("menu")
    assert spark.sql("SELECT max(price) AS m FROM menu").first().m == 15


def test_qualified_catalog_name(spark):
    frame(spark, "menu", MENU).createOrReplaceGlobalTempView("menu_g")
    assert rows(load_table(spark, "", "global_temp.menu_g")) == rows(frame(spark, "menu", MENU))


def test_materialize_writes_under_checkpoint_dir(spark):
    name = f"stage_{uuid.uuid4().hex[:8]}"
    df = frame(spark, "menu", MENU)
    out = materialize(spark, df, name)
    base = spark.conf.get("spark.checkpoint.dir")
    assert any(base.rstrip("/") in f for f in out.inputFiles())
    assert rows(spark.table(name)) == rows(df)


def test_unknown_format_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        load_table(spark, str(tmp_path), "menu", fmt="orc")


def test_new_accessor_sees_files_that_were_added(spark, tmp_path):
    frame(spark, "menu", MENU).write.parquet(str(tmp_path / "menu.parquet"))
    assert Tables(spark, str(tmp_path)).menu.count() == 3
    frame(spark, "menu", MENU).write.mode("append").parquet(str(tmp_path / "menu.parquet"))
    assert Tables(spark, str(tmp_path)).menu.count() == 6


def test_stages_of_one_name_do_not_meet(spark):
    name = f"stage_{uuid.uuid4().hex[:8]}"
    one = materialize(spark, spark.range(3), name)
    two = materialize(spark, one.where("id > 0"), name)  # rewriting a stage from itself
    assert one.count() == 3 and two.count() == 2 and spark.table(name).count() == 2


def test_scale_conf_sizes_partitions_from_input():
    from casework.session import scale_conf
    tb100 = 100 * 1024 ** 4
    c = scale_conf(tb100, total_cores=8000)
    n = int(c["spark.sql.shuffle.partitions"])
    assert n == -(-tb100 // (256 * 1024 ** 2))          # ~400k partitions of 256 MB
    assert c["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == str(n)
    assert int(c["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) == 128 * 1024 ** 2
    # small input: at least three waves of tasks
    assert scale_conf(10 * 1024 ** 2, total_cores=64)["spark.sql.shuffle.partitions"] == "192"
