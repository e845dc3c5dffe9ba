import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[4]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "4g")
             .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="casework-test-wh-"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        # tests only: the cluster names its shared folder in spark.checkpoint.dir
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="casework-test-ckpt-"))
    yield spark
    spark.stop()


def rows(df, *cols):
    """Sorted list of tuples of the given columns (all columns if none)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
