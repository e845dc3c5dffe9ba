"""Typed table sources.

Tables are read with an explicit schema (never inferred). For Parquet the
footers of all files are compared with it first (``casework.sources.drift``):
a missing, renamed or widened column raises ``SchemaDrift`` instead of reading
as NULL or failing half way. Parquet scans keep
Spark's projection and predicate pushdown: callers select columns and filter
after ``load_table`` and Catalyst moves both into the ``FileScan``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from casework.sources.drift import check_schema

_L, _I, _D, _S = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()
_TS = T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Schemas of the driver tables (TPC-H-like star plus an event stream).
DRIVER_SCHEMAS: dict[str, T.StructType] = {
    "region": _schema(("r_regionkey", _I), ("r_name", _S)),
    "nation": _schema(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
    "customer": _schema(("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I),
                        ("c_acctbal", _D), ("c_mktsegment", _S)),
    "supplier": _schema(("s_suppkey", _L), ("s_name", _S), ("s_nationkey", _I),
                        ("s_acctbal", _D)),
    "part": _schema(("p_partkey", _L), ("p_name", _S), ("p_brand", _S), ("p_type", _S),
                    ("p_size", _I), ("p_retailprice", _D)),
    "orders": _schema(("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S),
                      ("o_totalprice", _D), ("o_orderdate", _TS), ("o_orderpriority", _S)),
    "lineitem": _schema(("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L),
                        ("l_linenumber", _I), ("l_quantity", _D), ("l_extendedprice", _D),
                        ("l_discount", _D), ("l_tax", _D), ("l_returnflag", _S),
                        ("l_linestatus", _S), ("l_shipdate", _TS)),
    "events": _schema(("event_id", _L), ("ts", _TS), ("user_id", _L), ("event_type", _S),
                      ("value", _D), ("props", _S)),
    "labels": _schema(("doc_id", _L), ("quality", _I), ("toxic", _I)),
}

# Schemas of the three case-study tables (loyalty sales, deliveries,
# subscriptions), for jobs that run on data shaped like the original cases.
CASE_SCHEMAS: dict[str, T.StructType] = {
    "sales": _schema(("customer_id", _S), ("order_date", T.DateType()), ("product_id", _I)),
    "menu": _schema(("product_id", _I), ("product_name", _S), ("price", _I)),
    "members": _schema(("customer_id", _S), ("join_date", T.DateType())),
    "runners": _schema(("runner_id", _I), ("registration_date", T.DateType())),
    "customer_orders": _schema(("order_id", _I), ("customer_id", _I), ("pizza_id", _I),
                               ("exclusions", _S), ("extras", _S), ("order_time", _TS)),
    "runner_orders": _schema(("order_id", _I), ("runner_id", _I), ("pickup_time", _S),
                             ("distance", _S), ("duration", _S), ("cancellation", _S)),
    "pizza_names": _schema(("pizza_id", _I), ("pizza_name", _S)),
    "pizza_recipes": _schema(("pizza_id", _I), ("toppings", _S)),
    "pizza_toppings": _schema(("topping_id", _I), ("topping_name", _S)),
    "runner_ratings": _schema(("order_id", _I), ("runner_id", _I), ("rating", _I)),
    "plans": _schema(("plan_id", _I), ("plan_name", _S), ("price", T.DecimalType(5, 2))),
    "subscriptions": _schema(("customer_id", _I), ("plan_id", _I), ("start_date", T.DateType())),
}


def table_path(base: str, name: str) -> str:
    """``<base>/<name>.parquet``, a file or a folder: one rule for every file
    system, so nothing is looked up on the driver's own disk."""
    return f"{base.rstrip('/')}/{name if name.endswith('.parquet') else name + '.parquet'}"


def load_table(spark: SparkSession, base: str, name: str,
               schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """Read one table with its declared schema.

    ``base`` is a folder (local path or any Hadoop URI); ``name`` may also be
    a catalog table (``db.t``), which is read through the session catalog.
    """
    if "." in name and not name.endswith(".parquet"):
        return spark.table(name)
    schema = schema or DRIVER_SCHEMAS.get(name) or CASE_SCHEMAS.get(name)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "parquet":
        df = reader.parquet(table_path(base, name))
        return df if schema is None else check_schema(spark, df, schema)
    if fmt == "csv":
        return reader.option("header", "true").csv(os.path.join(base, f"{name}.csv"))
    if fmt == "json":
        return reader.json(os.path.join(base, f"{name}.json"))
    raise ValueError(f"unsupported format {fmt!r}")


class Tables:
    """Lazy accessor: ``t = Tables(spark, sf_dir); t.orders`` reads once per name.

    An accessor lists each table's files at its first use and keeps the reader
    for itself only: a new accessor sees files that were added since.
    """

    def __init__(self, spark: SparkSession, base: str, fmt: str = "parquet"):
        self.spark, self.base, self.fmt = spark, base, fmt
        self._readers: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._readers:
            self._readers[name] = load_table(self.spark, self.base, name, fmt=self.fmt)
        return self._readers[name]

    def register_views(self, *names: str) -> None:
        """Expose tables to ``spark.sql`` under their own names."""
        for n in names:
            getattr(self, n).createOrReplaceTempView(n)
