"""casework: business-event analytics as composable Spark DataFrame operators.

Layout
------
``sources``    typed table loading and append sinks
``functions``  Column-level helpers (cleaning, time parts, text, arrays)
``operators``  DataFrame -> DataFrame operators (ranking, anchors, rates,
               lifecycle, list assembly, row contracts, dense ids)
``plans``      the registered jobs: stand-in queries on the driver tables
               and the three case-study plans on their own schemas
``streaming``  the append-with-contract sink as a Structured Streaming job

Every operator is expressed with built-in Spark expressions (no Python UDFs),
so Catalyst can push filters and prune columns into the Parquet scan.
"""

from casework.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
