"""Drift check: do all Parquet files of a table hold the declared columns?

Reading with a declared schema turns a missing or renamed column into NULLs
without a word. The check reads the footers of all files (by several threads:
a footer is one small read), sorts the files by their physical schema and
compares each kind of file with the declaration, before a plan is built.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

THREADS = 16


class SchemaDrift(ValueError):
    """A file doesn't hold the declared columns."""


_CHECKED: set[tuple] = set()


def _file_kinds(spark: SparkSession, files: list[str]) -> dict[str, list[str]]:
    """Physical schema -> files."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def kind(file: str) -> str:
        source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(file), conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        try:
            return reader.getFileMetaData().getSchema().toString()
        finally:
            reader.close()

    with ThreadPoolExecutor(min(THREADS, len(files))) as pool:
        kinds: dict[str, list[str]] = {}
        for file, text in zip(files, pool.map(kind, files)):
            kinds.setdefault(text, []).append(file)
    return kinds


def drift(spark: SparkSession, df: DataFrame, declared: T.StructType) -> list[str]:
    """Differences between the files of ``df`` (a Parquet reader) and ``declared``:
    missing columns and other types. Columns that aren't declared don't count."""
    files = sorted(df.inputFiles())
    out = []
    for _, members in sorted(_file_kinds(spark, files).items(), key=lambda kv: kv[1][0]) if files else ():
        have = {f.name: f.dataType for f in spark.read.parquet(members[0]).schema}
        where = members[0] + (f" and {len(members) - 1} more" if len(members) > 1 else "")
        for field in declared:
            if field.name not in have:
                out.append(f"{where}: no column {field.name}")
            elif have[field.name] != field.dataType:
                out.append(f"{where}: {field.name} is {have[field.name].simpleString()}, declared {field.dataType.simpleString()}")
    return out


def check_schema(spark: SparkSession, df: DataFrame, declared: T.StructType) -> DataFrame:
    """``df`` if its files hold the declared columns, else ``SchemaDrift``. The
    same files (by name, length and time) are checked once per application."""
    statuses = []
    for file in df.inputFiles():
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
        statuses.append((file, status.getLen(), status.getModificationTime()))
    key = (spark.sparkContext.applicationId, declared.json(), tuple(sorted(statuses)))
    if key not in _CHECKED:
        found = drift(spark, df, declared)
        if found:
            raise SchemaDrift("; ".join(found))
        _CHECKED.add(key)
    return df
