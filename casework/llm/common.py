"""Helpers shared by the operators: stages, Arrow text slices, word hashes."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casework.session import checkpoint_dir

U64 = np.uint64
# odd 64-bit multipliers of the polynomial hashes (arithmetic modulo 2^64)
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD1342543DE82EF95
SPAN_BASE = 0xC2B2AE3D27D4EB4F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


_STAGE_CONF = {
    # Spark removes the shuffle files of a query as soon as it has ended
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # rows of a batch that Python gets at once: texts of some megabytes
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def stage(df: DataFrame, name: str, rows_per_batch: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    and a later join reads plain files, so adaptive execution can split a
    skewed key on either side. The shuffle files of the write go at its end.
    ``rows_per_batch``: rows that Python gets at once, where they are large."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    settings = _STAGE_CONF | ({"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows_per_batch)} if rows_per_batch else {})
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def mix(x: np.ndarray) -> np.ndarray:
    """Bit mixer of splitmix64."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << int(n - 1).bit_length()
            for side, base in (("up", self.base), ("down", self.inverse)):
                a = np.full(size, base, U64)
                a[0] = 1
                setattr(self, side, np.cumprod(a, dtype=U64))
        return self.up[:n], self.down[:n]


_POWERS = {b: Powers(b) for b in (BYTE_BASE, WORD_BASE, SPAN_BASE)}
_BYTE_CODES = mix(np.arange(1, 257, dtype=U64) * U64(0x2545F4914F6CDD1D))


def prefix_sums(values: np.ndarray, base: int) -> np.ndarray:
    up, _ = _POWERS[base].upto(max(len(values), 1))
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[:len(values)], out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of the values in [start, end), independent of the position."""
    _, down = _POWERS[base].upto(max(len(sums), 1))
    return mix((sums[end] - sums[start]) * down[start])


def batch_text(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text is empty."""
    a = batch.column(batch.schema.get_field_index(column))
    if a.null_count:
        a = a.fill_null("")
    if len(a) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(a.type)
    _, off, data = a.buffers()
    off = np.frombuffer(off, np.int64 if wide else np.int32)[a.offset:a.offset + len(a) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, off


def give_back() -> None:
    """Return freed memory to the system: Spark keeps its Python workers, and
    what one task has freed should not count against the next one."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def text_slices(batch: pa.RecordBatch, column: str, most: int = 1 << 21) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices (first row, end row, bytes, offsets from 0) of at most ``most``
    bytes; a longer text is a slice of its own. Every row is in one slice."""
    raw, off = batch_text(batch, column)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi
    give_back()


_ASCII_SPACE = np.zeros(256, bool)
_ASCII_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def is_space(buf: np.ndarray) -> np.ndarray:
    """Which bytes are ASCII white space."""
    return _ASCII_SPACE[buf]


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


def split_words(buf: np.ndarray, off: np.ndarray, separator: np.ndarray = _ASCII_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) byte positions of the words of all rows, and the word
    offset of each row. Words never cross rows."""
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    sep = separator[buf]
    before = np.empty(len(buf), bool)
    before[0] = True
    before[1:] = sep[:-1]
    first = off[:-1][off[:-1] < len(buf)]
    before[first] = True
    after = np.empty(len(buf), bool)
    after[-1] = True
    after[:-1] = sep[1:]
    after[first[first > 0] - 1] = True
    start = np.flatnonzero(~sep & before)
    end = np.flatnonzero(~sep & after) + 1
    return start, end, np.searchsorted(start, off)


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes and length."""
    sums = prefix_sums(_BYTE_CODES[buf], BYTE_BASE)
    return mix(range_hash(sums, start, end, BYTE_BASE) + (end - start).astype(U64))


def row_of(word_offsets: np.ndarray) -> np.ndarray:
    """Row number of each word."""
    return np.repeat(np.arange(len(word_offsets) - 1), np.diff(word_offsets))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def map_arrow(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def star_rounds(edges: DataFrame, name: str, most: int = 60) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b longs).

    Alternating large-star and small-star rounds: every round is an aggregate
    (smallest neighbour, combined before the shuffle) and a join with plain
    files, each written to the shared folder. Returns (node, component_id) for
    every node that has an edge to another node; component_id is the smallest
    node reachable.
    """
    def linked(e: DataFrame, both: bool) -> DataFrame:
        big, small = F.greatest("a", "b"), F.least("a", "b")
        e = e.where("a <> b")
        if both:
            return e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        return e.select(big.alias("a"), small.alias("b"))

    def star(e: DataFrame, large: bool, tag: str) -> DataFrame:
        e = linked(e, large)
        low = e.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        low = stage(low, f"{name}-{tag}-low")
        j = e.join(low, F.col("a") == F.col("k"))
        if large:
            out = j.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            # a node all of whose neighbours are smaller keeps its smallest one
            out = out.union(low.where("m < k").select(F.col("k").alias("a"), F.col("m").alias("b")))
        else:
            out = j.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select(F.col("k").alias("a"), F.col("m").alias("b")))
        return stage(out.where("a <> b").distinct(), f"{name}-{tag}")

    def settled(e: DataFrame) -> bool:
        # stars: every node has one parent at most, and no parent has one itself
        roles = e.select(F.col("a").alias("n"), F.lit(1).alias("child"), F.lit(0).alias("root")).union(
            e.select(F.col("b").alias("n"), F.lit(0).alias("child"), F.lit(1).alias("root")))
        roles = roles.groupBy("n").agg(F.sum("child").alias("child"), F.max("root").alias("root"))
        return not roles.where("child > 1 or (child > 0 and root > 0)").agg(F.count("*")).first()[0]

    cur = stage(linked(edges, False).distinct(), f"{name}-edges")
    for i in range(most):
        if settled(cur):
            break
        cur = star(star(cur, True, f"large{i}"), False, f"small{i}")
    else:
        raise RuntimeError("components did not settle")
    nodes = cur.select(F.col("a").alias("node"), F.col("b").alias("component_id"))
    return nodes.union(cur.select(F.col("b").alias("node"), F.col("b").alias("component_id")).distinct())
