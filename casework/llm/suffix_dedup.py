"""Suffix-array dedup: byte strings that repeat anywhere, by LCP intervals.

A string of 100 bytes is removed where it also starts earlier. Equal strings
hold the same anchor, their 24-byte seed of smallest hash, at the same offset,
so the suffix array is cut by seed, and only suffixes at anchors are sorted:

1. segments: per text, the stretches of windows with one anchor, one row each
   (seed, hash of the stretch, document, first window, number of windows);
2. equal segments are one variant with its earliest place and its count, by an
   aggregate. All places of a variant but the earliest are repeated whole;
3. a seed with one variant is done. The variants of the others are read once
   each, at their earliest place, and dealt by seed. A seed's bucket holds
   texts that are all different. Its enhanced suffix array: the suffixes at the
   anchors in order, the lengths of the prefixes that neighbours share, and a
   scan with a stack that yields the tree of common-prefix intervals. The
   left contexts of an interval's members are ordered and scanned the same way:
   where a left extension is diverse, the interval's members part. An interval
   of right depth r and a left interval of depth l are a maximal repeat
   of l + r bytes with all its members, and it counts if l + r reaches the length;
4. of each group, all members but the earliest lose the group's bytes.

A seed with more variants than ``BUCKET`` isn't sorted in one task: its windows
are aggregated by their hash in Spark, which gives the same spans.

Segments are compared by two 64-bit hashes (seed, segment), the members of a
bucket byte by byte.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casework.llm.common import (
    _BYTE_CODES, BYTE_BASE, SPAN_BASE, U64, batch_text, give_back, mix, prefix_sums, range_hash, record_batch, signed, stage, table, text_slices,
)
from casework.llm.substring_dedup import _sliding_min

LENGTH = 100
SEED = 24
BUCKET = 20_000
_PLACE_BITS = 24
#: a long text is cut into parts of so many windows; no window is lost
_PART = 1 << 22

_SEGMENTS = "seed long, segment long, doc_id long, first long, windows int, shift int"
_SEGMENTS_PA = pa.schema([("seed", pa.int64()), ("segment", pa.int64()), ("doc_id", pa.int64()), ("first", pa.int64()), ("windows", pa.int32()), ("shift", pa.int32())])


def _cut(buf, off, length, seed):
    """(row, seed hash, segment hash, first window, windows, anchor - first) of a slice of texts."""
    n = len(buf)
    low_bits = U64((1 << _PLACE_BITS) - 1)
    last = np.repeat(off[1:], np.diff(off))
    windows = np.flatnonzero(np.arange(n) + length <= last)
    if not len(windows):
        return None
    codes = _BYTE_CODES[buf]
    sums = prefix_sums(codes, BYTE_BASE)
    at = np.arange(n - seed + 1)
    seeds = range_hash(sums, at, at + seed, BYTE_BASE)
    order = (mix(seeds) & ~low_bits) | at.astype(U64)
    low = (_sliding_min(order, length - seed + 1)[windows] & low_bits).astype(np.int64)
    new = np.ones(len(windows), bool)
    # anchors of two texts differ in place
    new[1:] = low[1:] != low[:-1]
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(windows)))
    first, low = windows[begin], low[begin]
    span = range_hash(prefix_sums(codes, SPAN_BASE), first, first + count - 1 + length, SPAN_BASE)
    segment = mix(span + (low - first).astype(U64) * U64(0x100000001B3) + count.astype(U64))
    row = np.searchsorted(off, first, side="right") - 1
    return row, seeds[low], segment, first - off[row], count, low - first


def segments(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Step 1. Rows without an id and texts shorter than ``length`` have none."""
    def run(batches):
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            for lo, hi, buf, off in text_slices(b, "text"):
                for part in range(0, max(len(buf) - length + 1, 1), _PART) if hi == lo + 1 else (0,):
                    piece = buf if hi > lo + 1 else buf[part:part + _PART + length - 1]
                    got = _cut(piece, off if hi > lo + 1 else np.array([0, len(piece)]), length, seed)
                    if got is not None:
                        row, s, g, first, count, shift = got
                        yield record_batch(_SEGMENTS_PA, signed(s), signed(g), ids[lo:hi][row], first + part, count.astype(np.int32), shift.astype(np.int32))

    return docs.where("doc_id is not null and text is not null").select("doc_id", "text").mapInArrow(run, _SEGMENTS)


_OPENED = "seed long, doc_id long, anchor long, shift int, body binary"
_OPENED_PA = pa.schema([("seed", pa.int64()), ("doc_id", pa.int64()), ("anchor", pa.int64()), ("shift", pa.int32()), ("body", pa.binary())])


def _open(docs: DataFrame, variants: DataFrame, length: int) -> DataFrame:
    """The bytes of each variant, read at its earliest place."""
    at = variants.groupBy("doc_id").agg(F.collect_list(F.struct("seed", "first", "windows", "shift")).alias("at"))

    def run(batches):
        for b in batches:
            ids, (raw, off), lists = b.column(0).to_numpy(zero_copy_only=False), batch_text(b, "text"), b.column(2)
            for i in range(len(ids)):
                data, flat = raw[off[i]:off[i + 1]].tobytes(), lists.slice(i, 1).flatten()
                seed, first, windows, shift = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(4))
                for lo in range(0, len(seed), 1 << 15):
                    part = slice(lo, lo + (1 << 15))
                    bodies = [data[f:f + w + length - 1] for f, w in zip(first[part].tolist(), windows[part].tolist())]
                    yield record_batch(_OPENED_PA, seed[part], np.full(len(bodies), ids[i]), (first + shift)[part], shift[part], bodies)
            give_back()

    return docs.select("doc_id", "text").join(at, "doc_id").select("doc_id", "text", "at").mapInArrow(run, _OPENED)


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return n - (((int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")).bit_length() + 7) // 8)


def intervals(keys: list[bytes]) -> list[tuple[int, int, int]]:
    """(depth, first, last) of the common-prefix intervals of sorted ``keys``
    with at least two members: a scan over the lengths that neighbours share,
    with the open intervals on a stack."""
    out, stack = [], []
    for i in range(1, len(keys) + 1):
        depth = _shared(keys[i - 1], keys[i]) if i < len(keys) else -1
        left = i - 1
        while stack and stack[-1][0] > depth:
            d, left = stack.pop()
            out.append((d, left, i - 1))
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, left))
    return out


def maximal_repeats(members: list[tuple[bytes, bytes]], length: int) -> list[tuple[int, int, list[int]]]:
    """(left depth, right depth, member numbers) of the groups of members
    (left context from the anchor backwards, suffix from the anchor on) that
    share at least ``length`` bytes around the anchor."""
    order = sorted(range(len(members)), key=lambda k: members[k][1])
    groups = []
    for right, lo, hi in intervals([members[k][1] for k in order]):
        mine = sorted(order[lo:hi + 1], key=lambda k: members[k][0])
        # where the left extension is diverse, the interval parts
        for left, a, z in intervals([members[k][0] for k in mine]):
            if left + right >= length:
                groups.append((left, right, mine[a:z + 1]))
    return groups


_SPANS = "doc_id long, start long, length long"
_SPANS_PA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64())])


def _bucket_spans(docs: list[int], anchors: list[int], shifts: list[int], bodies: list[bytes], length: int):
    """Spans that the later members of a bucket's groups lose."""
    found = maximal_repeats([(b[:s][::-1], b[s:]) for b, s in zip(bodies, shifts)], length)
    widest: dict[int, list] = {}
    for left, right, group in found:
        earliest = min((docs[k], anchors[k]) for k in group)
        for k in group:
            # a repeated row of a document stands at the same place
            if (docs[k], anchors[k]) != earliest:
                widest.setdefault(k, []).append((anchors[k] - left, anchors[k] + right))
    for k, mine in widest.items():
        mine.sort()
        lo, hi = mine[0]
        for s, e in mine[1:]:
            if s > hi:
                yield docs[k], lo, hi - lo
                lo, hi = s, e
            hi = max(hi, e)
        yield docs[k], lo, hi - lo


def _sorted_buckets(opened: DataFrame, length: int) -> DataFrame:
    """Step 3 and 4 of the buckets of bounded size."""
    def run(batches):
        rest: list[list] = [[], [], [], [], []]
        for b in batches:
            for have, column in zip(rest, b.columns):
                have.extend(column.to_pylist())
            yield from close(rest, False)
        yield from close(rest, True)

    def close(rest, last):
        """The spans of the seeds that are complete; the last seed may go on."""
        seeds, out, lo = rest[0], [], 0
        cuts = [i for i in range(1, len(seeds)) if seeds[i] != seeds[i - 1]] + ([len(seeds)] if last and seeds else [])
        for hi in cuts:
            if hi - lo > 1:
                out.extend(_bucket_spans(*(c[lo:hi] for c in rest[1:]), length))
            lo = hi
        for column in rest:
            del column[:lo]
        if out:
            yield record_batch(_SPANS_PA, *zip(*out))

    return opened.repartition("seed").sortWithinPartitions("seed").mapInArrow(run, _SPANS)


_WINDOWS = "seed long, window_hash long, left int, doc_id long, anchor long"
_WINDOWS_PA = pa.schema([("seed", pa.int64()), ("window_hash", pa.int64()), ("left", pa.int32()), ("doc_id", pa.int64()), ("anchor", pa.int64())])


def _hashed_buckets(opened: DataFrame, length: int) -> DataFrame:
    """Step 3 and 4 of the larger buckets: aggregates over their windows."""
    def run(batches):
        for b in batches:
            seed, doc, anchor, shift = (b.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            off = np.frombuffer(b.column(4).buffers()[1], np.int32)[b.column(4).offset:][:len(seed) + 1].astype(np.int64)
            data = b.column(4).buffers()[2]
            codes = _BYTE_CODES[np.frombuffer(data, np.uint8)[off[0]:off[-1]]]
            sums, off = prefix_sums(codes, SPAN_BASE), off - off[0]
            count = np.diff(off) - length + 1
            row = np.repeat(np.arange(len(count)), count)
            place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            s = off[:-1][row] + place
            h = mix(range_hash(sums, s, s + length, SPAN_BASE) + (shift[row] - place).astype(U64))
            yield record_batch(_WINDOWS_PA, seed[row], signed(h), (shift[row] - place).astype(np.int32), doc[row], anchor[row])

    windows = stage(opened.mapInArrow(run, _WINDOWS), "suffix-windows")
    key = ["seed", "window_hash"]
    first = stage(windows.groupBy(key).agg(F.min(F.struct("doc_id", "anchor")).alias("src"), F.count("*").alias("n"))
                  .where("n > 1").select(*key, F.col("src.doc_id").alias("src_doc"), F.col("src.anchor").alias("src_anchor")), "suffix-first")
    later = windows.join(first, key).where("doc_id <> src_doc or anchor <> src_anchor")
    return later.select("doc_id", (F.col("anchor") - F.col("left")).alias("start"), F.lit(length).cast("long").alias("length"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, seed: int = SEED, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, start, length): byte spans whose every string of ``length``
    bytes also starts earlier (in a document of smaller id, or earlier in the
    same one). Together they hold all such strings; they may overlap."""
    found = stage(segments(docs, length, seed), "suffix-segments")
    place = F.struct("doc_id", "first", "windows", "shift")
    variants = stage(found.groupBy("seed", "segment").agg(F.min(place).alias("src"), F.count("*").alias("n")).select("seed", "segment", "src.*", "n"), "suffix-variants")
    several = stage(variants.groupBy("seed").agg(F.count("*").alias("variants")).where("variants > 1"), "suffix-seeds")
    # the segment's hash stands for windows and shift as well
    copies = stage(found.join(variants.where("n > 1").select("seed", "segment", F.col("doc_id").alias("src_doc"), F.col("first").alias("src_first")), ["seed", "segment"])
                   .where("doc_id <> src_doc or first <> src_first")
                   .select("doc_id", F.col("first").alias("start"), (F.col("windows") + length - 1).cast("long").alias("length")), "suffix-copies")
    branching = stage(variants.join(several, "seed").select("seed", "variants", "doc_id", "first", "windows", "shift"), "suffix-branching")
    small = stage(_open(docs, branching.where(F.col("variants") <= bucket), length), "suffix-opened")
    spans = copies.union(stage(_sorted_buckets(small, length), "suffix-sorted"))
    large = branching.where(F.col("variants") > bucket)
    if not large.isEmpty():
        spans = spans.union(_hashed_buckets(stage(_open(docs, large, length), "suffix-large"), length))
    return spans


_OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
_OUT_PA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED, bucket: int = BUCKET, with_kept: bool = True) -> DataFrame:
    """Documents without the bytes of strings that also start earlier.

    Returns one row per input row: doc_id, n_bytes, n_removed, n_spans (maximal
    runs of removed bytes), kept_sha256 and, with ``with_kept``, kept: the
    remaining bytes (a cut may part the bytes of a character). A null or empty
    text has no bytes. Rows without an id are neither sources nor cut. doc_id
    identifies a text: rows that repeat a document are no source for each other
    and get the same result each. Further columns are ignored.
    """
    spans = (repeated_spans(docs.select("doc_id", "text"), length, seed, bucket).groupBy("doc_id")
             .agg(F.collect_list(F.struct("start", "length")).alias("spans")))

    def run(batches):
        for b in batches:
            lists = b.column(2)
            for lo, hi, buf, off in text_slices(b, "text", 1 << 23):
                data, out = buf.tobytes(), []
                for i in range(hi - lo):
                    body, n, runs, cut = data[off[i]:off[i + 1]], int(off[i + 1] - off[i]), 0, 0
                    if lists[lo + i].is_valid:
                        flat = lists.slice(lo + i, 1).flatten()
                        start, size = flat.field(0).to_numpy(), flat.field(1).to_numpy()
                        edge = np.zeros(n + 1, np.int64)
                        np.add.at(edge, start, 1)
                        np.add.at(edge, start + size, -1)
                        gone = np.cumsum(edge[:-1]) > 0
                        cut = int(gone.sum())
                        runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                        body = buf[off[i]:off[i + 1]][~gone].tobytes()
                    out.append((n, cut, runs, hashlib.sha256(body).hexdigest(), body if with_kept else None))
                yield record_batch(_OUT_PA, b.column(0).slice(lo, hi - lo), *zip(*out))

    out = docs.select("doc_id", "text").join(spans, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(run, _OUT)
    return out if with_kept else out.drop("kept")


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes covered by a 100-byte string that also starts earlier, removed."""
    return remove_repeats(table(spark, sf_dir, "documents"), with_kept=False)


ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, i, md5(substr(x, 2 * i + 1, 200)) AS h FROM (SELECT doc_id, x, unnest(range(length(x) // 2 - 99)) AS i FROM t WHERE length(x) >= 200)),
g AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS k FROM w) WHERE k > 1),
b AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 100 THEN 0 ELSE 1 END AS fresh FROM g),
s AS (SELECT doc_id, min(i) AS lo, max(i) + 100 AS hi FROM (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM b) GROUP BY doc_id, k),
k AS (SELECT doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans FROM s GROUP BY doc_id),
v AS (SELECT doc_id, hi AS lo, lead(lo) OVER (PARTITION BY doc_id ORDER BY lo) AS hi FROM (SELECT * FROM s UNION ALL SELECT DISTINCT doc_id, -1, 0 FROM s)),
p AS (SELECT doc_id, string_agg(substr(x, 2 * lo + 1, 2 * (coalesce(hi, length(x) // 2) - lo)), '' ORDER BY lo) AS x FROM v JOIN t USING (doc_id) GROUP BY doc_id)
SELECT t.doc_id, CAST(length(t.x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(p.x, t.x))) AS kept_sha256
FROM t LEFT JOIN k USING (doc_id) LEFT JOIN p USING (doc_id)
"""
