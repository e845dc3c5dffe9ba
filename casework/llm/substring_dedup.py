"""Substring dedup on a De Bruijn graph of token k-mers.

The 50-word windows are the edges of a De Bruijn graph (two consecutive edges
overlap in 49 words). As in partitioned compaction of such graphs, all edges
that share a minimizer (the 16-word seed of smallest hash in the window) form
one partition, and consecutive edges of a document with the same minimizer are
one path:

1. paths: per document, one row per path (seed, digest of the path's words,
   document, first window, number of windows);
2. seeds that start in one document only are dropped, so unrepeated text
   leaves after one aggregate and one join;
3. equal paths (seed, digest) join into one variant with its source coordinate
   (smallest document and place). Only the variants of branching seeds are
   opened, once each, at their source coordinate, into single edges whose
   smallest document is aggregated;
4. compaction: a join of each path with the one that starts where it ends gives
   the graph's steps. Where a variant has one successor, which has no other
   predecessor, at all their places, the two compact; joins that double the
   reach of each pointer find the head of every nonbranching chain, and its
   places stand for the whole chain, a long repeated span;
5. a chain in a later document than its source is repeated as a whole; a path
   in the source itself is repeated where its edges occur in a smaller
   document. Spans of a document are merged and its words removed.

A place is verified against the words at its source coordinate: both carry the
128-bit BLAKE2b digest of their words, and only equal ones join, for paths and
for edges. Every window is looked at; nothing is sampled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casework.llm.common import (
    U64, WORD_BASE, is_space, mix, prefix_sums, range_hash, record_batch, row_of, signed, split_words, stage, table,
    text_slices, word_hashes,
)

WINDOW = 50
SEED = 16
PART = 1 << 23
_LOW = U64((1 << 24) - 1)

_CHUNK = 1 << 16
HOPS = 3

_PATHS = "seed long, path binary, doc_id long, first int, windows int"
_PATHS_PA = pa.schema([("seed", pa.int64()), ("path", pa.binary()), ("doc_id", pa.int64()), ("first", pa.int32()), ("windows", pa.int32())])
_EDGES = "seed long, path binary, place int, edge binary, src_doc long"
_EDGES_PA = pa.schema([("seed", pa.int64()), ("path", pa.binary()), ("place", pa.int32()), ("edge", pa.binary()), ("src_doc", pa.int64())])


class _Words:
    """The words of a slice with one space after each, and where they stand."""

    def __init__(self, buf, start, end):
        self.end = np.cumsum(end - start + 1) - 1
        self.start = self.end - (end - start)
        text = np.full(int(self.end[-1]) + 1 if len(end) else 0, 0x20, np.uint8)
        inside = np.ones(len(text), bool)
        inside[self.end] = False
        text[inside] = buf[~is_space(buf)]
        self.text = memoryview(text)

    def digests(self, first: np.ndarray, count: np.ndarray) -> list[bytes]:
        """Digest of ``count`` words from each ``first``."""
        places = zip(self.start[first].tolist(), self.end[first + count - 1].tolist())
        return [hashlib.blake2b(self.text[lo:hi], digest_size=16).digest() for lo, hi in places]


def _sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width and len(v) > size:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    rest = width - size
    return np.minimum(v[:-rest], v[rest:]) if rest else v


def _slice_paths(buf, off, window, seed, most=PART):
    """(row, seed hash, path digest, first window, windows) of the paths of one
    slice, a long text in parts of ``most`` windows."""
    start, end, words = split_words(buf, off)
    if len(start) < window:
        return
    w = word_hashes(buf, start, end)
    given = _Words(buf, start, end)
    if len(off) > 2 or len(w) <= most:
        for row, s, first, count in _word_paths(w, words, window, seed):
            yield row, s, given.digests(words[row] + first, count + window - 1), first, count
        return
    # a long text is cut into parts that share window - 1 words; no window is lost
    for at in range(0, len(w) - window + 1, most):
        part = w[at:at + most + window - 1]
        for row, s, first, count in _word_paths(part, np.array([0, len(part)]), window, seed):
            yield row, s, given.digests(first + at, count + window - 1), first + at, count


def _word_paths(w, words, window, seed):
    n = len(w)
    last = words[1:][row_of(words)]
    edges = np.flatnonzero(np.arange(n) + window <= last)
    if not len(edges):
        return
    seeds = range_hash(prefix_sums(w, WORD_BASE), np.arange(n - seed + 1), np.arange(seed, n + 1), WORD_BASE)
    order = (mix(seeds) & ~_LOW) | np.arange(len(seeds), dtype=U64)
    low = (_sliding_min(order, window - seed + 1)[edges] & _LOW).astype(np.int64)
    cut = np.empty(len(edges), bool)
    cut[0] = True
    # seeds of two documents differ in position, so a new document starts a new path
    cut[1:] = low[1:] != low[:-1]
    at = np.flatnonzero(cut)
    count = np.diff(np.append(at, len(edges)))
    first, low = edges[at], low[at]
    row = np.searchsorted(words, first, side="right") - 1
    yield row, seeds[low], first - words[row], count


def paths(docs: DataFrame, window: int = WINDOW, seed: int = SEED, most: int = PART) -> DataFrame:
    """Step 1. Documents without an id or with fewer words have no path."""
    def run(batches):
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            for lo, hi, buf, off in text_slices(b, "text"):
                for row, s, p, first, count in _slice_paths(buf, off, window, seed, most):
                    yield record_batch(_PATHS_PA, signed(s), p, ids[lo:hi][row], first.astype(np.int32), count.astype(np.int32))

    return docs.where("doc_id is not null and text is not null").select("doc_id", "text").mapInArrow(run, _PATHS)


def _open_edges(docs: DataFrame, variants: DataFrame, window: int) -> DataFrame:
    """Step 4: the edges of each variant, read at its source coordinate."""
    at = variants.groupBy(F.col("src_doc").alias("doc_id")).agg(F.collect_list(F.struct("seed", "path", "src_first", "windows")).alias("at"))

    def run(batches):
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            lists = b.column(b.schema.get_field_index("at"))
            for lo, hi, buf, off in text_slices(b, "text"):
                start, end, words = split_words(buf, off)
                given = _Words(buf, start, end)
                part = lists.slice(lo, hi - lo)
                flat, sizes = part.flatten(), part.value_lengths().to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(hi - lo), sizes)
                seed, first, count = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3))
                place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                each = np.repeat(np.arange(len(count)), count)
                for k in range(0, len(each), _CHUNK):
                    e, p = each[k:k + _CHUNK], place[k:k + _CHUNK]
                    edge = given.digests(words[:-1][row[e]] + first[e] + p, window)
                    yield record_batch(_EDGES_PA, seed[e], flat.field(1).take(pa.array(e)), p.astype(np.int32), edge, ids[lo:hi][row[e]])

    # a repeated row of a document opens the same edges again; the aggregates are minima and sets
    return docs.select("doc_id", "text").join(at, "doc_id").mapInArrow(run, _EDGES)


def chains(found: DataFrame) -> DataFrame:
    """Step 4: (path, head) of the variants that follow another one in a
    nonbranching chain. Places only grow along a document, so no chain is a
    cycle, and a chain of n variants takes log4(n) rounds of joins."""
    ends = found.select("doc_id", (F.col("first") + F.col("windows")).alias("at"), "path")
    begins = found.select("doc_id", F.col("first").alias("at"), F.col("path").alias("next"))
    steps = stage(ends.join(begins, ["doc_id", "at"], "full").groupBy("path", "next").agg(F.lit(1).alias("one")).drop("one"), "sub-steps")
    # a null stands for the start or end of a repeated stretch
    ahead = steps.where("path is not null").groupBy("path").agg(F.count("*").alias("ways"), F.max("next").alias("next")).where("ways = 1 and next is not null")
    back = steps.where("next is not null").groupBy("next").agg(F.count("*").alias("ways"), F.max("path").alias("path")).where("ways = 1 and path is not null")
    now = stage(ahead.join(back, ["path", "next"]).select(F.col("next").alias("path"), F.col("path").alias("head")), "sub-links")
    while True:
        # each pointer moves up to three pointers on, so it reaches four times as far
        far = now
        for hop in range(HOPS):
            onward = now.select(F.col("path").alias("head"), F.col("head").alias(f"far{hop}"))
            far = far.join(onward, "head", "left").select("path", F.coalesce(f"far{hop}", "head").alias("head"), F.col(f"far{hop}").isNotNull().alias("moved"))
        now = stage(far, "sub-chains")
        # where the last hop moved none, every pointer is at its head
        if now.where("moved").isEmpty():
            return now.drop("moved")
        now = now.drop("moved")


def repeated_spans(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(doc_id, first, windows, src_doc, src_first): runs of windows of a
    document that also start in a document with a smaller id. ``src_doc`` and
    ``src_first`` are the source coordinate where the whole run is a copy, and
    null where several smaller documents share parts of it."""
    found = stage(paths(docs, window, seed), "sub-paths")
    shared = stage(found.groupBy("seed").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo <> hi").select("seed"), "sub-seeds")
    # a repeated row's places count once
    found = stage(found.join(shared, "seed").dropDuplicates(["doc_id", "first", "path"]), "sub-shared")
    variants = stage(found.groupBy("seed", "path", "windows").agg(F.min(F.struct("doc_id", "first")).alias("src"))
                     .select("seed", "path", "windows", F.col("src.doc_id").alias("src_doc"), F.col("src.first").alias("src_first")), "sub-variants")
    branching = stage(variants.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1").select("seed"), "sub-branching")
    edges = stage(_open_edges(docs, variants.join(branching, "seed"), window), "sub-edges")
    lowest = stage(edges.groupBy("seed", "edge").agg(F.min("src_doc").alias("lo"), F.max("src_doc").alias("hi")).where("lo <> hi").drop("hi"), "sub-lowest")
    own = stage(edges.join(lowest, ["seed", "edge"]).where("lo < src_doc").groupBy("path", "src_doc").agg(F.collect_set("place").alias("places")), "sub-own")
    followers = chains(found)
    length = (variants.join(followers, "path", "left").groupBy(F.coalesce("head", "path").alias("path"))
              .agg(F.sum("windows").cast("int").alias("windows")))
    heads = stage(variants.drop("windows", "seed").join(length, "path"), "sub-heads")
    whole = (found.select("path", "doc_id", "first").join(heads, "path").where("doc_id > src_doc")
             .select("doc_id", "first", "windows", "src_doc", "src_first"))
    parts = (found.join(own, "path").where("doc_id = src_doc").select("doc_id", "first", F.explode("places").alias("place"))
             .select("doc_id", (F.col("first") + F.col("place")).alias("first"), F.lit(1).alias("windows"),
                     F.lit(None).cast("long").alias("src_doc"), F.lit(None).cast("int").alias("src_first")))
    return whole.union(parts)


_OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
_OUT_PA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())])


def remove_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED, with_text: bool = True) -> DataFrame:
    """Documents without the words of their repeated windows.

    Returns one row per input row: doc_id, n_words, n_removed, kept_sha256 and,
    with ``with_text``, kept_text (the kept words joined by one space). A null
    or empty text has no words (digest of the empty string). Rows without an
    id are neither sources nor cut. doc_id identifies a text: rows that repeat
    a document get the same result each and are no source for each other. Other
    columns are ignored.
    """
    spans = repeated_spans(docs, window, seed).groupBy("doc_id").agg(F.collect_list(F.struct("first", "windows")).alias("spans"))

    def run(batches):
        for b in batches:
            raw, off = None, None
            for lo, hi, buf, off in text_slices(b, "text", 1 << 23):
                data, spans = buf.tobytes(), b.column(2).slice(lo, hi - lo)
                out = []
                for i in range(hi - lo):
                    words = data[off[i]:off[i + 1]].split()
                    n, cut, kept = len(words), 0, words
                    if spans[i].is_valid:
                        s = spans.slice(i, 1).flatten()
                        first, count = s.field(0).to_numpy(), s.field(1).to_numpy()
                        edge = np.zeros(n + 1, np.int64)
                        np.add.at(edge, first, 1)
                        np.add.at(edge, np.minimum(first + count - 1 + window, n), -1)
                        keep = np.cumsum(edge[:-1]) == 0
                        kept = list(compress(words, keep))
                        cut = n - len(kept)
                    text = b" ".join(kept)
                    out.append((n, cut, hashlib.sha256(text).hexdigest(), text.decode() if with_text else None))
                yield record_batch(_OUT_PA, b.column(0).slice(lo, hi - lo), *zip(*out))

    out = docs.select("doc_id", "text").join(spans, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(run, _OUT)
    return out if with_text else out.drop("kept_text")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words covered by a 50-word window that also starts in a document with a
    smaller doc_id, removed from every document."""
    return remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS h
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM t WHERE len(w) >= 50)),
lo AS (SELECT h, min(doc_id) AS d FROM win GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN lo USING (h) WHERE d < doc_id),
cut AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN ps IS NULL THEN w ELSE
              list_transform(list_filter(range(1, len(w) + 1), lambda x: NOT list_contains(ps, x)), lambda x: w[x]) END, ' '), '')) AS kept_sha256
FROM t LEFT JOIN cut USING (doc_id)
"""
