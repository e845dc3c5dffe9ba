"""N-gram Jaccard self-join of documents by vertical partitioning.

Documents link when the Jaccard similarity of their sets of word 5-grams is at
least 0.8. All n-grams stand in one global order, rarest first; ``fragments``
cuts that order, so every document's set falls into segments, the overlap of a
pair is counted segment by segment, and the partial counts are summed per pair.

1. Equal sets are one class (a set's id is a hash of its members), so copies
   cost one row.
2. Order: all n-grams of all documents are counted; the most frequent ones
   (at most ``MOST_FREQUENT``, the only thing broadcast) come last, by count,
   the others by hash. Any fixed order gives exact results; this one keeps
   what many documents share out of the prefixes.
3. Prefix filter: two linked sets share a member among the first
   ``n - ceil(0.8 n) + 1`` of each. Members that only one class has in its
   prefix leave at once.
4. Within the classes that share a prefix member, first each is paired with
   one of them, the member's hub: a group costs as many pairs as it has
   classes. Pairs pass the length and positional filters, are verified by the
   sum of partial overlaps, and linked classes are joined into components.
5. Where a member's group still falls into several components, every pair
   across components that passes the filters is verified too. So no link that
   would join two components is missed, and no pair within one is expanded.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casework.llm.common import (
    U64, WORD_BASE, lower_ascii, mix, prefix_sums, range_hash, record_batch, signed, split_words, stage, star_rounds, table,
    text_slices, word_hashes,
)

SHINGLE = 5
PERCENT = 80               # links: 100 * intersection >= PERCENT * union
FRAGMENTS = 16             # of the global order
EARLY = 4                  # fragments that are compared first
FREQUENT = 16              # counted occurrences from which an n-gram is frequent
BUCKET_GRAMS = 4_000_000   # n-grams that one task counts, about
SALT_GRAMS = 2_000_000_000
MOST_FREQUENT = 1 << 18    # frequent n-grams that are broadcast (16 bytes each)


def shingle_sets(buf: np.ndarray, off: np.ndarray, width: int = SHINGLE):
    """Per row the sorted distinct 64-bit hashes of its n-grams (the whole
    sequence with fewer words; nothing without words)."""
    buf = lower_ascii(buf)
    start, end, rows = split_words(buf, off)
    sums = prefix_sums(word_hashes(buf, start, end), WORD_BASE)
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()):
        if b - a >= width:
            s = np.arange(a, b - width + 1)
            yield np.unique(range_hash(sums, s, s + width, WORD_BASE))
        elif b > a:
            yield range_hash(sums, np.array([a]), np.array([b]), WORD_BASE) ^ U64(b - a)
        else:
            yield np.zeros(0, U64)


def set_id(members: np.ndarray) -> int:
    return int(mix(np.array([mix(members).sum(dtype=U64) + U64(len(members))]))[:1].view(np.int64)[0])


class Order:
    """The global order: n-grams that are not frequent by hash, then the
    frequent ones by count. ``grams`` holds the upper 48 bits of the hash."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        at = np.argsort(grams)
        self.grams, self.counts = grams[at], counts[at]

    def frequency(self, members: np.ndarray) -> np.ndarray:
        if not len(self.grams):
            return np.zeros(len(members), np.int64)
        top = members >> U64(16)
        k = np.minimum(np.searchsorted(self.grams, top), len(self.grams) - 1)
        return np.where(self.grams[k] == top, self.counts[k], 0)

    def sort(self, members: np.ndarray) -> np.ndarray:
        return members[np.lexsort((members, self.frequency(members)))]

    def fragment(self, members: np.ndarray, fragments: int) -> np.ndarray:
        by_hash = ((members >> U64(32)) * U64(fragments - 1) >> U64(32)).astype(np.int64)
        return np.where(self.frequency(members) > 0, fragments - 1, by_hash)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def _sets_of(batches, width):
    """(ids, sets) of the documents, a slice of some megabytes of text at a time."""
    for b in batches:
        for lo, hi, buf, off in text_slices(b, "text"):
            yield b.column(0).slice(lo, hi - lo), list(shingle_sets(buf, off, width))


def set_table(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, sid); sid is null without words."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("sid", pa.int64())])

    def run(batches):
        for ids, sets in _sets_of(batches, width):
            yield record_batch(schema, ids, [len(s) for s in sets], [set_id(s) if len(s) else None for s in sets])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, sid long")


def _distinct_sets(sets) -> dict[int, np.ndarray]:
    return {set_id(s): s for s in sets if len(s)}


def frequent_grams(docs: DataFrame, total: int, width: int = SHINGLE, least: int = FREQUENT, most: int = MOST_FREQUENT) -> Order:
    """The order by the counts of all n-grams, over distinct sets per batch.

    A slice of text sends its distinct n-grams (48 bits of the hash, and a
    count) as one sorted run per bucket of the hash. A bucket holds about
    ``BUCKET_GRAMS`` of the ``total``, but a frequent n-gram has an entry of
    each slice in it, so a bucket's runs are dealt to salts first, one for
    about ``SALT_GRAMS`` of the total: a salt sums its runs to one, and the
    bucket sums those of its salts. Only the ``most`` frequent n-grams reach
    the driver."""
    buckets, salts = max(64, -(-total // BUCKET_GRAMS)), max(1, -(-total // SALT_GRAMS))
    schema = pa.schema([("bucket", pa.int64()), ("salt", pa.int64()), ("run", pa.binary()), ("seen", pa.binary())])
    edges = np.array([(b << 48) // buckets for b in range(buckets + 1)], U64)

    def runs(batches):
        salt = TaskContext.get().partitionId()
        for _, sets in _sets_of(batches, width):
            salt += 1
            sets = list(_distinct_sets(sets).values())
            if sets:
                grams, seen = np.unique(np.concatenate(sets) >> U64(16), return_counts=True)
                packed = (grams << U64(16)) | np.minimum(seen, 0xFFFF).astype(U64)
                at = np.searchsorted(grams, edges)
                full = np.flatnonzero(np.diff(at))
                yield record_batch(schema, full, np.full(len(full), salt % salts), [packed[at[b]:at[b + 1]].tobytes() for b in full], [None] * len(full))

    def summed(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        run = np.frombuffer(b"".join(t.column("run").to_pylist()), U64)
        if t.column("seen").null_count:  # as the slices sent them
            run = np.sort(run)
            grams, seen = run >> U64(16), (run & U64(0xFFFF)).astype(np.int64)
        else:
            seen = np.frombuffer(b"".join(t.column("seen").to_pylist()), np.int64)
            at = np.argsort(run, kind="stable")
            grams, seen = run[at], seen[at]
        first = np.flatnonzero(np.diff(grams, prepend=grams[:1] + U64(1)))
        return grams[first], np.add.reduceat(seen, first)

    def salted(t: pa.Table) -> pa.Table:
        grams, seen = summed(t)
        return pa.Table.from_batches([record_batch(schema, [t.column("bucket")[0].as_py()], [0], [grams.tobytes()], [seen.tobytes()])])

    def count(t: pa.Table) -> pa.Table:
        grams, seen = summed(t)
        keep = seen >= least
        return pa.table({"gram": pa.array(signed(grams[keep])), "seen": pa.array(seen[keep])})

    columns = "bucket long, salt long, run binary, seen binary"
    sent = docs.select("doc_id", "text").mapInArrow(runs, columns)
    if salts > 1:
        sent = sent.groupBy("bucket", "salt").applyInArrow(salted, columns)
    counts = sent.groupBy("bucket").applyInArrow(count, "gram long, seen long")
    top = counts.orderBy(F.desc("seen"), "gram").limit(most).toArrow()
    return Order(top.column(0).to_numpy().view(U64), top.column(1).to_numpy())


def prefixes(docs: DataFrame, order, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(gram, sid, n, i, doc_id): the members in each class's prefix, their
    place, and the class's smallest document in the batch."""
    schema = pa.schema([("gram", pa.int64()), ("sid", pa.int64()), ("n", pa.int32()), ("i", pa.int32()), ("doc_id", pa.int64())])

    def run(batches):
        for ids, sets in _sets_of(batches, width):
            own, low = _distinct_sets(sets), {}
            for doc, s in zip(ids.to_pylist(), sets):
                sid = set_id(s) if len(s) else None
                low[sid] = min(doc, low.get(sid, doc))
            grams, sids, ns, places, docs_ = [], [], [], [], []
            for sid, s in own.items():
                p = prefix_length(len(s), percent)
                grams.append(order.value.sort(s)[:p])
                sids.append(np.full(p, sid))
                ns.append(np.full(p, len(s), np.int32))
                places.append(np.arange(p, dtype=np.int32))
                docs_.append(np.full(p, low[sid]))
            if grams:
                yield record_batch(schema, signed(np.concatenate(grams)), *map(np.concatenate, (sids, ns, places, docs_)))

    return docs.select("doc_id", "text").mapInArrow(run, "gram long, sid long, n int, i int, doc_id long")


def segments(docs: DataFrame, wanted: DataFrame, order, width: int = SHINGLE, fragments: int = FRAGMENTS, early: int = EARLY) -> DataFrame:
    """(sid, fragment, members, early) of the documents in ``wanted``
    (doc_id); ``early`` is the size of the first fragments together. The first
    fragment of either part is there even when it is empty, so every pair meets
    in both parts."""
    schema = pa.schema([("sid", pa.int64()), ("fragment", pa.int32()), ("members", pa.list_(pa.int64())), ("early", pa.int32())])

    def run(batches):
        for _, sets in _sets_of(batches, width):
            out = []
            for sid, s in _distinct_sets(sets).items():
                f = order.value.fragment(s, fragments)
                at = np.argsort(f, kind="stable")
                parts = np.split(signed(s[at]), np.searchsorted(f[at], np.arange(1, fragments)))
                size = int((f < early).sum())
                out += [(sid, k, m, size) for k, m in enumerate(parts) if len(m) or k in (0, early)]
            if out:
                yield record_batch(schema, *map(list, zip(*out)))

    return docs.select("doc_id", "text").join(wanted, "doc_id").mapInArrow(run, "sid long, fragment int, members array<bigint>, early int")


def _least_overlap(n, m, percent: int):
    """Smallest intersection that links sets of n and m members."""
    n, m = n.cast("long"), m.cast("long")
    return F.ceil((percent * (n + m)) / F.lit(100.0 + percent) - 1e-6)


def _pass_filters(a: str, b: str, percent: int):
    """Length and positional filter of two prefix rows."""
    n, m, i, j = (F.col(x).cast("long") for x in (f"{a}.n", f"{b}.n", f"{a}.i", f"{b}.i"))
    return ((100 * F.least(n, m) >= percent * F.greatest(n, m))
            & (1 + F.least(n - i - 1, m - j - 1) >= _least_overlap(n, m, percent)))


def _overlaps(pairs: DataFrame, parts: DataFrame, keep: list[str]) -> DataFrame:
    """The pairs with ``keep`` and c, the sum of their partial overlaps in the
    fragments of ``parts``, and the early sizes of both."""
    left = parts.select(F.col("sid").alias("a"), "fragment", F.col("members").alias("x"), F.col("early").alias("e_a"))
    right = parts.select(F.col("sid").alias("b"), "fragment", F.col("members").alias("y"), F.col("early").alias("e_b"))
    # a fragment that one side lacks adds nothing to the overlap
    partial = (pairs.select("a", "b", *keep).join(left, "a").join(right, ["b", "fragment"])
               .select("a", "b", *keep, "e_a", "e_b", F.size(F.array_intersect("x", "y")).alias("c")))
    return partial.groupBy("a", "b", *keep, "e_a", "e_b").agg(F.sum("c").alias("c"))


def verified(pairs: DataFrame, parts: DataFrame, name: str, percent: int = PERCENT, early: int = EARLY) -> DataFrame:
    """The linked ones of ``pairs`` (a, b, n_a, n_b): partial overlaps per
    fragment, summed per pair. The first ``early`` fragments come first; a pair
    whose overlap there leaves too little for the others is out."""
    least = _least_overlap(F.col("n_a"), F.col("n_b"), percent)
    first = _overlaps(pairs, parts.where(F.col("fragment") < early), ["n_a", "n_b"])
    some = stage(first.where(F.col("c") + F.least(F.col("n_a") - F.col("e_a"), F.col("n_b") - F.col("e_b")) >= least)
                 .select("a", "b", "n_a", "n_b", F.col("c").alias("c_early")), f"{name}-early")
    rest = _overlaps(some, parts.where(F.col("fragment") >= early), ["n_a", "n_b", "c_early"])
    c = F.col("c") + F.col("c_early")
    both = F.col("n_a").cast("long") + F.col("n_b") - c
    return rest.where(F.lit(100) * c >= F.lit(percent) * both).select("a", "b")


def _pair(m: str, h: str) -> list[Column]:
    """(a, b, n_a, n_b) of two prefix rows, the smaller id first."""
    swap = F.col(f"{m}.sid") > F.col(f"{h}.sid")
    pick = lambda c, x, y: F.when(swap, F.col(f"{y}.{c}")).otherwise(F.col(f"{x}.{c}"))
    return [pick("sid", m, h).alias("a"), pick("sid", h, m).alias("b"), pick("n", m, h).alias("n_a"), pick("n", h, m).alias("n_b")]


def near_duplicates(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Components of documents linked by n-gram similarity.

    Returns one row per input row: doc_id, n_shingles (size of the set),
    component_id (smallest doc_id that links lead to, itself included).
    Without words, or with a null text, the set is empty and linked with
    nothing. A row without an id is linked with nothing and has a null
    component_id. Repeated rows stay rows; other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    own = stage(set_table(docs, width), "ngram-sets")
    live = docs.where("doc_id is not null and text is not null")
    classes = stage(own.where("sid is not null and doc_id is not null").groupBy("sid")
                    .agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n")), "ngram-classes")
    total = classes.agg(F.sum("n")).first()[0] or 0
    order = spark.sparkContext.broadcast(frequent_grams(live, total, width))
    # copies in several batches give equal rows; a gram that one class has leaves first
    prefix = stage(prefixes(live, order, width, percent), "ngram-prefixes")
    shared = stage(prefix.groupBy("gram").agg(F.min("sid").alias("lo"), F.max("sid").alias("hi"))
                   .where("lo <> hi").select("gram"), "ngram-shared")
    members = stage(prefix.join(shared, "gram").groupBy("gram", "sid", "n", "i").agg(F.min("doc_id").alias("doc_id")), "ngram-members")

    # the hub is the class of the earliest document: copies are near their origin
    hubs = stage(members.groupBy("gram").agg(F.min(F.struct("doc_id", "sid", "n", "i")).alias("hub"))
                 .select("gram", F.col("hub.sid").alias("sid"), F.col("hub.n").alias("n"), F.col("hub.i").alias("i")), "ngram-hubs")
    first = stage(members.alias("m").join(hubs.alias("h"), "gram").where("m.sid <> h.sid")
                  .where(_pass_filters("m", "h", percent)).select(*_pair("m", "h")).distinct(), "ngram-pairs1")

    def links(pairs: DataFrame, name: str) -> DataFrame:
        ends = pairs.select(F.col("a").alias("sid")).union(pairs.select(F.col("b").alias("sid"))).distinct()
        wanted = ends.join(classes, "sid").select(F.col("rep").alias("doc_id")).distinct()
        # a repeated row gives its fragments again in every slice it stands in
        parts = stage(segments(live, wanted, order, width).dropDuplicates(["sid", "fragment"]), f"{name}-segments")
        return stage(verified(pairs, parts, name, percent), f"{name}-links")

    linked = links(first, "ngram-1")
    comp = stage(star_rounds(linked, "ngram-comp1"), "ngram-comp1")

    # members whose group still falls into several components
    of = members.join(comp.select(F.col("node").alias("sid"), F.col("component_id").alias("c")), "sid", "left").withColumn("c", F.coalesce("c", "sid"))
    of = stage(of, "ngram-of")
    open_ = stage(of.groupBy("gram").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("gram"), "ngram-open")
    rest = stage(of.join(open_, "gram"), "ngram-rest")
    across = (rest.alias("m").join(rest.alias("h"), (F.col("m.gram") == F.col("h.gram")) & (F.col("m.sid") < F.col("h.sid"))
                                   & (F.col("m.c") != F.col("h.c")) & _pass_filters("m", "h", percent))
              .select(*_pair("m", "h")).distinct())
    second = stage(across.join(first, ["a", "b"], "left_anti"), "ngram-pairs2")
    more = links(second, "ngram-2")
    comp = stage(star_rounds(comp.select(F.col("node").alias("a"), F.col("component_id").alias("b")).union(more), "ngram-comp2"), "ngram-comp2")

    label = classes.join(comp.select(F.col("node").alias("sid"), F.col("component_id").alias("c")), "sid", "left").withColumn("c", F.coalesce("c", "sid"))
    lowest = label.groupBy("c").agg(F.min("rep").alias("component_id"))
    label = stage(label.join(lowest, "c").select("sid", "component_id"), "ngram-label")
    return (own.join(label, "sid", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")))


def keep_one(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id;
    of rows that repeat it one stays. Rows without an id stay. All columns
    stay."""
    kept = near_duplicates(docs, width, percent).where("doc_id = component_id").select("doc_id").distinct()
    rows = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).select(*docs.columns)
    return rows.union(docs.where(F.col("doc_id").isNull()))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5(CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(list_slice(w, i, i + 4), ' ') END) AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM l JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
r(a, b) AS (SELECT doc_id, doc_id FROM t UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT t.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(r.b) AS component_id
FROM t JOIN r ON r.a = t.doc_id LEFT JOIN n ON n.doc_id = t.doc_id GROUP BY t.doc_id, n.n
"""
