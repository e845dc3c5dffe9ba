"""Benchmark decontamination: BM25 with block-max WAND over the test items.

The test items are indexed, the training passages are the queries. An item's
words are cut into units of at most ``UNIT`` words; a posting holds a unit and
the word's BM25 weight in it, as a share of the weights of all the unit's
words, so a passage that holds a whole unit scores 1 against it. Postings
stand in blocks with their largest weight. Every document is read whole as
overlapping passages of two blocks of ``UNIT`` words, so any ``UNIT``
consecutive words lie within one passage. A unit's most frequent words may
weigh up to half of ``SCORE`` together; its other postings are the essential
ones. A passage first adds up the essential weights of its words, in NumPy for
many passages at once; a unit that lacks what its frequent words cannot make
up is out. Passages with a unit left walk their posting lists by block-max
WAND and retrieve every unit of at least ``SCORE``.

A retrieved item is verified around its passage: the first half of its words
(the question) and the second half (the answer) must each have ``OVERLAP`` of
their five-word shingles there. As one edited word takes up to five of them
with it, an item of at least ``EDIT`` words is also there if each half has
``OVERLAP`` of its words and no more three-word shingles of both halves are
missing than one edited word in every ``EDIT`` explains.

The index is the only thing that is broadcast, in shards of about
``SHARD_BYTES`` of item text; more items mean more shards, each of which reads
the documents once. The driver holds one shard at a time. Statistics (document frequencies, lengths) are taken over
all items.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casework.llm.common import (
    U64, WORD_BASE, lower_ascii, prefix_sums, range_hash, record_batch, signed, split_words, stage, table, text_slices, word_hashes,
)

UNIT = 64
BLOCK = 16
SCORE = 0.6
OVERLAP = 0.8
SHINGLE = 5
EDIT = 10                  # words of an item for each one that may be edited
EDIT_SHINGLE = 3
K1, B = 1.2, 0.75
SHARD_BYTES = 4 << 20

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[:128] = True
_SEPARATOR[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = False


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the lower-cased words of letters and digits, word offset of each row)."""
    buf = lower_ascii(buf)
    start, end, rows = split_words(buf, off, _SEPARATOR)
    return word_hashes(buf, start, end), rows


def units_of(n: int) -> list[tuple[int, int]]:
    parts = max(1, -(-n // UNIT))
    cut = [round(i * n / parts) for i in range(parts + 1)]
    return list(zip(cut, cut[1:])) if n else []


def shingles(sums: np.ndarray, a: int, b: int, width: int) -> np.ndarray:
    """Hashes of the word n-grams within [a, b)."""
    s = np.arange(a, max(a, b - width + 1))
    return range_hash(sums, s, s + width, WORD_BASE)


class Index:
    """Postings of one shard. ``items``: (item_id, word hashes)."""

    def __init__(self, items: list[tuple[int, np.ndarray]], frequency: dict[int, int], units: int, length: float):
        self.parts = []      # per item: (question, answer) as (width, distinct shingles)
        self.edited = []     # per item: (question, answer) as (distinct words, distinct short shingles), and how many of these may miss
        self.ids, self.item = [], []   # of each item; item of each unit
        rows: dict[int, list[tuple[int, float]]] = {}
        for item_id, w in items:
            if not len(w):
                continue
            sums, half = prefix_sums(w, WORD_BASE), max(1, len(w) // 2)
            pair, edited = [], []
            for a, b in ((0, half), (half, len(w))):
                width = min(SHINGLE, b - a)
                pair.append((width, np.unique(shingles(sums, a, b, width))) if width else None)
                edited.append((np.unique(w[a:b]), np.unique(shingles(sums, a, b, EDIT_SHINGLE))))
            self.parts.append(pair)
            self.edited.append((edited, EDIT_SHINGLE * (len(w) // EDIT)))
            self.ids.append(item_id)
            for a, b in units_of(len(w)):
                terms, tf = np.unique(w[a:b], return_counts=True)
                idf = np.array([math.log(1 + (units - n + 0.5) / (n + 0.5)) for n in (frequency[int(t)] for t in signed(terms))])
                weight = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * (b - a) / length))
                for t, x in zip(terms.tolist(), (weight / weight.sum()).tolist()):
                    rows.setdefault(t, []).append((len(self.item), x))
                self.item.append(len(self.ids) - 1)
        self.terms = np.array(sorted(rows), U64)
        self.units = [[u for u, _ in rows[t]] for t in self.terms.tolist()]
        self.weights = [[x for _, x in rows[t]] for t in self.terms.tolist()]
        self.blocks = [[max(x[i:i + BLOCK]) for i in range(0, len(x), BLOCK)] for x in self.weights]
        self.most = [max(x) for x in self.weights]
        self._split_essential()

    def _split_essential(self):
        """Essential postings as one array each (``first[t]`` to
        ``first[t + 1]`` for a term), and what a unit needs of them."""
        term = np.repeat(np.arange(len(self.terms)), [len(u) for u in self.units])
        unit = np.array([u for us in self.units for u in us], np.int64)
        weight = np.array([x for xs in self.weights for x in xs], np.float64)
        often = np.array([len(u) for u in self.units], np.int64)
        # by unit, the most frequent terms first
        order = np.lexsort((term, -often[term], unit)) if len(term) else np.zeros(0, np.int64)
        start = np.searchsorted(unit[order], np.arange(len(self.item)))
        run = np.cumsum(weight[order])
        run -= np.repeat((run - weight[order])[start], np.diff(np.append(start, len(order)))) if len(order) else 0
        frequent = run <= SCORE / 2
        self.need = SCORE - np.bincount(unit[order][frequent], weight[order][frequent], len(self.item)) - 1e-9
        keep = np.sort(order[~frequent])
        self.first = np.searchsorted(term[keep], np.arange(len(self.terms) + 1))
        self.essential_unit, self.essential_weight = unit[keep], weight[keep]

    def term_ids(self, w: np.ndarray) -> np.ndarray:
        """Number of each word's term, -1 for none."""
        if not len(self.terms):
            return np.full(len(w), -1)
        k = np.minimum(np.searchsorted(self.terms, w), len(self.terms) - 1)
        return np.where(self.terms[k] == w, k, -1)

    def retrieve(self, terms: list[int], least: float = SCORE) -> list[tuple[int, float]]:
        """Every (unit, score) of at least ``least`` for a set of terms."""
        end, least = len(self.item), least - 1e-9
        at = dict.fromkeys(terms, 0)
        live = sorted(terms, key=lambda t: self.units[t][0])
        out = []
        while live:
            # pivot: the first unit that the lists up to it could lift over the threshold
            total, pivot = 0.0, -1
            for i, t in enumerate(live):
                total += self.most[t]
                if total >= least:
                    pivot = i
                    break
            if pivot < 0:
                return out
            unit = self.units[live[pivot]][at[live[pivot]]]
            while pivot + 1 < len(live) and self.units[live[pivot + 1]][at[live[pivot + 1]]] == unit:
                pivot += 1
            # block-max test, on the blocks in which the unit would stand
            bound, edge = 0.0, end
            for t in live[:pivot + 1]:
                block = self._seek(t, at[t], unit) // BLOCK
                if block < len(self.blocks[t]):
                    bound += self.blocks[t][block]
                    last = self.units[t][min(len(self.units[t]), (block + 1) * BLOCK) - 1]
                    edge = min(edge, last + 1)
            if bound < least:
                # no unit before the first block border or the next list can do better
                target = edge if pivot + 1 == len(live) else min(edge, self.units[live[pivot + 1]][at[live[pivot + 1]]])
                target = max(target, unit + 1)
            else:
                target = unit + 1
                score = 0.0
                for t in live[:pivot + 1]:
                    k = self._seek(t, at[t], unit)
                    if k < len(self.units[t]) and self.units[t][k] == unit:
                        score += self.weights[t][k]
                if score >= least:
                    out.append((unit, score))
            for t in live[:pivot + 1]:
                at[t] = self._seek(t, at[t], target)
            live = sorted((t for t in live if at[t] < len(self.units[t])), key=lambda t: self.units[t][at[t]])
        return out

    def _seek(self, term: int, start: int, unit: int) -> int:
        """First posting from ``start`` on whose unit is not before ``unit``."""
        from bisect import bisect_left
        return bisect_left(self.units[term], unit, start)

    def passages(self, ids: np.ndarray, rows: np.ndarray):
        """(row, first word, end) of the passages in which a unit has the
        essential weight that it needs."""
        units = len(self.item)
        count = np.diff(rows)
        blocks = -(-count // UNIT)
        first = np.append(0, np.cumsum(blocks))            # block offset of each row
        row = np.repeat(np.arange(len(count)), blocks)
        at = np.flatnonzero(ids >= 0)
        size = np.diff(self.first)
        at = at[size[ids[at]] > 0]
        if not len(at):
            return
        r = np.searchsorted(rows, at, side="right") - 1
        block = first[r] + (at - rows[r]) // UNIT
        pairs = np.unique(block * len(self.terms) + ids[at])
        block, term = pairs // len(self.terms), pairs % len(self.terms)
        n = size[term]
        place = np.repeat(self.first[term], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        keys, each = np.unique(np.repeat(block, n) * units + self.essential_unit[place], return_inverse=True)
        have = np.bincount(each, self.essential_weight[place], len(keys))
        block, unit = keys // units, keys % units
        # the next block of the same document is in the passage too
        after = np.minimum(np.searchsorted(keys, keys + units), len(keys) - 1)
        both = (keys[after] == keys + units) & (block + 1 < first[row[block] + 1])
        good = have + np.where(both, have[after], 0.0) >= self.need[unit]
        # a block that has enough alone is also the second one of a passage, and
        # a last block is read together with the one before it
        alone = have >= self.need[unit]
        start = np.concatenate([block[good], block[alone] - 1])
        doc = row[np.concatenate([block[good], block[alone]])]
        start = np.unique(np.maximum(np.minimum(start, first[doc + 1] - 2), first[doc]))
        for k in start.tolist():
            r = int(row[k])
            a = int(rows[r] + (k - first[r]) * UNIT)
            yield r, a, min(a + 2 * UNIT, int(rows[r + 1]))

    def leaks(self, w: np.ndarray, rows: np.ndarray):
        """(row, item number, score, question overlap, answer overlap) of
        every verified item of the rows' texts."""
        ids = self.term_ids(w)
        sums, best = None, {}
        for r, a, b in self.passages(ids, rows):
            terms = np.unique(ids[a:b])
            terms = terms[terms >= 0]
            for unit, score in self.retrieve(terms.tolist()):
                item = self.item[unit]
                sums = prefix_sums(w, WORD_BASE) if sums is None else sums
                size = sum(len(p[1]) + p[0] for p in self.parts[item] if p)
                lo, hi = max(int(rows[r]), a - size), min(int(rows[r + 1]), b + size)
                share = [float(np.isin(p[1], shingles(sums, lo, hi, p[0])).mean()) if p else 1.0 for p in self.parts[item]]
                old = best.get((r, item))
                if (min(share) >= OVERLAP - 1e-9 or self._is_edited(item, w, sums, lo, hi)) and (old is None or (score, *share) > old):
                    best[r, item] = (score, *share)
        for (r, item), (score, q, ans) in best.items():
            yield r, item, score, q, ans


    def _is_edited(self, item: int, w: np.ndarray, sums: np.ndarray, lo: int, hi: int) -> bool:
        """Whether the words [lo, hi) hold the item with a few words edited."""
        halves, most = self.edited[item]
        if not most:
            return False
        here = shingles(sums, lo, hi, EDIT_SHINGLE)
        missing = sum(int((~np.isin(s, here)).sum()) for _, s in halves)
        return missing <= most and all(np.isin(own, w[lo:hi]).mean() >= OVERLAP - 1e-9 for own, _ in halves)


def _item_words(texts: list[str]) -> list[np.ndarray]:
    data = [t.encode() for t in texts]
    off = np.append(0, np.cumsum([len(x) for x in data]))
    w, rows = words(np.frombuffer(b"".join(data), np.uint8), off)
    return np.split(w, rows[1:-1])


def _items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    return (benchmark.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).distinct())


def _shards(items: DataFrame, shard_bytes: int) -> int:
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-size // shard_bytes))


def build_indexes(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> Iterator[Index]:
    """The index of each shard, one after the other. Items with equal words
    under one id count once; items without an id or words are left out."""
    items = _items(benchmark, id_col, text_col)

    def stats(batches):
        schema = pa.schema([("term", pa.int64()), ("n", pa.int64()), ("size", pa.int64())])
        for b in batches:
            for w in _item_words(b.column(1).to_pylist()) if b.num_rows else ():
                for lo, hi in units_of(len(w)):
                    terms = np.unique(signed(w[lo:hi]))
                    # the first row of a unit carries its length
                    size = np.zeros(len(terms), np.int64)
                    size[0] = hi - lo
                    yield record_batch(schema, terms, (size > 0).astype(np.int64), size)

    seen = items.mapInArrow(stats, "term long, n long, size long")
    total = seen.agg(F.sum("n"), F.sum("size")).first()
    if not total[0]:
        return
    shards = _shards(items, shard_bytes)
    frequency = seen.groupBy("term").agg(F.count("*").alias("df"))
    for s in range(shards):
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(shards)) == s).orderBy("id", "text").collect()
        if not part:
            continue
        own = _item_words([r["text"] for r in part])
        terms = sorted({int(t) for w in own for t in signed(w)})
        df = frequency.join(items.sparkSession.createDataFrame([(t,) for t in terms], "term long"), "term") if terms else frequency.limit(0)
        found = {r["term"]: r["df"] for r in df.collect()}
        yield Index(list(zip((r["id"] for r in part), own)), found, total[0], total[1] / total[0])


_LEAK = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
_LEAK_PA = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())])


def leaks(docs: DataFrame, benchmark: DataFrame, indexes: Iterable[Index] | None = None) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap): one row per
    document and item found in it.

    A null or empty text holds nothing. Rows that share an id give one row per
    item, with the largest figures; rows without an id count as one document.
    An empty table of either kind gives no row; other columns are ignored.
    """
    spark = docs.sparkSession
    out = spark.createDataFrame([], _LEAK)
    for index in build_indexes(benchmark) if indexes is None else indexes:
        shared = spark.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            index = shared.value
            for b in batches:
                ids = b.column(0)
                for lo, hi, buf, off in text_slices(b, "text"):
                    found = list(index.leaks(*words(buf, off)))
                    if found:
                        row, item, *figures = zip(*found)
                        yield record_batch(_LEAK_PA, ids.slice(lo, hi - lo).take(pa.array(row)), [index.ids[i] for i in item], *map(list, figures))

        out = out.union(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _LEAK))
    return out.groupBy("doc_id", "item_id").agg(*[F.max(c).alias(c) for c in ("score", "question_overlap", "answer_overlap")])


def drop_leaks(docs: DataFrame, benchmark: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``docs`` without the rows whose text holds an item. All columns stay.

    Repeated rows go or stay together, whatever their id; a null text stays.
    With one shard every decision is made where the row is, so no text is
    shuffled. With more, each shard's pass writes a digest of the texts that it
    found, its index is released, and ``docs`` is read once more without them.
    """
    spark = docs.sparkSession
    one, digests = _shards(_items(benchmark), shard_bytes) == 1, None
    own = F.sha2(F.col("text").cast("string"), 256)
    for s, index in enumerate(build_indexes(benchmark, shard_bytes=shard_bytes)):
        shared = spark.sparkContext.broadcast(index)

        def run(batches, shared=shared, keep_found=not one):
            for b in batches:
                keep = np.full(b.num_rows, not keep_found)
                for lo, _, buf, off in text_slices(b, "text"):
                    for found in shared.value.leaks(*words(buf, off)):
                        keep[lo + found[0]] = keep_found
                yield b.filter(pa.array(keep))

        if one:
            return docs.mapInArrow(run, docs.schema)
        texts = docs.select(F.col("text").cast("string").alias("text"))
        part = stage(texts.mapInArrow(run, texts.schema).select(own.alias("__leak")).distinct(), f"leaks{s}")
        shared.destroy()
        digests = part if digests is None else digests.union(part)
    return docs if digests is None else docs.join(digests.distinct(), own == F.col("__leak"), "left_anti")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
