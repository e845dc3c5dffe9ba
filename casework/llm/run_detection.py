"""Periodic run detection on a Re-Pair grammar of the word ids.

A run is a stretch of consecutive words of one text with smallest period q,
at least ``times`` periods and ``least`` words long, that no neighbouring word
extends. Spark deals the texts; inside a task a slice of texts is one grammar:

1. Re-Pair in rounds: every adjacent pair of symbols that occurs twice is
   counted, and each round replaces the pairs that are more frequent than the
   pairs they overlap. A pair seen once can never be repeated later, so it
   leaves the count for good. What is left of each text is paired to a
   balanced tree, so every word border of a text is the inner border of just
   one kind of node;
2. the runs of a nonterminal that cross its inner border are computed once, at
   its first occurrence. A crossing run holds half its length on one side, so
   the words at the border recur one period on; such periods are found by
   four-word hashes, confirmed by the hash of half a period and extended to
   both sides by hashes of growing lengths;
3. they are translated to all places where the nonterminal was derived, and
   only the maximal intervals are kept: a run of a text lies whole in the lowest
   node that holds it and crosses the border there, so none is lost. Of the
   periods found for one interval the smallest counts.

Words are compared by 64-bit hashes. Work grows with n log n for a text of n
words, memory with the longest text of a task.
"""

from __future__ import annotations

import zlib
from fractions import Fraction
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casework.llm.common import U64, WORD_BASE, mix, prefix_sums, range_hash, record_batch, row_of, split_words, table, text_slices, word_hashes

LEAST = 24
TIMES = 3
_GRAM = 4
_CHUNK = 1 << 21


class _Words:
    """The word hashes of a slice, with hashes of any range."""

    def __init__(self, w: np.ndarray):
        self.w, self.sums = w, prefix_sums(w, WORD_BASE)
        n = len(w)
        at = np.arange(max(n - _GRAM + 1, 0))
        self.gram = np.zeros(n + 1, U64)
        self.gram[at] = range_hash(self.sums, at, at + _GRAM, WORD_BASE)

    def same(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        return range_hash(self.sums, a, a + length, WORD_BASE) == range_hash(self.sums, b, b + length, WORD_BASE)

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """Length, at most ``most``, of what is equal from a and b on (or before a and b)."""
        got = np.zeros(len(a), np.int64)
        step = 1 << int(most.max(initial=0)).bit_length()
        while step:
            t = np.flatnonzero(got + step <= most)
            if len(t):
                size = got[t] + step
                shift = size if back else 0
                ok = self.same(a[t] - shift, b[t] - shift, size)
                got[t[ok]] += step
            step >>= 1
        return got


def _crossing(words: _Words, s, b, e, least: int, times: int):
    """(node, start, end, period) of the repetitions in [s, e) across b."""
    out = []
    half = -(-least // 2)
    for right in (True, False):
        side = (e - b) if right else (b - s)
        # the longer side of a run holds half of it
        count = np.where(side >= half, side * 2 // times, 0)
        ends = np.cumsum(count)
        for lo in range(0, int(ends[-1]) if len(ends) else 0, _CHUNK):
            flat = np.arange(lo, min(lo + _CHUNK, int(ends[-1])))
            node = np.searchsorted(ends, flat, side="right")
            q = flat - (ends[node] - count[node]) + 1
            # so many words at the border are the same one period on
            m = np.maximum(-(-times * q // 2) - q, half - q)
            room = q + m <= side[node]
            node, q, m = node[room], q[room], m[room]
            short = np.minimum(m, _GRAM)
            x = b[node] if right else b[node] - short
            y = x + q if right else x - q
            ok = words.gram[x] == words.gram[y]
            # fewer words than a gram: left to the next test
            ok |= short < _GRAM
            node, q, m = node[ok], q[ok], m[ok]
            x = b[node] if right else b[node] - m
            y = x + q if right else x - q
            ok = words.same(x, y, m)
            node, q = node[ok], q[ok]
            x = b[node] if right else b[node] - q
            ahead = words.common(x, x + q, e[node] - x - q, False)
            behind = words.common(x, x + q, x - s[node], True)
            size = behind + q + ahead
            ok = size >= np.maximum(least, times * q)
            out.append((node[ok], (x - behind)[ok], (x + q + ahead)[ok], q[ok]))
    return [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 4


def find_runs(w: np.ndarray, offsets: np.ndarray, least: int = LEAST, times: int = TIMES):
    """(row, start, end, period) of all runs of the texts whose word hashes are
    ``w[offsets[r]:offsets[r + 1]]``, by row, start, period. ``times`` >= 2."""
    n = len(w)
    row = row_of(offsets)
    words = _Words(w)
    starts, stops, periods = [], [], []

    def collect(s, b, e, symbol):
        long = e - s >= least
        s, b, e, symbol = s[long], b[long], e[long], symbol[long]
        if not len(s):
            return
        _, first, kind = np.unique(symbol, return_index=True, return_inverse=True)
        node, lo, hi, q = _crossing(words, s[first], b[first], e[first], least, times)
        if not len(node):
            return
        # every derivation of a nonterminal has the runs of its first one
        order = np.argsort(kind, kind="stable")
        size = np.bincount(kind, minlength=len(first))
        begin = np.cumsum(size) - size
        each = np.repeat(np.arange(len(node)), size[node])
        place = np.arange(len(each)) - np.repeat(np.cumsum(size[node]) - size[node], size[node])
        shift = s[order[begin[node[each]] + place]] - s[first][node[each]]
        lo, hi, q = lo[each] + shift, hi[each] + shift, q[each]
        text = row[lo]
        head, tail = offsets[text], offsets[text + 1]
        grows = ((lo > head) & (w[np.maximum(lo - 1, 0)] == w[np.maximum(lo - 1, 0) + q])) | ((hi < tail) & (w[np.minimum(hi, n - 1)] == w[np.minimum(hi, n - 1) - q]))
        starts.append(lo[~grows]), stops.append(hi[~grows]), periods.append(q[~grows])

    def joined(at):
        return mix(symbol[at] * U64(0x9E3779B97F4A7C15) + mix(symbol[at + 1] + U64(0x632BE59BD9B4E019)))

    def merge(pick):
        """Replace the symbols at ``pick`` and after them by one."""
        nonlocal pos, symbol, alive
        both = joined(pick)
        stop = np.append(pos, n)
        collect(pos[pick], pos[pick + 1], stop[pick + 2], both)
        symbol[pick], alive[pick] = both, alive[pick + 1]
        keep = np.ones(len(pos), bool)
        keep[pick + 1] = False
        pos, symbol, alive = pos[keep], symbol[keep], alive[keep]

    pos, symbol = np.arange(n), mix(w)
    alive = np.zeros(n, bool)
    alive[:-1] = row[1:] == row[:-1]
    while True:
        at = np.flatnonzero(alive)
        if not len(at):
            break
        kinds, kind, count = np.unique(joined(at), return_inverse=True, return_counts=True)
        again = count[kind] > 1
        alive[at[~again]] = False
        at, kind = at[again], kind[again]
        if not len(at):
            break
        # the pairs' order: by count, then by their own (random) ids
        rank = np.zeros(len(pos) + 2, np.int64)
        rank[at + 1] = count[kind] * len(kinds) + kind
        top = at[(rank[at + 1] >= rank[at]) & (rank[at + 1] >= rank[at + 2])]
        # neighbours of the same rank overlap (a a a): every second one
        fresh = np.ones(len(top), bool)
        fresh[1:] = top[1:] != top[:-1] + 1
        since = np.arange(len(top)) - np.maximum.accumulate(np.where(fresh, np.arange(len(top)), 0))
        merge(top[since % 2 == 0])
    while True:
        text = row[pos] if n else row
        first = np.searchsorted(text, text)
        place = np.arange(len(pos)) - first
        pick = np.flatnonzero((place[:-1] % 2 == 0) & (text[1:] == text[:-1])) if len(pos) else np.zeros(0, np.int64)
        if not len(pick):
            break
        # symbols that never recur: a node of its own each
        symbol = mix(np.arange(len(pos), dtype=U64) + U64(int(pos[-1]) << 20))
        merge(pick)
    if not starts:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    s, e, q = (np.concatenate(c) for c in (starts, stops, periods))
    order = np.lexsort((q, e, s))
    s, e, q = s[order], e[order], q[order]
    least_period = np.ones(len(s), bool)
    least_period[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    s, e, q = s[least_period], e[least_period], q[least_period]
    order = np.lexsort((q, s))
    s, e, q = s[order], e[order], q[order]
    return row[s], s, e, q


_RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_OUT = f"doc_id long, n_words long, runs {_RUNS}, top struct<start: bigint, length: bigint, period: bigint>, collapsed_text string"
_RUN_PA = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_OUT_PA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN_PA)), ("top", _RUN_PA), ("collapsed_text", pa.string())])


def _struct(start, length, period, mask=None) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (start, length, period)], fields=list(_RUN_PA), mask=mask)


def collapse_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """The runs of every text, and the text with one period of each run.

    Returns one row per input row: doc_id, n_words, runs (start and length in
    words, numbered from 0, and period; by start, then period), top (the run
    of the greatest length / period; of equals the smallest start, then the
    smallest period; null without a run) and collapsed_text: the words joined
    by one space, without those that a run holds after its first period. Words
    are separated by ASCII white space. A null or empty text has no words and
    an empty collapsed_text. Rows that repeat, or have no id, are texts like
    any other; further columns are ignored.
    """
    def run(batches):
        for batch in batches:
            for lo, hi, buf, off in text_slices(batch, "text"):
                start, end, words = split_words(buf, off)
                row, s, e, q = find_runs(word_hashes(buf, start, end), words, least, times)
                s, e = s - words[row], e - words[row]
                begin = np.searchsorted(row, np.arange(hi - lo + 1))
                tops, texts, data = [], [], buf.tobytes()
                for i in range(hi - lo):
                    kept, mine = data[off[i]:off[i + 1]].split(), slice(begin[i], begin[i + 1])
                    top = None
                    if begin[i] < begin[i + 1]:
                        edge = np.zeros(len(kept) + 1, np.int64)
                        np.add.at(edge, s[mine] + q[mine], 1)
                        np.add.at(edge, e[mine], -1)
                        kept = compress(kept, np.cumsum(edge[:-1]) == 0)
                        runs = zip(s[mine].tolist(), (e - s)[mine].tolist(), q[mine].tolist())
                        top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
                    tops.append(top)
                    texts.append(b" ".join(kept).decode())
                none = pa.array([t is None for t in tops], pa.bool_())
                yield record_batch(_OUT_PA, batch.column(0).slice(lo, hi - lo), np.diff(words),
                                   pa.ListArray.from_arrays(pa.array(begin, pa.int32()), _struct(s, e - s, q)),
                                   _struct(*zip(*[t or (0, 0, 0) for t in tops]), mask=none), texts)

    return docs.select("doc_id", "text").mapInArrow(run, _OUT)


def plant_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): with h = crc32 of the decimal id and g = h // 10, a text
    of n > 0 words with h % 10 = 0 repeats from word a = g % n on the next
    p = 1 + (n - a) // (3 + g % 8) words; others stay as they are. Rows
    without an id stay as they are."""
    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            changed = {}
            for i, d in enumerate(ids):
                h = 1 if d is None else zlib.crc32(str(d).encode())
                if h % 10 == 0 and texts[i].is_valid:
                    w, g = texts[i].as_py().encode().split(), h // 10
                    if w:
                        a = g % len(w)
                        p = 1 + (len(w) - a) // (3 + g % 8)
                        changed[i] = b" ".join(w[a + (k - a) % p] if k > a else w[k] for k in range(len(w))).decode()
            if changed:
                mask = np.zeros(len(ids), bool)
                mask[list(changed)] = True
                texts = pa.compute.replace_with_mask(texts, pa.array(mask), pa.array(list(changed.values()), texts.type))
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], names=["doc_id", "text"])

    import pyarrow.compute  # noqa: F401
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, text string")


def op11_run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every document after planting, and digests of the runs and
    of the collapsed text."""
    found = collapse_runs(plant_runs(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"), F.col("top.length").alias("length"),
        F.col("top.period").alias("period"), F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed_text").cast("binary"), 256).alias("collapsed_sha256"))


#: DuckDB: crc32 of an ASCII string ``{}``, bit by bit
CRC32 = ("xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split({}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))), "
         "lambda c, x: list_reduce(list_concat([xor(c, x)], [CAST(0 AS BIGINT) FOR z IN range(8)]), lambda r, z: xor(r >> 1, 3988292384 * (r & 1)))))")

# equal 16-word grams of a text stand in islands of one distance q; an island
# with 15 + q more words is a stretch of period q
ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, w, len(w) AS n, CASE WHEN doc_id IS NULL THEN 1 ELSE %s END AS h
           FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)),
p AS (SELECT *, (h // 10) %% greatest(n, 1) AS a, 1 + (n - (h // 10) %% greatest(n, 1)) // (3 + (h // 10) %% 8) AS p FROM t),
d AS (SELECT doc_id, n, CASE WHEN h %% 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) %% p END]) ELSE w END AS w FROM p),
g AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i + 1, i + 16), ' ')) AS g FROM (SELECT doc_id, w, unnest(range(n - 15)) AS i FROM d WHERE n >= 24)),
e AS (SELECT x.doc_id, y.i - x.i AS q, x.i AS i FROM g x JOIN g y ON x.doc_id = y.doc_id AND x.g = y.g AND x.i < y.i),
s AS (SELECT doc_id, q, min(i) AS start, count(*) + 15 + q AS length
      FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e) GROUP BY doc_id, q, island),
r AS (SELECT doc_id, start, length, min(q) AS period FROM s WHERE length >= greatest(24, 3 * q) GROUP BY doc_id, start, length),
o AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs,
             first(start ORDER BY length / period DESC, start, period) AS start, first(length ORDER BY length / period DESC, start, period) AS length,
             first(period ORDER BY length / period DESC, start, period) AS period
      FROM r GROUP BY doc_id),
c AS (SELECT doc_id, list(DISTINCT i) AS gone FROM (SELECT doc_id, unnest(range(start + period, start + length)) AS i FROM r) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length, CAST(period AS BIGINT) AS period,
       CAST(1000 * length // period AS BIGINT) AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256,
       sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(range(n), lambda i: NOT list_contains(gone, i)), lambda i: w[i + 1]) END, ' '), '')) AS collapsed_sha256
FROM d LEFT JOIN o USING (doc_id) LEFT JOIN c USING (doc_id)
""" % CRC32.format("CAST(doc_id AS VARCHAR)")
