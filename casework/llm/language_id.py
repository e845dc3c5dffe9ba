"""Language identification by cross-parsing entropy.

A suffix automaton is built of a bounded sample of labelled text per language.
A text is parsed greedily into longest phrases that occur in the language's
sample: walk the automaton and start a new phrase where no transition exists.
The language whose parse needs fewest phrases, each weighted by the bits that
point into its sample (log2 of its size), per byte of text wins.

The automata are laid out as one dense transition table per language (a missing
transition holds the state after the new phrase's first byte and a break flag),
so a whole batch of texts is walked with NumPy, one byte of every lane at a
time. Texts are parsed whole, in blocks of ``BLOCK`` bytes; each block starts
with a new phrase. Every language is learned; the tables of ``SHARD_LANGUAGES``
at a time are broadcast, a text meets all shards and the smallest cost wins.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casework.llm.common import batch_text, record_batch, table, text_slices

SAMPLE_ROWS = 96          # labelled documents per language, on average
SAMPLE_BYTES = 24_576     # training bytes per language
SAMPLE_CHARS = 2_048      # characters taken from one labelled document, at a place chosen by hash
SHARD_LANGUAGES = 16      # languages whose tables are one broadcast: at most 16 * 2 * SAMPLE_BYTES states
BLOCK = 512
FACTOR = 2.5              # a text may cost that much more per byte than the language's own sample ...
SLACK_PHRASES = 12        # ... and so many phrases more, since short texts vary
_BREAK = np.int32(1 << 30)

_OUT = "doc_id long, lang_pred string, score double"
_OUT_PA = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def held_out(doc_id) -> F.Column:
    """crc32 of the id's digits mod 3 is 1; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _fold(raw: np.ndarray) -> np.ndarray:
    """Bytes with A-Z in lower case and every other ASCII byte as a space."""
    return _FOLD[raw]


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def suffix_automaton(data: bytes) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``data``; state 0 is the root."""
    go, link, longest = [{}], [-1], [0]
    last = 0
    for c in data:
        cur = len(go)
        go.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = cur
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if longest[q] == longest[p] + 1:
                link[cur] = q
            else:
                copy = len(go)
                go.append(dict(go[q]))
                longest.append(longest[p] + 1)
                link.append(link[q])
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = copy
                    p = link[p]
                link[q] = link[cur] = copy
        last = cur
    return go


class CrossParser:
    """Dense tables of every language's automaton over one byte alphabet."""

    def __init__(self, samples: dict[str, bytes]):
        self.langs = sorted(samples)
        folded = {k: _fold(np.frombuffer(samples[k], np.uint8)).tobytes() for k in self.langs}
        seen = sorted(set(b"".join(folded.values())))
        # symbol 0 is any byte that no sample has: it is a phrase of its own
        self.symbol = np.zeros(256, np.int32)
        for i, c in enumerate(seen):
            self.symbol[c] = i + 1
        self.width = len(seen) + 1
        self.symbol = self.symbol[_FOLD]
        self.tables, self.bits = [], []
        where = {c: i + 1 for i, c in enumerate(seen)}
        for k in self.langs:
            go = suffix_automaton(folded[k])
            root = np.full(self.width, _BREAK, np.int32)
            for c, q in go[0].items():
                root[where[c]] = (q * self.width) | _BREAK
            # from state 0 every byte starts a phrase
            t = np.tile(root, (len(go), 1))
            rows = np.repeat(np.arange(1, len(go)), [len(g) for g in go[1:]])
            cols = np.array([where[c] for g in go[1:] for c in g], np.int64)
            t[rows, cols] = np.array([q * self.width for g in go[1:] for q in g.values()], np.int64)
            self.tables.append(t.ravel())
            self.bits.append(np.log2(max(2, len(folded[k]))))

    def costs(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """(rows, languages): weighted phrases per byte of each row."""
        n = np.diff(off)
        blocks = -(-n // BLOCK)
        row = np.repeat(np.arange(len(n)), blocks)
        start = off[:-1][row] + (np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * BLOCK
        size = np.minimum(off[1:][row] - start, BLOCK)
        order = np.argsort(-size, kind="stable")
        start, size, row = start[order], size[order], row[order]
        codes = self.symbol[buf]
        out = np.zeros((len(n), len(self.langs)))
        live = np.searchsorted(-size, -np.arange(1, BLOCK + 1), side="right")  # lanes of at least that many bytes
        for j, t in enumerate(self.tables):
            state, phrases = np.zeros(len(start), np.int32), np.zeros(len(start), np.int32)
            for i in range(BLOCK):
                m = live[i]
                if not m:
                    break
                nxt = t[state[:m] + codes[start[:m] + i]]
                phrases[:m] += nxt >> 30
                state[:m] = nxt & (_BREAK - 1)
            out[:, j] = np.bincount(row, phrases, len(n)) * self.bits[j]
        return out / np.maximum(n, 1)[:, None]


def _limit(sample: bytes) -> float:
    """Cost per byte up to which a text is of a language: ``FACTOR`` times what
    the second half of its sample costs when it is parsed by the first half."""
    half = len(sample) // 2
    rest = np.frombuffer(sample[half:], np.uint8)
    return FACTOR * float(CrossParser({"": sample[:half]}).costs(rest, np.array([0, len(rest)]))[0, 0])


def _span() -> F.Column:
    """``SAMPLE_CHARS`` characters of the text, from a place chosen by hash."""
    spare = F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0))
    return F.substring(F.col("text"), (F.pmod(F.xxhash64("text", "doc_id"), spare + 1) + 1).cast("int"), F.lit(SAMPLE_CHARS))


def train(docs: DataFrame, rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES) -> dict[str, bytes]:
    """A bounded sample, per language, of the labelled rows that are not held
    out; no language is left out.

    Every language weighs the same: rows are taken in the order of (hash of
    the row) * (rows of the language), so about ``rows`` of each come first.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id") & F.col("text").rlike(r"\p{L}"))
    counts = [(r["lang"], float(r["count"])) for r in known.groupBy("lang").count().collect()]
    if not counts:
        return {}
    # one row per language, which the driver holds anyway; without the hint all texts would be shuffled
    weight = docs.sparkSession.createDataFrame(counts, "lang string, weight double")
    picked = (known.join(F.broadcast(weight), "lang")
              .select("lang", _span().alias("text"),
                      ((F.xxhash64("doc_id", "text").cast("double") / 2.0**64 + 0.5) * F.col("weight")).alias("at"))
              # that many of a language are expected, and no more than that go to the driver
              .where(F.col("at") < 2.0 * rows).orderBy("at", "text").limit(rows * len(counts)).collect())
    samples = {lang: b"" for lang, _ in counts}
    for r in picked:
        samples[r["lang"]] += r["text"].encode() + b" "
    # a language whose rows are copies of few may have none below the bound
    none = [k for k, v in samples.items() if not v]
    if none:
        for r in known.where(F.col("lang").isin(none)).groupBy("lang").agg(F.min(_span()).alias("text")).collect():
            samples[r["lang"]] = r["text"].encode() + b" "
    return {k: v[:size] for k, v in samples.items()}


def _broadcast(spark: SparkSession, samples: dict[str, bytes], shard: int) -> tuple[list[str], list]:
    """(languages in order, a broadcast parser per ``shard`` of them); the
    driver holds the tables of one shard at a time."""
    langs = sorted(samples)
    return langs, [spark.sparkContext.broadcast(CrossParser({k: samples[k] for k in langs[i:i + shard]})) for i in range(0, len(langs), shard)]


_LETTER = r"\p{L}"


def _labels(batch: pa.RecordBatch, letters: np.ndarray, count: int, shards: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(language numbers, scores, costs per byte) of the batch's rows; the
    number ``count``, after the last language, is ``und``."""
    n = batch.num_rows
    best, low, after = np.full(n, count), np.full(n, np.inf), np.full(n, np.inf)
    first = 0
    for shared in shards:
        m = shared.value
        for lo, hi, buf, off in text_slices(batch, "text", 1 << 22):
            cost = m.costs(buf, off)
            k = np.argmin(cost, axis=1)
            c = cost[np.arange(hi - lo), k]
            cost[np.arange(hi - lo), k] = np.inf
            # equal costs go to the first language in order, which an earlier shard has
            better = c < low[lo:hi]
            after[lo:hi] = np.minimum(np.where(better, low[lo:hi], np.minimum(after[lo:hi], c)), cost.min(axis=1))
            best[lo:hi], low[lo:hi] = np.where(better, first + k, best[lo:hi]), np.minimum(low[lo:hi], c)
        first += len(m.langs)
        if len(shards) > 1 and shared._path is not None:
            # one shard's tables in memory at a time; the next batch reads them again
            del m, shared._value
    score = 1 - low / np.maximum(after, 1e-300) if count > 1 else np.full(n, float(count))
    return np.where(letters, best, count), np.clip(np.where(letters, score, 0), 0, 1), low


def _has_letters(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(_MARK)).to_numpy(zero_copy_only=False).astype(bool)


def _marked(docs: DataFrame) -> DataFrame:
    return docs.withColumn(_MARK, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))


_MARK = "has letters (language_id)"


def predict(docs: DataFrame, model: dict[str, bytes], shard: int = SHARD_LANGUAGES) -> DataFrame:
    """(doc_id, lang_pred, score) of each row.

    ``und`` with score 0 if the text is null or has no letter, or nothing was
    learned. The score compares the best language with the next one
    (1 - best / next); with one language it is 1. Equal costs go to the first
    language in order. Rows with equal or null ids stay rows of their own;
    other columns are ignored. An empty table gives no row.
    """
    langs, shards = _broadcast(docs.sparkSession, model, shard)

    def run(batches):
        names = np.array([*langs, "und"], object)
        for b in batches:
            best, score, _ = _labels(b, _has_letters(b), len(langs), shards)
            yield record_batch(_OUT_PA, b.column(0), names[best].tolist(), score)

    return _marked(docs.select("doc_id", "text")).mapInArrow(run, _OUT)


def keep_languages(docs: DataFrame, model: dict[str, bytes], wanted: list[str] | None = None, shard: int = SHARD_LANGUAGES) -> DataFrame:
    """The rows of ``docs`` in one of the ``wanted`` languages (None: all that
    the model has); all columns stay, and every decision is made where the row is.

    A row goes if its text is null or has no letter, if its language is not
    wanted, or if it is none of the model's languages: its parse costs more
    than ``FACTOR`` times what the language's own sample costs per byte, and
    ``SLACK_PHRASES`` phrases more. Nothing stays of an empty model.
    """
    langs, shards = _broadcast(docs.sparkSession, model, shard)
    limit = np.array([*(_limit(model[k]) for k in langs), 0.0])
    slack = np.array([*(np.log2(max(2, len(model[k]))) for k in langs), 0.0]) * SLACK_PHRASES
    take = np.array([*(wanted is None or k in wanted for k in langs), False])

    def run(batches):
        for b in batches:
            best, _, cost = _labels(b, _has_letters(b), len(langs), shards)
            _, off = batch_text(b, "text")
            size = np.diff(off)
            keep = take[best] & (np.where(np.isfinite(cost), cost, 0) * size <= limit[best] * size + slack[best])
            yield b.filter(pa.array(keep)).drop_columns([_MARK])

    return _marked(docs).mapInArrow(run, docs.schema)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    return predict(docs, train(docs)).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")

