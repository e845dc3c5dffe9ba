"""Packing of tokenised documents into fixed-length sequences.

A document's ids are cut every ``length`` ids; the pieces go to randomised
groups (a hash of document and start), and each group is packed by first-fit
decreasing: a tournament tree over the bins' free capacity finds the first bin
that takes a piece in O(log bins). Groups have a bounded expected number of
pieces whatever the size of the corpus, so any number of them runs side by
side. Ids themselves never leave the task that made them: a piece carries
their number and checksum, and ``sequences`` rebuilds them from the text.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casework.llm.common import lower_ascii, record_batch, split_words, stage, table, text_slices, word_hashes

LENGTH = 2048
END_ID = 1
GROUP_PIECES = 2000
CACHE_WORDS = 1_000_000   # about 70 bytes each

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_PIECES_PA = pa.schema([(c.split()[0], pa.int64()) for c in _PIECES.split(", ")])


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


_BREAKS = np.zeros(256, bool)
_BREAKS[list(b".,;:!?")] = True
_LETTER = np.zeros(256, bool)
_LETTER[ord("a"):ord("z") + 1] = True


class WordTokenizer:
    """Ids of many texts at once.

    The vocabulary's pre-tokenizer drops white space and never joins across
    it, so the ids of a text are those of its chunks between ASCII white space
    (one mark after an ASCII letter at a chunk's end is a chunk of its own
    too). A distinct chunk is encoded once and found again by its 64-bit hash
    while at most ``CACHE_WORDS`` chunks are kept. Chunks of letters that the
    normalizer leaves as they are go straight to the vocabulary's merges, all
    others through the whole tokenizer.
    """

    # a-z and the lower-case Latin-1 letters in UTF-8 without the division sign
    plain = re.compile(rb"(?:[a-z]|\xc3[\xa0-\xb6\xb8-\xbf])+\Z")

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.whole = Tokenizer.from_file(path)
        self.merges = Tokenizer(self.whole.model)
        self.merges.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        size = self.whole.get_vocab_size()
        self.ends = np.array([(self.whole.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.forget()

    def forget(self):
        self.keys, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _letters(self, words: list[bytes]) -> list[np.ndarray]:
        out = []
        for lo in range(0, len(words), 10_000):
            part = words[lo:lo + 10_000]
            lines = [b" ".join(part[i:i + 500]).decode() for i in range(0, len(part), 500)]
            ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.merges.encode_batch_fast(lines, add_special_tokens=False)])
            out += np.split(ids, np.flatnonzero(self.ends[ids])[:-1] + 1)
        return out

    def _learn(self, keys: np.ndarray, words: list[bytes]):
        ids: list = [None] * len(words)
        plain = [i for i, w in enumerate(words) if self.plain.match(w)]
        for i, a in zip(plain, self._letters([words[i] for i in plain])):
            ids[i] = a
        rest = [i for i, a in enumerate(ids) if a is None]
        for lo in range(0, len(rest), 10_000):
            part = rest[lo:lo + 10_000]
            for i, e in zip(part, self.whole.encode_batch_fast([words[i].decode() for i in part], add_special_tokens=False)):
                ids[i] = np.array(e.ids, np.uint32)
        size = np.array([len(a) for a in ids], np.int64)
        at = len(self.pool) + np.cumsum(size) - size
        keys, self.pool = np.concatenate([self.keys, keys]), np.concatenate([self.pool, *ids])
        order = np.argsort(keys, kind="stable")
        self.keys, self.at, self.size = keys[order], np.concatenate([self.at, at])[order], np.concatenate([self.size, size])[order]

    def encode(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, id offset of each row)."""
        buf = lower_ascii(buf)
        start, end, rows = split_words(buf, off)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        mark = (end - start > 1) & _BREAKS[buf[end - 1]] & _LETTER[buf[np.maximum(end - 2, 0)]]
        # a marked chunk becomes two: the letters, and the mark
        place = np.arange(len(start)) + np.cumsum(mark) - mark
        s, e = np.empty(len(start) + mark.sum(), np.int64), np.empty(len(start) + mark.sum(), np.int64)
        s[place], e[place] = start, end - mark
        s[place[mark] + 1], e[place[mark] + 1] = end[mark] - 1, end[mark]
        rows = rows + np.append(0, np.cumsum(mark))[rows]
        keys, first, each = np.unique(word_hashes(buf, s, e), return_index=True, return_inverse=True)
        new = self._missing(keys)
        if new.any():
            if len(self.keys) + new.sum() > CACHE_WORDS:
                self.forget()
                new = np.ones(len(keys), bool)
            data = buf.tobytes()
            self._learn(keys[new], [data[a:b] for a, b in zip(s[first[new]].tolist(), e[first[new]].tolist())])
        k = np.searchsorted(self.keys, keys)
        size = self.size[k][each]
        until = np.append(0, np.cumsum(size))
        ids = self.pool[np.repeat(self.at[k][each] - until[:-1], size) + np.arange(until[-1])]
        return ids, until[rows]

    def _missing(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.ones(len(keys), bool)
        k = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[k] != keys


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer_of(path: str) -> WordTokenizer:
    """One per Python worker: its chunks serve the worker's later tasks too."""
    if path not in _TOKENIZERS:
        # Spark runs one worker per core; threads of the library would only add memory
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def _rows_of_ids(batch: pa.RecordBatch, tokenizer: WordTokenizer, end_id: int) -> Iterator[np.ndarray]:
    """The ids of each row of the batch, with ``end_id`` at the end."""
    for lo, hi, buf, off in text_slices(batch, "text", 1 << 21):
        ids, rows = tokenizer.encode(buf, off)
        for i in range(hi - lo):
            yield np.append(ids[rows[i]:rows[i + 1]], np.uint32(end_id)).astype("<u4")


def pieces(docs: DataFrame, path: str | None = None, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Every document's ids, with ``end_id`` at the end, cut into pieces."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]):
        tokenizer = tokenizer_of(path)
        for b in batches:
            out = []
            for doc, ids in zip(b.column(0).to_pylist(), _rows_of_ids(b, tokenizer, end_id)):
                for s in range(0, len(ids), length):
                    part = ids[s:s + length]
                    out.append((doc, s, len(part), zlib.crc32(part.tobytes()), len(ids)))
            if out:
                yield record_batch(_PIECES_PA, *map(list, zip(*out)))

    return docs.select("doc_id", "text").mapInArrow(run, _PIECES)


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """Bin of each item; ``sizes`` must be in descending order."""
    leaves = 1 << max(0, len(sizes) - 1).bit_length()
    free = [capacity] * (2 * leaves)  # free[i]: largest free capacity below node i
    out = []
    for size in sizes:
        i = 1
        while i < leaves:
            i = 2 * i if free[2 * i] >= size else 2 * i + 1
        out.append(i - leaves)
        free[i] -= size
        while i > 1:
            i //= 2
            free[i] = max(free[2 * i], free[2 * i + 1])
    return out


_PACKED = _PIECES + ", sequence_id long, offset long"


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, end_id: int = END_ID,
         group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Pieces with their sequence and offset.

    One row per piece: doc_id, start, length, ids_crc32 (of the unsigned
    little-endian 32-bit ids), doc_tokens, sequence_id, offset. A null or
    empty text is the single id ``end_id``. Rows with equal or null ids stay
    rows of their own; other columns are ignored. An empty table gives no row.
    """
    cut = stage(pieces(docs, path, length, end_id), "pack-pieces")
    groups = max(1, -(-cut.count() // group_pieces))
    # the row's place in the written stage takes part, so that equal rows spread too
    place = F.struct("_metadata.file_name", "_metadata.row_index")
    cut = cut.withColumn("grp", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", place), F.lit(groups)))

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        sizes = t.column("length").to_pylist()
        bins = first_fit_decreasing(sizes, length)
        used: dict[int, int] = {}
        offsets = []
        for i, n in zip(bins, sizes):
            offsets.append(used.get(i, 0))
            used[i] = offsets[-1] + n
        base = t.column("grp")[0].as_py() << 32
        return (t.drop_columns(["grp"]).append_column("sequence_id", pa.array([base + i for i in bins], pa.int64()))
                .append_column("offset", pa.array(offsets, pa.int64())))

    return cut.groupBy("grp").applyInArrow(run, _PACKED)


def sequences(docs: DataFrame, packed: DataFrame, path: str | None = None, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """(sequence_id, offset, ids array) of the packed pieces, read back from
    the texts; a sequence is its rows in the order of ``offset``. doc_id must
    be unique and not null here."""
    path = path or tokenizer_path()
    def run(batches: Iterator[pa.RecordBatch]):
        tokenizer = tokenizer_of(path)
        for b in batches:
            out = []
            for ids, places in zip(_rows_of_ids(b, tokenizer, end_id), b.column(b.schema.get_field_index("places")).to_pylist()):
                for p in places:
                    out.append((p["sequence_id"], p["offset"], ids[p["start"]:p["start"] + p["length"]].astype(np.int32)))
            if out:
                s, o, ids = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(s, pa.int64()), pa.array(o, pa.int64()), pa.array(ids, pa.list_(pa.int32()))],
                                                 names=["sequence_id", "offset", "ids"])

    places = packed.groupBy("doc_id").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("places"))
    return docs.select("doc_id", "text").join(places, "doc_id").mapInArrow(run, "sequence_id long, offset long, ids array<int>")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 ids."""
    return pack(table(spark, sf_dir, "documents"))
