"""The pipeline against a brute-force version, stage by stage."""

import os
import re
import zlib

import pytest

import corpus_pipeline
from casework.llm.packing import tokenizer_path

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15),
]


def luhn(digits):
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def smallest_ids(sets):
    ids, parent = sorted(sets), {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i for i in ids if find(i) == i}


def holds_item(text, item):
    w, v = re.findall(r"[^\W_]+", text.lower()), re.findall(r"[^\W_]+", item.lower())
    grams = {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    for part in (v[:max(1, len(v) // 2)], v[max(1, len(v) // 2):]):
        own = {tuple(part[i:i + 5]) for i in range(len(part) - 4)}
        if len(own & grams) < 0.8 * len(own):
            return False
    return True


def without_pii(text):
    spans = sorted((m.start(), k, m.end()) for k, (_, p, ok) in enumerate(PII) for m in re.finditer(p, text) if ok(m.group()))
    out, until = [], 0
    for a, k, b in spans:
        if a >= until:
            out += [text[until:a], f"[{PII[k][0]}]"]
        until = max(until, b)
    return "".join(out) + text[until:]


def test_stages(spark):
    from tokenizers import Tokenizer
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.union(spark.createDataFrame([(10_001, None, "en", "x", 0), (10_002, "12 34", None, "x", 5), (10_003, "", None, None, None)], docs.schema))
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    columns = docs.columns

    want = {i: t for i, t in rows.items() if t and re.search(r"[^\W\d_]", t)}
    docs = corpus_pipeline.language(spark, docs, SF)
    assert docs.columns == columns and {r["doc_id"]: r["text"] for r in docs.collect()} == want

    kept = smallest_ids({i: shingle_set(t) for i, t in want.items()})
    want = {i: t for i, t in want.items() if i in kept}
    docs = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert docs.columns == columns and {r["doc_id"]: r["text"] for r in docs.collect()} == want

    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {i: t for i, t in want.items() if not any(holds_item(t, x) for x in items)}
    docs = corpus_pipeline.decontamination(spark, docs, SF)
    assert docs.columns == columns and {r["doc_id"]: r["text"] for r in docs.collect()} == want

    want = {i: without_pii(t) for i, t in want.items()}
    docs = corpus_pipeline.personal_data(spark, docs, SF)
    assert docs.columns == columns
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in docs.collect()}
    assert {i: t for i, (t, _) in got.items()} == want and all(len(t) == n for t, n in got.values())

    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids = {i: tokenizer.encode(t, add_special_tokens=False).ids + [1] for i, t in want.items()}
    pieces = corpus_pipeline.sequences(spark, docs, SF).collect()
    check_pieces(pieces, ids)


def check_pieces(pieces, ids, length=2048):
    """Every id in exactly one piece, and every sequence without gaps."""
    per, bins = {}, {}
    for p in pieces:
        per.setdefault(p["doc_id"], []).append(p)
        bins.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert set(per) == set(ids)
    for i, own in per.items():
        at = 0
        for p in sorted(own, key=lambda p: p["start"]):
            part = ids[i][at:at + p["length"]]
            assert p["start"] == at and p["doc_tokens"] == len(ids[i])
            assert p["ids_crc32"] == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))
            at += p["length"]
        assert at == len(ids[i])
    for places in bins.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= length


def test_run_is_the_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "personal_data", "packing"]
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and got.count() > 0
