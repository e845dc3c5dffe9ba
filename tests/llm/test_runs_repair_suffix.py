"""Run detection, conversation repair and suffix-array dedup against brute
force, with nulls, empty and long texts, repeated rows, ties, clashing columns
and empty tables."""

import hashlib
import itertools
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from casework.llm import conversation_repair, run_detection, suffix_dedup
from casework.llm.common import mix
from tests.llm.test_operators_llm import empty, frame, random_texts, split


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


# ------------------------------------------------------------ 11 run detection

def brute_runs(w, least=24, times=3):
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, times * q) and j > i:
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def periodic_words(rnd, most):
    w = []
    while len(w) < most:
        if w and rnd.random() < 0.6:
            p = rnd.randrange(1, min(len(w), 30) + 1)
            w += (w[-p:] * rnd.randrange(1, 6))[:rnd.randrange(1, 100)]
        else:
            w += [rnd.choice("abc") for _ in range(rnd.randrange(1, 12))]
    return w[:most]


@pytest.mark.parametrize("least,times", [(24, 3), (6, 3), (4, 2), (3, 3)])
def test_find_runs(least, times):
    rnd = random.Random(least + times)
    for _ in range(60):
        texts = [periodic_words(rnd, rnd.randrange(0, 160)) for _ in range(rnd.randrange(1, 6))]
        off = np.cumsum([0] + [len(x) for x in texts])
        flat = np.array([ord(c) for t in texts for c in t], np.uint64)
        row, s, e, q = run_detection.find_runs(mix(flat), off, least, times)
        got = [[] for _ in texts]
        for a, b, c, d in zip(row, s, e, q):
            got[a].append((b - off[a], c - b, d))
        assert got == [brute_runs(t, least, times) for t in texts]


def expected_runs(i, text, planted):
    w = split(text)
    n, h = len(w), 1 if i is None else zlib.crc32(str(i).encode())
    if planted and h % 10 == 0 and n:
        a, p = h // 10 % n, 1 + (n - h // 10 % n) // (3 + h // 10 % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    runs = brute_runs(w)
    gone = {k for s, size, q in runs for k in range(s + q, s + size)}
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    return i, n, runs, top, " ".join(x for k, x in enumerate(w) if k not in gone)


def test_collapse_runs(spark):
    rnd = random.Random(5)
    df, rows = frame(spark, [" ".join(periodic_words(rnd, rnd.randrange(0, 300))) for _ in range(40)] + random_texts(3, n=60, letters="abcdefg"))
    rows = [r for r in rows if r[0] != 905]
    df = df.where("doc_id is null or doc_id <> 905")
    for planted in (False, True):
        got = run_detection.collapse_runs(run_detection.plant_runs(df) if planted else df).collect()
        got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.top and tuple(r.top), r.collapsed_text) for r in got]
        assert sorted(got, key=repr) == sorted((expected_runs(i, t, planted) for i, t in rows), key=repr)
    assert any(r[2] for r in got) and any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows)


def test_collapse_runs_long(spark):
    texts = [(1, "a " * 300_000), (2, ("x " * 99 + "y ") * 3000), (3, " ".join(str(k) for k in range(200_000)))]
    got = {r.doc_id: r for r in run_detection.collapse_runs(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert [tuple(r) for r in got[1].runs] == [(0, 300_000, 1)] and got[1].collapsed_text == "a"
    assert tuple(got[2].top) == (0, 300_000, 100) if len(got[2].runs) == 1 else (0, 300_000, 100) in [tuple(r) for r in got[2].runs]
    assert not got[3].runs and got[3].top is None and got[3].n_words == 200_000
    assert run_detection.collapse_runs(run_detection.plant_runs(empty(spark))).count() == 0


# ------------------------------------------------------------ 12 conversation repair

def faults(rows):
    """(code letters, counts) of rows in order."""
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        kind = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(kind)
    return out


def brute_repair(rows):
    """Cheapest edits by search over all states, compared as whole strings."""
    kinds = faults(rows)
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {(len(rows), ""): (0, "", ()), (len(rows), "a"): (0, "", ())}
    for i in range(len(rows), -1, -1):
        for _ in range(4):  # inserts lead to states of the same place
            for state in ("", "s", "u", "a"):
                options = [best[i, state]] if (i, state) in best else []

                def way(cost, letter, to, message=None, at=i):
                    if (at, to) in best:
                        c, a, m = best[at, to]
                        options.append((c + cost, letter + a, ((message,) if message is not None else ()) + m))
                for to, name in (("u", "user"), ("a", "assistant")):
                    if to in follow[state]:
                        way(3, "I", to, f"{name}:")
                if i < len(rows):
                    role, text = rows[i]
                    way(4, "D", state, at=i + 1)
                    if kinds[i] not in ("blank", "duplicate"):
                        extra = 3 if kinds[i] == "truncated" else 0
                        if role[:1] and role[:1] in follow[state]:
                            way(extra, "K", role[:1], f"{role}:{text}", i + 1)
                        for to, name in (("u", "user"), ("a", "assistant")):
                            if to in follow[state]:
                                way(3 + extra, "R", to, f"{name}:{text}", i + 1)
                if options:
                    best[i, state] = min(options, key=lambda o: o[:2])
    return best[0, ""], kinds


def expected_report(conv, rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = [t for t, _, _ in rows if t is not None]
    (cost, audit, messages), kinds = brute_repair([(r, t) for _, r, t in rows])
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    return conv, gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(messages)), list(messages)


def conversation(rnd, n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", ""]
    texts = ["Yes.", "No!", "Cut off", "", " \n", "Ünï?", "Fine. ", "Done.\n"]
    out = [(rnd.choice([None, *range(-2, n)]), rnd.choice(roles), rnd.choice(texts) + (str(k) + "." if rnd.random() < 0.7 else "")) for k in range(n)]
    return out + [rnd.choice(out) for _ in range(n // 6)]


@pytest.mark.parametrize("block_rows", [1024, 3])
def test_conversation_repair(spark, block_rows):
    rnd = random.Random(block_rows)
    convs = {c: conversation(rnd, rnd.randrange(1, 25)) for c in [*range(60), None]}
    convs[100] = conversation(rnd, 400)
    rows = [(c, t, r, x, 1.5) for c, m in convs.items() for t, r, x in m]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, cost double")
    report, messages = conversation_repair.repair(df, block_rows)
    want = {c: expected_report(c, m) for c, m in convs.items()}
    got = {r.conv_id: tuple(r) for r in report.collect()}
    assert got == {c: w[:-1] for c, w in want.items()}
    said = {}
    for m in sorted(messages.collect(), key=lambda m: (m.block, m.place)):
        said.setdefault(m.conv_id, []).append(f"{m.role}:{m.text}")
    assert said == {c: w[-1] for c, w in want.items() if w[-1]}


def test_checkpointed_edits_match_for_every_length():
    rnd = random.Random(2)
    for n in range(0, 40):
        codes = bytes(rnd.choice([0, 1, 2, 3, 4, 5, 9, 10]) for _ in range(n))
        audit, state = conversation_repair.edits(codes, 0, conversation_repair.END, True)
        assert sum(a != "I" for a in audit) == n and state in (0, 3)


def test_damage_and_query(spark, tmp_path):
    rows = [(c, t, r, x) for c in range(300) for t, r, x in [(0, "user", "Hi there. You?"), (1, "assistant", "Well!"), (3, None, None)]] + [(900, None, None, "x")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: tuple(r) for r in conversation_repair.op12_conversation_repair(spark, str(tmp_path)).collect()}
    left = {c: [] for c, *_ in rows}
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        r, x = "user" if kind == 4 else " " if r is None else r, " " if x is None else x
        x = "" if kind == 1 else "".join(k for k in x if k not in ".!?") if kind == 2 else x
        left[c] += [] if kind == 0 else [(t, r, x)] * (2 if kind == 3 else 1)
    assert got == {c: expected_report(c, m)[:-1] for c, m in left.items()}
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    report, messages = conversation_repair.repair(none)
    assert report.count() == 0 and messages.count() == 0


def test_one_row_that_stands_many_times(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hello.")] * 5000 + [(1, 1, "assistant", "Hi.")], "conv_id long, turn long, role string, text string")
    (row,) = conversation_repair.repair(df)[0].collect()
    assert (row.duplicate, row.cost, row.audit) == (4999, 4 * 4999, "K" + "D" * 4999 + "K")


# ------------------------------------------------------------ 13 suffix-array dedup

def brute_bytes(rows, length):
    first = {}
    texts = {i: (t or "").encode() for i, t in rows if i is not None}
    for i in sorted(texts):
        for k in range(len(texts[i]) - length + 1):
            first.setdefault(texts[i][k:k + length], (i, k))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 2, bool)
        for k in range(len(b) - length + 1) if i is not None else ():
            if first[b[k:k + length]] < (i, k):
                gone[1 + k:1 + k + length] = True
        kept = bytes(x for k, x in enumerate(b) if not gone[1 + k])
        out.append((i, len(b), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), sha(kept), kept))
    return sorted(out, key=repr)


@pytest.mark.parametrize("length,seed,bucket,letters", [(100, 24, 20_000, "abcdefgh"), (20, 5, 20_000, "ab"), (20, 5, 2, "abc"), (12, 4, 0, "ab"), (9, 9, 50, "a")])
def test_suffix_dedup(spark, length, seed, bucket, letters):
    df, rows = frame(spark, random_texts(length, n=50, letters=letters))
    cut = [r for r in rows if r[0] not in (904, 905)] + [(904, "é" * 700), (905, "a " * 500)]
    df = spark.createDataFrame([(i, t, "x", 7) for i, t in cut], "doc_id long, text string, seed string, start int").repartition(5)
    got = suffix_dedup.remove_repeats(df, length, seed, bucket).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in got), key=repr)
    assert got == brute_bytes(cut, length)
    assert sum(r[2] for r in got) > 0
    assert suffix_dedup.remove_repeats(empty(spark), length, seed).count() == 0


def test_maximal_repeats_against_all_substrings():
    rnd = random.Random(9)
    for _ in range(200):
        members = [(bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(0, 6))), b"x" + bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(0, 6)))) for _ in range(rnd.randrange(1, 9))]
        groups = {(left, right, tuple(sorted(g))) for left, right, g in suffix_dedup.maximal_repeats(members, 3)}
        want = set()
        for left, right in itertools.product(range(6), range(1, 7)):
            shared = {}
            for k, (a, b) in enumerate(members):
                if len(a) >= left and len(b) >= right and left + right >= 3:
                    shared.setdefault((a[:left], b[:right]), []).append(k)
            for g in shared.values():
                # maximal: one more byte on either side loses a member
                if len(g) > 1 and len({members[k][0][left:left + 1] or k for k in g}) > 1 and len({members[k][1][right:right + 1] or k for k in g}) > 1:
                    want.add((left, right, tuple(g)))
        assert want <= groups
        for left, right, g in groups:
            assert len({members[k][0][:left] for k in g}) == len({members[k][1][:right] for k in g}) == 1


def test_long_text_is_cut_into_parts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_PART", 64)
    rnd = random.Random(4)
    base = "".join(rnd.choice("abcdef") for _ in range(900))
    rows = [(1, base), (2, "zz" + base[100:700] + "q" + base[:50]), (3, base[300:500] * 3)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).repartition(3, "doc_id"), 30, 8).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in got), key=repr) == brute_bytes(rows, 30)
