"""PII spans against a brute-force version with Python's own expressions."""

import hashlib
import re

from hypothesis import given, settings, strategies as st

from casework.llm import pii


def luhn_ok(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d)
        total += d if i % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn_ok(d)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15),
]


def brute(text):
    spans = sorted((m.start(), k, m.end()) for k, (_, p, ok) in enumerate(BASE) for m in re.finditer(p, text or "") if ok(m.group()))
    counts = [sum(s[1] == k for s in spans) for k in range(4)]
    listed = ",".join(f"{BASE[k][0]}:{a}:{b}" for a, k, b in spans)
    return (*counts, hashlib.sha256(listed.encode()).hexdigest()), listed


def check(spark, texts):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = {r["doc_id"]: r for r in pii.digest(df).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want, listed = brute(t)
        r = got[i]
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) == want, (t, listed, r["spans"])
        own = [s for s in r["spans"].split(",") if s.split(":")[0] in pii.BASE]
        assert ",".join(own) == listed


EDGE = [
    None, "", " ", "a@b", "a@b.c", "a@b.c+d@e.f", "a@b.c.d@e.f", "x@@y.z", ".@-.-", "é a@b.c ü 1.2.3.4", "1.2.3.4.5.6.7.8", "01.002.255.256",
    "256.1.1.1", "1.1.1.1", "0000000255.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111112", "4111  1111", "+1 (887) 555-2355",
    "+1 (887) 555-2355.", "+1234567890123456", "++1234567890", "+1-", "+12+1234567890", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5", "𝟏 𐍈 a@b.co 𐍈 +4912345678901",
    "7.7.7.7\n8.8.8.8", "a" * 20000, "a." * 20000, "1" * 20000, "1.1" * 9000, "1 " * 20000, "a@" + "b." * 20000, "a@b.c" * 3000, "+" + "1-" * 20000,
]


def test_edge_texts(spark):
    check(spark, EDGE)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab.@+-%_ 0123459()é𐍈\n", max_size=60), min_size=1, max_size=40))
def test_random_texts(spark, texts):
    check(spark, texts)


def test_method_spans_need_checksum_and_context(spark):
    texts = ["my iban DE89 3704 0044 0532 0130 00 ok", "my iban DE89 3704 0044 0532 0130 01 ok", "ssn 078-05-1120", "part 078-05-1120", "GB82WEST12345698765432"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.digest(df).collect()}
    assert got[0] == "iban:8:35" and got[1] == "" and got[2] == "id:4:15" and got[3] == "" and got[4] == "iban:0:22"


def test_scores_and_redaction(spark):
    df = spark.createDataFrame([(1, "card 4111 1111 1111 1111, mail a@b.c!"), (2, None), (3, "none"), (4, "+371449635398431.")], "doc_id long, text string")
    found = pii.detect(df)
    rows = {r["doc_id"]: r for r in pii.redact(found).collect()}
    assert rows[1]["text"] == "card [card], mail [email]!" and rows[2]["text"] is None and rows[3]["text"] == "none"
    assert rows[1]["spans"][0]["score"] == 1.0
    assert rows[4]["text"] == "[phone]."  # the card number within goes with it


def test_empty_table(spark):
    assert pii.digest(spark.createDataFrame([], "doc_id long, text string")).count() == 0
