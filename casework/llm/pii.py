"""Personal data: expressions propose spans, checksums confirm them, context
words adjust their score.

Everything is DataFrame expressions. A kind's matches are what
``regexp_extract_all`` finds from left to right; their places follow from the
lengths of the texts between them (``split`` by the same expression), so no
marker is written into a text. Expressions use possessive repeats and start
only where a run of their characters starts (or where the last match ended),
which finds the same matches in linear time on texts of any length.

Kinds ``email``, ``ip``, ``card`` and ``phone`` are always kept once
confirmed. ``iban`` (mod-97) and ``id`` (a 3-2-4 digit group) are kept when
their score reaches ``KEEP``: a confirmed checksum gives 0.6, a bare shape
0.2, and a context word within ``NEAR`` characters before or after adds 0.4.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casework.llm.common import table

PIECE = 256
NEAR = 40
KEEP = 0.5

# a part of at most 255, with any leading zeros
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str          # for java.util.regex
    hint: str             # a cheap test that every text with a match passes
    confirm: str          # none, ip, luhn, digits or mod97
    shape: float          # score of a confirmed match
    context: str          # words that add to the score
    always: bool          # kept whatever the score


KINDS = [
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@",
         "none", 0.8, r"mail|e-mail|email|contact|write", True),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", "ip", 0.6, r"ip|address|host|server", True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9][\x20-]?[0-9]", "luhn", 0.8, r"card|visa|credit|debit|pay", True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", "digits", 0.6, r"phone|tel|call|mobile|fax", True),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         "[A-Z]{2}[0-9]{2}", "mod97", 0.6, r"iban|account|bank|konto|cuenta|compte", False),
    Kind("id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "none", 0.2,
         r"ssn|social security|passport|identity", False),
]
BASE = [k.name for k in KINDS if k.always]
_SPANS = "array<struct<start:bigint,kind:int,end:bigint,score:double>>"


def luhn(digits: Column) -> Column:
    """Luhn's checksum of a string of digits."""
    values = F.transform(F.reverse(F.split(digits, "")), lambda d: d.cast("int"))
    doubled = F.transform(values, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(iban: Column) -> Column:
    """ISO 13616: the first four characters go to the end, letters count from
    10, and the number leaves 1 when divided by 97."""
    s = F.regexp_replace(iban, " ", "")
    moved = F.concat(F.substr(s, F.lit(5)), F.substring(s, 1, 4))
    values = F.transform(F.split(moved, ""), lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55))
    rest = F.aggregate(values, F.lit(0), lambda a, v: F.when(v > 9, a * 100 + v).otherwise(a * 10 + v) % 97)
    return rest == 1


def confirmed(check: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if check == "ip":
        return match.rlike(rf"\A{_PART}(?:\.{_PART}){{3}}\z")
    if check == "luhn":
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(F.lit(False))
    if check == "digits":
        return F.length(digits).between(10, 15)
    if check == "mod97":
        return mod97(match)
    return F.lit(True)


def spans_of(text: Column, kind: Kind, number: int) -> Column:
    """Array of (start, kind number, end, score) of the confirmed matches, in
    code points with the end exclusive."""
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    parts = F.split(text, kind.pattern, -1)
    n = F.greatest(F.size(found), F.lit(0))
    pair = F.arrays_zip(F.slice(parts, F.lit(1), n).alias("gap"), found.alias("match"), F.slice(parts, F.lit(2), n).alias("after"))

    def judged(x: Column) -> Column:
        near = F.concat_ws(" ", F.substr(x["gap"], F.greatest(F.length(x["gap"]) - NEAR + 1, F.lit(1))), F.substring(x["after"], 1, NEAR))
        score = F.lit(kind.shape) + F.when(near.rlike(rf"(?i)(?<![a-z])(?:{kind.context})(?![a-z])"), F.lit(0.4)).otherwise(F.lit(0.0))
        score = F.least(F.round(score, 1), F.lit(1.0))
        keep = confirmed(kind.confirm, x["match"])
        return F.struct(F.length(x["gap"]).alias("gap"), F.length(x["match"]).alias("match"), score.alias("score"),
                        (keep if kind.always else keep & (score >= KEEP)).alias("keep"))

    # places are a running sum; spans are gathered in pieces, so that a text
    # with many of them isn't copied once for each
    def step(acc: Column, x: Column) -> Column:
        start = acc["until"] + x["gap"]
        end = start + x["match"]
        one = F.array(F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end"), x["score"].alias("score")))
        piece = F.when(x["keep"], F.concat(acc["piece"], one)).otherwise(acc["piece"])
        full = F.size(acc["piece"]) >= PIECE
        return F.struct(end.alias("until"), F.when(full, F.when(x["keep"], one).otherwise(none)).otherwise(piece).alias("piece"),
                        F.when(full, F.concat(acc["pieces"], F.array(acc["piece"]))).otherwise(acc["pieces"]).alias("pieces"))

    none = F.array().cast(_SPANS)
    start = F.struct(F.lit(0).cast("bigint").alias("until"), none.alias("piece"), F.array().cast(f"array<{_SPANS}>").alias("pieces"))
    all_ = F.aggregate(F.transform(pair, judged), start, step, lambda acc: F.flatten(F.concat(acc["pieces"], F.array(acc["piece"]))))
    return F.when(text.rlike(kind.hint), all_).otherwise(none)


def detect(docs: DataFrame, text_col: str = "text", out: str = "spans") -> DataFrame:
    """Adds ``out``: the spans of all kinds by start and kind, an array of
    (start, kind number, end, score); no spans for a null text. The column
    replaces one of that name; other columns stay."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    per = [spans_of(text, k, i) for i, k in enumerate(KINDS)]
    return docs.withColumn(out, F.array_sort(F.concat(*per)))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k.name) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """``text_col`` with every span replaced by its kind in brackets; spans
    that overlap are replaced as one, under the kind of the first."""
    names = F.array(*[F.lit(f"[{k.name}]") for k in KINDS])
    text = F.col(text_col)

    def step(acc: Column, s: Column) -> Column:
        apart = s["start"] >= acc["until"]
        cut = F.concat(acc["out"], F.substr(text, (acc["until"] + 1).cast("int"), F.greatest(s["start"] - acc["until"], F.lit(0)).cast("int")), F.get(names, s["kind"]))
        return F.struct(F.when(apart, cut).otherwise(acc["out"]).alias("out"), F.greatest(acc["until"], s["end"]).alias("until"))

    done = F.aggregate(F.col(f"`{spans_col}`"), F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("until")), step,
                       lambda acc: F.concat(acc["out"], F.substr(text, (acc["until"] + 1).cast("int"))))
    return docs.withColumn(text_col, F.when(F.size(F.col(f"`{spans_col}`")) > 0, done).otherwise(text))


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with the spans of ``text`` replaced and ``n_chars`` counted
    anew where a text changed; all columns stay."""
    name = "spans (pii)"
    done = redact(detect(docs, "text", name), "text", name)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(F.size(F.col(f"`{name}`")) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return done.select(*docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256 (of the
    base spans), spans (all). A null text is empty; rows with equal or null
    ids keep a row each; other columns are ignored."""
    found = detect(docs.select("doc_id", F.col("text").alias("text")), out="found")
    base = F.filter("found", lambda s: s["kind"] < len(BASE))
    count = lambda i: F.size(F.filter("found", lambda s: s["kind"] == i)).cast("long")
    return found.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(BASE)],
                        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"), _listed(F.col("found")).alias("spans"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all documents."""
    return digest(table(spark, sf_dir, "documents"))
