"""Conversation structure repair by a square-root checkpointed DP.

A conversation's rows become one whose role initials read ``(s?(ua)+)?`` by the
cheapest edits: Keep (0), Rerole to user or assistant (3), Delete (4, required
for blank and duplicate rows), Insert an empty user or assistant row (3); a
truncated row that isn't deleted adds 3. Of the cheapest edits those whose
initials are the ASCII-least are taken.

1. rows that are equal meet in an aggregate that counts them; the earliest turn
   of every (conversation, role, text) tells the duplicates;
2. the rows are sorted by range of (conversation, turn, role, text), so a long
   conversation spans several tasks, and cut into blocks of bounded size with
   one code byte per row;
3. a conversation of several blocks: each block's state-cost matrix; a backward
   pass over the matrices gives the cost vector at the end of each block (the
   outer checkpoints). With it, a block maps each state it may start in to the
   state it ends in, and a forward pass over these maps gives its start;
4. in a block, the backward pass stores its vectors every sqrt(n) rows only;
   the walk forward recomputes the vectors of one stretch after the other
   and takes, at each step, the ASCII-least edit that keeps the cost tight. An
   edit's initial tells the state it leads to, so this is the least sequence;
5. the blocks of a conversation are joined in order, a block at a time: its
   digest is that of a sequence and is updated by one task, which holds a block
   and the audit (one byte per row) at most.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from math import isqrt

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casework.llm.common import record_batch, stage, table
from casework.llm.run_detection import CRC32

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLOCK_ROWS = 1024
BLOCK_BYTES = 1 << 17
_FAR = 1 << 50
# states: nothing yet, after s, after u, after a
_NEXT = (2, 2, 3, 2)
_ROLE = (None, None, "user", "assistant")
#: edits at the end of a conversation: none, insert user and assistant, insert assistant, none
END = (0, 2 * INSERT, INSERT, 0)
_INITIAL = {"s": 0, "u": 1, "a": 2}
_MUST_DELETE, _IS_TRUNCATED = 4, 8
_BATCH = 200


def _kept_state(code: int, state: int) -> int | None:
    """State after keeping a row, if its initial may follow."""
    initial = code & 3
    if initial == 0:
        return 1 if state == 0 else None
    if initial == 1:
        return 2 if state != 2 else None
    return 3 if initial == 2 and state == 2 else None


def _back(code: int, after: tuple) -> tuple:
    """Costs from before a row by state, from those after it."""
    cost = [DELETE + after[s] for s in range(4)]
    if not code & _MUST_DELETE:
        extra = TRUNCATED if code & _IS_TRUNCATED else 0
        for s in range(4):
            cost[s] = min(cost[s], REROLE + extra + after[_NEXT[s]])
            kept = _kept_state(code, s)
            if kept is not None:
                cost[s] = min(cost[s], KEEP + extra + after[kept])
    user = min(cost[2], INSERT + cost[3])
    return min(cost[0], INSERT + user), min(cost[1], INSERT + user), user, min(cost[3], INSERT + user)


@lru_cache(maxsize=1 << 14)
def _step(code: int, after: tuple) -> tuple[tuple, tuple]:
    """(costs before a row, moves): costs are taken less their least, of which
    few differ, so a row is a lookup. A state's move is the ASCII-least tight
    edits up to and with the row, and the state they lead to."""
    here = _back(code, after)
    extra = TRUNCATED if code & _IS_TRUNCATED else 0
    moves = []
    for state in range(4):
        initials = ""
        while DELETE + after[state] != here[state] and INSERT + here[_NEXT[state]] == here[state]:
            initials += "I"
            state = _NEXT[state]
        kept = None if code & _MUST_DELETE else _kept_state(code, state)
        if DELETE + after[state] == here[state]:
            initials += "D"
        elif kept is not None and KEEP + extra + after[kept] == here[state]:
            initials, state = initials + "K", kept
        else:
            initials, state = initials + "R", _NEXT[state]
        moves.append((initials, state))
    return _less_least(here), tuple(moves)


def _less_least(costs) -> tuple:
    least = min(costs)
    return tuple(c - least for c in costs)


def edits(codes: bytes, start: int, end: tuple, last: bool):
    """(edits, state after them) of a block that starts in ``start`` and ends
    with the costs ``end``."""
    n = len(codes)
    step = max(isqrt(n), 1)
    v = _less_least(end)
    marks = {n: v}
    for i in range(n - 1, -1, -1):
        v = _step(codes[i], v)[0]
        if i % step == 0:
            marks[i] = v
    out, state = [], start
    for lo in range(0, n, step):
        hi = min(lo + step, n)
        v, rows = marks[hi], []
        for i in range(hi - 1, lo - 1, -1):
            v, moves = _step(codes[i], v)
            rows.append(moves)
        for moves in reversed(rows):
            initials, state = moves[state]
            out.append(initials)
    while last and state in (1, 2):
        out.append("I")
        state = _NEXT[state]
    return "".join(out), state


_BLOCK = ("conv_id long, block long, codes binary, roles array<string>, texts array<string>, blank long, duplicate long, truncated long, illegal long, "
          "first_initial string, last_initial string, first_turn long, last_turn long, turns long")
_L, _S = pa.int64(), pa.string()
_BLOCK_PA = pa.schema([("conv_id", _L), ("block", _L), ("codes", pa.binary()), ("roles", pa.list_(_S)), ("texts", pa.list_(_S)), ("blank", _L), ("duplicate", _L),
                       ("truncated", _L), ("illegal", _L), ("first_initial", _S), ("last_initial", _S), ("first_turn", _L), ("last_turn", _L), ("turns", _L)])
_LEGAL = {"su", "ua", "au"}
_SPACE = " \t\n\x0b\x0c\r"


class _Block:
    """Rows of one conversation in order, until they are written as a block."""

    def __init__(self, conv_id):
        self.conv_id, self.codes, self.roles, self.texts, self.size = conv_id, bytearray(), [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.first_turn = self.last_turn = None

    def add(self, turn, role, text, copy):
        initial, body = role[:1], text.strip(_SPACE)
        code = _INITIAL.get(initial, 3)
        if not body:
            self.blank += 1
            code |= _MUST_DELETE
        elif copy:
            self.duplicate += 1
            code |= _MUST_DELETE
        else:
            if body[-1] not in ".!?":
                self.truncated += 1
                code |= _IS_TRUNCATED
            self.roles.append(role)
            self.texts.append(text)
            self.size += len(text) + len(role)
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in _LEGAL
        self.last = initial
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.last_turn = turn
            if self.first_turn is None:
                self.first_turn = turn
        self.codes.append(code)

    def full(self, rows):
        return len(self.codes) >= rows or self.size >= BLOCK_BYTES

    def row(self, number):
        return (self.conv_id, number, bytes(self.codes), self.roles, self.texts, self.blank, self.duplicate, self.truncated, self.illegal, self.first, self.last,
                self.first_turn, self.last_turn, self.turns)


def blocks(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Step 1 and 2: blocks of the rows (conv_id, turn, role, text[, copies])."""
    if "copies" not in rows.columns:
        rows = rows.withColumn("copies", F.lit(1))
    rows = (rows.select("conv_id", F.col("turn").cast("long"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), "copies")
            .groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")))
    # the id is a number or null, so the parts can't run into each other
    message = F.sha2(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.lit(":"), F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
    rows = stage(rows.withColumn("message", message), "repair-rows")
    first = stage(rows.groupBy("message").agg(F.min("turn").alias("first_turn"), F.max(F.col("turn").isNull()).alias("no_turn"), F.count("*").alias("n"))
                  .where("n > 1").drop("n"), "repair-first")
    later = F.coalesce(F.col("turn").isNotNull() & (F.col("no_turn") | (F.col("turn") > F.col("first_turn"))), F.lit(False))
    rows = stage(rows.join(first, "message", "left").select("conv_id", "turn", "role", "text", "copies", later.alias("later")), "repair-flagged")

    def run(batches):
        number, block, done = TaskContext.get().partitionId() << 32, None, []

        def flush():
            nonlocal done
            out, done = done, []
            return record_batch(_BLOCK_PA, *zip(*out))

        for b in batches:
            for conv_id, turn, role, text, copies, is_later in zip(*(c.to_pylist() for c in b.columns)):
                for k in range(copies):
                    if block is None or block.conv_id != conv_id or block.full(block_rows):
                        if block is not None:
                            done.append(block.row(number))
                            number += 1
                        block = _Block(conv_id)
                    block.add(turn, role, text, is_later or k > 0)
                    if len(done) >= _BATCH:
                        yield flush()
        if block is not None:
            done.append(block.row(number))
        if done:
            yield flush()

    keys = ["conv_id", "turn", "role", "text"]
    return stage(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(run, _BLOCK), "repair-blocks")


def _borders(cut: DataFrame) -> DataFrame:
    """Step 3: (block, start, end, last) of the blocks of the conversations
    that have several; few numbers per block of up to ``BLOCK_ROWS`` rows."""
    several = cut.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("conv_id").alias("id"))
    inner = stage(cut.select("conv_id", "block", "codes").join(several, F.col("conv_id").eqNullSafe(F.col("id"))).drop("id"), "repair-long")

    def matrices(batches):
        for b in batches:
            out = []
            for codes in b.column(2).to_pylist():
                columns = []
                for t in range(4):
                    v = tuple(0 if s == t else _FAR for s in range(4))
                    for code in reversed(codes):
                        v = _back(code, v)
                    columns.append(v)
                out.append([columns[t][s] for s in range(4) for t in range(4)])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.list_(_L))], names=["conv_id", "block", "matrix"])

    def ends(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block", ignore_index=True)
        v, out = END, []
        for m in reversed(pdf["matrix"].tolist()):
            out.append(list(v))
            v = tuple(min(int(m[4 * s + t]) + v[t] for t in range(4)) for s in range(4))
        return pd.DataFrame({"conv_id": pdf["conv_id"], "block": pdf["block"], "end": out[::-1], "last": [i == len(out) - 1 for i in range(len(out))]})

    def leads(batches):
        for b in batches:
            out = [[edits(codes, s, end, last)[1] for s in range(4)] for codes, end, last in zip(*(b.column(k).to_pylist() for k in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in (0, 1, 3, 4)), pa.array(out, pa.list_(_L))], names=["conv_id", "block", "end", "last", "leads"])

    def starts(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block", ignore_index=True)
        state, out = 0, []
        for to in pdf["leads"].tolist():
            out.append(state)
            state = int(to[state])
        return pd.DataFrame({"block": pdf["block"], "start": out, "end": pdf["end"], "last": pdf["last"]})

    costs = inner.mapInArrow(matrices, "conv_id long, block long, matrix array<long>").groupBy("conv_id").applyInPandas(ends, "conv_id long, block long, end array<long>, last boolean")
    led = inner.join(stage(costs, "repair-ends").drop("conv_id"), "block").select("conv_id", "block", "codes", "end", "last")
    led = led.mapInArrow(leads, "conv_id long, block long, end array<long>, last boolean, leads array<long>")
    return stage(led.groupBy("conv_id").applyInPandas(starts, "block long, start long, end array<long>, last boolean"), "repair-starts")


_STATS = ["blank", "duplicate", "truncated", "illegal", "first_initial", "last_initial", "first_turn", "last_turn", "turns"]
_WALKED_PA = pa.schema([("conv_id", _L), ("block", _L), ("audit", _S), ("cost", _L), ("roles", pa.list_(_S)), ("texts", pa.list_(_S)),
                        *(_BLOCK_PA.field(c) for c in _STATS)])
_WALKED = "conv_id long, block long, audit string, cost long, roles array<string>, texts array<string>, " + ", ".join(
    f"{c} {'string' if c.endswith('initial') else 'long'}" for c in _STATS)


def _walk(cut: DataFrame) -> DataFrame:
    """Step 4: the edits and the repaired rows of every block, with its counts."""
    def run(batches):
        for b in batches:
            out = []
            for codes, roles, texts, start, end, last in zip(*(c.to_pylist() for c in b.columns[2:8])):
                state, alone = start or 0, end is None
                audit, _ = edits(codes, state, END if alone else end, alone or last)
                i = j = cost = 0
                new_roles, new_texts = [], []
                for edit in audit:
                    if edit == "I":
                        state = _NEXT[state]
                        new_roles.append(_ROLE[state])
                        new_texts.append("")
                        cost += INSERT
                        continue
                    code = codes[i]
                    i += 1
                    if edit == "D":
                        cost += DELETE
                    else:
                        state = _kept_state(code, state) if edit == "K" else _NEXT[state]
                        cost += (KEEP if edit == "K" else REROLE) + (TRUNCATED if code & _IS_TRUNCATED else 0)
                        new_roles.append(roles[j] if edit == "K" else _ROLE[state])
                        new_texts.append(texts[j])
                    j += not code & _MUST_DELETE
                out.append((audit, cost, new_roles, new_texts))
            if out:
                yield record_batch(_WALKED_PA, b.column(0), b.column(1), *zip(*out), *b.columns[8:])

    given = cut.join(_borders(cut), "block", "left")
    return stage(given.select("conv_id", "block", "codes", "roles", "texts", "start", "end", "last", *_STATS).mapInArrow(run, _WALKED), "repair-walked")


_REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_REPORT_PA = pa.schema([("conv_id", _L), *((c, _L) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", _S), ("repaired_sha256", _S)])


class _Report:
    def __init__(self, conv_id):
        self.conv_id, self.sha, self.audit, self.sums = conv_id, hashlib.sha256(), [], [0] * 5
        self.first_turn = self.last_turn = self.last = None
        self.turns, self.empty = 0, True

    def add(self, audit, cost, roles, texts, blank, duplicate, truncated, illegal, first_initial, last_initial, first_turn, last_turn, turns):
        self.audit.append(audit)
        illegal += self.last is not None and self.last + first_initial not in _LEGAL
        self.last = last_initial
        self.sums = [x + y for x, y in zip(self.sums, (blank, duplicate, truncated, illegal, cost))]
        self.turns += turns - (first_turn is not None and first_turn == self.last_turn)
        self.first_turn = first_turn if self.first_turn is None else self.first_turn
        self.last_turn = self.last_turn if last_turn is None else last_turn
        for role, text in zip(roles, texts):
            self.sha.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
            self.empty = False

    def row(self):
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        return self.conv_id, gaps, *self.sums, "".join(self.audit), self.sha.hexdigest()


def _reports(blocks_: DataFrame) -> DataFrame:
    """Step 5."""
    def run(batches):
        now, done = None, []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if now is None or now.conv_id != row[0]:
                    if now is not None:
                        done.append(now.row())
                    now = _Report(row[0])
                now.add(*row[2:])
            if done:
                yield record_batch(_REPORT_PA, *zip(*done))
                done = []
        if now is not None:
            yield record_batch(_REPORT_PA, *zip(*[now.row()]))

    return blocks_.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(run, _REPORT)


def repair(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Repair conversations of rows (conv_id, turn, role, text).

    Rows are taken by turn (nulls first), ties by role, then text. A null role
    or text is one space. A column ``copies`` tells how often a row stands
    there (else once); further columns are ignored. Rows without a conv_id
    are one conversation.

    Returns two tables. Report, one row per conversation: conv_id, gaps (turns
    missing between the smallest and the largest), blank, duplicate,
    truncated (rows by their first fault), illegal (adjacent role initials that
    aren't su, ua or au), cost, audit (the edits' initials in order),
    repaired_sha256 (of the repaired ``role:text``, joined by newlines). Messages,
    one row per repaired one: conv_id, place (from 0 in its block), block,
    role, text. An empty table gives empty tables.
    """
    cut = blocks(rows, block_rows)
    walked = _walk(cut)
    report = stage(_reports(walked), "repair-report", rows_per_batch=_BATCH)
    messages = (walked.select("conv_id", "block", F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "message"))
                .select("conv_id", "block", "place", F.col("message.roles").alias("role"), F.col("message.texts").alias("text")))
    return report, messages


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by crc32(conv_id:turn) % 20 (a null is one space): 0 is
    dropped, 1 loses its text, 2 its ``.!?``, 3 stands twice, 4 is of role user."""
    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    return (conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind")).where("kind <> 0")
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                    F.when(F.col("kind") == 3, 2).otherwise(1).alias("copies")))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations and the cheapest edits that repair them."""
    rows = table(spark, sf_dir, "conversations")
    report, _ = repair(damaged(rows))
    report = report.withColumnRenamed("conv_id", "id")
    all_ids = rows.select("conv_id").distinct()
    out = all_ids.join(report, F.col("conv_id").eqNullSafe(F.col("id")), "left").drop("id")
    return out.select("conv_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


# backward over the rows with (cost, audit, messages) for each state
ORACLE_SQL = r"""
WITH RECURSIVE d AS (SELECT *, %s %% 20 AS kind FROM (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
     coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations)),
x AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
             CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM d WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
             regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body FROM x),
f AS (SELECT *, body = '' AS blank, body <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS dup,
             lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair FROM o),
r AS (SELECT *, blank OR dup AS gone, NOT blank AND NOT dup AND right(body, 1) NOT IN ('.', '!', '?') AS cut FROM f),
n AS (SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
             count(*) FILTER (dup) AS duplicate, count(*) FILTER (cut) AS truncated,
             count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
dp AS (
  SELECT conv_id, n + 1 AS i, {'c': 0, 'a': '', 'm': CAST([] AS VARCHAR[])} AS v0, {'c': 6, 'a': 'II', 'm': ['user:', 'assistant:']} AS v1,
         {'c': 3, 'a': 'I', 'm': ['assistant:']} AS v2, {'c': 0, 'a': '', 'm': CAST([] AS VARCHAR[])} AS v3 FROM n
  UNION ALL
  SELECT conv_id, i, list_min([c0, {'c': 3 + u.c, 'a': 'I' || u.a, 'm': list_prepend('user:', u.m)}]),
         list_min([c1, {'c': 3 + u.c, 'a': 'I' || u.a, 'm': list_prepend('user:', u.m)}]), u,
         list_min([c3, {'c': 3 + u.c, 'a': 'I' || u.a, 'm': list_prepend('user:', u.m)}])
  FROM (SELECT *, list_min([c2, {'c': 3 + c3.c, 'a': 'I' || c3.a, 'm': list_prepend('assistant:', c3.m)}]) AS u FROM (
    SELECT dp.conv_id, r.i,
      list_min(list_filter([{'c': 4 + v0.c, 'a': 'D' || v0.a, 'm': v0.m},
        CASE WHEN NOT gone THEN {'c': 3 + t + v2.c, 'a': 'R' || v2.a, 'm': list_prepend('user:' || text, v2.m)} END,
        CASE WHEN NOT gone AND role[1] = 's' THEN {'c': t + v1.c, 'a': 'K' || v1.a, 'm': list_prepend(role || ':' || text, v1.m)} END,
        CASE WHEN NOT gone AND role[1] = 'u' THEN {'c': t + v2.c, 'a': 'K' || v2.a, 'm': list_prepend(role || ':' || text, v2.m)} END], lambda z: z IS NOT NULL)) AS c0,
      list_min(list_filter([{'c': 4 + v1.c, 'a': 'D' || v1.a, 'm': v1.m},
        CASE WHEN NOT gone THEN {'c': 3 + t + v2.c, 'a': 'R' || v2.a, 'm': list_prepend('user:' || text, v2.m)} END,
        CASE WHEN NOT gone AND role[1] = 'u' THEN {'c': t + v2.c, 'a': 'K' || v2.a, 'm': list_prepend(role || ':' || text, v2.m)} END], lambda z: z IS NOT NULL)) AS c1,
      list_min(list_filter([{'c': 4 + v2.c, 'a': 'D' || v2.a, 'm': v2.m},
        CASE WHEN NOT gone THEN {'c': 3 + t + v3.c, 'a': 'R' || v3.a, 'm': list_prepend('assistant:' || text, v3.m)} END,
        CASE WHEN NOT gone AND role[1] = 'a' THEN {'c': t + v3.c, 'a': 'K' || v3.a, 'm': list_prepend(role || ':' || text, v3.m)} END], lambda z: z IS NOT NULL)) AS c2,
      list_min(list_filter([{'c': 4 + v3.c, 'a': 'D' || v3.a, 'm': v3.m},
        CASE WHEN NOT gone THEN {'c': 3 + t + v2.c, 'a': 'R' || v2.a, 'm': list_prepend('user:' || text, v2.m)} END,
        CASE WHEN NOT gone AND role[1] = 'u' THEN {'c': t + v2.c, 'a': 'K' || v2.a, 'm': list_prepend(role || ':' || text, v2.m)} END], lambda z: z IS NOT NULL)) AS c3
    FROM dp JOIN (SELECT *, CASE WHEN cut THEN 3 ELSE 0 END AS t FROM r) r ON dp.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = dp.i - 1)))
SELECT ids.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(v0.c, 0) AS BIGINT) AS cost,
       coalesce(v0.a, '') AS audit, sha256(coalesce(array_to_string(v0.m, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM ids.conv_id
     LEFT JOIN (SELECT * FROM dp WHERE i = 1) dp ON dp.conv_id IS NOT DISTINCT FROM ids.conv_id
""" % CRC32.format("k")
