"""Repair of conversations: the cheapest edits that give the role order `(s?(ua)+)?`, by iterative-deepening A*.

A conversation is its rows by turn (nulls first; rows of one turn by role, then text). Edits, in ASCII order of
their initials: Delete a row (3), Insert an empty user or assistant row (2), Keep a row (0), Rerole a row to user or
assistant (2). Blank and repeated rows must go; a truncated row that stays costs 1 more. What an insertion or a new role
must be follows from the roles before it, so a string of initials says everything.

The search runs depth first in that order under a bound on the total cost, and raises the bound to the least cost that the
failed round left open. A transposition table holds for each (row, role state) the cost that failed visits have shown to be
needed from there. The first accepting path is the least string among the cheapest.

Conversations of at most CHUNK_ROWS rows and CHUNK_CHARS characters are searched whole. Longer ones are cut into chunks
of CHUNK_ROWS rows; each chunk is searched by itself between every two role states, and a pass over the chunks' few costs
picks the states. Strings of one chunk end with a row's edit, so none begins another, and chunkwise least strings make the
least string. Only the hash of a long conversation is one sequential stream, in constant memory, as SHA-256 needs.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, Window as W
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from ..functions.order_stats import ranked
from .common import durable

CHUNK_ROWS = 512
CHUNK_CHARS = 8 << 20
SPACE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
START, SYSTEM, USER, ASSISTANT, END = range(5)
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 3, 2, 2, 1
_KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})  # role state, initial -> state after a kept row
_MADE = (USER, USER, ASSISTANT, USER)  # the state that an inserted or reroled row leads to
_NAME = {USER: "user", ASSISTANT: "assistant"}
_LEGAL = ("su", "ua", "au")


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): rows damaged by crc32 of `conv_id:turn` modulo 20; a null value is one space.

    0 drops a row (`gone`; it stays as a row so that its conversation is known), 1 empties its text, 2 takes `.!?` out of it,
    3 repeats it, 4 makes it a user row; other values leave it.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text, role = part("text"), part("role")
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.when(hit == 4, "user").otherwise(role).alias("role"),
                       F.when(hit <= 1, "").when(hit == 2, F.translate(text, "".join(ENDS), "")).otherwise(text).alias("text"), (hit == 0).alias("gone"),
                       F.explode(F.when(hit == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"))
    return rows.drop("_copy")


class Search:
    """Cheapest edits of one run of rows from a role state to a goal: another state, or END (accepting; rows may be added last)."""

    def __init__(self, initials, faults):
        """`initials` holds each row's role initial, `faults` a `d` where it must go, a `t` where truncated, else another letter."""
        self.initials, self.faults, self.n = initials, faults, len(initials)
        low = np.fromiter((DELETE_COST if f == "d" else (0 if r in ("s", "u", "a") else REROLE_COST) + (TRUNCATED_COST if f == "t" else 0) for r, f in zip(initials, faults)), np.int64, self.n)
        self.least = np.minimum(low, DELETE_COST)[::-1].cumsum()[::-1].tolist() + [0]

    def reachable(self, start: int, goal: int) -> bool:
        if goal == END or start == goal:
            return True
        if goal == SYSTEM:
            return start == START and any(r == "s" and f != "d" for r, f in zip(self.initials, self.faults))
        return goal != START and self.n > 0

    def edits(self, i: int, state: int, goal: int) -> list[tuple[int, str, int, int]]:
        """(cost, initial, next row, next state) in ASCII order."""
        out, row = [], i < self.n
        if row:
            out.append((DELETE_COST, "D", i + 1, state))
        if row or goal == END:
            out.append((INSERT_COST, "I", i, _MADE[state]))
        if row and self.faults[i] != "d":
            extra = TRUNCATED_COST if self.faults[i] == "t" else 0
            kept = _KEPT[state].get(self.initials[i])
            if kept is not None:
                out.append((extra, "K", i + 1, kept))
            if kept != _MADE[state]:  # a new role equal to the old one never pays
                out.append((REROLE_COST + extra, "R", i + 1, _MADE[state]))
        return out

    def run(self, start: int = START, goal: int = END) -> tuple[int, str]:
        """(cost, least string of initials); the goal must be reachable."""
        needed: dict = {}  # transposition table: (row, state) -> cost that failed visits have shown to be needed from there
        least, n = self.least, self.n
        bound = least[0]
        while True:
            path = []
            stack = [[0, start, 0, None, 0, 1 << 60]]  # row, state, cost so far, edits, next edit, least cost seen from here
            while stack:
                top = stack[-1]
                i, state, spent, edits, at, low = top
                if edits is None:
                    if i == n and (state == goal or goal == END and state in (START, ASSISTANT)):
                        return spent, "".join(path)
                    edits = top[3] = self.edits(i, state, goal)
                if at < len(edits):
                    cost, initial, j, after = edits[at]
                    top[4] += 1
                    rest = cost + needed.get((j, after), least[j])
                    if spent + rest > bound:
                        top[5] = min(low, rest)
                    else:
                        path.append(initial)
                        stack.append([j, after, spent + cost, None, 0, 1 << 60])
                    continue
                stack.pop()
                needed[i, state] = max(low, needed.get((i, state), 0))
                if stack:
                    path.pop()
                    over = stack[-1]
                    over[5] = min(over[5], over[3][over[4] - 1][0] + needed[i, state])
            bound = max(bound + 1, needed[0, start])


def _faults(roles, texts, seen: set) -> list[str]:
    """Each row's first fault: b(lank), r(epeated), t(runcated), else k."""
    out = []
    for role, text in zip(roles, texts):
        bare = text.rstrip(SPACE)
        key = (role, text)
        out.append("b" if not bare else "r" if key in seen else "k" if bare.endswith(ENDS) else "t")
        seen.add(key)
    return out


def _illegal(initials) -> int:
    return sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))


def _must(faults) -> list[str]:
    return ["d" if f in "br" else f for f in faults]


class Repaired:
    """SHA-256 of `role:text` of the repaired rows, newline-joined, fed row by row."""

    def __init__(self):
        self.state, self.hash, self.first = START, hashlib.sha256(), True

    def _add(self, role: str, text: str) -> None:
        self.hash.update((f"{role}:{text}" if self.first else f"\n{role}:{text}").encode("utf-8", "surrogatepass"))
        self.first = False

    def feed(self, edits: str, role: str = "", text: str = "") -> None:
        """Apply the edits of one row: insertions before it, then its own, or insertions alone."""
        for e in edits:
            if e == "K":
                self.state = _KEPT[self.state][role[:1]]
                self._add(role, text)
            elif e in "IR":
                self.state = _MADE[self.state]
                self._add(_NAME[self.state], text if e == "R" else "")


def _split(audit: str) -> tuple[list[str], str]:
    """The edits of each row (with insertions before it), and those after the last row."""
    out, start = [], 0
    for at, e in enumerate(audit):
        if e != "I":
            out.append(audit[start : at + 1])
            start = at + 1
    return out, audit[start:]


def _clip(x: int) -> int:
    return min(x, (1 << 63) - 1)


def _whole(turns, roles, texts) -> tuple:
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of one conversation's rows."""
    faults = _faults(roles, texts, set())
    initials = [r[:1] for r in roles]
    cost, audit = Search(initials, _must(faults)).run()
    out = Repaired()
    edits, tail = _split(audit)
    for e, role, text in zip(edits, roles, texts):
        out.feed(e, role, text)
    out.feed(tail)
    known = set(turns) - {None}
    gaps = _clip(max(known) - min(known) + 1 - len(known)) if known else 0
    return gaps, faults.count("b"), faults.count("r"), faults.count("t"), _illegal(initials), cost, audit, out.hash.hexdigest()


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _result_schema(conv) -> StructType:
    schema = StructType().add("conv_id", conv)
    for name in COUNTS:
        schema = schema.add(name, LongType())
    return schema.add("audit", StringType()).add("repaired_sha256", StringType())


def _groups(batches, keys: int):
    """(key, rows) of consecutive rows with equal first `keys` columns; rows as lists of the other columns."""
    last, held = None, None
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        heads = list(zip(*columns[:keys]))
        for at, head in enumerate(heads):
            if held is None or head != last:
                if held is not None:
                    yield last, held
                last, held = head, [[] for _ in columns[keys:]]
            for store, c in zip(held, columns[keys:]):
                store.append(c[at])
    if held is not None:
        yield last, held


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


def _repair_short(rows: DataFrame) -> DataFrame:
    schema = _result_schema(rows.schema["conv_id"].dataType)
    fields = [(f.name, t) for f, t in zip(schema.fields, [None] + [pa.int64()] * 6 + [pa.string()] * 2)]

    def run(batches):
        keys, found, kind = [], [], None

        def batch():
            arrays = [pa.array(keys, kind)] + [pa.array([f[k] for f in found], t) for k, (_, t) in enumerate(fields[1:])]
            return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])

        def typed():
            nonlocal kind
            for b in batches:
                kind = b.schema.field(0).type
                yield b

        for (key,), (turns, roles, texts, gone) in _groups(typed(), 1):
            at = [i for i, g in enumerate(gone) if not g]
            keys.append(key)
            found.append(_whole([turns[i] for i in at], [roles[i] for i in at], [texts[i] for i in at]))
            if len(keys) == 1000:
                yield batch()
                keys, found = [], []
        if keys:
            yield batch()

    # each conversation lies in one partition, its rows one after the other
    together = rows.repartition("conv_id").sortWithinPartitions(F.col("conv_id"), *_order())
    return together.select("conv_id", "turn", "role", "text", "gone").mapInArrow(run, schema)


# ---- long conversations, chunk by chunk ------------------------------------

_CHUNK = StructType().add("illegal", LongType()).add("first", StringType()).add("last", StringType()).add(
    "ways", ArrayType(StructType().add("start", IntegerType()).add("goal", IntegerType()).add("cost", LongType()).add("order", IntegerType()).add("audit", StringType())))


def _ways(initials, faults, first: bool) -> list[dict]:
    """The cheapest edits of a chunk between every two role states; `order` ranks the strings of one starting state."""
    search, out = Search(initials, _must(faults)), []
    for start in (START,) if first else (START, SYSTEM, USER, ASSISTANT):
        own = [(goal, *search.run(start, goal)) for goal in range(5) if search.reachable(start, goal)]
        ranks = {audit: k for k, audit in enumerate(sorted(a for _, _, a in own))}
        out += [dict(start=start, goal=goal, cost=cost, order=ranks[audit], audit=audit) for goal, cost, audit in own]
    return out


def _chain(ways: list) -> tuple[int, list[tuple[int, int]]]:
    """Total cost and each chunk's (start, goal): the cheapest chain from START to END, ties to the least strings."""
    best, picks = None, []
    for own in reversed(ways):
        now = {}
        for start, goal, cost, order in own:
            if best is None and goal != END or best is not None and (goal == END or goal not in best):
                continue
            offer = (cost + (best[goal][0] if best is not None else 0), order, goal)
            if start not in now or offer < now[start]:
                now[start] = offer
        picks.append({s: g for s, (_, _, g) in now.items()})
        best = now
    chosen, state = [], START
    for step in reversed(picks):
        chosen.append((state, step[state]))
        state = step[state]
    return best[START][0], chosen


def _repair_long(rows: DataFrame, chunk_rows: int) -> DataFrame:
    conv = rows.schema["conv_id"].dataType
    again = F.row_number().over(W.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first())) > 1
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = F.when(bare == "", "b").when(F.col("again"), "r").when(F.substring(bare, -1, 1).isin(*ENDS), "k").otherwise("t")
    rows = rows.filter("NOT gone").withColumn("again", again)
    # of equal rows the one that counts as first comes first
    rows = ranked(rows.select("conv_id", "turn", "role", "text", "again", fault.alias("fault")), ["conv_id"], [*_order(), F.col("again")]).drop("again")
    at = F.col("ordinal") - 1
    rows = durable(rows.withColumn("chunk", F.floor(at / chunk_rows).cast("long")).withColumn("slot", (at % chunk_rows).cast("int")).drop("ordinal"))

    def search(batches):
        for (key, chunk), (_, initials, faults) in _groups(batches, 2):
            yield pa.RecordBatch.from_pylist([dict(conv_id=key, chunk=chunk, illegal=_illegal(initials), first=initials[0], last=initials[-1], ways=_ways(initials, faults, chunk == 0))], kinds)

    shape = StructType().add("conv_id", conv).add("chunk", LongType())
    for f in _CHUNK.fields:
        shape = shape.add(f)
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(shape)
    parts = rows.select("conv_id", "chunk", "slot", F.substring("role", 1, 1).alias("initial"), "fault")
    parts = durable(parts.repartition("conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", "slot").mapInArrow(search, shape))

    def chain(frame: pd.DataFrame) -> pd.DataFrame:
        """The chunks' costs of one conversation: numbers only, a few per chunk."""
        frame = frame.sort_values("chunk")
        total, chosen = _chain([[(w["start"], w["goal"], w["cost"], w["order"]) for w in own] for own in frame["costs"]])
        border = sum(a + b not in _LEGAL for a, b in zip(frame["last"][:-1], frame["first"][1:]))
        return pd.DataFrame({"conv_id": frame["conv_id"], "chunk": frame["chunk"], "start": [s for s, _ in chosen], "goal": [g for _, g in chosen],
                             "cost": total, "illegal": int(frame["illegal"].sum()) + border})

    numbers = F.transform("ways", lambda w: F.struct(w["start"].alias("start"), w["goal"].alias("goal"), w["cost"].alias("cost"), w["order"].alias("order")))
    chains = StructType().add("conv_id", conv).add("chunk", LongType()).add("start", IntegerType()).add("goal", IntegerType()).add("cost", LongType()).add("illegal", LongType())
    picked = parts.select("conv_id", "chunk", "illegal", "first", "last", numbers.alias("costs")).groupBy("conv_id").applyInPandas(chain, chains)
    a, b = picked.alias("a"), parts.select("conv_id", "chunk", "ways").alias("b")
    way = F.filter("b.ways", lambda w: (w["start"] == F.col("a.start")) & (w["goal"] == F.col("a.goal")))[0]["audit"]
    edits = durable(a.join(b, F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.chunk") == F.col("b.chunk")))
                    .select("a.conv_id", "a.chunk", "a.cost", "a.illegal", way.alias("audit")))

    def digest(batches):
        key, out, chunk, edits, tail = None, None, None, [], ""

        def done():
            out.feed(tail)
            return pa.RecordBatch.from_arrays([pa.array([key], kind), pa.array([out.hash.hexdigest()])], ["conv_id", "repaired_sha256"])

        for batch in batches:
            kind = batch.schema.field(0).type
            for k, c, slot, role, text, audit in zip(*[c.to_pylist() for c in batch.columns]):
                if out is None or k != key:
                    if out is not None:
                        yield done()
                    key, out, chunk = k, Repaired(), None
                if c != chunk:
                    edits, tail = _split(audit)
                    chunk = c
                out.feed(edits[slot], role, text)
        if out is not None:
            yield done()

    marked = rows.alias("r").join(edits.alias("e"), F.col("r.conv_id").eqNullSafe(F.col("e.conv_id")) & (F.col("r.chunk") == F.col("e.chunk")))
    marked = marked.select("r.conv_id", "r.chunk", "r.slot", "r.role", "r.text", "e.audit").repartition("conv_id").sortWithinPartitions("conv_id", "chunk", "slot")
    hashes = marked.mapInArrow(digest, StructType().add("conv_id", conv).add("repaired_sha256", StringType()))
    whole = edits.groupBy("conv_id").agg(F.max("cost").alias("cost"), F.max("illegal").alias("illegal"),
                                         F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "audit"))), lambda s: s["audit"]), "").alias("audit"))
    wide = lambda c: c.cast("decimal(20,0)")
    gaps = F.least(F.coalesce(wide(F.max("turn")) - wide(F.min("turn")) + 1 - F.count_distinct("turn"), F.lit(0)), F.lit((1 << 63) - 1)).cast("long")
    counts = rows.groupBy("conv_id").agg(gaps.alias("gaps"), *[F.count_if(F.col("fault") == f).alias(n) for f, n in (("b", "blank"), ("r", "duplicate"), ("t", "truncated"))])
    joined = counts.alias("c").join(whole.alias("w"), F.col("c.conv_id").eqNullSafe(F.col("w.conv_id"))).join(hashes.alias("h"), F.col("c.conv_id").eqNullSafe(F.col("h.conv_id")))
    return joined.select("c.conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repair(rows: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Faults, cheapest edits and repaired hash of each conversation of rows(conv_id, turn, role, text, gone).

    Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. Roles and texts must not be null
    (`damage` sees to that); `gone` rows only make their conversation known, and one without other rows has zeros, an empty audit and
    the empty string's hash. A null conv_id is a conversation of its own; null turns come first and count for no gap; rows of one turn
    go by role, then text; repeated rows count each. A role that is empty or begins with another letter than s, u or a cannot be kept.
    Other columns are left behind. An empty table gives an empty one. Gaps beyond a long are the largest long.
    """
    rows = rows.select("conv_id", "turn", "role", "text", "gone")
    sizes = rows.filter("NOT gone").groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))
    long = durable(sizes.filter((F.col("n") > chunk_rows) | (F.col("chars") > chunk_chars)).select(F.col("conv_id").alias("_long")))
    if long.isEmpty():
        return _repair_short(rows)
    held = F.col("conv_id").eqNullSafe(F.col("_long"))
    short = _repair_short(rows.join(long, held, "left_anti"))
    return short.unionByName(_repair_long(rows.join(long, held, "left_semi"), chunk_rows))
