"""Conversation structure repair as lightest derivations (Knuth's generalisation of Dijkstra's algorithm).

The grammar of roles is `(s?(ua)+)?` over the initials of the rows that remain.  An item (i, state) stands for
the edits of the rows from the i-th on, read from a state of the grammar: N (nothing yet), S (a system row),
U (a user row, to be answered) or A (answered; an end like N).  Each edit is a deduction that puts its letter before
an item's audit and adds its cost; a block of rows is a deduction of two antecedents, the block's own edits
from one state to another and the item that starts at the latter.  Items leave the agenda by (cost, rows
covered, audit).  All functions are monotone in that order and superior: an edit raises the cost or, where it
costs nothing, the rows covered, which are equal for all derivations of one item.  So an item is final when it first
leaves the agenda, by least cost and then by the audit that is least in ASCII order.

Rows are dealt over tasks by ranges of (conv_id, turn, role, text key), so one conversation may hold any share
of all rows.  A task cuts its rows into blocks of one conversation and at most `BLOCK` rows.  A block that is
a whole conversation is solved at once; for a part, the lightest edits between every two states are found.
Only these go through one task for each conversation, from the last block to the first, with audits as chains
that share their ends.  Texts are shuffled once, to the edits that keep them.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from .common import Scratch
from .merkle import _CRC_SQL, crc32_sql

BLOCK = 512
KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
LEGAL = {"su", "ua", "au"}
#: State after a row of the given initial, where the grammar allows it; a row without initial changes nothing.
NEXT = {("N", "s"): "S", ("N", "u"): "U", ("S", "u"): "U", ("U", "a"): "A", ("A", "u"): "U", **{(p, ""): p for p in "NSUA"}}
#: The role that a state asks for, by which rows are given another role or inserted.
ASKED = {"N": "user", "S": "user", "U": "assistant", "A": "user"}
ENDS = ("N", "A")
WHITE = " \t\n\x0b\x0c\r"

# Symbols of rows: x must go; else the initial, in upper case if the text is truncated; _ and = without initial, ? and ! with another.
_SYMBOL = {("s", False): "s", ("s", True): "S", ("u", False): "u", ("u", True): "U", ("a", False): "a", ("a", True): "A", ("", False): "_", ("", True): "="}
_INITIAL = {"s": "s", "S": "s", "u": "u", "U": "u", "a": "a", "A": "a", "_": "", "=": ""}
_TRUNCATED = frozenset("SUA=!")


def symbol(role: str, truncated: bool) -> str:
    return _SYMBOL.get((role[:1], truncated), "!" if truncated else "?")


def _edits(sign: str, state: str) -> Iterator[tuple[str, int, str]]:
    """Edits of a row in a state: letter, cost, state after it."""
    yield DELETE, COST[DELETE], state
    if sign != "x":
        more = TRUNCATED_COST * (sign in _TRUNCATED)
        kept = NEXT.get((state, _INITIAL.get(sign, "?")))
        if kept:
            yield KEEP, COST[KEEP] + more, kept
        yield REROLE, COST[REROLE] + more, NEXT[state, ASKED[state][0]]


_INSERTED = {p: NEXT[p, ASKED[p][0]] for p in "NSUA"}
_BEFORE_INSERT = {q: [p for p in "NSUA" if _INSERTED[p] == q] for q in "NSUA"}
_BEFORE_ROW = {sign: {q: [(p, letter, cost) for p in "NSUA" for letter, cost, r in _edits(sign, p) if r == q] for q in "NSUA"} for sign in "xsSuUaA_=?!"}


def lightest(signs: str, exits: tuple[str, ...], starts: tuple[str, ...], last: bool = True) -> dict[str, tuple[int, str]]:
    """Cost and audit of the lightest edits of the rows from each of starts to one of exits.

    last says that no row follows: only then may a row be inserted at the end, so that each edit of a longer
    conversation stands in one block alone.
    """
    n, wanted, found = len(signs), set(starts), {}
    agenda = [(0, 0, "", q) for q in exits]
    final: set[tuple[int, str]] = set()
    while agenda and len(found) < len(wanted):
        cost, covered, audit, q = heapq.heappop(agenda)
        if (covered, q) in final:
            continue
        final.add((covered, q))
        if covered == n and q in wanted:
            found[q] = (cost, audit)
        if covered or last:
            for p in _BEFORE_INSERT[q]:
                heapq.heappush(agenda, (cost + COST[INSERT], covered, INSERT + audit, p))
        if covered < n:
            for p, letter, more in _BEFORE_ROW[signs[n - 1 - covered]][q]:
                heapq.heappush(agenda, (cost + more, covered + 1, letter + audit, p))
    return found


@lru_cache(200_000)
def _whole(signs: str) -> tuple[int, str]:
    return lightest(signs, ENDS, ("N",))["N"]


@lru_cache(2_000)
def _part(signs: str) -> list[tuple[str, str, int, str]]:
    """(from, to, cost, audit) of a block that rows follow."""
    return [(p, q, *found) for q in "NSUA" for p, found in lightest(signs, (q,), tuple("NSUA"), last=False).items()]


# --- blocks -------------------------------------------------------------------------------------

_LONG, _TEXT = pa.int64(), pa.string()
_ROWS = pa.list_(pa.struct([("place", pa.int32()), ("turn", _LONG), ("role", _TEXT), ("key", _TEXT)]))
_PARTS = pa.list_(pa.struct([("p", _TEXT), ("q", _TEXT), ("cost", _LONG), ("audit", _TEXT)]))
_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_BLOCK = pa.schema([
    ("conv_id", _LONG), ("at", _LONG), ("whole", pa.bool_()), ("rows", _ROWS), ("cost", _LONG), ("audit", _TEXT), ("parts", _PARTS), ("low", _LONG), ("high", _LONG), ("turns", _LONG),
    ("first_turn", _LONG), ("last_turn", _LONG), *((c, _LONG) for c in _COUNTS), ("first", _TEXT), ("last", _TEXT),
])


class _Block:
    """Rows of one conversation in order, at most BLOCK of them."""

    def __init__(self) -> None:
        self.signs: list[str] = []
        self.rows: list[dict] = []
        self.turns: list[int | None] = []
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.first = self.last = None

    def add(self, turn: int | None, role: str, key: str, fault: str) -> None:
        must = fault in ("blank", "duplicate")
        if fault:
            self.counts[fault] += 1
        initial = role[:1]
        if self.last is None:
            self.first = initial
        elif self.last + initial not in LEGAL:
            self.counts["illegal"] += 1
        self.last = initial
        if not must:
            self.rows.append({"place": len(self.signs), "turn": turn, "role": role, "key": key})
        self.signs.append("x" if must else symbol(role, fault == "truncated"))
        self.turns.append(turn)

    def row(self, conv_id: int | None, at: int, whole: bool) -> dict:
        signs, known = "".join(self.signs), sorted({t for t in self.turns if t is not None})
        cost, audit = _whole(signs) if whole else (None, None)
        parts = None if whole else [*({"p": p, "q": q, "cost": c, "audit": a} for p, q, c, a in _part(signs)), *({"p": p, "q": "end", "cost": c, "audit": a} for p, (c, a) in lightest(signs, ENDS, tuple("NSUA")).items())]
        out = {"conv_id": conv_id, "at": at, "whole": whole, "rows": self.rows, "cost": cost, "audit": audit, "parts": parts}
        out |= {"low": known[0] if known else None, "high": known[-1] if known else None, "turns": len(known), "first_turn": self.turns[0], "last_turn": self.turns[-1]}
        return out | self.counts | {"first": self.first, "last": self.last}


def _cut(block: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def blocks() -> Iterator[dict]:
            """Blocks in order; the task's first and last conversation may go on in other tasks."""
            now, conv, number, run, pieces, marked = _Block(), None, 0, 0, 0, None
            for x in (x for batch in batches for x in batch.to_pylist()):
                if now.signs and x["conv_id"] != conv:
                    yield now.row(conv, (part << 33) + number, run > 0 and pieces == 0)
                    now, number, run, pieces = _Block(), number + 1, run + 1, 0
                conv, row = x["conv_id"], (x["turn"], x["role"], x["key"])
                if x["n"] == 0:
                    marked = row
                    continue
                for k in range(x["n"]):
                    if len(now.signs) == block:
                        yield now.row(conv, (part << 33) + number, False)
                        now, number, pieces = _Block(), number + 1, pieces + 1
                    fault = "blank" if x["code"] == 1 else "duplicate" if k or marked != row else "truncated" if x["code"] == 2 else ""
                    now.add(*row, fault)
            if now.signs:
                yield now.row(conv, (part << 33) + number, False)

        held: list[dict] = []
        for x in blocks():
            held.append(x)
            if len(held) == 500:
                yield pa.RecordBatch.from_pylist(held, _BLOCK)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, _BLOCK)

    return cut


# --- conversations of several blocks ------------------------------------------------------------


def _less(x: tuple, y: tuple) -> bool:
    """Whether audit x comes before audit y; both are chains (text, rest, block, state) of one conversation."""
    i = j = 0
    while x is not y or i != j:
        if x is None or y is None:
            return x is None and y is not None
        n = min(len(x[0]) - i, len(y[0]) - j)
        a, b = x[0][i : i + n], y[0][j : j + n]
        if a != b:
            return a < b
        i, j = i + n, j + n
        if i == len(x[0]):
            x, i = x[1], 0
        if j == len(y[0]):
            y, j = y[1], 0
    return False


_VERDICT = pa.schema([("conv_id", _LONG), ("at", _LONG), ("state", _TEXT), ("gaps", _LONG), *((c, _LONG) for c in _COUNTS), ("cost", _LONG), ("audit", _TEXT)])


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Verdicts (at is null) and the blocks' audits of conversations whose blocks come from the last to the first."""
    rows = (x for batch in batches for x in batch.to_pylist())
    for conv_id, blocks in groupby(rows, key=lambda x: x["conv_id"]):
        items: dict[str, tuple[int, tuple | None]] = {}
        total, later = dict.fromkeys(_COUNTS, 0), None
        low = high = None
        turns = 0
        for x in blocks:
            made: dict[str, tuple[int, tuple | None]] = {}
            for e in x["parts"]:
                if (later is None) != (e["q"] == "end"):
                    continue
                cost, rest = items.get(e["q"], (None, None)) if later else (0, None)
                if cost is None:
                    continue
                new = (e["cost"] + cost, (e["audit"], rest, x["at"], e["p"]))
                old = made.get(e["p"])
                if old is None or new[0] < old[0] or new[0] == old[0] and _less(new[1], old[1]):
                    made[e["p"]] = new
            items = made
            for k in total:
                total[k] += x[k]
            turns += x["turns"]
            if later:
                total["illegal"] += x["last"] + later["first"] not in LEGAL
                turns -= x["last_turn"] is not None and x["last_turn"] == later["first_turn"]
            low = min((t for t in (low, x["low"]) if t is not None), default=None)
            high = max((t for t in (high, x["high"]) if t is not None), default=None)
            later = x
        cost, chain = items["N"]
        pieces, held = [], []
        while chain:
            text, chain, at, state = chain
            pieces.append(text)
            held.append({"conv_id": conv_id, "at": at, "state": state, "audit": text})
            if len(held) == 500:
                yield pa.RecordBatch.from_pylist(held, _VERDICT)
                held = []
        held.append({"conv_id": conv_id, "at": None, "gaps": 0 if low is None else high - low + 1 - turns, "cost": cost, "audit": "".join(pieces), **total})
        yield pa.RecordBatch.from_pylist(held, _VERDICT)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of blocks that leave a row: its place, role, and the key of its text; an inserted row has none."""
    for batch in batches:
        out = {c: [] for c in ("conv_id", "at", "place", "edit", "new_role", "turn", "role", "key")}
        for x in batch.to_pylist():
            rows, i, state = {r["place"]: r for r in x["rows"]}, 0, x["state"]
            for place, letter in enumerate(x["audit"]):
                r = None
                if letter != INSERT:
                    r, i = rows.get(i), i + 1
                if letter == DELETE:
                    continue
                role = r["role"] if letter == KEEP else ASKED[state]
                state = NEXT[state, role[:1]]
                for c, v in (("conv_id", x["conv_id"]), ("at", x["at"]), ("place", place), ("edit", letter), ("new_role", role), *((c, r[c] if r else None) for c in ("turn", "role", "key"))):
                    out[c].append(v)
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], list(out))


class Repair:
    """Verdicts and repaired rows of conversations(conv_id, turn, role, text, ...).

    Rows are read by turn, nulls first; rows of one turn by role and then by the MD5 of the text.  A null role
    or text counts as one space; a null conv_id is a conversation like any other.  Repeated rows are
    duplicates from the second on.  A text of any length is read whole.  A role is known by its first letter; one without
    letters (an empty text) fits everywhere.  Other columns are ignored; an empty table gives empty results.
    """

    def __init__(self, conversations: DataFrame, block: int = BLOCK):
        scratch = Scratch(conversations.sparkSession)
        text = F.coalesce("text", F.lit(" "))
        rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), F.md5(text).alias("key"))
        self.rows = rows
        rest = F.rtrim("text", F.lit(WHITE))
        code = F.when(rest == "", 1).when(F.substring(rest, -1, 1).isin(".", "!", "?"), 0).otherwise(2)
        counted = scratch.stored(rows.withColumn("code", code).groupBy("conv_id", "turn", "role", "key", "code").agg(F.count("*").alias("n")), "counted")
        order = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
        firsts = counted.groupBy("conv_id", "role", "key").agg(F.min(order).alias("first")).select("conv_id", F.col("first.turn").alias("turn"), "role", "key", F.lit(0).alias("code"), F.lit(0).cast("long").alias("n"))
        keys = ["conv_id", "turn", "role", "key"]
        dealt = scratch.stored(counted.union(firsts), "rows").repartitionByRange(*keys).sortWithinPartitions(*keys, "n")
        blocks = scratch.stored(dealt.mapInArrow(_cut(block), from_arrow_schema(_BLOCK)), "blocks")
        scratch.drop("counted", "rows")
        whole = blocks.filter("whole")
        parts = blocks.filter("not whole").drop("rows").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("at"))
        joined = scratch.stored(parts.mapInArrow(_join, from_arrow_schema(_VERDICT)), "joined")
        gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
        self.verdicts = whole.select("conv_id", gaps.alias("gaps"), *_COUNTS, "cost", "audit").union(joined.filter("at is null").drop("at", "state"))
        self._blocks, self._joined = blocks, joined

    def repaired(self) -> DataFrame:
        """conv_id, at, place, edit, role, text: the rows that the edits leave, in order of (at, place) within conv_id."""
        whole = self._blocks.filter("whole").select("conv_id", "at", "rows", "audit", F.lit("N").alias("state"))
        pieces = self._joined.filter("at is not null").select("at", "audit", "state")
        parts = self._blocks.filter("not whole").select("conv_id", "at", "rows").join(pieces, "at").select(*whole.columns)
        edits = whole.union(parts).mapInArrow(_apply, "conv_id long, at long, place int, edit string, new_role string, turn long, role string, key string")
        edits = edits.select("conv_id", "at", "place", "edit", F.col("new_role").alias("role"), F.when(F.col("key").isNotNull(), _row_key()).alias("row_key"))
        texts = self.rows.select(_row_key().alias("row_key"), "text").dropDuplicates(["row_key"])
        kept = edits.filter("row_key is not null").join(texts, "row_key").select("conv_id", "at", "place", "edit", "role", "text")
        return kept.union(edits.filter("row_key is null").select("conv_id", "at", "place", "edit", "role", F.lit("")))


def _row_key() -> Column:
    """One text that stands for conv_id, turn, role and the text's key."""
    whole = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    return F.md5(F.concat_ws(":", whole("conv_id"), whole("turn"), "key", "role"))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (x for batch in batches for x in batch.to_pylist())
    held: list[tuple[int | None, str]] = []
    for conv_id, own in groupby(rows, key=lambda x: x["conv_id"]):
        made, between = sha256(), b""
        for x in own:
            made.update(between + f"{x['role']}:{x['text']}".encode())
            between = b"\n"
        held.append((conv_id, made.hexdigest()))
        if len(held) == 1000:
            yield _digest_batch(held)
            held = []
    if held:
        yield _digest_batch(held)


def _digest_batch(held: list[tuple[int | None, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([c for c, _ in held], pa.int64()), pa.array([h for _, h in held])], ["conv_id", "repaired_sha256"])


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256: the sha256 of each conversation's `role:text` lines.

    A digest of this kind can't be joined from parts, so a conversation's lines pass one task, one after the other;
    it holds one batch of them at a time.
    """
    ordered = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "at", "place")
    return ordered.select("conv_id", "role", "text").mapInArrow(_digest, "conv_id long, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """conversations with the faults that the hash of conv_id and turn says; nulls in role and text become one space."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(one("conv_id"), F.lit(":"), one("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(one("text"), "[.!?]", "")).otherwise(one("text"))
    role = F.when(fault == 4, "user").otherwise(one("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)))
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def repaired_damage(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """The verdict and the digest of the repaired rows for every conv_id, after damage."""
    made = Repair(damaged(conversations), block)
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().alias("e")
    joined = every.join(made.verdicts.alias("v"), F.col("e.conv_id").eqNullSafe(F.col("v.conv_id")), "left")
    joined = joined.join(digests(made.repaired()).alias("d"), F.col("e.conv_id").eqNullSafe(F.col("d.conv_id")), "left")
    counts = [F.coalesce(f"v.{c}", F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    none = sha256().hexdigest()
    return joined.select("e.conv_id", *counts, F.coalesce("v.audit", F.lit("")).alias("audit"), F.coalesce("d.repaired_sha256", F.lit(none)).alias("repaired_sha256"))


def repaired_damage_sql() -> str:
    """The same over conversations in DuckDB SQL: the lightest edits up to each row, state by state."""
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    least = lambda *made: "list_min(list_filter([" + ", ".join(made) + "], lambda x: x IS NOT NULL))"
    step = lambda old, cost, letter, line: f"{{'c': {old}.c + {cost}, 'a': {old}.a || '{letter}', 't': {old}.t || {line}}}"
    kept = lambda old, initial: f"CASE WHEN {old} IS NOT NULL AND {initial} AND NOT must THEN {step(old, 'more', 'K', 'line')} END"
    other = lambda old, role: f"CASE WHEN {old} IS NOT NULL AND NOT must THEN {step(old, '2 + more', 'R', f"chr(10) || '{role}:' || text")} END"
    gone = lambda old: f"CASE WHEN {old} IS NOT NULL THEN {step(old, 3, 'D', repr(''))} END"
    put = lambda old, role: f"CASE WHEN {old} IS NOT NULL THEN {step(old, 2, 'I', f"chr(10) || '{role}:'")} END"
    i = lambda x: f"initial = '{x}'"
    row = {
        "n": least(gone("n"), kept("n", i(""))),
        "s": least(gone("s"), kept("s", i("")), kept("n", i("s"))),
        "u": least(gone("u"), kept("u", i("")), kept("n", i("u")), kept("s", i("u")), kept("a", i("u")), other("n", "user"), other("s", "user"), other("a", "user")),
        "a": least(gone("a"), kept("a", i("")), kept("u", i("a")), other("u", "assistant")),
    }
    return f"""
WITH RECURSIVE {_CRC_SQL},
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
struck AS (SELECT *, {crc32_sql("k")} % 20 AS f FROM keyed, crc),
copies AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role, CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM struck),
numbered AS (SELECT *, row_number() OVER () AS r FROM copies),
placed AS (SELECT *, substr(role, 1, 1) AS initial, rtrim(text, {white}) AS body, row_number() OVER w AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, r) AS nth FROM numbered WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), r)),
rows AS (SELECT *, body = '' AS blank, body <> '' AND nth > 1 AS duplicate, body = '' OR nth > 1 AS must, body <> '' AND nth = 1 AND right(body, 1) NOT IN ('.', '!', '?') AS truncated, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS was, chr(10) || role || ':' || text AS line FROM placed),
verdicts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
  count(*) FILTER (was IS NOT NULL AND was || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS rows FROM rows GROUP BY conv_id),
edits(conv_id, i, n, s, u, a) AS (
  SELECT conv_id, 0, {{'c': 0, 'a': '', 't': ''}}, NULL::STRUCT(c INTEGER, a VARCHAR, t VARCHAR), NULL::STRUCT(c INTEGER, a VARCHAR, t VARCHAR), NULL::STRUCT(c INTEGER, a VARCHAR, t VARCHAR) FROM verdicts
  UNION ALL
  SELECT conv_id, i, {row["n"]}, {row["s"]}, {row["u"]}, {row["a"]}
  FROM (SELECT x.conv_id, r.i, n, s, {least("u", put("n", "user"), put("s", "user"), put("a", "user"))} AS u, {least("a", put("u", "assistant"))} AS a, r.initial, r.must, r.truncated::INTEGER AS more, r.line, r.text
        FROM edits x JOIN rows r ON r.conv_id IS NOT DISTINCT FROM x.conv_id AND r.i = x.i + 1)),
ends AS (SELECT conv_id, i, {least("n", "a", put("u", "assistant"), "CASE WHEN s IS NOT NULL THEN {'c': s.c + 4, 'a': s.a || 'II', 't': s.t || chr(10) || 'user:' || chr(10) || 'assistant:'} END")} AS best FROM edits)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
  coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN verdicts v ON c.conv_id IS NOT DISTINCT FROM v.conv_id LEFT JOIN ends e ON c.conv_id IS NOT DISTINCT FROM e.conv_id AND e.i = v.rows
"""
