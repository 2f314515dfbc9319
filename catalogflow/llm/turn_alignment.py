"""Repair of conversations by aligning their turns with the grammar ``(s?(ua)+)?`` of role initials.

The turns of a conversation are aligned with the grammar's string of each feasible length at the
least cost (Wagner-Fischer). The alternating string is told by its length and its last symbol, so
one table, filled from the last turn backwards, holds the alignments with the strings of all
lengths: row i, column r is the cost of turning turns i, i+1, ... into the last r symbols. Only a
band of it is filled (Ukkonen): a plain repair, which inserts a turn wherever the roles do not
alternate, gives an incumbent cost, and a cell whose column is too far from the number of usable
turns left cannot be on a path as cheap as that. Of all strings that cost the least the audits are
traced back, taking the ASCII-least edit at each step, and compared.

Turns are sorted into ranges by conversation and turn, so no task holds a conversation because of
its key. What a task sees of a conversation is cut into chunks of at most ``CHUNK`` turns. A
conversation that is one chunk is aligned at once; of the others each chunk is aligned from every
state of the grammar to every state, and these small tables are composed along the conversation.
Two audits of one cost and one number of turns are never prefixes of each other (a longer one would
hold more insertions, each of which costs), so the ASCII-least whole is made of ASCII-least parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogflow.llm.blocks import _column, map_arrow
from catalogflow.session import materialize

#: Turns and characters of a chunk.
CHUNK, CHUNK_CHARS = 256, 1 << 20

# Costs of the edits (fixed values); keeping is free, a truncated turn that stays costs 1 more.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}
# States of the grammar: before all turns, then by the last turn's initial.
START, SYSTEM, USER, ASSISTANT = STATES = "^sua"
#: Pairs of role initials that may follow each other (fixed value).
LEGAL = {"su", "ua", "au"}
_SPACE = " \t\n\x0b\x0c\r"
_FAR = 1 << 60

Entry = tuple[int, str]


class Turn(NamedTuple):
    """What the alignment reads of a turn: initial, whether it has to go, what keeping it costs."""

    initial: str
    gone: bool
    truncated: int


def _other(symbol: str) -> str:
    return "a" if symbol == "u" else "u"


class _Table:
    """Costs of aligning turns with the alternating strings that end in ``last``, in a band."""

    def __init__(self, turns: list[Turn], last: str, spare: int):
        self.turns, self.last = turns, last
        n = len(turns)
        left = [0] * (n + 1)
        for i in range(n - 1, -1, -1):
            left[i] = left[i + 1] + (not turns[i].gone)
        # Beyond what every repair costs, a column off by one costs 2: a usable turn deleted
        # (3, or 2 more than keeping a truncated one) or one inserted.
        wide = spare // 2
        self.low = [max(k - wide, 0) for k in left]
        self.rows: list[list[int]] = [[]] * (n + 1)
        self.rows[n] = [INSERT * r for r in range(self.low[n], left[n] + wide + 1)]
        for i in range(n - 1, -1, -1):
            turn, low, below = turns[i], self.low[i], self.low[i + 1]
            after, row = self.rows[i + 1], []
            size, before = len(after), _FAR
            for r in range(low, left[i] + wide + 1):
                at = r - below
                cost = after[at] + DELETE if 0 <= at < size else _FAR
                if r:
                    cost = min(cost, before + INSERT)
                    if not turn.gone and 0 < at <= size:
                        fits = turn.initial == self.symbol(r)
                        match = after[at - 1] + turn.truncated + (0 if fits else REROLE)
                        cost = min(cost, match)
                row.append(cost)
                before = cost
            self.rows[i] = row

    def symbol(self, r: int) -> str:
        """The first of the last ``r`` symbols."""
        return self.last if r % 2 else _other(self.last)

    def cost(self, i: int, r: int) -> int:
        at = r - self.low[i]
        return self.rows[i][at] if 0 <= at < len(self.rows[i]) else _FAR

    def lengths(self, i: int, first: str) -> Iterator[tuple[int, int]]:
        """Cost and length of the strings that begin with ``first``, for the turns from ``i`` on."""
        for r in range(max(self.low[i], 1), self.low[i] + len(self.rows[i])):
            if self.symbol(r) == first:
                yield self.cost(i, r), r

    def audit(self, i: int, r: int) -> str:
        """The ASCII-least edits of least cost that turn the turns from ``i`` on into r symbols."""
        out, n = [], len(self.turns)
        while i < n or r:
            cost = self.cost(i, r)
            turn = self.turns[i] if i < n else None
            if turn and self.cost(i + 1, r) + DELETE == cost:
                edit = "D"
            elif r and self.cost(i, r - 1) + INSERT == cost:
                edit = "I"
            else:
                edit = "K" if turn.initial == self.symbol(r) else "R"
            i, r = i + (edit != "I"), r - (edit != "D")
            out.append(edit)
        return "".join(out)


def _plain_cost(turns: list[Turn], first: str, last: str) -> int:
    """The cost of inserting a turn wherever the roles do not alternate from ``first`` to ``last``."""
    cost, expected, sent = 0, first, False
    for turn in turns:
        if turn.gone:
            cost += DELETE
            continue
        cost += turn.truncated
        if turn.initial == expected:
            expected = _other(expected)
        elif turn.initial in ROLES:
            cost += INSERT
        else:
            cost += REROLE
            expected = _other(expected)
        sent = True
    while not sent or expected == last:
        cost, expected, sent = cost + INSERT, _other(expected), True
    return cost


def alignments(
    turns: list[Turn], starts: Iterable[str] = STATES, ends: Iterable[str] = STATES
) -> dict[tuple[str, str], Entry]:
    """Least cost and ASCII-least audit from each of ``starts`` to each of ``ends``."""
    starts, n = list(starts), len(turns)
    base = sum(DELETE if t.gone else t.truncated for t in turns)
    options: dict[tuple[str, str], list[tuple[int, str, _Table | None, int, int]]] = {}

    def offer(pair, cost, done, table=None, i=0, r=0):
        options.setdefault(pair, []).append((cost, done, table, i, r))

    system = [i for i, t in enumerate(turns) if not t.gone and t.initial == "s"]
    for state in starts:
        if state in ends:
            offer((state, state), DELETE * n, "D" * n)
    if START in starts and SYSTEM in ends:
        for i in system:
            kept = "D" * i + "K" + "D" * (n - i - 1)
            offer((START, SYSTEM), DELETE * (n - 1) + turns[i].truncated, kept)
    for last in (USER, ASSISTANT):
        if last not in ends:
            continue
        firsts = {"a" if s == USER else "u" for s in starts}
        most = max(_plain_cost(turns, first, last) for first in firsts)
        table = _Table(turns, last, most - base)
        for state in starts:
            for cost, r in table.lengths(0, "a" if state == USER else "u"):
                offer((state, last), cost, "", table, 0, r)
        if START in starts:
            for i in system:
                spent = DELETE * i + turns[i].truncated
                for cost, r in table.lengths(i + 1, "u"):
                    offer((START, last), spent + cost, "D" * i + "K", table, i + 1, r)
    out = {}
    for pair, found in options.items():
        least = min(f[0] for f in found)
        if least < _FAR:
            audits = (
                done + (table.audit(i, r) if table else "")
                for cost, done, table, i, r in found
                if cost == least
            )
            out[pair] = (least, min(audits))
    return out


def best_repair(turns: list[Turn]) -> Entry:
    """Least cost and ASCII-least audit of a whole conversation."""
    found = alignments(turns, (START,), (START, ASSISTANT))
    return min(found.values())


def repaired(
    rows: list[tuple[str, str]], audit: str, state: str = START
) -> tuple[list[tuple[str, str]], str]:
    """The role and text of each turn that ``audit`` leaves of ``rows``, and the state after them."""
    out, left = [], iter(rows)
    for edit in audit:
        if edit == "D":
            next(left)
            continue
        role, text = next(left) if edit != "I" else ("", "")
        if edit == "K":
            state = role[:1]
        else:
            state = "a" if state == USER else "u"
            role = ROLES[state]
        out.append((role, text))
    return out, state


# What a chunk tells of its conversation.
_COUNTS = "blank bigint, duplicate bigint, truncated bigint, illegal bigint"
_TURNS = "turns bigint, least bigint, most bigint, first string, last string"
_TABLE = "array<struct<begin:string,end:string,cost:bigint,audit:string>>"
_ROWS = "array<struct<role:string,text:string>>"
_CHUNK = f"part int, seq bigint, {_COUNTS}, {_TURNS}, whole boolean, entries {_TABLE}, rows {_ROWS}"


class _Chunk:
    """Turns of one conversation that follow each other."""

    def __init__(self):
        self.rows: list[tuple[str, str]] = []
        self.turns: list[Turn] = []
        self.numbers: set[int] = set()
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.chars = 0

    def add(self, turn: int | None, role: str, text: str, later: bool) -> None:
        inner = text.strip(_SPACE)
        if not inner:
            fault = "blank"
        elif later:
            fault = "duplicate"
        else:
            fault = "truncated" if inner[-1] not in ".!?" else None
        if fault:
            self.faults[fault] += 1
        if self.rows and self.rows[-1][0][:1] + role[:1] not in LEGAL:
            self.illegal += 1
        gone = fault in ("blank", "duplicate")
        self.turns.append(Turn(role[:1], gone, TRUNCATED if fault == "truncated" else 0))
        self.rows.append((role, text))
        self.chars += len(text)
        if turn is not None:
            self.numbers.add(turn)

    def full(self) -> bool:
        return len(self.rows) >= CHUNK or self.chars >= CHUNK_CHARS

    def told(self, whole: bool) -> dict:
        rows = self.rows
        if whole:
            cost, audit = best_repair(self.turns)
            entries, (rows, _) = {(START, ASSISTANT): (cost, audit)}, repaired(rows, audit)
        else:
            entries = alignments(self.turns)
        return {
            **self.faults,
            "illegal": self.illegal,
            "turns": len(self.numbers),
            "least": min(self.numbers, default=None),
            "most": max(self.numbers, default=None),
            "first": self.rows[0][0][:1],
            "last": self.rows[-1][0][:1],
            "whole": whole,
            "entries": [
                {"begin": b, "end": e, "cost": c, "audit": a} for (b, e), (c, a) in entries.items()
            ],
            "rows": [{"role": r, "text": t} for r, t in rows],
        }


def _chunks(sorted_turns: DataFrame, kind: T.DataType) -> DataFrame:
    """The chunks of sorted turns, whole conversations repaired, written once."""
    schema = T.StructType([T.StructField("conv", kind), *T._parse_datatype_string(_CHUNK)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        types = to_arrow_schema(schema)
        part = TaskContext.get().partitionId()
        chunk, conv, seq, convs, cut = None, None, 0, 0, False
        out: list[dict] = []

        def close(whole: bool) -> None:
            nonlocal seq
            out.append({"conv": conv, "part": part, "seq": seq, **chunk.told(whole)})
            seq += 1

        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                for row in batch.slice(i, 1024).to_pylist():
                    if chunk is None or row["conv"] != conv:
                        if chunk is not None:
                            # A task's first conversation may have begun in the one before.
                            close(whole=not cut and convs > 1)
                        chunk, conv, cut, convs = _Chunk(), row["conv"], False, convs + 1
                    for copy in range(row["copies"]):
                        if chunk.full():
                            close(whole=False)
                            chunk, cut = _Chunk(), True
                        chunk.add(row["turn"], row["role"], row["text"], row["later"] or copy > 0)
                if out:
                    yield pa.RecordBatch.from_pylist(out, types)
                    out.clear()
        if chunk is not None:
            # Its last one may go on in the next.
            close(whole=False)
            yield pa.RecordBatch.from_pylist(out, types)

    return materialize(map_arrow(sorted_turns, run, schema), "chunks")


_SUMMARY = f"gaps bigint, {_COUNTS}, cost bigint, audit string"


def _compose(kind: T.DataType):
    """Chunks sorted by conversation and place to one summary each, and the way through each chunk."""

    def through(states: dict[str, Entry], entries: list[dict]) -> tuple[dict, dict[str, str]]:
        """The states after a chunk, and from which state the best way to each of them came."""
        options: dict[str, list[dict]] = {}
        for e in entries:
            if e["begin"] in states:
                options.setdefault(e["end"], []).append(e)
        after, via = {}, {}
        for end, found in options.items():
            least = min(states[e["begin"]][0] + e["cost"] for e in found)
            ties = [e for e in found if states[e["begin"]][0] + e["cost"] == least]
            audit, via[end] = min((states[e["begin"]][1] + e["audit"], e["begin"]) for e in ties)
            after[end] = (least, audit)
        return after, via

    def summed(conv, chunks: list[dict]) -> list[dict]:
        states: dict[str, Entry] = {START: (0, "")}
        came: list[dict[str, str]] = []
        counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        turns, least, most, last = 0, None, None, None
        for c in chunks:
            states, via = through(states, c["entries"])
            came.append(via)
            for k in counts:
                counts[k] += c[k]
            if last is not None and last + c["first"] not in LEGAL:
                counts["illegal"] += 1
            last = c["last"]
            if c["turns"]:
                turns += c["turns"] - (most is not None and most == c["least"])
                least = c["least"] if least is None else least
                most = c["most"]
        end = min((s for s in (START, ASSISTANT) if s in states), key=states.__getitem__)
        cost, audit = states[end]
        gaps = 0 if least is None else most - least + 1 - turns
        out = [{"conv": conv, "gaps": gaps, **counts, "cost": cost, "audit": audit}]
        for c, via in zip(reversed(chunks), reversed(came)):
            begin = via[end]
            out.append({"conv": conv, "part": c["part"], "seq": c["seq"], "begin": begin, "end": end})
            end = begin
        return out

    schema = T.StructType(
        [
            T.StructField("conv", kind),
            *T._parse_datatype_string(f"{_SUMMARY}, part int, seq bigint, begin string, end string"),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        types = to_arrow_schema(schema)
        held: list[dict] = []
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if held and row["conv"] != held[0]["conv"]:
                    yield pa.RecordBatch.from_pylist(summed(held[0]["conv"], held), types)
                    held = []
                held.append(row)
        if held:
            yield pa.RecordBatch.from_pylist(summed(held[0]["conv"], held), types)

    return run, schema


def _hashes(kind: T.DataType):
    """SHA-256 of each conversation's lines, from pieces sorted by conversation and place."""
    schema = T.StructType([T.StructField("conv", kind), T.StructField("sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        types = to_arrow_schema(schema)
        conv, state, lines = None, None, 0
        for batch in batches:
            for row in batch.to_pylist():
                if state is None or row["conv"] != conv:
                    if state is not None:
                        found = {"conv": conv, "sha256": state.hexdigest()}
                        yield pa.RecordBatch.from_pylist([found], types)
                    conv, state, lines = row["conv"], hashlib.sha256(), 0
                for turn in row["rows"]:
                    state.update(("\n" if lines else "").encode())
                    state.update(f"{turn['role']}:{turn['text']}".encode())
                    lines += 1
        if state is not None:
            found = {"conv": conv, "sha256": state.hexdigest()}
            yield pa.RecordBatch.from_pylist([found], types)

    return run, schema


def _applied(kind: T.DataType):
    """The turns that the chosen way through each chunk leaves."""
    schema = T.StructType(
        [T.StructField("conv", kind), *T._parse_datatype_string(f"part int, seq bigint, rows {_ROWS}")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        types = to_arrow_schema(schema)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                way = (row["begin"], row["end"])
                audit = next(e["audit"] for e in row["entries"] if (e["begin"], e["end"]) == way)
                turns, _ = repaired([(r["role"], r["text"]) for r in row["rows"]], audit, way[0])
                out = {c: row[c] for c in ("conv", "part", "seq")}
                out["rows"] = [{"role": r, "text": t} for r, t in turns]
                yield pa.RecordBatch.from_pylist([out], types)

    return run, schema


class Repaired(NamedTuple):
    """audits: one row per conversation; chunks: its repaired turns in order of part and seq."""

    audits: DataFrame
    chunks: DataFrame

    def turns(self, conv_col: str = "conv_id") -> DataFrame:
        """conversation, part, seq, place, role, text: the repaired turns, in order of the three."""
        out = self.chunks.select("conv", "part", "seq", F.posexplode("rows").alias("place", "turn"))
        return out.select(F.col("conv").alias(conv_col), "part", "seq", "place", "turn.*")

    def hashes(self, conv_col: str = "conv_id") -> DataFrame:
        """conversation, sha256 of its repaired ``role:text`` lines joined by newlines."""
        line = F.transform("rows", lambda r: F.concat(r["role"], F.lit(":"), r["text"]))
        whole = self.chunks.where("whole").select(
            "conv", F.sha2(F.array_join(line, "\n"), 256).alias("sha256")
        )
        run, schema = _hashes(self.chunks.schema["conv"].dataType)
        parts = self.chunks.where("NOT whole").select("conv", "part", "seq", "rows")
        dealt = parts.repartition("conv").sortWithinPartitions("conv", "part", "seq")
        found = whole.unionByName(map_arrow(dealt, run, schema))
        return found.withColumnRenamed("conv", conv_col)


def repair(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> Repaired:
    """The cheapest edits that give every conversation the role initials ``(s?(ua)+)?``.

    Turns are taken by number, null first, then by role and a hash of the text. A turn is blank (no character but
    white space), or a duplicate (its role and text were there before), or truncated (its last
    character is none of ``.!?``), whichever comes first. Blank and duplicate turns have to go.
    Edits: Keep costs 0, Rerole to user or assistant 2, Delete 3, Insert an empty user or assistant
    turn 2; a truncated turn that stays costs 1.

    ``audits``: conversation, gaps (numbers missing between its least and greatest one), blank,
    duplicate, truncated, illegal (neighbours whose initials are not su, ua or au), cost, audit (the
    initials of the edits in order, of the cheapest the ASCII-least). ``chunks``: the repaired turns.

    A null role or text counts as one space; a null conversation is one of its own; equal rows are
    each a turn; roles beside system, user and assistant go or are changed. A conversation of any
    length is cut into chunks, so only its chunks' tables and its audit meet in one task. Any other
    column is ignored, and an empty table gives empty ones.
    """
    kind = turns.schema[conv_col].dataType
    text = F.coalesce(_column(turns, text_col), F.lit(" "))
    picked = turns.select(
        _column(turns, conv_col).alias("conv"),
        _column(turns, turn_col).cast("bigint").alias("turn"),
        F.coalesce(_column(turns, role_col), F.lit(" ")).alias("role"),
        text.alias("text"),
    )
    # Equal turns are counted before they are shuffled, so many copies are one row.
    counted = (
        picked.groupBy("conv", "turn", "role", "text")
        .agg(F.count("*").alias("copies"))
        .withColumn("digest", F.unhex(F.sha2("text", 256)))
    )
    # Only role and text that stand under several turn numbers need to know the first of these.
    repeats = (
        counted.groupBy("conv", "role", "digest")
        .agg(
            F.count("*").alias("times"),
            F.min("turn").alias("first"),
            F.max(F.col("turn").isNull()).alias("unnumbered"),
        )
        .where("times > 1")
        .select(*[F.col(c).alias(f"_{c}") for c in ("conv", "role", "digest", "first", "unnumbered")])
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("conv", "role", "digest")]
    later = F.col("turn").isNotNull() & (F.col("_unnumbered") | (F.col("turn") > F.col("_first")))
    flagged = counted.join(repeats, same, "left").select(
        "conv", "turn", "role", "text", "digest", "copies", F.coalesce(later, F.lit(False)).alias("later")
    )
    order = ("conv", "turn", "role", "digest")
    in_order = flagged.repartitionByRange(*order).sortWithinPartitions(*order)
    chunks = _chunks(in_order.drop("digest"), kind)

    whole = chunks.where("whole")
    audit = F.get("entries", F.lit(0))
    gaps = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0))
    faults = ("blank", "duplicate", "truncated", "illegal")
    alone = whole.select(
        "conv", gaps.alias("gaps"), *faults, audit["cost"].alias("cost"), audit["audit"].alias("audit")
    )
    parts = chunks.where("NOT whole")
    run, schema = _compose(kind)
    ways = materialize(
        map_arrow(
            parts.drop("rows").repartition("conv").sortWithinPartitions("conv", "part", "seq"),
            run, schema,
        ),
        "ways",
    )
    joined = ways.where("part IS NULL").select("conv", "gaps", *faults, "cost", "audit")
    chosen = ways.where("part IS NOT NULL").select("part", "seq", "begin", "end")
    run, schema = _applied(kind)
    applied = map_arrow(
        parts.select("conv", "part", "seq", "entries", "rows").join(chosen, ["part", "seq"]), run, schema
    )
    pieces = whole.select("conv", "part", "seq", "rows", "whole").unionByName(
        applied.withColumn("whole", F.lit(False))
    )
    return Repaired(alone.unionByName(joined).withColumnRenamed("conv", conv_col), pieces)


def digest_sql(damaged: str) -> str:
    """conv_id, counts, cost, audit and the hash of the repaired lines, in SQL.

    ``damaged`` selects conv_id, turn, role, text. The best way to each state of the grammar is
    carried along a conversation as one text, its cost in eight digits and its audit after it.
    """

    def add(way: str, cost: str, edit: str) -> str:
        spent = f"CAST(substr({way}, 1, 8) AS BIGINT) + {cost}"
        return f"(lpad(CAST({spent} AS VARCHAR), 8, '0') || substr({way}, 9) || '{edit}')"

    def taken(symbol: str, ways: str) -> str:
        """Into ``symbol`` by the row, kept or given another role, from each of ``ways``."""
        found = [
            f"CASE WHEN NOT gone AND {fits} THEN {add(way, cost, edit)} END"
            for way in ways
            for fits, cost, edit in (
                (f"initial = '{symbol}'", "cut", "K"), ("true", "cut + 2", "R"),
            )
        ]
        return ", ".join(found)

    def inserted(frame: str) -> str:
        u = f"least(u, {', '.join(add(w, '2', 'I') for w in 'esa')})"
        return (
            f"SELECT conv_id, pos, e, s, u, least(a, {add('u', '2', 'I')}) AS a FROM "
            f"(SELECT conv_id, pos, e, s, {u} AS u, a FROM ({frame}))"
        )

    first = inserted(
        "SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS pos, '00000000' AS e, "
        "CAST(NULL AS VARCHAR) AS s, CAST(NULL AS VARCHAR) AS u, CAST(NULL AS VARCHAR) AS a FROM r"
    )
    step = inserted(
        f"SELECT r.conv_id, r.pos, {add('e', '3', 'D')} AS e, "
        f"least({add('s', '3', 'D')}, CASE WHEN NOT gone AND initial = 's' THEN "
        f"{add('e', 'cut', 'K')} END) AS s, "
        f"least({add('u', '3', 'D')}, {taken('u', 'esa')}) AS u, "
        f"least({add('a', '3', 'D')}, {taken('a', 'u')}) AS a "
        "FROM way JOIN r ON r.conv_id IS NOT DISTINCT FROM way.conv_id AND r.pos = way.pos + 1"
    )
    blank = r"NOT regexp_matches(text, '[^\x20\x09-\x0D]')"
    cut = r"NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$')"
    return f"""
WITH RECURSIVE t AS ({damaged}),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos
  FROM t
),
f AS (
  SELECT *, left(role, 1) AS initial, {blank} AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before
  FROM o
),
r AS (
  SELECT *, blank OR again AS gone,
    CAST(NOT blank AND NOT again AND {cut} AS BIGINT) AS cut FROM f
),
way AS ({first} UNION ALL {step}),
best AS (
  SELECT conv_id, CAST(substr(found, 1, 8) AS BIGINT) AS cost, substr(found, 9) AS audit
  FROM (SELECT conv_id, least(e, a) AS found, pos, max(pos) OVER (PARTITION BY conv_id) AS n FROM way)
  WHERE pos = n
),
edits AS (
  SELECT conv_id, i, edit,
    count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv_id ORDER BY i) AS pos,
    count(*) FILTER (edit <> 'D') OVER (PARTITION BY conv_id ORDER BY i) AS place
  FROM (SELECT conv_id, i, substr(audit, CAST(i AS BIGINT), 1) AS edit
        FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS i FROM best))
),
lines AS (
  SELECT e.conv_id, e.i, e.edit, place, r.role, CASE WHEN e.edit = 'I' THEN '' ELSE r.text END AS text,
    max(CASE WHEN place = 1 AND e.edit = 'K' AND r.initial = 's' THEN 1 ELSE 0 END)
      OVER (PARTITION BY e.conv_id) AS led
  FROM edits e LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM e.conv_id AND r.pos = e.pos
  WHERE e.edit <> 'D'
),
repaired AS (
  SELECT conv_id, string_agg((CASE WHEN edit = 'K' THEN role WHEN (place - led) % 2 = 1 THEN 'user'
    ELSE 'assistant' END) || ':' || text, chr(10) ORDER BY i) AS lines
  FROM lines GROUP BY conv_id
),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
    CAST(sum(cut) AS BIGINT) AS truncated,
    count(*) FILTER (pos > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN repaired ON repaired.conv_id IS NOT DISTINCT FROM c.conv_id"""
