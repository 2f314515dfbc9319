"""Repairs against a plain search over the states of the grammar."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from catalogflow.llm import queries, turn_alignment
from catalogflow.llm.turn_alignment import Turn, alignments, best_repair, repaired

SF = "/root/testdata/sf0.001"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def brute(turns):
    """Least cost and audit by a pass over the states, any number of insertions in between."""

    def steps(state, turn):
        """edit, cost, state after it; turn None: insertions."""
        for symbol in "ua":
            if symbol == ("a" if state == "u" else "u"):
                if turn is None:
                    yield "I", 2, symbol
                elif not turn.gone:
                    if turn.initial == symbol:
                        yield "K", turn.truncated, symbol
                    yield "R", 2 + turn.truncated, symbol
        if turn is not None:
            yield "D", 3, state
            if state == "^" and turn.initial == "s" and not turn.gone:
                yield "K", turn.truncated, "s"

    def better(best, state, found):
        if state not in best or found < best[state]:
            best[state] = found
            return True

    def insert(best):
        waiting = list(best)
        while waiting:
            state = waiting.pop()
            cost, audit = best[state]
            for edit, more, after in steps(state, None):
                if better(best, after, (cost + more, audit + edit)):
                    waiting.append(after)
        return best

    best = insert({"^": (0, "")})
    for turn in turns:
        following = {}
        for state, (cost, audit) in best.items():
            for edit, more, after in steps(state, turn):
                better(following, after, (cost + more, audit + edit))
        best = insert(following)
    return min(best[s] for s in "^a" if s in best)


def some_turns(r, n, roles="uuuaaast"):
    return [Turn(r.choice(roles), r.random() < 0.15, int(r.random() < 0.3)) for _ in range(n)]


def test_best_repair_equals_a_plain_search():
    r = random.Random(5)
    for _ in range(4000):
        turns = some_turns(r, r.randint(0, 12), r.choice(["ua", "uuuaaast", "t", "sssu", "u", "uas"]))
        assert best_repair(turns) == brute(turns)
    for n in (60, 150):
        turns = some_turns(r, n)
        assert best_repair(turns) == brute(turns)


def test_every_repair_follows_the_grammar():
    r = random.Random(6)
    names = {"u": "user", "a": "assistant", "s": "system", "t": "tool"}
    for _ in range(500):
        turns = some_turns(r, r.randint(0, 10))
        cost, audit = best_repair(turns)
        rows, _ = repaired([(names[t.initial], "x") for t in turns], audit)
        assert GRAMMAR.fullmatch("".join(role[0] for role, _ in rows))
        assert len(audit.replace("I", "")) == len(turns)


def test_chunks_compose():
    """Tables from state to state, put together, give the whole's least cost and audit."""
    r = random.Random(7)
    for _ in range(400):
        turns = some_turns(r, r.randint(1, 14))
        states = {"^": (0, "")}
        cut = sorted(r.sample(range(len(turns) + 1), min(2, len(turns))))
        for i, j in zip([0, *cut], [*cut, len(turns)]):
            found = defaultdict(list)
            for (b, e), (cost, audit) in alignments(turns[i:j]).items():
                if b in states:
                    found[e].append((states[b][0] + cost, states[b][1] + audit))
            states = {e: min(options) for e, options in found.items()}
        assert min(states[s] for s in "^a" if s in states) == brute(turns)


def expected(rows):
    """The contract's row for the turns (number, role, text) of one conversation, in order."""
    counts, seen, turns = defaultdict(int), set(), []
    for _, role, text in rows:
        inner = text.strip(" \t\n\x0b\x0c\r")
        if not inner:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        else:
            fault = "truncated" if inner[-1] not in ".!?" else "none"
        counts[fault] += 1
        seen.add((role, text))
        turns.append(Turn(role[:1], fault in ("blank", "duplicate"), int(fault == "truncated")))
    pairs = zip(rows, rows[1:])
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs)
    cost, audit = brute(turns)
    kept, _ = repaired([(role, text) for _, role, text in rows], audit)
    lines = "\n".join(f"{role}:{text}" for role, text in kept)
    numbers = {n for n, _, _ in rows if n is not None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    digest = hashlib.sha256(lines.encode()).hexdigest()
    faults = (counts["blank"], counts["duplicate"], counts["truncated"])
    return (gaps, *faults, illegal, cost, audit, digest)


def in_order(rows):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest())
    return sorted(rows, key=key)


def found_by(spark, rows, **settings):
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, n int")
    out = turn_alignment.repair(frame)
    audits = {r.conv_id: tuple(r)[1:] for r in out.audits.collect()}
    hashes = {r.conv_id: r.sha256 for r in out.hashes().collect()}
    assert audits.keys() == hashes.keys()
    turns = defaultdict(list)
    for r in out.turns().orderBy("part", "seq", "place").collect():
        turns[r.conv_id].append((r.role, r.text))
    for conv, digest in hashes.items():
        lines = "\n".join(f"{role}:{text}" for role, text in turns[conv])
        assert hashlib.sha256(lines.encode()).hexdigest() == digest
    return {c: (*audits[c], hashes[c]) for c in audits}


@pytest.mark.parametrize("chunk", [3, 256])
def test_conversations_of_all_lengths(spark, monkeypatch, chunk):
    """One conversation has a third of all turns; repeats, ties, unnumbered and unknown turns."""
    monkeypatch.setattr(turn_alignment, "CHUNK", chunk)
    r = random.Random(chunk)
    rows = []
    for conv in [*range(60), *[60] * 30, None]:
        for turn in range(r.randint(1, 9)):
            rows.append(
                (conv, r.choice([turn, turn, None, turn + 2]),
                 r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                 r.choice(["Yes.", "no", " ", "", None, f"text {r.randint(0, 30)}!", "a\n.\n"]), 0)
            )
    of = defaultdict(list)
    for conv, turn, role, text, _ in rows:
        of[conv].append((turn, " " if role is None else role, " " if text is None else text))
    assert found_by(spark, rows) == {c: expected(in_order(turns)) for c, turns in of.items()}


def test_one_turn_repeated_many_times(spark):
    rows = [(1, 0, "user", "Hello.", 0)] * 3000 + [(1, 1, "assistant", "Yes.", 0), (2, 5, "user", "x" * 300_000, 0)]
    found = found_by(spark, rows)
    assert found[1][:7] == (0, 0, 2999, 0, 2999, 3 * 2999, "K" + "D" * 2999 + "K")
    # Deleted for 3; kept with a turn inserted it would cost 3 as well.
    assert found[2][:7] == (0, 0, 0, 1, 0, 3, "D")


def test_query_equals_the_contract(spark):
    data = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    of = {r.conv_id: [] for r in data}
    for r in data:
        kind = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", r.text)}.get(kind, r.text)
        turn = (r.turn, "user" if kind == 4 else r.role, text)
        of[r.conv_id] += [turn] * {0: 0, 3: 2}.get(kind, 1)
    found = {r.conv_id: tuple(r)[1:] for r in queries.op13_turn_alignment(spark, SF).collect()}
    assert found == {c: expected(in_order(turns)) for c, turns in of.items()}


def test_empty(spark):
    frame = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    out = turn_alignment.repair(frame)
    assert out.audits.count() == out.hashes().count() == out.turns().count() == 0
