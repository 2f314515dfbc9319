"""Runs found by tiles against a plain scan over every period."""

import hashlib
import random
import zlib
from fractions import Fraction

import pytest

from catalogflow.llm import periodic_runs, queries
from tests.llm.conftest import ODD_ROWS

SF = "/root/testdata/sf0.001"


def brute(words):
    """start, length, period of all runs, by comparing the words of every period."""
    found = set()
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(6, 4 * q):
                found.add((s, i + q - s, q))

    def shorter(run):
        return any(
            run[2] % d == 0 and d < run[2] and s <= run[0] and s + n >= run[0] + run[1]
            for s, n, d in found
        )

    return sorted(r for r in found if not shorter(r))


def left(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def texts(seed, n):
    r = random.Random(seed)
    for _ in range(n):
        letters, size, out = r.choice([1, 2, 2, 3, 5, 50]), r.choice([3, 10, 40, 150, 400]), []
        while len(out) < size:
            if r.random() < 0.5:
                out += [r.randrange(letters) for _ in range(r.randint(1, 20))]
            else:
                part = [r.randrange(letters) for _ in range(r.randint(1, r.choice([3, 10, 40])))]
                out += (part * r.randint(2, 9))[: r.randint(1, 400)]
        yield " ".join(map(str, out))


@pytest.mark.parametrize("tile_words", [2, 4096])
def test_runs_equal_a_plain_scan(spark, monkeypatch, tile_words):
    monkeypatch.setattr(periodic_runs, "TILE_WORDS", tile_words)
    rows = list(enumerate(texts(tile_words, 400)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r for r in periodic_runs.collapse_runs(docs).collect()}
    assert sum(len(r.runs) for r in found.values()) > 300
    for i, text in rows:
        words = text.encode().split()
        runs = brute(words)
        assert [tuple(r) for r in found[i].runs] == runs
        assert found[i].text.encode() == left(words, runs)


def test_run_over_many_tiles(spark):
    """A long document whose runs stretch over several tiles, with a break inside."""
    part = [f"w{i}" for i in range(700)]
    words = ["a"] * 9000 + part * 9 + ["x"] + part * 4 + ["a", "b"] * 3000
    docs = spark.createDataFrame([(1, "\n".join(words))], "doc_id bigint, text string")
    row = periodic_runs.collapse_runs(docs).first()
    assert [tuple(r) for r in row.runs] == [
        (0, 9000, 1), (9000, 6300, 700), (15301, 2800, 700), (18101, 6000, 2),
    ]
    assert row.text.split() == ["a", *part, "x", *part, "a", "b"]


def test_odd_rows(spark, odd, empty):
    found = sorted((r.doc_id or 0, r.n_words, r.text) for r in periodic_runs.collapse_runs(odd).collect())
    plain = {2: "", 5: "word", 7: "line"}
    want = [
        (i or 0, len((t or "").split()), plain.get(i, " ".join((t or "").split()))) for i, t in ODD_ROWS
    ]
    assert found == sorted(want)
    assert periodic_runs.collapse_runs(empty).count() == 0
    assert periodic_runs.collapse_runs(empty, with_text=False).columns == [
        "doc_id", "n_words", "runs", "kept_sha256",
    ]


def test_query_equals_the_contract(spark):
    found = {r.doc_id: r for r in queries.op12_scale_tiles(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(found) == len(docs) and any(r.n_runs for r in found.values())
    for r in docs:
        words = (r.text or "").encode().split()
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute(words)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
        lines = "".join("%d,%d,%d\n" % x for x in runs)
        row = found[r.doc_id]
        assert (row.n_runs, row.start, row.length, row.period) == (len(runs), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(left(words, runs)).hexdigest()
