import hashlib
import re

import pytest

from catalogflow.llm import wu_manber
from catalogflow.llm.queries import QUERIES, SQL
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
DIGITS = "one two three four five six seven eight nine ten"


def brute(docs, items):
    def words(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for window, of in windows.items():
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    found |= of
        names = sorted(str(x) for x in found if x is not None)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=repr)


ITEMS = [
    (1, DIGITS + " eleven"), (2, "Two words"), (3, None), (4, " ... "), (None, "lonely"),
    (10, DIGITS.upper()), (2, "Two words"), (7, "été 42"),
]
DOCS = [
    (1, f"x {DIGITS.replace(' ', ', ')}; eleven"), (2, "two-words and TWO words"), (3, None), (4, ""),
    (5, "lonely"), (5, "lonely"), (6, "one " * 300), (7, "Été 42 été 42"), (8, f"{DIGITS}x"),
    (None, f"{DIGITS} {DIGITS}"), (9, "wordstwo words"), (10, "étÉ 42"),
]


def frames(spark):
    return (
        spark.createDataFrame(DOCS, "doc_id bigint, text string"),
        spark.createDataFrame(ITEMS, "item_id bigint, text string"),
    )


def test_equals_brute_force(spark, rows):
    docs, items = frames(spark)
    assert rows(wu_manber.decontaminate(docs, items)) == brute(DOCS, ITEMS)


def test_several_passes_give_the_same(spark, rows, monkeypatch):
    monkeypatch.setattr(wu_manber, "PATTERNS_PER_PASS", 4)
    docs, items = frames(spark)
    assert rows(wu_manber.decontaminate(docs, items)) == brute(DOCS, ITEMS)


def test_clean_keeps_the_rest(spark, odd, empty):
    docs, items = frames(spark)
    kept = {r.doc_id for r in wu_manber.clean(docs, items).collect()}
    assert kept == {d for d, *_, hit in brute(DOCS, ITEMS) if not hit}
    none = items.limit(0)
    assert wu_manber.clean(odd, none).columns == odd.columns
    assert wu_manber.clean(odd, none).count() == odd.count()
    assert wu_manber.clean(empty, items).count() == 0


def test_equals_sql(spark):
    name = "op9_wu_manber"
    assert compare(spark, connect(SF), QUERIES[name], SQL[name], SF) is None


@pytest.mark.parametrize("low, high", [(1, 3), (8, 14)])
def test_search_finds_all(low, high):
    import random

    r = random.Random(low)
    patterns = {" ".join(r.choices("ab abc b ca".split(), k=r.randint(low, high))) for _ in range(60)}
    table = wu_manber.WuManber([p.encode() for p in patterns])
    text = (" " + " ".join(r.choices("ab abc b ca".split(), k=3000)) + " ").encode()
    want = sorted(
        (m.start(), p) for p in table.patterns for m in re.finditer(b"(?=" + re.escape(p) + b")", text)
    )
    assert sorted((at, table.patterns[k]) for at, k in table.search(text)) == want
