import hashlib
import random
import re

from catalogflow.llm import substring_dedup
from catalogflow.llm.queries import QUERIES, SQL
from tests.oracle import compare, connect
from tests.llm.conftest import ODD_ROWS

SF = "/root/testdata/sf0.001"


def brute(rows):
    from collections import Counter

    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    windows = Counter(tuple(w[i : i + 35]) for w in words for i in range(len(w) - 34))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - 34):
            if windows[tuple(w[i : i + 35])] > 1:
                gone.update(range(i, i + 35))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=repr)


def cases():
    """Copies with edits, shifted passages, repeats inside one text, and few different words."""
    r = random.Random(5)
    word = lambda: "".join(r.choices("abcdefg", k=r.randint(1, 4)))
    base = [word() for _ in range(400)]
    rows = [(0, " ".join(base)), (1, " ".join(base))]
    for i in range(2, 40):
        copy = list(base)
        for at in r.sample(range(400), r.choice((1, 5, 12, 40))):
            copy[at] = word()
        cut = r.randint(0, 200)
        rows.append((i, " ".join([word() for _ in range(r.randint(0, 60))] + copy[cut : cut + r.randint(30, 200)])))
    passage = [word() for _ in range(36)]
    rows += [(40 + i, " ".join([*[word() for _ in range(20)], *passage[: 34 + i % 3], word()])) for i in range(9)]
    rows += [(60, "a " * 100), (61, "a " * 34), (62, "a b " * 40), (63, "b a " * 18), (64, " ".join(passage * 2))]
    return rows


def test_equals_brute_force(spark, rows):
    data = cases() + ODD_ROWS[:6] + [(8, "x y z " * 100), (None, "same id " * 20), (None, "other id " * 20)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string").repartition(5)
    assert rows(substring_dedup.remove_repeats(docs)) == brute(data)


def test_equals_sql(spark):
    name = "op2_substring_dedup"
    assert compare(spark, connect(SF), QUERIES[name], SQL[name], SF) is None


def test_odd_rows(odd, empty, rows):
    assert rows(substring_dedup.remove_repeats(odd)) == brute(ODD_ROWS)
    assert substring_dedup.remove_repeats(empty).count() == 0
