import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catalogflow.functions import sentiment, split_list, strip, title_year, tokens
from catalogflow.functions.text import NEGATIVE_WORDS, POSITIVE_WORDS, WHITESPACE

_GAPS = st.text(alphabet=list(WHITESPACE), min_size=0, max_size=3)
_WORDS = st.sampled_from(["good", "GREAT", "bad", "Sad", "great!", "plain", "ümlaut", "ß", ""])
_TEXTS = st.lists(st.tuples(_GAPS, _WORDS), max_size=8).map(
    lambda pairs: "".join(gap + word for gap, word in pairs)
)


def _apply(spark, expression, values):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in frame.orderBy("i").select(expression(F.col("v"))).collect()]


def _rule(text):
    words = set(text.lower().split())
    good, bad = words & set(POSITIVE_WORDS), words & set(NEGATIVE_WORDS)
    return "positive" if good and not bad else "negative" if bad and not good else "neutral"


@pytest.mark.parametrize(
    "title, year",
    [
        ("Toy Story (1995)", 1995), ("2001: A (1968) (1969)", 1968), ("A (12345)", None),
        ("A (199)", None), ("", None), (None, None), ("(0007)", 7),
    ],
)
def test_title_year(spark, title, year):
    assert _apply(spark, title_year, [title]) == [year]


def test_lists(spark):
    assert _apply(spark, lambda c: split_list(c, "pipe"), ["A|B", "", "|A ", None]) == [
        ["A", "B"], [""], ["", "A "], None,
    ]
    mixed = [" A, B,,C\t\nD ,", ",A", "", None]
    assert _apply(spark, lambda c: split_list(c, "mixed"), mixed) == [
        ["A", "B", "C", "D", ""], ["", "A"], [""], None,
    ]


def test_sentiment_examples(spark):
    texts = ["A great buy", "Terrible page", "good but sad", "plain visit", "great!", "", None]
    assert _apply(spark, sentiment, texts) == [
        "positive", "negative", "neutral", "neutral", "neutral", "neutral", None,
    ]


def test_sentiment_with_other_words(spark):
    label = lambda c: sentiment(c, ("oui",), ("non",))
    assert _apply(spark, label, ["oui", "non", "oui non", "good"]) == [
        "positive", "negative", "neutral", "neutral",
    ]


@settings(max_examples=8, deadline=None)
@given(st.lists(_TEXTS, min_size=20, max_size=40))
def test_text_rules_match_python(spark, texts):
    assert _apply(spark, sentiment, texts) == [_rule(x) for x in texts]
    assert _apply(spark, strip, texts) == [x.strip() for x in texts]
    assert _apply(spark, tokens, texts) == [x.lower().split() for x in texts]
    parts = [[p.strip() for p in re.split(r"[,\t\n]+", x)] for x in texts]
    assert _apply(spark, lambda c: split_list(c, "mixed"), texts) == parts
