import random

import pytest
from pyspark.sql import functions as F

from catalogflow.operators.numbering import (
    _rank, factorize, number_rows, number_values,
)
from catalogflow.plans import bridge_rows, list_names, lookup, normalize, unmatched


def test_numbers_are_dense_and_ordered(spark):
    values = list(range(1000))
    random.Random(1).shuffle(values)
    frame = spark.createDataFrame([(v,) for v in values], "v int").repartition(7)
    numbered = number_rows(frame, F.desc("v"), name="n")
    assert {(r.v, r.n) for r in numbered.collect()} == {(v, 1000 - v) for v in values}


def test_one_value_may_fill_most_of_the_table(spark):
    frame = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("n"), "id")).alias("v")
    )
    got = number_values(frame, "v", "id", name="n")
    assert got.count() == 1001
    assert got.filter("v = 'hot'").first()["n"] == 2
    assert got.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()[:] == (1, 1001, 1001)


def test_empty_table(spark):
    assert number_rows(spark.range(0), "id", name="n").count() == 0


def test_factorize(spark, rows):
    frame = spark.createDataFrame([(1, "b"), (2, None), (3, "a"), (4, "b")], "i int, v string")
    coded, index = factorize(frame, "v", "i")
    assert rows(coded, "i", "code") == [(1, 0), (2, -1), (3, 1), (4, 0)]
    assert rows(index, "code", "v") == [(0, "b"), (1, "a")]


@pytest.mark.parametrize("kinds", ["a bigint, b int", "a string, b bigint"])
def test_rank_orders_as_the_columns_do(spark, kinds):
    edge = [None, -(2**63), -5, -1, 0, 1, 7, 2**63 - 1]
    small = [None, -(2**31), -1, 0, 1, 2**31 - 1]
    pairs = [(a, b) for a in edge for b in small]
    if kinds.startswith("a string"):
        pairs = [(a if a is None else str(a), b) for a, b in pairs]
    frame = spark.createDataFrame(pairs, kinds)
    by_rank = frame.orderBy(_rank(frame, ("a", "b"))).collect()
    assert by_rank == frame.orderBy("a", "b").collect()


def test_first_appearance_is_kept_in_a_hash_table(spark, movies):
    names = list_names(movies, "starring", "mixed", "actor_name")
    first = names.groupBy("actor_name").agg(F.min(_rank(names, ("item_id", "pos"))))
    assert "SortAggregate" not in first._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def movies(spark):
    cells = [(2, "B, A"), (1, "A,,A"), (3, None), (4, "C\tA "), (5, "")]
    return spark.createDataFrame(cells, "item_id bigint, starring string")


def test_normalize(movies, rows):
    got = normalize(movies, "starring", "mixed", "actor_id", "actor_name")
    # the comma run in "A,,A" is one delimiter; item 1 comes first
    assert rows(got.dimension, "actor_id", "actor_name") == [(1, "A"), (2, "B"), (3, "C"), (4, "")]
    assert rows(got.bridge) == [(1, 1), (1, 1), (2, 1), (2, 2), (4, 1), (4, 3), (5, 4)]


def test_normalize_options(movies, rows):
    got = normalize(
        movies, "starring", "mixed", "actor_id", "actor_name",
        keep_null=True, drop_empty=True, dedup=True,
    )
    assert rows(got.dimension, "actor_name") == sorted([("A",), ("B",), ("C",), (None,)], key=repr)
    null_id = got.dimension.filter("actor_name IS NULL").first()["actor_id"]
    assert rows(got.bridge) == [(1, 1), (2, 1), (2, 2), (3, null_id), (4, 1), (4, 4)]
    assert null_id == 3


def test_bridge_gives_back_the_source(movies, rows):
    names = list_names(movies, "starring", "mixed", "actor_name")
    got = normalize(movies, "starring", "mixed", "actor_id", "actor_name")
    back = got.bridge.join(got.dimension, "actor_id")
    assert rows(back, "item_id", "actor_name") == rows(names, "item_id", "actor_name")


def test_lookup_drops_and_reports_unknown_names(spark, movies, rows):
    names = list_names(movies, "starring", "mixed", "actor_name")
    known = spark.createDataFrame([(7, "A")], "actor_id bigint, actor_name string")
    assert rows(lookup(names, known, "actor_name", "actor_id")) == [(1, 7), (1, 7), (2, 7), (4, 7)]
    assert rows(unmatched(names, known, "actor_name")) == [(2, "B"), (4, "C"), (5, "")]
    assert bridge_rows(names, known, "actor_name", "actor_id").count() == names.count()
