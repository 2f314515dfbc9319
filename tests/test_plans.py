"""The shape of plans: what must reach the scan, what must not appear, what must be split."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401
from catalogflow.bindings.registry import QUERIES
from catalogflow.operators import aggregates, keys
from catalogflow.plans import lookup, rated_movies, unmatched

SF = "/root/testdata/sf0.001"


def _physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["avg_rating", "ratings_per_title", "batch_touched_avg"])
def test_scans_read_only_the_columns_used(spark, name):
    plan = _physical(QUERIES[name](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all("l_extendedprice" not in s and "l_tax" not in s for s in schemas)


@pytest.mark.parametrize(
    "name, predicate",
    [("point_lookup", "EqualTo(p_partkey,42)"), ("recent_day", "GreaterThan(ts,")],
)
def test_predicates_reach_the_scan(spark, name, predicate):
    plan = _physical(QUERIES[name](spark, SF))
    assert predicate in re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)


@pytest.mark.parametrize(
    "name", sorted(n for n in QUERIES if not n.startswith("stream_"))
)
def test_no_python_workers_and_no_cross_joins(spark, name):
    plan = _physical(QUERIES[name](spark, SF))
    assert not re.search(r"EvalPython|MapInPandas|CartesianProduct|NestedLoopJoin", plan)


@pytest.fixture
def large_tables(spark):
    """Makes small test tables count as large ones."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _hot(spark, n=60_000):
    """A third of all rows has key 0."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 2000)
    return spark.range(0, n, 1, 8).select(
        key.cast("bigint").alias("item_id"), F.col("id").alias("user_id"), F.lit(1.0).alias("rating")
    )


def _movies(spark, n=1500):
    return spark.range(n).select(
        F.col("id").alias("item_id"), F.concat(F.lit("t"), "id").alias("title")
    )


def test_hot_keys_are_split_in_joins(spark, large_tables):
    ratings, movies = _hot(spark), _movies(spark)
    inside = ratings.filter("item_id < 1500").count()
    for joined, expected in (
        (rated_movies(ratings, movies), inside),
        (keys.with_keys(ratings, movies, "item_id"), inside),
        (keys.without_keys(ratings, movies, "item_id"), 60_000 - inside),
    ):
        assert len(joined.collect()) == expected
        assert "SortMergeJoin(skew=true)" in _physical(joined)


def test_hot_names_are_split_in_lookups(spark, large_tables):
    names = _hot(spark).select("item_id", F.concat(F.lit("n"), "item_id").alias("actor_name"))
    known = _movies(spark).select(
        F.col("item_id").alias("actor_id"), F.concat(F.lit("n"), "item_id").alias("actor_name")
    )
    found, missing = lookup(names, known, "actor_name", "actor_id"), unmatched(names, known, "actor_name")
    assert len(found.collect()) + len(missing.collect()) == 60_000
    assert "SortMergeJoin(skew=true)" in _physical(found)


def test_hot_items_are_combined_before_the_shuffle(spark, large_tables):
    totals = aggregates.rating_totals(_hot(spark))
    totals.collect()
    plan = _physical(totals)
    assert plan.index("partial_sum") > plan.index("Exchange hashpartitioning")
    per_title = aggregates.ratings_per_title(_hot(spark), _movies(spark))
    assert per_title.agg(F.max("ratings")).first()[0] >= 20_000


def test_touched_items_filter_early_when_few_and_late_when_many(spark, large_tables):
    ratings, batch = _hot(spark), _movies(spark, 50)

    def order():
        plan = _physical(aggregates.average_for_touched(ratings, batch))
        plan = plan[plan.index("Initial Plan") :] if "Initial Plan" in plan else plan
        return plan.index("partial_sum") < plan.index("LeftSemi")

    assert not order()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert order()


def test_a_bucketed_dimension_is_not_shuffled(spark, large_tables, tmp_path):
    """Neither by a lookup nor by the movies job, whatever its size."""
    from catalogflow.sinks import bucket_table
    from catalogflow.streaming.jobs import _listed_names

    dimension = _movies(spark).select(
        F.col("item_id").alias("actor_id"), F.concat(F.lit("n"), "item_id").alias("actor_name")
    )
    bucket_table(dimension, "known_actors", "actor_name", 16, str(tmp_path / "actors"))
    try:
        known = spark.table("known_actors")
        names = _hot(spark, 3000).select("item_id", F.concat(F.lit("n"), "item_id").alias("actor_name"))
        for joined in (lookup(names, known, "actor_name", "actor_id"), unmatched(names, known, "actor_name")):
            plan = _physical(joined)
            below = plan[plan.index("SortMergeJoin") :].split("Exchange hashpartitioning(actor_name")
            assert len(below) == 2 and plan.count("Bucketed: true") == 1
        films = spark.createDataFrame(
            [(1, "g", "n1, n2", "d")], "item_id bigint, genres string, starring string, directedBy string"
        )
        empty = {n: spark.createDataFrame([], f"{n[:-1]}_id bigint, {n[:-1]}_name string") for n in ("genres", "directors")}
        found = _listed_names(films, lambda n: known if n == "actors" else empty[n])
        assert found.filter("kind = 'actors' AND id IS NOT NULL").count() == 2
        part = _physical(found.filter("kind = 'actors'"))
        assert "Bucketed: true" in part
        for line in part.split("\n"):
            assert not ("Exchange" in line and "actor_id" in line)
    finally:
        spark.sql("DROP TABLE known_actors")
