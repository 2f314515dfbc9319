from datetime import timedelta

from pyspark.sql import functions as F

from catalogflow.operators import keys, sampling
from catalogflow.plans import (
    flag_holdout, flagged_holdout, holdout, link_catalogue, merge_catalogue, recent_rows,
)


def _movies(spark, n=300):
    return spark.range(n).select(F.col("id").alias("item_id"), F.lit("t").alias("title"))


def test_membership_keeps_rows_without_a_key_on_the_other_side(spark, rows):
    frame = spark.createDataFrame([(1,), (2,), (2,), (None,)], "item_id bigint")
    held = spark.createDataFrame([(2,), (2,)], "item_id bigint")
    assert rows(keys.with_keys(frame, held, "item_id")) == [(2,), (2,)]
    assert rows(keys.without_keys(frame, held, "item_id")) == [(1,), (None,)]
    assert rows(flag_holdout(frame, held)) == sorted(
        [(1, "db"), (2, "stream"), (2, "stream"), (None, "db")], key=repr
    )


def test_sample_is_the_same_for_any_layout(spark, rows):
    movies = _movies(spark)
    once = rows(sampling.sample_rows(movies, 10, "item_id"))
    assert once == rows(sampling.sample_rows(movies.repartition(7, "title"), 10, "item_id"))
    assert len(once) == 10
    assert once != rows(sampling.sample_rows(movies, 10, "item_id", seed=1))


def test_large_sample_contains_the_small_one(spark, rows):
    movies = _movies(spark, 2000)
    small = set(rows(sampling.sample_rows(movies, 10, "item_id")))
    large = rows(sampling.sample_rows(movies, 1500, "item_id"))
    assert len(large) == 1500 and small < set(large)


def test_fraction(spark):
    movies = _movies(spark, 20_000)
    assert 900 < sampling.sample_fraction(movies, 0.05, "item_id").count() < 1100
    assert sampling.sample_fraction(movies, 0, "item_id").count() == 0
    assert sampling.sample_fraction(movies, 1, "item_id").count() == 20_000


def test_sides_are_disjoint_and_complete(spark, rows):
    movies = _movies(spark)
    facts = spark.range(2000).select((F.col("id") % 310).alias("item_id"), "id")
    facts = facts.unionByName(spark.createDataFrame([(None, -1)], "item_id bigint, id bigint"))
    for how in ({"n": 10}, {"fraction": 0.2}):
        sides = holdout(movies, {"facts": facts}, **how)
        for table, whole in (("movies", movies), ("facts", facts)):
            stream = sides.stream[table].select(*whole.columns)
            assert rows(stream.unionByName(sides.db[table])) == rows(whole)
        held = {r[0] for r in rows(sides.stream["movies"], "item_id")}
        assert held and held.isdisjoint(r[0] for r in rows(sides.db["facts"], "item_id"))
        assert sides.stream["movies"].first()["neutral_reviews"] == 0
        flagged = flagged_holdout(movies, {"facts": facts}, **how)
        for table in ("movies", "facts"):
            side = flagged[table].filter("split = 'stream'").drop("split")
            assert rows(side) == rows(sides.stream[table].select(*side.columns))
            assert flagged[table].filter("split IS NULL").count() == 0


def test_null_or_empty(spark, rows):
    frame = spark.createDataFrame([("",), (None,), (" ",)], "g string")
    assert rows(keys.null_or_empty(frame, "g")) == sorted([("",), (None,)], key=repr)


def test_recent_rows(spark, rows):
    frame = spark.sql(
        "SELECT id, TIMESTAMP '2024-01-01 00:00:00' + make_dt_interval(0, 0, id) AS ingest_ts "
        "FROM range(10)"
    )
    as_of = F.lit("2024-01-01 00:09:00").cast("timestamp")
    assert rows(recent_rows(frame, as_of), "id") == [(i,) for i in range(5, 10)]
    assert rows(recent_rows(frame, as_of, limit=2), "id") == [(8,), (9,)]
    assert rows(recent_rows(frame, as_of, timedelta(minutes=1)), "id") == [(9,)]
    assert recent_rows(frame).count() == 0


def test_merge_keeps_the_metadata_side(spark, rows):
    catalogue = spark.createDataFrame(
        [(1, "X", "g|h"), (2, "Y", "g")], "movieId bigint, title string, genres string"
    )
    links = spark.createDataFrame(
        [(1, "i1", 10), (3, "i3", 30)], "movieId bigint, imdbId string, tmdbId int"
    )
    metadata = spark.createDataFrame(
        [(1, "A", "d", "s", 1.5, "m1"), (2, "B", "d", "s", 2.5, "m2")],
        "item_id bigint, title string, directedBy string, starring string, avgRating double, "
        "imdbId string",
    )
    linked = link_catalogue(catalogue, links)
    assert rows(linked, "movieId", "tmdbId") == [(1, 10)]
    assert rows(merge_catalogue(metadata, linked)) == [
        (1, "A", "g|h", "d", "s", 1.5, "m1"), (2, "B", None, "d", "s", 2.5, "m2"),
    ]
