import json
from datetime import timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from catalogflow import schemas
from catalogflow.operators.aggregates import add_rating_totals, average_ratings, review_totals
from catalogflow.plans import bulk_load, movie_snapshot, stamp_loaded
from catalogflow.sources import replay_stream
from catalogflow.streaming import (
    await_all, movies_job, ratings_job, reviews_job, run_stream, running_averages,
    running_sentiment,
)
from catalogflow.streaming.stateful import current_averages, current_sentiment
from catalogflow.tables import LOADED, Tables


@pytest.fixture
def topic(tmp_path):
    """Writes messages as files and gives their folder."""

    def write(name, files):
        folder = tmp_path / name
        folder.mkdir(exist_ok=True)
        have = len(list(folder.iterdir()))
        for n, messages in enumerate(files):
            lines = [m if isinstance(m, str) else json.dumps(m) for m in messages]
            (folder / f"{have + n:03}.txt").write_text("\n".join(lines) + "\n")
        return str(folder)

    return write


@pytest.fixture
def tables(tmp_path):
    return Tables(str(tmp_path / "tables"))


def _rating(item, user, rating):
    return {"item_id": item, "user_id": user, "rating": rating}


def _run(spark, job, path, *args):
    job(replay_stream(spark, path, max_files=1), *args).awaitTermination()


DATA = [[_rating(i % 5, i, (i * 7 + f) % 6) for i in range(20)] for f in range(3)]


def test_ratings_end_as_in_batch(spark, rows, topic, tables, tmp_path):
    path = topic("ratings", DATA + [["{oops", {"user_id": 1}]])
    _run(spark, ratings_job, path, tables, str(tmp_path / "cp"))
    facts = tables.read(spark, "ratings")
    assert facts.count() == 60
    assert facts.agg(F.count_distinct("batch_id")).first()[0] == 3
    from_totals = tables.read(spark, "rating_totals")
    expected = rows(average_ratings(facts))
    films = spark.range(5).select(
        F.col("id").alias("item_id"), F.lit(0.0).alias("avgRating"),
        *[F.lit(0).alias(f"{s}_reviews") for s in ("positive", "negative", "neutral")],
    )
    no_reviews = review_totals(spark.createDataFrame([], "item_id bigint, sentiment string"))
    snapshot = movie_snapshot(films, from_totals, no_reviews)
    assert rows(snapshot, "item_id", "avgRating") == expected
    assert rows(tables.read(spark, "quarantine_ratings"), "topic", "raw") == [
        ("ratings", '{"user_id": 1}'), ("ratings", "{oops"),
    ]
    # text and instant of the ingest time agree, one per batch
    stamps = facts.select("timestamp", "ingest_ts", "batch_id").distinct()
    assert stamps.count() == 3


def test_unusable_ratings_go_to_quarantine(spark, rows, topic, tables, tmp_path):
    odd = ["1e20", "NaN", "Infinity", "four", "1e400", True]
    path = topic("ratings", [[_rating(1, 1, v) for v in odd] + [_rating(1, 2, "4.0")]])
    _run(spark, ratings_job, path, tables, str(tmp_path / "cp"))
    assert rows(tables.read(spark, "ratings"), "user_id", "rating") == [(2, 4.0)]
    assert tables.read(spark, "quarantine_ratings").count() == len(odd)


def test_whole_decimals_are_counters(spark, rows, topic, tables, tmp_path):
    film = _film(1, "g") | {"positive_reviews": "0.0", "negative_reviews": "3.00", "neutral_reviews": "2"}
    bad = _film(2, "g") | {"positive_reviews": "0.5"}
    dimensions = lambda n: spark.createDataFrame([], schemas.INPUTS[n])
    path = topic("movies", [[[film, bad]]])
    _run(spark, movies_job, path, dimensions, tables, str(tmp_path / "cp"))
    assert rows(tables.read(spark, "movies"), "item_id", "negative_reviews") == [(1, 3)]
    assert tables.read(spark, "quarantine_movies").count() == 1


def test_another_checkpoint_replaces_nothing(spark, rows, topic, tables, tmp_path):
    _run(spark, ratings_job, topic("a", DATA), tables, str(tmp_path / "cp1"))
    _run(spark, ratings_job, topic("b", [DATA[0][:3]]), tables, str(tmp_path / "cp2"))
    assert tables.read(spark, "ratings").count() == 63
    total = tables.read(spark, "rating_totals").agg(F.sum("rating_count")).first()[0]
    assert total == 63


def test_recent_reads_few_folders(spark, topic, tables, tmp_path):
    _run(spark, ratings_job, topic("ratings", DATA), tables, str(tmp_path / "cp"))
    now = F.current_timestamp()
    found = tables.recent(spark, "ratings", now)
    assert found.count() == 60
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hour" in plan and "_commits" not in plan
    assert tables.recent(spark, "ratings", F.lit("2030-01-01").cast("timestamp")).count() == 0


def test_recent_rows_of_other_hours_are_not_read(spark, rows, topic, tables, tmp_path):
    """Loaded rows are a week old: their partition is pruned, whatever the table is."""
    loaded = spark.createDataFrame([(1, 9, 5.0)], "item_id bigint, user_id bigint, rating double")
    bulk_load({"ratings": stamp_loaded(loaded)}, tables)
    _run(spark, ratings_job, topic("ratings", DATA), tables, str(tmp_path / "cp"))
    now = F.current_timestamp()
    found = tables.recent(spark, "ratings", now, timedelta(hours=2))
    assert found.count() == 60
    week = tables.recent(spark, "ratings", now, timedelta(days=8))
    assert week.count() == 61
    with pytest.raises(ValueError):
        tables.recent(spark, "rating_totals", now)


def test_batches_without_bad_messages_leave_no_quarantine(spark, rows, topic, tables, tmp_path):
    path = topic("ratings", [*DATA, ["{oops"]])
    _run(spark, ratings_job, path, tables, str(tmp_path / "cp"))
    written = (tmp_path / "tables" / "quarantine_ratings").glob("run=*/batch_id=*")
    assert sorted(p.name for p in written) == ["batch_id=-1", "batch_id=3"]


def test_a_triggered_job_takes_one_file_each_time(spark, topic, tables, tmp_path):
    path = topic("ratings", DATA)
    job = ratings_job(replay_stream(spark, path, max_files=1), tables, str(tmp_path / "cp"), "1 second")
    try:
        job.processAllAvailable()
        topic("ratings", DATA[:1])
        job.processAllAvailable()
        starts = {p["batchId"]: p["timestamp"] for p in job.recentProgress if p["numInputRows"]}
    finally:
        job.stop()
    assert tables.read(spark, "ratings").groupBy("batch_id").count().count() == 4
    assert len(set(starts.values())) == len(starts) == 4


def test_compacting_leaves_recent_rows_alone(spark, rows, topic, tables, tmp_path):
    _run(spark, ratings_job, topic("ratings", DATA), tables, str(tmp_path / "cp"))
    for name in ("ratings", "rating_totals"):
        tables.compact(spark, name)
    assert tables.recent(spark, "ratings", F.current_timestamp()).count() == 60
    assert tables.read(spark, "ratings").count() == 60
    assert tables.visible(spark, "rating_totals").filter("batch_id >= 0").count() == 1


def test_state_is_written_in_few_files(spark, topic, tmp_path):
    table = str(tmp_path / "running")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        messages = replay_stream(spark, topic("ratings", DATA))
        running_averages(messages, table, str(tmp_path / "cp")).awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    written = [f for f in (tmp_path / "running").rglob("batch_id=0/*.parquet")]
    assert 1 <= len(written) <= 4


def test_restart_continues_and_repeats_nothing(spark, rows, topic, tables, tmp_path):
    checkpoint = str(tmp_path / "cp")
    path = topic("ratings", DATA[:2])
    for _ in range(2):
        _run(spark, ratings_job, path, tables, checkpoint)
    before = rows(tables.read(spark, "ratings"))
    assert len(before) == 40
    topic("ratings", DATA[2:])
    _run(spark, ratings_job, path, tables, checkpoint)
    after = rows(tables.read(spark, "ratings"))
    assert len(after) == 60 and set(before) < set(after)


def test_failed_batch_is_repeated_under_its_id(spark, topic, tmp_path):
    path, checkpoint = topic("ratings", DATA), str(tmp_path / "cp")
    done, failing = [], [True]

    def process(batch, batch_id):
        stamp = batch.select(F.col("now").cast("string")).first()[0]
        done.append((batch_id, batch.count(), stamp))
        if batch_id == 1 and failing:
            failing.clear()
            raise RuntimeError("lost connection")

    def start():
        messages = replay_stream(spark, path, max_files=1)
        return run_stream(messages.withColumn("now", F.current_timestamp()), process, checkpoint)

    with pytest.raises(StreamingQueryException):
        start().awaitTermination()
    start().awaitTermination()
    assert [d[0] for d in done] == [0, 1, 1, 2]
    # the repeated batch has the same rows and the time of its first attempt
    assert done[1] == done[2]


def test_reviews(spark, rows, topic, tables, tmp_path):
    path = topic(
        "reviews",
        [
            [{"item_id": 1, "txt": "good"}, {"item_id": 1, "txt": "a Great one"}],
            [{"item_id": 1, "txt": "plain"}, {"item_id": 8, "txt": "sad"}, {"item_id": 2}],
        ],
    )
    _run(spark, reviews_job, path, tables, str(tmp_path / "cp"))
    assert rows(tables.read(spark, "reviews"), "item_id", "sentiment") == [
        (1, "neutral"), (1, "positive"), (1, "positive"), (8, "negative"),
    ]
    totals = tables.read(spark, "review_totals").groupBy("item_id").sum(
        "positive", "negative", "neutral"
    )
    assert rows(totals) == [(1, 2, 0, 1), (8, 0, 1, 0)]
    assert rows(tables.read(spark, "quarantine_reviews"), "raw") == [('{"item_id": 2}',)]


def test_loading_again_replaces_everything(spark, rows, topic, tables, tmp_path):
    loaded = spark.createDataFrame([(1, 9, 5.0)], "item_id bigint, user_id bigint, rating double")
    bulk_load({"ratings": stamp_loaded(loaded)}, tables)
    _run(spark, ratings_job, topic("ratings", DATA), tables, str(tmp_path / "cp"))
    assert tables.read(spark, "ratings").count() == 61
    assert add_rating_totals(tables.read(spark, "rating_totals")).count() == 5
    bulk_load({"ratings": stamp_loaded(loaded)}, tables)
    assert rows(tables.read(spark, "ratings"), "user_id", "batch_id") == [(9, LOADED)]
    assert rows(tables.read(spark, "rating_totals"), "item_id", "rating_count") == [(1, 1)]


def _film(item, genres, starring="X", title="T (1999)"):
    return {"item_id": item, "title": title, "genres": genres, "directedBy": "D",
            "starring": starring, "imdbId": "tt"}


def test_movies_see_new_dimension_entries(spark, rows, topic, tables, tmp_path):
    known = {"genres": [(1, "g")], "actors": [(5, "X")], "directors": [(9, "D")]}
    columns = {"genres": "genre", "actors": "actor", "directors": "director"}

    def dimensions(listed):
        name = columns[listed]
        return spark.createDataFrame(known[listed], f"{name}_id bigint, {name}_name string")

    path = topic("movies", [[[_film(1, "g|h"), _film(2, "g|g")]]])
    checkpoint = str(tmp_path / "cp")
    _run(spark, movies_job, path, dimensions, tables, checkpoint)
    known["genres"].append((2, "h"))
    topic("movies", [[[_film(3, "h", "X,Y")], [_film(4, "g", title=None)]]])
    _run(spark, movies_job, path, dimensions, tables, checkpoint)
    assert rows(tables.read(spark, "movies"), "item_id", "year", "avgRating", "neutral_reviews") == [
        (1, 1999, 0.0, 0), (2, 1999, 0.0, 0), (3, 1999, 0.0, 0),
    ]
    assert rows(tables.read(spark, "movies_genres"), "item_id", "genre_id") == [
        (1, 1), (2, 1), (2, 1), (3, 2),
    ]
    assert rows(tables.read(spark, "movies_directors"), "item_id", "director_id") == [
        (1, 9), (2, 9), (3, 9),
    ]
    assert rows(tables.read(spark, "unmatched"), "kind", "name", "item_id") == [
        ("actors", "Y", 3), ("genres", "h", 1),
    ]
    assert tables.read(spark, "quarantine_movies").count() == 1


@pytest.mark.parametrize("files", [1, 3])
def test_running_state_equals_batch(spark, rows, topic, tmp_path, files):
    path = topic("ratings", DATA)
    table, checkpoint = str(tmp_path / "running"), str(tmp_path / "cp")
    running_averages(replay_stream(spark, path, max_files=files), table, checkpoint).awaitTermination()
    flat = [(r["item_id"], float(r["rating"])) for f in DATA for r in f]
    batch = average_ratings(spark.createDataFrame(flat, "item_id bigint, rating double"))
    assert rows(current_averages(spark, table)) == rows(batch)


def test_running_sentiment(spark, rows, topic, tmp_path):
    path = topic("reviews", [[{"item_id": 1, "txt": "good"}], [{"item_id": 1, "txt": "bad"}]])
    table, checkpoint = str(tmp_path / "running"), str(tmp_path / "cp")
    running_sentiment(replay_stream(spark, path, max_files=1), table, checkpoint).awaitTermination()
    assert rows(current_sentiment(spark, table)) == [(1, 1, 1, 0)]


def test_await_all_stops_the_others_when_one_fails(spark, topic, tmp_path):
    path = topic("ratings", DATA)

    def fail(batch, batch_id):
        raise RuntimeError("no")

    steady = run_stream(
        replay_stream(spark, path), lambda b, n: None, str(tmp_path / "a"), "1 second"
    )
    broken = run_stream(replay_stream(spark, path), fail, str(tmp_path / "b"), "1 second")
    with pytest.raises(StreamingQueryException):
        await_all([steady, broken])
    assert not steady.isActive


def test_three_jobs_at_once(spark, topic, tables, tmp_path):
    ratings = replay_stream(spark, topic("ratings", DATA), max_files=1)
    reviews = replay_stream(spark, topic("reviews", [[{"item_id": 1, "txt": "good"}]]))
    await_all(
        [
            ratings_job(ratings, tables, str(tmp_path / "cp1")),
            reviews_job(reviews, tables, str(tmp_path / "cp2")),
        ]
    )
    assert tables.read(spark, "ratings").count() == 60
    assert tables.read(spark, "reviews").count() == 1
