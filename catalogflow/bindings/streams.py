"""The streaming jobs over replayed tables; each must end where the batch query does."""

from __future__ import annotations

import time
from datetime import timedelta

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from catalogflow import schemas
from catalogflow.bindings import tables as t
from catalogflow.bindings.catalogue import REVIEW_TOTALS_SQL, SNAPSHOT_SQL
from catalogflow.bindings.registry import query
from catalogflow.operators.aggregates import add_rating_totals, add_review_totals, average
from catalogflow.plans import bulk_load, current_movies, normalize, replay, serving, stamp_loaded
from catalogflow.plans.bulkload import prepare_movies, prepare_reviews
from catalogflow.session import work_folder
from catalogflow.sinks import message_per_row, to_replay
from catalogflow.sources import replay_stream
from catalogflow.streaming import (
    Catalogue, GrowingDimensions, await_all, averages_after_load, catalogue_job, movies_job, ratings_job, reviews_job, running_averages, running_sentiment,
    sentiment_after_load,
)
from catalogflow.streaming.history import averages_so_far, sentiment_so_far
from catalogflow.streaming.progress import ProgressLog, rows_per_query
from catalogflow.streaming.stateful import current_averages, current_sentiment
from catalogflow.tables import Tables


def _messages(spark, topic, frame):
    """The table as a stream of about four micro-batches."""
    path = work_folder(spark, f"topic-{topic}")
    replay(topic, frame, path, per_file=frame.count() // 4 + 1)
    files = len(spark.read.text(path).inputFiles())
    return replay_stream(spark, path, max_files=files // 4 + 1)


def _counted(movies):
    return movies.withColumns(
        {f"{s}_reviews": F.lit(0) for s in ("positive", "negative", "neutral")}
    )


def _run(job, *args):
    """Work off the topic; a failed batch raises here."""
    job(*args).awaitTermination()


def _tables(spark):
    root = work_folder(spark, "tables")
    return Tables(root), f"{root}/checkpoints"


@query(f"SELECT item_id, {t.AVERAGE} FROM ({t.RATINGS}) GROUP BY item_id")
def stream_avg_rating(spark, sf):
    """Averages from the totals the ratings job appended."""
    tables, checkpoints = _tables(spark)
    messages = _messages(spark, "ratings", t.ratings(spark, sf))
    _run(ratings_job, messages, tables, f"{checkpoints}/ratings")
    totals = add_rating_totals(tables.read(spark, "rating_totals"))
    return totals.select("item_id", average().alias("avgRating"))


@query(f"SELECT item_id, {t.AVERAGE} FROM ({t.RATINGS}) GROUP BY item_id")
def stream_after_load(spark, sf):
    """Half of the ratings loaded, the rest streamed: averages cover both."""
    tables, checkpoints = _tables(spark)
    by_status = t.load(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("item_id"),
        F.col("l_suppkey").alias("user_id"),
        F.col("l_quantity").alias("rating"),
        "l_linestatus",
    )
    old, new = (by_status.filter(F.col("l_linestatus") == s).drop("l_linestatus") for s in "OF")
    bulk_load({"ratings": stamp_loaded(old)}, tables)
    _run(ratings_job, _messages(spark, "ratings", new), tables, f"{checkpoints}/ratings")
    totals = add_rating_totals(tables.read(spark, "rating_totals"))
    return totals.select("item_id", average().alias("avgRating"))


@query(t.RATINGS)
def stream_restart(spark, sf):
    """The ratings job run a second time from its checkpoint adds nothing."""
    tables, checkpoints = _tables(spark)
    messages = _messages(spark, "ratings", t.ratings(spark, sf))
    for _ in range(2):
        _run(ratings_job, messages, tables, f"{checkpoints}/ratings")
    return tables.read(spark, "ratings").select("item_id", "user_id", "rating")


@query(f"SELECT item_id, {t.AVERAGE} FROM ({t.RATINGS}) GROUP BY item_id")
def stream_avg_rating_state(spark, sf):
    """Averages from running totals in streaming state."""
    tables, checkpoints = _tables(spark)
    messages = _messages(spark, "ratings", t.ratings(spark, sf))
    _run(running_averages, messages, tables.path("running"), f"{checkpoints}/running")
    return current_averages(spark, tables.path("running"))


def _halves(spark, sf):
    """The ratings of lines by status: those to be loaded and those to be streamed."""
    lines = t.load(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("item_id"),
        F.col("l_suppkey").alias("user_id"),
        F.col("l_quantity").alias("rating"),
        "l_linestatus",
    )
    return [lines.filter(F.col("l_linestatus") == s).drop("l_linestatus") for s in "OF"]


@query(f"SELECT item_id, {t.AVERAGE} FROM ({t.RATINGS}) GROUP BY item_id")
def stream_state_after_load(spark, sf):
    """Half of the ratings loaded; the state that the others go to begins with their totals."""
    tables, checkpoints = _tables(spark)
    old, new = _halves(spark, sf)
    bulk_load({"ratings": stamp_loaded(old)}, tables)
    loaded = add_rating_totals(tables.read(spark, "rating_totals"))
    running = tables.path("running")
    messages = _messages(spark, "ratings", new)
    _run(averages_after_load, messages, loaded, running, f"{checkpoints}/running")
    return averages_so_far(spark, running, loaded)


@query(REVIEW_TOTALS_SQL)
def stream_sentiment_after_load(spark, sf):
    """Reviews with odd event ids loaded, the others streamed on top of their counters."""
    tables, checkpoints = _tables(spark)
    reviews = t.reviews(spark, sf, F.col("event_id"))
    odd = F.col("event_id") % 2 == 1
    old, new = (reviews.filter(side).drop("event_id") for side in (odd, ~odd))
    bulk_load({"reviews": prepare_reviews(old)}, tables)
    loaded = add_review_totals(tables.read(spark, "review_totals"))
    running = tables.path("running")
    messages = _messages(spark, "reviews", new)
    _run(sentiment_after_load, messages, loaded, running, f"{checkpoints}/running")
    return sentiment_so_far(spark, running, loaded)


@query(REVIEW_TOTALS_SQL)
def stream_sentiment_state(spark, sf):
    tables, checkpoints = _tables(spark)
    messages = _messages(spark, "reviews", t.reviews(spark, sf))
    _run(running_sentiment, messages, tables.path("running"), f"{checkpoints}/running")
    return current_sentiment(spark, tables.path("running"))


@query(SNAPSHOT_SQL)
def stream_snapshot(spark, sf):
    """All three jobs, then the movie table they amount to."""
    tables, checkpoints = _tables(spark)
    movies, ratings, reviews = (
        t.movies(spark, sf), t.ratings(spark, sf), t.reviews(spark, sf)
    )
    dimensions = {n: normalize(movies, *listed).dimension for n, listed in schemas.LISTS.items()}
    _run(ratings_job, _messages(spark, "ratings", ratings), tables, f"{checkpoints}/ratings")
    _run(reviews_job, _messages(spark, "reviews", reviews), tables, f"{checkpoints}/reviews")
    messages = _messages(spark, "movies", _counted(movies))
    _run(movies_job, messages, dimensions.get, tables, f"{checkpoints}/movies")
    return _films(spark, tables)


def _films(spark, tables):
    counters = [f"{s}_reviews" for s in ("positive", "negative", "neutral")]
    return current_movies(spark, tables).select("item_id", "title", "avgRating", *counters)


@query(SNAPSHOT_SQL)
def stream_snapshot_compacted(spark, sf):
    """Films, ratings and reviews streamed, compacted twice on the way and vacuumed once."""
    tables, checkpoints = _tables(spark)
    ratings, reviews = t.ratings(spark, sf), t.reviews(spark, sf)
    bulk_load({"movies": prepare_movies(t.movies(spark, sf))}, tables)
    half = F.col("user_id") % 2 == 0
    for n, part in enumerate((ratings.filter(half), ratings.filter(~half))):
        _run(ratings_job, _messages(spark, "ratings", part), tables, f"{checkpoints}/ratings{n}")
        for name in ("ratings", "rating_totals"):
            tables.compact(spark, name)
    tables.vacuum(spark, "rating_totals")
    _run(reviews_job, _messages(spark, "reviews", reviews), tables, f"{checkpoints}/reviews")
    tables.compact(spark, "review_totals")
    return _films(spark, tables)


@query(t.RATINGS)
def stream_two_sources(spark, sf):
    """Two topics, each with a checkpoint that counts from 0: neither replaces the other's rows."""
    tables, checkpoints = _tables(spark)
    ratings, half = t.ratings(spark, sf), F.col("user_id") % 2 == 0
    for n, part in enumerate((ratings.filter(half), ratings.filter(~half))):
        _run(ratings_job, _messages(spark, "ratings", part), tables, f"{checkpoints}/{n}")
    return tables.read(spark, "ratings").select("item_id", "user_id", "rating")


@query(
    f"SELECT item_id, count(*) AS facts, {t.AVERAGE} FROM ({t.RATINGS}) GROUP BY item_id"
)
def stream_broken_batch(spark, sf):
    """Facts of a batch that broke before its totals stay unseen, and the restart repeats it."""
    tables, checkpoints = _tables(spark)
    messages = _messages(spark, "ratings", t.ratings(spark, sf))
    try:
        _run(ratings_job, messages, _Breaking(tables.root), f"{checkpoints}/ratings")
    except StreamingQueryException:
        pass
    seen = tables.read(spark, "ratings").groupBy("item_id").count()
    summed = add_rating_totals(tables.read(spark, "rating_totals"))
    torn = seen.join(summed, "item_id", "full").filter(
        ~F.col("count").eqNullSafe(F.col("rating_count"))
    )
    if not torn.isEmpty():
        raise AssertionError("facts without their totals are visible")
    _run(ratings_job, messages, tables, f"{checkpoints}/ratings")
    facts = tables.read(spark, "ratings").groupBy("item_id").agg(F.count("*").alias("facts"))
    totals = add_rating_totals(tables.read(spark, "rating_totals"))
    return facts.join(totals.select("item_id", average().alias("avgRating")), "item_id")


class _Breaking(Tables):
    """Fails once between the facts and the totals of the second batch."""

    def append(self, frame, name, batch_id, run):
        if name == "rating_totals" and batch_id == 1:
            raise RuntimeError("lost connection")
        super().append(frame, name, batch_id, run)


@query(
    "SELECT CASE WHEN bad THEN 'quarantine' ELSE 'ratings' END AS place, count(*) AS n FROM "
    "(SELECT l_suppkey % 10 < 5 AS bad FROM lineitem) GROUP BY ALL"
)
def stream_quarantine(spark, sf):
    """Ratings that no total can hold go to quarantine, and the job goes on."""
    tables, checkpoints = _tables(spark)
    wrong = F.element_at(
        F.array(*map(F.lit, ["1e20", "NaN", "Infinity", "four", "1e400"])),
        (F.col("user_id") % 10 + 1).cast("int"),
    )
    rating = F.when(F.col("user_id") % 10 < 5, wrong).otherwise(F.col("rating").cast("string"))
    sent = t.ratings(spark, sf).withColumn("rating", rating)
    path = work_folder(spark, "topic-ratings")
    to_replay(message_per_row(sent), path, None)
    _run(ratings_job, replay_stream(spark, path), tables, f"{checkpoints}/ratings")
    kept = tables.read(spark, "ratings").select(F.lit("ratings").alias("place"))
    bad = tables.read(spark, "quarantine_ratings").select(F.lit("quarantine").alias("place"))
    return kept.unionByName(bad).groupBy("place").agg(F.count("*").alias("n"))


@query(
    f"SELECT title, count(*) AS ratings FROM ({t.RATINGS}) JOIN ({t.MOVIES}) USING (item_id) "
    "GROUP BY title"
)
def live_ratings_per_title(spark, sf):
    """Ratings per title over the live tables."""
    tables, checkpoints = _tables(spark)
    bulk_load({"movies": prepare_movies(t.movies(spark, sf))}, tables)
    messages = _messages(spark, "ratings", t.ratings(spark, sf))
    _run(ratings_job, messages, tables, f"{checkpoints}/ratings")
    return serving.live_ratings_per_title(spark, tables)


@query(t.RATINGS + " WHERE l_linestatus = 'F'")
def live_recent(spark, sf):
    """Rows of the last hour: those streamed just now, not those loaded as older."""
    tables, checkpoints = _tables(spark)
    lines = t.load(spark, sf, "lineitem")
    old, new = (
        lines.filter(F.col("l_linestatus") == s).select(
            F.col("l_partkey").alias("item_id"),
            F.col("l_suppkey").alias("user_id"),
            F.col("l_quantity").alias("rating"),
        )
        for s in "OF"
    )
    bulk_load({"ratings": stamp_loaded(old)}, tables)
    _run(ratings_job, _messages(spark, "ratings", new), tables, f"{checkpoints}/ratings")
    found = tables.recent(spark, "ratings", F.current_timestamp(), timedelta(hours=1))
    return found.select("item_id", "user_id", "rating")


def _known_sql(listed: str) -> str:
    column, kind, id_name, name = schemas.LISTS[listed]
    return (
        f"SELECT item_id, {id_name}, {name} FROM ({t.names_sql(column, kind, name)}) "
        f"JOIN ({t.dimension_sql(column, kind, id_name, name)}) USING ({name})"
    )


def _streamed_movies(spark, sf, gaps: bool = False):
    """The tables after the movies job; with ``gaps`` every third dimension entry is missing."""
    tables, checkpoints = _tables(spark)
    movies = t.movies(spark, sf)
    dimensions = {n: normalize(movies, *listed).dimension for n, listed in schemas.LISTS.items()}
    if gaps:
        dimensions = {
            n: d.filter(F.col(schemas.LISTS[n][2]) % 3 != 0) for n, d in dimensions.items()
        }
    messages = _messages(spark, "movies", _counted(movies))
    _run(movies_job, messages, dimensions.get, tables, f"{checkpoints}/movies")
    return tables


@query(f"SELECT item_id, genre_id FROM ({_known_sql('genres')})")
def stream_movies_bridge(spark, sf):
    """The genre bridge as the movies job appends it."""
    tables = _streamed_movies(spark, sf)
    return tables.read(spark, "movies_genres").select("item_id", "genre_id")


@query(f"SELECT item_id, actor_id FROM ({_known_sql('actors')}) WHERE actor_id % 3 <> 0")
def stream_bridge_actors(spark, sf):
    tables = _streamed_movies(spark, sf, gaps=True)
    return tables.read(spark, "movies_actors").select("item_id", "actor_id")


@query(f"SELECT item_id, director_id FROM ({_known_sql('directors')}) WHERE director_id % 3 <> 0")
def stream_bridge_directors(spark, sf):
    tables = _streamed_movies(spark, sf, gaps=True)
    return tables.read(spark, "movies_directors").select("item_id", "director_id")


@query(
    " UNION ALL ".join(
        f"SELECT '{n}' AS kind, {name} AS name, item_id FROM ({_known_sql(n)}) WHERE {id_name} % 3 = 0"
        for n, (_, _, id_name, name) in schemas.LISTS.items()
    )
)
def stream_unmatched(spark, sf):
    """Names that the dimensions lack."""
    tables = _streamed_movies(spark, sf, gaps=True)
    return tables.read(spark, "unmatched").drop("batch_id")


def _growing_movies(spark, sf, slices: int = 4):
    """The movies job with dimensions that begin empty; films come in slices by their ids.

    Each slice is a run from the same checkpoint that finds new files in the topic.
    """
    tables, checkpoints = _tables(spark)
    topic = work_folder(spark, "topic-movies")
    dimensions = GrowingDimensions.below(tables.path("dimensions"))
    movies = _counted(t.movies(spark, sf))
    inner = [n / slices for n in range(1, slices)]
    bounds = [None, *movies.approxQuantile("item_id", inner, 0.001), None]
    for n, (low, high) in enumerate(zip(bounds, bounds[1:])):
        part = movies
        if low is not None:
            part = part.filter(F.col("item_id") > low)
        if high is not None:
            part = part.filter(F.col("item_id") <= high)
        replay("movies", part, f"{topic}/{n}")
        messages = replay_stream(spark, f"{topic}/*")
        _run(movies_job, messages, dimensions, tables, f"{checkpoints}/movies")
    return tables, dimensions


@query(t.dimension_sql(*schemas.LISTS["actors"]))
def stream_growing_dimension(spark, sf):
    """Actors numbered as their films arrive: the ids of a load of all films at once."""
    return _growing_movies(spark, sf)[1].tables["actors"].read(spark)


@query(f"SELECT item_id, actor_id FROM ({_known_sql('actors')})")
def stream_growing_bridge(spark, sf):
    """The actors' bridge beside dimensions that grow: no name is left out."""
    tables, _ = _growing_movies(spark, sf, slices=2)
    return tables.read(spark, "movies_actors").select("item_id", "actor_id")


def _maintained(spark, sf, late: bool):
    """The keyed tables after all topics; ``late``: every second film comes after all the rest."""
    root = work_folder(spark, "catalogue")
    catalogue = Catalogue.below(root, parts=16)
    topics = {n: f"{root}/topics/{n}" for n in ("movies", "ratings", "reviews")}
    movies = _counted(t.movies(spark, sf))
    even = F.col("item_id") % 2 == 0
    sent = [
        ("movies", movies.filter(even) if late else movies),
        ("ratings", t.ratings(spark, sf)),
        ("reviews", t.reviews(spark, sf)),
    ]
    for topic, frame in sent:
        replay(topic, frame, f"{topics[topic]}/0")

    def run():
        streams = {n: replay_stream(spark, f"{path}/*") for n, path in topics.items()}
        catalogue_job(streams, catalogue, f"{root}/checkpoint").awaitTermination()

    run()
    if late:
        replay("movies", movies.filter(~even), f"{topics['movies']}/1")
        run()
    return catalogue


@query(SNAPSHOT_SQL)
def stream_snapshot_keyed(spark, sf):
    """The movie table kept row by row; half of the films come after their ratings."""
    counters = [f"{s}_reviews" for s in ("positive", "negative", "neutral")]
    movies = _maintained(spark, sf, late=True).movies(spark)
    return movies.select("item_id", "title", "avgRating", *counters)


@query(
    f"SELECT title, count(*) AS ratings FROM ({t.RATINGS}) JOIN ({t.MOVIES}) USING (item_id) "
    "GROUP BY title"
)
def stream_ratings_per_title(spark, sf):
    """Ratings per title kept by the changes of both sides, with late films."""
    return _maintained(spark, sf, late=True).ratings_per_title(spark)


@query(
    "SELECT 'ratings' AS query, CAST(count(*) AS BIGINT) AS rows FROM lineitem UNION ALL "
    "SELECT 'reviews', CAST(count(*) AS BIGINT) FROM events"
)
def stream_progress(spark, sf):
    """What the queries say they have read of each topic, from the rows their listener wrote."""
    tables, checkpoints = _tables(spark)
    progress = ProgressLog(tables.path("progress")).attach(spark)
    jobs = {"ratings": (ratings_job, t.ratings), "reviews": (reviews_job, t.reviews)}
    started = [
        job(_messages(spark, n, rows(spark, sf)), tables, f"{checkpoints}/{n}", name=f"{n}-{tables.root}")
        for n, (job, rows) in jobs.items()
    ]
    await_all(started, each_poll=lambda: progress.write(spark))
    while not all(progress.ended(str(q.runId)) for q in started):
        time.sleep(0.1)
    progress.detach(spark)
    found = rows_per_query(progress.read(spark))
    return found.select(F.substring_index("query", "-", 1).alias("query"), "rows")


@query(f"SELECT item_id, {t.AVERAGE} FROM ({t.RATINGS}) GROUP BY item_id")
def stream_paced(spark, sf):
    """The ratings offered at a steady pace to a job that is triggered every second."""
    tables, checkpoints = _tables(spark)
    ratings = t.ratings(spark, sf)
    path = work_folder(spark, "topic-ratings")
    replay("ratings", ratings, path, per_second=max(1, ratings.count() // 4))
    messages = replay_stream(spark, path, max_files=1)
    job = ratings_job(messages, tables, f"{checkpoints}/ratings", "1 second")
    try:
        job.processAllAvailable()
    finally:
        job.stop()
    if job.exception() is not None:
        raise job.exception()
    totals = add_rating_totals(tables.read(spark, "rating_totals"))
    return totals.select("item_id", average().alias("avgRating"))
