"""The three topic jobs: parse, stamp, append facts and additive totals.

A batch is parsed once and persisted; every table it feeds is written from that copy by
the executors. Facts and totals lie in folders named by the query and the batch, so a repeated
batch replaces itself and no other; a commit entry, written last, shows them together. Averages and counters are never updated in place: they follow from the
totals (``plans.movie_snapshot``), whatever the order in which batches arrived.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from catalogflow import schemas
from catalogflow.functions import local_text, sentiment, title_year
from catalogflow.functions.text import NEGATIVE_WORDS, POSITIVE_WORDS
from catalogflow.operators.aggregates import rating_totals, review_totals
from catalogflow.operators.keys import with_keys
from catalogflow.operators.parsing import parse_movies, parse_ratings, parse_reviews
from catalogflow.plans.normalize import list_names
from catalogflow.streaming.dimensions import GrowingDimensions
from catalogflow.streaming.runner import ONCE, query_id, run_stream
from catalogflow.tables import Tables

Dimensions = Callable[[str], DataFrame]


@contextmanager
def _kept(batch: DataFrame):
    batch.persist()
    try:
        yield batch
    finally:
        batch.unpersist()


def stamped(rows: DataFrame, as_of=None) -> DataFrame:
    """Add the ingest instant and its text.

    In a stream ``current_timestamp`` is the start time logged for the batch, so a
    repeated batch gets the time of its first attempt.
    """
    now = F.current_timestamp() if as_of is None else as_of
    return rows.withColumn("ingest_ts", now).withColumn("timestamp", local_text(F.col("ingest_ts")))


class _Writer:
    """Writes the tables of one batch; leaving it without an error commits them together."""

    def __init__(self, tables: Tables, batch: DataFrame, batch_id: int):
        self.tables, self.spark = tables, batch.sparkSession
        self.batch_id, self.run = batch_id, query_id(batch)

    def append(self, frame: DataFrame, name: str) -> None:
        self.tables.append(frame, name, self.batch_id, self.run)

    def quarantine(self, batch: DataFrame, topic: str) -> None:
        bad = batch.filter("not ok").withColumn("topic", F.lit(topic))
        # Most batches have nothing to put aside; the batch is kept, so looking costs no reading.
        if not bad.isEmpty():
            self.append(bad, f"quarantine_{topic}")

    def __enter__(self) -> _Writer:
        return self

    def __exit__(self, error, *_) -> None:
        if error is None:
            self.tables.commit(self.spark, self.batch_id, self.run)


def ratings_job(
    messages: DataFrame,
    tables: Tables,
    checkpoint: str,
    trigger: str = ONCE,
    name: str | None = None,
) -> StreamingQuery:
    """Ratings topic to ``ratings``, ``rating_totals`` and a quarantine table.

    ``name`` is what the query is called in its progress.
    """
    tables.create(messages.sparkSession, "ratings", "rating_totals", "quarantine_ratings")

    def process(batch: DataFrame, batch_id: int) -> None:
        with _kept(batch), _Writer(tables, batch, batch_id) as out:
            good = batch.filter("ok")
            out.append(good, "ratings")
            out.append(rating_totals(good), "rating_totals")
            out.quarantine(batch, "ratings")

    return run_stream(stamped(parse_ratings(messages)), process, checkpoint, trigger, name=name)


def reviews_job(
    messages: DataFrame,
    tables: Tables,
    checkpoint: str,
    trigger: str = ONCE,
    positive: tuple[str, ...] = POSITIVE_WORDS,
    negative: tuple[str, ...] = NEGATIVE_WORDS,
    name: str | None = None,
) -> StreamingQuery:
    """Reviews topic to ``reviews``, ``review_totals`` and a quarantine table."""
    tables.create(messages.sparkSession, "reviews", "review_totals", "quarantine_reviews")

    def process(batch: DataFrame, batch_id: int) -> None:
        with _kept(batch), _Writer(tables, batch, batch_id) as out:
            good = batch.filter("ok")
            out.append(good, "reviews")
            out.append(review_totals(good), "review_totals")
            out.quarantine(batch, "reviews")

    scored = parse_reviews(messages).withColumn(
        "sentiment", sentiment(F.col("txt"), positive, negative)
    )
    return run_stream(stamped(scored), process, checkpoint, trigger, name=name)


def _listed_names(films: DataFrame, dimensions: Dimensions) -> DataFrame:
    """kind, item_id, name and the id that the kind's dimension knows it by, or null."""
    found = []
    for listed, (column, kind, id_name, name) in schemas.LISTS.items():
        names = list_names(films, column, kind, name)
        # Only the entries this batch needs: a large dimension is scanned once and never
        # shuffled as long as the batch's names are few.
        needed = with_keys(dimensions(listed).select(id_name, name), names, name)
        found.append(
            names.join(needed, name, "left").select(
                F.lit(listed).alias("kind"), "item_id", F.col(name).alias("name"), F.col(id_name).alias("id")
            )
        )
    return reduce(DataFrame.unionByName, found)


def movies_job(
    messages: DataFrame,
    dimensions: Dimensions | GrowingDimensions,
    tables: Tables,
    checkpoint: str,
    trigger: str = ONCE,
    name: str | None = None,
) -> StreamingQuery:
    """Movies topic to ``movies``, three bridge tables and the names no dimension knows.

    ``dimensions(list_name)`` is called in every batch, so entries added since the last
    one are seen. It returns the id and name columns of ``schemas.LISTS``. All lists of a
    batch are cut and looked up once; bridges and unmatched names are parts of that result.
    ``GrowingDimensions`` first give ids to the names they do not know, so none stays unmatched.
    """
    bridges = [f"movies_{n}" for n in schemas.LISTS]
    tables.create(messages.sparkSession, "movies", "unmatched", "quarantine_movies", *bridges)
    growing = isinstance(dimensions, GrowingDimensions)
    if growing:
        dimensions.create(messages.sparkSession)

    def process(batch: DataFrame, batch_id: int) -> None:
        with _kept(batch), _Writer(tables, batch, batch_id) as out:
            good = batch.filter("ok")
            films = good.withColumn("year", title_year(F.col("title")))
            out.append(films.withColumn("avgRating", F.lit(0.0)), "movies")
            if growing:
                dimensions.learn(good, out.run, batch_id)
            known = dimensions.reader(out.spark) if growing else dimensions
            with _kept(_listed_names(good, known)) as names:
                for listed, (_, _, id_name, _) in schemas.LISTS.items():
                    found = names.filter((F.col("kind") == listed) & F.col("id").isNotNull())
                    out.append(found.withColumnRenamed("id", id_name), f"movies_{listed}")
                out.append(names.filter("id is null"), "unmatched")
            out.quarantine(batch, "movies")

    return run_stream(stamped(parse_movies(messages)), process, checkpoint, trigger, name=name)
