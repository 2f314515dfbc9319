"""First load of the serving tables, stamped as older than anything streamed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogflow.functions import ago_text, sentiment, title_year
from catalogflow.operators.aggregates import rating_totals, review_totals
from catalogflow.plans.holdout import COUNTERS
from catalogflow.sinks import append_batch, create_table, replace_table
from catalogflow.tables import SCHEMAS, Tables

# Fixed value: age given to loaded rows.
LOADED_DAYS_AGO = 7


def stamp_loaded(frame: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Add the text time stamp and its instant, seven days before ``as_of`` (default: now)."""
    now = F.current_timestamp() if as_of is None else as_of
    at = now - F.make_dt_interval(F.lit(LOADED_DAYS_AGO))
    return frame.withColumns(
        {"timestamp": ago_text(now, LOADED_DAYS_AGO), "ingest_ts": at.cast("timestamp")}
    )


def prepare_movies(movies: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Movie rows with zero average and counters, and the title's year unless they have one."""
    added = {c: F.lit(0).cast("bigint") for c in COUNTERS} | {"avgRating": F.lit(0.0)}
    if "year" not in movies.columns:
        added["year"] = title_year(F.col("title"))
    return stamp_loaded(movies.withColumns(added), as_of)


def prepare_reviews(
    reviews: DataFrame, scored: bool = True, as_of: Column | None = None
) -> DataFrame:
    """Review rows with their sentiment, or all ``neutral`` when not ``scored``."""
    label = sentiment(F.col("txt")) if scored else F.lit("neutral")
    return stamp_loaded(reviews.withColumn("sentiment", label), as_of)


def bulk_load(frames: Mapping[str, DataFrame], tables: Tables) -> None:
    """Replace each table by the given rows, as one batch ahead of all streamed ones.

    Live tables take their column types from their schema. Ratings and reviews also leave
    their totals, made from the two columns just written, so later averages and counters
    cover loaded and streamed rows alike.
    Other tables, such as dimensions, are replaced as they are.
    """
    totals = {"ratings": rating_totals, "reviews": review_totals}
    for name, frame in frames.items():
        if name not in SCHEMAS:
            replace_table(frame, tables.path(name))
            continue
        tables.replace(frame, name)
        if name in totals:
            written = tables.read(frame.sparkSession, name)
            tables.replace(totals[name](written), f"{name.removesuffix('s')}_totals")


def load_in_parts(parts: list[DataFrame], table: str) -> None:
    """Create a table from the schema of the first part, then append every part once."""
    first = parts[0]
    create_table(first.sparkSession, table, first.schema)
    for n, part in enumerate(parts):
        append_batch(part, table, n)
