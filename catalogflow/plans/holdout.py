"""Holding out films, with all rows that depend on them, for the stream."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogflow.operators.keys import with_keys, without_keys
from catalogflow.operators.sampling import SEED, in_fraction, sample_rows

# Number of films held out, and the counters a streamed film starts with.
HELD_OUT = 10
COUNTERS = ("positive_reviews", "negative_reviews", "neutral_reviews")


class Sides(NamedTuple):
    stream: dict[str, DataFrame]
    db: dict[str, DataFrame]


def holdout(
    movies: DataFrame,
    dependents: Mapping[str, DataFrame],
    n: int | None = HELD_OUT,
    fraction: float | None = None,
    seed: int = SEED,
    key: str = "item_id",
) -> Sides:
    """Split films and their dependent tables into a stream side and a DB side.

    With ``n`` the drawn keys are joined against each table. With ``fraction`` the draw
    is a predicate on the key, so no table is joined or shuffled. Streamed films get
    zero counters.
    """
    tables = {"movies": movies, **dependents}
    if fraction is not None:
        chosen = in_fraction(key, fraction, seed)
        stream = {t: f.filter(chosen) for t, f in tables.items()}
        db = {t: f.filter(~chosen) for t, f in tables.items()}
    else:
        keys = sample_rows(movies.select(key), n, key, seed)
        stream = {t: with_keys(f, keys, key) for t, f in tables.items()}
        db = {t: without_keys(f, keys, key) for t, f in tables.items()}
    stream["movies"] = stream["movies"].withColumns({c: F.lit(0).cast("bigint") for c in COUNTERS})
    return Sides(stream, db)


def flag_holdout(frame: DataFrame, keys: DataFrame, key: str = "item_id") -> DataFrame:
    """Add ``split`` (``stream`` or ``db``), so one pass can write both sides."""
    marked = keys.select(key).distinct().withColumn("_held", F.lit(True))
    return _named(frame.join(marked, key, "left"), F.col("_held")).drop("_held")


def _named(frame: DataFrame, held: Column) -> DataFrame:
    return frame.withColumn("split", F.when(held, "stream").otherwise("db"))


def flagged_holdout(
    movies: DataFrame,
    dependents: Mapping[str, DataFrame],
    n: int | None = HELD_OUT,
    fraction: float | None = None,
    seed: int = SEED,
    key: str = "item_id",
) -> dict[str, DataFrame]:
    """The split of ``holdout`` as a ``split`` column: each table is read once for both sides."""
    movies = movies.withColumns({c: F.lit(0).cast("bigint") for c in COUNTERS})
    tables = {"movies": movies, **dependents}
    if fraction is not None:
        return {t: _named(f, in_fraction(key, fraction, seed)) for t, f in tables.items()}
    keys = sample_rows(movies.select(key), n, key, seed)
    return {t: flag_holdout(f, keys, key) for t, f in tables.items()}
