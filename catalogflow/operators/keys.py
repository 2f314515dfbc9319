"""Filters by key sets and by time.

Key sets are joined without a hint: Spark broadcasts a set it has measured to be small
and otherwise shuffles, splitting hot keys at run time.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_keys(frame: DataFrame, key: str) -> DataFrame:
    """Distinct values of ``key``, null included."""
    return frame.select(key).distinct()


def with_keys(frame: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    return frame.join(keys.select(key), key, "left_semi")


def without_keys(frame: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key does not occur in ``keys``; rows without a key stay."""
    return frame.join(keys.select(key), key, "left_anti")


def by_key(frame: DataFrame, key: str, value) -> DataFrame:
    """Point lookup; the predicate reaches the scan."""
    return frame.filter(F.col(key) == F.lit(value))


def null_or_empty(frame: DataFrame, column: str) -> DataFrame:
    return frame.filter(F.col(column).isNull() | (F.col(column) == ""))


def recent(
    frame: DataFrame,
    as_of: Column | None = None,
    window: timedelta = timedelta(minutes=5),
    column: str = "ingest_ts",
) -> DataFrame:
    """Rows newer than ``as_of`` (default: now) minus ``window``."""
    as_of = F.current_timestamp() if as_of is None else as_of
    return frame.filter(F.col(column) > as_of - F.lit(window))
