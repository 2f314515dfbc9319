"""Consecutive numbers over a distributed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogflow.session import materialize

_POSITION_BITS = 33  # layout of monotonically_increasing_id


def number_rows(frame: DataFrame, *order, name: str, start: int = 1) -> DataFrame:
    """Number rows consecutively in ``order``.

    A range sort lays the rows out, each one remembers its partition and position, and
    that layout is written once (range bounds are sampled, so computing it twice could
    give two layouts). Only partition sizes then meet in one place: one row per sort
    partition, whatever the data size, which is also why they can be broadcast.
    """
    laid_out = materialize(
        frame.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "numbering"
    )
    part = F.shiftright("_at", _POSITION_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        laid_out.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    position = F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        laid_out.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + position + F.lit(start))
        .drop("_at", "_part", "_offset")
    )


def _rank(frame: DataFrame, order: tuple[str, ...]) -> Column:
    """One value that orders as the ``order`` columns do, null first.

    A whole number, alone or with a smaller one behind it (film and position), becomes a
    decimal: its minimum is kept in a hash table, while that of a struct needs a sort of
    all rows.
    """
    kinds = [frame.schema[c].dataType for c in order]
    small = (T.ByteType, T.ShortType, T.IntegerType)
    if not (isinstance(kinds[0], T.IntegralType) and all(isinstance(k, small) for k in kinds[1:])):
        return F.struct(*order)
    if len(order) > 2:
        return F.struct(*order)
    below_long = F.lit(str(-(2**63) - 1)).cast("decimal(20,0)")
    major = F.coalesce(F.col(order[0]).cast("decimal(20,0)"), below_long)
    if len(order) == 1:
        return major
    minor = F.coalesce(F.col(order[1]).cast("bigint") + F.lit(2**31 + 1), F.lit(0))
    return major * F.lit(2**33).cast("decimal(10,0)") + minor.cast("decimal(10,0)")


def number_values(
    frame: DataFrame, value: str, *order: str, name: str, start: int = 1
) -> DataFrame:
    """Distinct values numbered by first appearance: the least ``order`` tuple of each.

    A value is reduced to one row per task before any shuffle, so a value that fills a
    third of the data costs no more than a rare one.
    """
    first = frame.groupBy(value).agg(F.min(_rank(frame, order)).alias("_first"))
    return number_rows(first, "_first", value, name=name, start=start).select(name, value)


def factorize(
    frame: DataFrame, column: str, *order: str, code: str = "code"
) -> tuple[DataFrame, DataFrame]:
    """Codes from 0 by first appearance, and the code-to-value index. Null has code -1."""
    known = frame.filter(F.col(column).isNotNull())
    index = number_values(known, column, *order, name=code, start=0)
    coded = frame.join(index, column, "left").withColumn(
        code, F.coalesce(F.col(code), F.lit(-1))
    )
    return coded, index
