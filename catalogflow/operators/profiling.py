"""Column profiles. Each is one aggregation pass over the table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _per_column(frame: DataFrame, measures: dict[str, dict[str, Column]]) -> DataFrame:
    """One aggregation for all columns, turned into one row per column."""
    rows = [
        F.struct(F.lit(c).alias("column"), *[m.cast("bigint").alias(n) for n, m in ms.items()])
        for c, ms in measures.items()
    ]
    return frame.agg(F.array(*rows).alias("_all")).select(F.inline("_all"))


def _distinct(frame: DataFrame, column: str, approximate: bool) -> Column:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return count(F.col(column))


def _nulls(frame: DataFrame, column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def _empty(frame: DataFrame, column: str) -> Column:
    text = isinstance(frame.schema[column].dataType, T.StringType)
    return F.count_if(F.col(column) == "") if text else F.count_if(F.lit(False))


def _with_types(counts: DataFrame, frame: DataFrame) -> DataFrame:
    types = F.create_map(*[F.lit(x) for pair in frame.dtypes for x in pair])
    rest = [c for c in counts.columns if c != "column"]
    return counts.select("column", types[F.col("column")].alias("type"), *rest)


def row_count(frame: DataFrame) -> DataFrame:
    return frame.agg(F.count("*").alias("rows"))


def distinct_counts(frame: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct non-null values of every column.

    Exact counts shuffle each task's distinct values once per column; the approximate
    form keeps one sketch per column and shuffles next to nothing.
    """
    return _per_column(
        frame, {c: {"distinct_values": _distinct(frame, c, approximate)} for c in frame.columns}
    )


def distinct_values(frame: DataFrame, column: str) -> DataFrame:
    return frame.select(column).distinct()


def value_counts(frame: DataFrame, column: str) -> DataFrame:
    """Frequency of each non-null value, most frequent first."""
    counts = frame.filter(F.col(column).isNotNull()).groupBy(column)
    return counts.agg(F.count("*").alias("count")).orderBy(F.desc("count"), column)


def null_counts(frame: DataFrame) -> DataFrame:
    return _per_column(frame, {c: {"nulls": _nulls(frame, c)} for c in frame.columns})


def empty_counts(frame: DataFrame) -> DataFrame:
    """Empty texts per column; columns of other types have none."""
    return _per_column(frame, {c: {"empty": _empty(frame, c)} for c in frame.columns})


def column_summary(frame: DataFrame) -> DataFrame:
    """Type and number of non-null values of every column."""
    counts = _per_column(frame, {c: {"non_null": F.count(F.col(c))} for c in frame.columns})
    return _with_types(counts, frame)


def profile(frame: DataFrame, approximate: bool = False) -> DataFrame:
    """column, type, non_null, nulls, empty, distinct_values from one scan."""
    counts = _per_column(
        frame,
        {
            c: {
                "non_null": F.count(F.col(c)),
                "nulls": _nulls(frame, c),
                "empty": _empty(frame, c),
                "distinct_values": _distinct(frame, c, approximate),
            }
            for c in frame.columns
        },
    )
    return _with_types(counts, frame)


def histogram(frame: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-width bins between the extremes, empty ones included; the last is closed.

    NaN, infinities and null are left out. Two passes: the extremes (two numbers on the driver), then
    one counter per bin.
    """
    value = F.col(column).cast("double")
    known = frame.select(value.alias("_v")).filter(F.abs("_v") < F.lit(float("inf")))
    low, high = known.agg(F.min("_v"), F.max("_v")).first()
    slot, edges = histogram_edges(frame.sparkSession, low, high, bins)
    counts = known.groupBy(slot(F.col("_v")).alias("bin")).agg(F.count("*").alias("count"))
    return edges.join(counts, "bin", "left").select(
        "bin", "lower", F.coalesce("count", F.lit(0)).alias("count")
    )


def histogram_edges(
    spark: SparkSession, low: float | None, high: float | None, bins: int
) -> tuple[Callable[[Column], Column], DataFrame]:
    """The bin of a value between the extremes, and every bin with its lower edge."""
    if low is None:
        low, high = 0.0, 1.0
    elif low == high:
        low, high = low - 0.5, high + 0.5

    def slot(value: Column) -> Column:
        at = F.floor((value - F.lit(low)) / F.lit(high - low) * F.lit(bins))
        return F.least(at, F.lit(bins - 1)).cast("bigint")

    edges = spark.range(bins).select(
        F.col("id").alias("bin"),
        (F.lit(low) + F.col("id") * F.lit(high - low) / F.lit(bins)).alias("lower"),
    )
    return slot, edges


def preview(frame: DataFrame, n: int = 5) -> None:
    """Print the schema and a few rows."""
    frame.printSchema()
    frame.show(n, truncate=False)
