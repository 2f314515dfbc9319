"""File scans. File splits take the place of hand-made chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_jsonl(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """One JSON object per line. Without a schema Spark reads the data once more to infer it."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    multiline: bool = False,
) -> DataFrame:
    """CSV with a header; quotes inside quoted fields are doubled.

    ``multiline`` admits line breaks inside quotes, at the price of one task per file.
    """
    reader = spark.read.option("header", True).option("escape", '"')
    reader = reader.option("multiLine", multiline)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    since: int | None = None,
    with_run: bool = False,
) -> DataFrame:
    """An append-only table written by ``sinks.append_batch``, ``batch_id`` included.

    ``since`` keeps batches from that id on; it prunes folders, not rows. All batches are read,
    committed or not (``tables.Tables.read`` takes the committed ones).
    """
    places = [T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())]
    table = spark.read.schema(T.StructType(schema.fields + places)).parquet(path)
    table = table if since is None else table.filter(table.batch_id >= since)
    return table if with_run else table.drop("run")


def first_rows(frame: DataFrame, n: int) -> DataFrame:
    """Any ``n`` rows, for a look at the data; the scan stops once they are found."""
    return frame.limit(n)
