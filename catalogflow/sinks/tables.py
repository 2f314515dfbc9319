"""Table writes. Nothing passes through the driver and no error is swallowed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogflow.sources.jdbc import jdbc_options

# The run of the empty batch that a new table begins with.
EMPTY_RUN = "none"


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder and all below it, wherever Spark can write."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def append_batch(
    frame: DataFrame, table: str, batch_id: int, run: str = "0", by: str | None = None
) -> None:
    """Add a batch to an append-only table; writing it again changes nothing.

    Each batch owns one folder, named by the run that counts it and its number, so a retry
    replaces exactly what the failed attempt left behind, and a run that counts from 0 again
    (a new checkpoint, another topic) replaces nothing of an older one. Inside it rows may lie in
    partitions ``by`` a column.
    """
    writer = frame.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if by is not None:
        writer = writer.partitionBy(by)
    writer.parquet(f"{table}/run={run}/batch_id={batch_id}")


def create_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    replace: bool = False,
    by: str | None = None,
) -> None:
    """An empty append-only table, unless there is one already; with ``replace`` in any case."""
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    empty = spark.range(0).select(*nothing)
    if replace:
        delete_folder(spark, table)
    inner = f"/{by}=-1" if by is not None else ""
    empty.write.mode("ignore").parquet(f"{table}/run={EMPTY_RUN}/batch_id=-1{inner}")


def bucket_table(frame: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """Replace a catalogue table whose rows lie in buckets by ``key``, sorted.

    Joins on the key read it as it lies: neither a batch nor another bucketed table makes Spark
    shuffle it. ``path`` puts it outside the warehouse.
    """
    writer = frame.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def _with_types(frame: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return frame.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def replace_table(
    frame: DataFrame, path: str, types: Mapping[str, str] | None = None
) -> None:
    """Replace a table, casting the columns named in ``types``."""
    _with_types(frame, types or {}).write.mode("overwrite").parquet(path)


def append_rows(frame: DataFrame, path: str) -> None:
    """Plain append, for loads that run once. Use ``append_batch`` where a retry can happen."""
    frame.write.mode("append").parquet(path)


def write_jsonl(frame: DataFrame, path: str) -> None:
    """One object per line; null fields are written too."""
    frame.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def split_jsonl(frame: DataFrame, flag: str, path: str) -> None:
    """Route rows by the value of ``flag`` into one folder each, in a single pass."""
    (
        frame.write.mode("overwrite")
        .option("ignoreNullFields", False)
        .partitionBy(flag)
        .json(path)
    )


def replace_jdbc(
    frame: DataFrame,
    url: str,
    table: str,
    types: Mapping[str, str] | None = None,
    batch_size: int = 10_000,
    **extra: str,
) -> None:
    """Replace a database table; ``types`` overrides column types by SQL type name."""
    writer = frame.write.format("jdbc").options(**jdbc_options(url, table, **extra))
    writer = writer.option("batchsize", batch_size)
    if types:
        ddl = ", ".join(f"{c} {t}" for c, t in types.items())
        writer = writer.option("createTableColumnTypes", ddl)
    writer.mode("overwrite").save()


def append_jdbc(
    frame: DataFrame, url: str, table: str, batch_id: int, batch_size: int = 10_000, **extra: str
) -> None:
    """Append a batch to a database table.

    A database append cannot be made idempotent from Spark alone, so rows carry their
    ``batch_id``: a retried batch can be told apart and removed.
    """
    (
        frame.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.format("jdbc")
        .options(**jdbc_options(url, table, **extra))
        .option("batchsize", batch_size)
        .mode("append")
        .save()
    )
