"""Topic streams: a broker, or a folder of message files standing in for one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    servers: str,
    topic: str,
    starting: str = "earliest",
    max_offsets: int | None = None,
    **extra: str,
) -> dict[str, str]:
    """Options of the Kafka source; ``max_offsets`` bounds the size of a micro-batch."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options | extra


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Needs the Kafka connector on the class path; fails at once where it is missing."""
    return (
        spark.readStream.format("kafka")
        .options(**kafka_options(servers, topic, **options))
        .load()
    )


def replay_stream(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Messages from a folder of text files, one per line, in a ``value`` column.

    All files present are read, then new ones as they appear. One of ``max_files`` and
    ``max_bytes`` bounds a micro-batch.
    """
    reader = spark.readStream.format("text").option("lineSep", "\n")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)
