"""Readers: files, databases over JDBC, topics."""

from catalogflow.sources.files import first_rows, read_csv, read_jsonl, read_table
from catalogflow.sources.jdbc import jdbc_options, read_jdbc
from catalogflow.sources.topics import kafka_options, kafka_stream, replay_stream

__all__ = [
    "first_rows", "read_csv", "read_jsonl", "read_table",
    "jdbc_options", "read_jdbc", "kafka_options", "kafka_stream", "replay_stream",
]
