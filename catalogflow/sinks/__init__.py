"""Writers: tables, JSON lines, databases, topics."""

from catalogflow.sinks.tables import (
    append_batch, append_jdbc, append_rows, bucket_table, create_table, replace_jdbc, replace_table, split_jsonl,
    write_jsonl,
)
from catalogflow.sinks.topics import message_per_row, messages_of_ten, to_kafka, to_replay

__all__ = [
    "append_batch", "append_jdbc", "append_rows", "bucket_table", "create_table", "replace_jdbc", "replace_table",
    "split_jsonl", "write_jsonl",
    "message_per_row", "messages_of_ten", "to_kafka", "to_replay",
]
