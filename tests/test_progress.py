"""The rows that queries leave about their progress."""

import json
import time

import pytest
from pyspark.errors import StreamingQueryException

from catalogflow.sources import replay_stream
from catalogflow.streaming import await_all, ratings_job, run_stream
from catalogflow.streaming.progress import ProgressLog, rows_per_query
from catalogflow.tables import Tables


def _topic(tmp_path, files=3):
    path = tmp_path / "topic"
    path.mkdir()
    for n in range(files):
        lines = [json.dumps({"item_id": i, "user_id": n, "rating": 3}) for i in range(10 + n)]
        (path / f"{n}.txt").write_text("\n".join([*lines, "{broken"]) + "\n")
    return str(path)


def _wait(log, query):
    for _ in range(200):
        if log.ended(str(query.runId)):
            return
        time.sleep(0.05)
    raise AssertionError("the end of the query was not reported")


def test_rows_read_equal_the_tables(spark, tmp_path):
    tables = Tables(str(tmp_path / "t"))
    log = ProgressLog(str(tmp_path / "progress")).attach(spark)
    messages = replay_stream(spark, _topic(tmp_path), max_files=1)
    query = ratings_job(messages, tables, str(tmp_path / "cp"), name="ratings in test")
    await_all([query], each_poll=lambda: log.write(spark))
    _wait(log, query)
    log.detach(spark)
    (row,) = rows_per_query(log.read(spark)).collect()
    kept = tables.read(spark, "ratings").count() + tables.read(spark, "quarantine_ratings").count()
    assert (row["query"], row.batches, row.rows) == ("ratings in test", 3, kept) and kept == 36
    # Written again there is nothing new, and a detached log hears nothing.
    log.write(spark)
    run_stream(messages, lambda b, n: None, str(tmp_path / "cp2")).awaitTermination()
    assert rows_per_query(log.read(spark)).count() == 1


def test_a_failure_leaves_its_message(spark, tmp_path):
    log = ProgressLog(str(tmp_path / "progress")).attach(spark)

    def fail(batch, batch_id):
        raise RuntimeError("lost connection")

    query = run_stream(replay_stream(spark, _topic(tmp_path)), fail, str(tmp_path / "cp"), name="bad")
    with pytest.raises(StreamingQueryException):
        query.awaitTermination()
    _wait(log, query)
    log.detach(spark)
    (row,) = log.read(spark).filter("error IS NOT NULL").collect()
    assert row["query"] == "bad" and "lost connection" in row.error and row.batch is None
