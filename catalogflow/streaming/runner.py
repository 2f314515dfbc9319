"""Starting and watching streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

ONCE = "once"

# Trigger intervals of the three jobs.
INTERVALS = {"movies": "10 seconds", "ratings": "5 seconds", "reviews": "5 seconds"}


def query_id(batch: DataFrame) -> str:
    """The id of the query whose batch this is: kept in its checkpoint, new with a new one."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise RuntimeError("not called from a streaming query's batch")
    return found


def run_stream(
    frame: DataFrame,
    process: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: str = ONCE,
    mode: str = "append",
    name: str | None = None,
) -> StreamingQuery:
    """Start a query that hands every micro-batch to ``process(batch, batch_id)``.

    ``trigger`` is an interval, or ``once`` to work off what is there and stop. An error
    in ``process`` ends the query; started again from ``checkpoint`` it repeats the same
    batch under the same id.
    """
    writer = frame.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if trigger == ONCE:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=trigger)
    return writer.foreachBatch(process).start()


def await_all(
    queries: list[StreamingQuery],
    poll_seconds: int = 1,
    each_poll: Callable[[], None] | None = None,
) -> None:
    """Wait until all queries have ended; if one fails, stop the rest and raise its error.

    Only the given queries are watched, so others of the session do not matter. ``each_poll`` is
    called again and again meanwhile.
    """
    waiting = list(queries)
    try:
        while waiting:
            waiting = [q for q in waiting if not q.awaitTermination(poll_seconds)]
            if each_poll is not None:
                each_poll()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
