"""What streaming queries report after each batch, as rows of a table."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from catalogflow.sinks import append_batch, create_table
from catalogflow.sources import read_table

PROGRESS = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("query", "query_id", "run_id", "started")]
    + [T.StructField(n, T.LongType()) for n in ("batch", "rows", "milliseconds", "state_rows")]
    + [T.StructField("error", T.StringType())]
)


@dataclass
class ProgressLog(StreamingQueryListener):
    """Collects the progress of a session's queries; ``write`` appends it to the table at ``path``.

    Spark calls the listener in the driver after each batch, so a few numbers per batch are held
    until they are written. A query that ends with an error leaves a row with its message.
    """

    path: str
    _name: str = field(default_factory=lambda: uuid.uuid4().hex)
    _written: int = 0
    _rows: list[tuple] = field(default_factory=list)
    _names: dict[str, str | None] = field(default_factory=dict)
    _ended: set[str] = field(default_factory=set)
    _lock: Lock = field(default_factory=Lock)

    def attach(self, spark: SparkSession) -> ProgressLog:
        create_table(spark, self.path, PROGRESS)
        spark.streams.addListener(self)
        return self

    def detach(self, spark: SparkSession) -> None:
        """Stop listening and write what is left."""
        spark.streams.removeListener(self)
        self.write(spark)

    def onQueryStarted(self, event) -> None:
        self._names[str(event.runId)] = event.name

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        state = sum(o["numRowsTotal"] for o in p.get("stateOperators", ()))
        row = (
            p.get("name"), p["id"], p["runId"], p["timestamp"], p["batchId"], p["numInputRows"],
            p.get("durationMs", {}).get("triggerExecution"), state, None,
        )
        with self._lock:
            self._rows.append(row)

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        with self._lock:
            if event.exception:
                name = self._names.get(run)
                self._rows.append((name, str(event.id), run, None, None, 0, None, None, event.exception))
            self._ended.add(run)

    def ended(self, run_id: str) -> bool:
        """Whether all there is to know of a query's run has arrived."""
        return run_id in self._ended

    def write(self, spark: SparkSession) -> None:
        """Append the rows since the last call, as one batch."""
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            append_batch(spark.createDataFrame(rows, PROGRESS).coalesce(1), self.path, self._written, self._name)
            self._written += 1

    def read(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.path, PROGRESS).drop("batch_id")


def rows_per_query(progress: DataFrame) -> DataFrame:
    """query, batches, rows: what each named query has read."""
    return progress.filter("batch IS NOT NULL").groupBy("query").agg(
        F.count_distinct("query_id", "batch").alias("batches"), F.sum("rows").alias("rows")
    )
