"""The live tables: append-only, one folder per run and batch, below one root.

A batch is visible once its commit entry is there, which is written after all of its tables.
So readers see a batch whole or not at all, whatever breaks between two writes. Compaction
writes the visible batches of a table as one and, with a single entry, puts it in their place.

Tables whose rows have an ingest time are partitioned by its hour, so recent rows are found by
pruning partitions, without the entries.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogflow import schemas
from catalogflow.operators.aggregates import add_rating_totals, add_review_totals
from catalogflow.operators.keys import by_key, recent
from catalogflow.sinks.tables import append_batch, create_table, delete_folder
from catalogflow.sources import read_table

# Streamed batches count from 0 in each run; an empty table is -1; a first load is -2.
LOADED, LOADED_RUN = -2, "load"

_FIXED = {
    "movies": schemas.MOVIES,
    "ratings": schemas.RATINGS,
    "reviews": schemas.REVIEWS,
    "rating_totals": schemas.RATING_TOTALS,
    "review_totals": schemas.REVIEW_TOTALS,
    "unmatched": schemas.UNMATCHED,
}
_BRIDGES = {f"movies_{n}": schemas.bridge(listed[2]) for n, listed in schemas.LISTS.items()}
_QUARANTINES = {f"quarantine_{n}": schemas.QUARANTINE for n in ("movies", "ratings", "reviews")}
SCHEMAS: dict[str, T.StructType] = _FIXED | _BRIDGES | _QUARANTINES

# The partition of tables with an ingest time: whole hours since 1970, in UTC.
HOUR = "hour"
TIMED = {n for n, schema in SCHEMAS.items() if "ingest_ts" in schema.names}
# Batches of timed tables are compacted once they are older than recent rows can be.
SETTLED = timedelta(days=1)

# What compaction may do to rows besides putting them together.
COMBINE: dict[str, Callable[[DataFrame], DataFrame]] = {
    "rating_totals": add_rating_totals,
    "review_totals": add_review_totals,
}


def _hour(at: Column) -> Column:
    return F.floor(F.unix_seconds(at) / 3600).cast("bigint")


def _by(name: str) -> str | None:
    return HOUR if name in TIMED else None


@dataclass(frozen=True)
class Tables:
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def create(self, spark: SparkSession, *names: str) -> None:
        """Empty tables and logs, where there are none."""
        create_table(spark, self.path("_commits"), schemas.COMMIT)
        for name in names:
            create_table(spark, self.path(name), SCHEMAS[name], by=_by(name))
            create_table(spark, self._compactions(name), schemas.COMPACTION)

    def _compactions(self, name: str) -> str:
        return self.path(f"_compacted_{name}")

    def append(self, frame: DataFrame, name: str, batch_id: int, run: str) -> None:
        """Write one table of a batch; nobody sees it before ``commit``."""
        append_batch(self._shaped(frame, name), self.path(name), batch_id, run, _by(name))

    def commit(self, spark: SparkSession, batch_id: int, run: str) -> None:
        """Make all tables of a batch visible at once."""
        entry = spark.range(1).select(F.current_timestamp().alias("committed_at")).coalesce(1)
        append_batch(entry, self.path("_commits"), batch_id, run)

    def visible(self, spark: SparkSession, name: str) -> DataFrame:
        """run, batch_id and committed_at of the batches that make up a table now."""
        commits = read_table(spark, self.path("_commits"), schemas.COMMIT, with_run=True)
        entries = read_table(spark, self._compactions(name), schemas.COMPACTION, with_run=True)
        made = entries.groupBy("run", "batch_id").agg(F.max("committed_at").alias("committed_at"))
        replaced = entries.select(F.col("of_run").alias("run"), F.col("of_batch").alias("batch_id"))
        known = commits.unionByName(made)
        return known.join(replaced, ["run", "batch_id"], "left_anti")

    def read(self, spark: SparkSession, name: str, since: int | None = None) -> DataFrame:
        """The rows of all visible batches, ``batch_id`` included."""
        rows = read_table(spark, self.path(name), SCHEMAS[name], since, with_run=True)
        batches = self.visible(spark, name).select("run", "batch_id")
        return rows.join(batches, ["run", "batch_id"], "left_semi").select(
            *SCHEMAS[name].names, "batch_id"
        )

    def recent(
        self, spark: SparkSession, name: str, as_of: Column, window: timedelta = timedelta(minutes=5)
    ) -> DataFrame:
        """Rows stamped within ``window`` before ``as_of``, of the partitions of these hours.

        Rows of a batch whose other tables are still being written are shown already. A window
        longer than what compaction leaves alone is read by the batches that make up the table.
        """
        if name not in TIMED:
            raise ValueError(f"rows of {name} have no ingest time")
        if window > SETTLED:
            return recent(self.read(spark, name).drop("batch_id"), as_of, window)
        hours = T.StructType([*SCHEMAS[name], T.StructField(HOUR, T.LongType())])
        rows = read_table(spark, self.path(name), hours)
        rows = rows.filter(F.col(HOUR) >= _hour(as_of - F.lit(window)))
        return recent(rows.select(*SCHEMAS[name].names), as_of, window)

    def lookup(self, spark: SparkSession, name: str, item_id: int) -> DataFrame:
        """Rows of one film; the predicate reaches the scan."""
        return by_key(self.read(spark, name), "item_id", item_id).drop("batch_id")

    def compact(self, spark: SparkSession, name: str) -> None:
        """Put the visible batches of a table together as one; totals are added up.

        Of a table with ingest times only batches older than ``SETTLED`` are taken, as recent rows
        are read without the entries that tell which of two copies counts. Readers that began before go on with the old folders, which stay until ``vacuum``.
        """
        batches = self.visible(spark, name)
        if name in TIMED:
            batches = batches.filter(F.col("committed_at") < F.current_timestamp() - F.lit(SETTLED))
        batches = batches.select("run", "batch_id").distinct()
        rows = read_table(spark, self.path(name), SCHEMAS[name], with_run=True)
        # One list for data and entry: a batch committed meanwhile stays as it is.
        listed = [tuple(r) for r in batches.collect()]
        if len(listed) < 2:
            return
        batches = spark.createDataFrame(listed, "run string, batch_id bigint")
        kept = rows.join(batches, ["run", "batch_id"], "left_semi").drop("run", "batch_id")
        run = f"compact-{uuid.uuid4().hex}"
        combine = COMBINE.get(name, lambda frame: frame.hint("rebalance"))
        append_batch(self._shaped(combine(kept), name), self.path(name), 0, run, _by(name))
        entry = batches.select(
            F.col("run").alias("of_run"),
            F.col("batch_id").alias("of_batch"),
            F.current_timestamp().alias("committed_at"),
        )
        append_batch(entry.coalesce(1), self._compactions(name), 0, run)

    def vacuum(self, spark: SparkSession, name: str) -> None:
        """Delete the folders of compacted batches. Run it when no older reader is left."""
        entries = read_table(spark, self._compactions(name), schemas.COMPACTION)
        for run, batch_id in entries.select("of_run", "of_batch").distinct().collect():
            delete_folder(spark, f"{self.path(name)}/run={run}/batch_id={batch_id}")

    def replace(self, frame: DataFrame, name: str) -> None:
        """Replace the whole table, streamed batches included, by a first load."""
        self.create(frame.sparkSession, name)
        (
            self._shaped(frame, name)
            .withColumns({"run": F.lit(LOADED_RUN), "batch_id": F.lit(LOADED)})
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy("run", "batch_id", *([HOUR] if name in TIMED else []))
            .parquet(self.path(name))
        )
        # What was compacted is gone with the rest.
        create_table(frame.sparkSession, self._compactions(name), schemas.COMPACTION, replace=True)
        # All loads share one entry, written by the first.
        entry = frame.sparkSession.range(1).select(F.current_timestamp().alias("committed_at"))
        folder = f"{self.path('_commits')}/run={LOADED_RUN}/batch_id={LOADED}"
        entry.coalesce(1).write.mode("ignore").parquet(folder)

    @staticmethod
    def _shaped(frame: DataFrame, name: str) -> DataFrame:
        columns = [F.col(f.name).cast(f.dataType) for f in SCHEMAS[name]]
        if name in TIMED:
            columns.append(_hour(F.col("ingest_ts").cast("timestamp")).alias(HOUR))
        return frame.select(*columns)
