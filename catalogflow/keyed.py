"""Tables with one row per key, updated by batches that rewrite only the parts they touch.

Rows lie in parts by a hash of their key, a partition column of the Parquet table. An update reads
and rewrites the parts of its keys through Spark's dynamic partition overwrite and leaves the files
of all others as they are. Each row remembers the batch that changed it last and what it held before,
so a repeated batch starts from what was there before its first attempt, whichever parts that
attempt had already replaced.

A table has one writer. Spark puts a new part in place by removing the old one and renaming the new
one; a driver that dies between the two leaves that part in the batch's work copy only, and the
table is then built again from the facts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogflow.session import materialize


@dataclass(frozen=True)
class KeyedTable:
    """``key``, columns that a batch ``sets``, and columns that it ``adds`` to, as DDL.

    ``parts`` is chosen once, when the table is created: so many that a part is a good file, and
    more than a batch touches.
    """

    path: str
    key: str
    adds: str
    sets: str = ""
    parts: int = 64

    def _fields(self, ddl: str) -> list[T.StructField]:
        return list(T._parse_datatype_string(ddl)) if ddl else []

    @property
    def _added(self) -> list[str]:
        return [f.name for f in self._fields(self.adds)]

    @property
    def _set(self) -> list[str]:
        return [f.name for f in self._fields(self.sets)]

    @property
    def _key(self) -> str:
        return self._fields(self.key)[0].name

    def _schema(self) -> T.StructType:
        held = [*self._fields(self.sets), *self._fields(self.adds)]
        return T.StructType(
            [
                *self._fields(self.key),
                *held,
                T.StructField("before", T.StructType(held)),
                T.StructField("run", T.StringType()),
                T.StructField("batch_id", T.LongType()),
                T.StructField("part", T.IntegerType()),
            ]
        )

    def _part(self) -> Column:
        return F.pmod(F.xxhash64(self._key), F.lit(self.parts)).cast("int")

    def create(self, spark: SparkSession) -> None:
        """An empty table, unless there is one."""
        nothing = spark.createDataFrame([], self._schema()).drop("part")
        nothing.coalesce(1).write.mode("ignore").parquet(f"{self.path}/part=-1")

    def _rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self._schema()).parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._rows(spark).select(self._key, *self._set, *self._added)

    def lookup(self, spark: SparkSession, *values) -> DataFrame:
        """The rows of a few keys: only their parts are read."""
        kind = self._fields(self.key)[0].dataType
        keys = spark.createDataFrame([(v,) for v in values], T.StructType().add(self._key, kind))
        parts = [r[0] for r in keys.select(self._part()).distinct().collect()]
        found = self._rows(spark).filter(F.col("part").isin(parts) & F.col(self._key).isin(*values))
        return found.select(self._key, *self._set, *self._added)

    def update(self, delta: DataFrame, run: str, batch_id: int) -> DataFrame:
        """Merge a batch: one row per key, with ``adds`` (null: nothing) and, with ``is_set``, ``sets``.

        Returns the changed rows: key, the columns, and ``before`` with what they were (null for a
        new row). Equal keys of ``delta`` are an error that Spark's join would hide, so they have to
        be aggregated before.
        """
        spark = delta.sparkSession
        delta = delta if "is_set" in delta.columns else delta.withColumn("is_set", F.lit(False))
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in self._fields(self.sets)]
        sets = self._set if set(self._set) <= set(delta.columns) else none
        batch = materialize(
            delta.select(self._part().alias("part"), self._key, "is_set", *sets, *self._added), "delta"
        )
        # At most as many numbers as the table has parts.
        touched = [r.part for r in batch.select("part").distinct().collect()]
        held = [*self._set, *self._added]
        again = (F.col("run") == run) & (F.col("batch_id") == batch_id)
        current = (
            self._rows(spark)
            .filter(F.col("part").isin(touched))
            .withColumn("again", again)
            .withColumn("there", ~F.col("again") | F.col("before").isNotNull())
        )
        old = {c: F.when(F.col("again"), F.col(f"before.{c}")).otherwise(F.col(c)) for c in held}
        current = current.select(
            F.col(self._key).alias("_key"),
            F.col("part").alias("_part"),
            F.when(F.col("there"), F.struct(*[v.alias(c) for c, v in old.items()])).alias("_old"),
            "before", "run", "batch_id",
        )
        merged = current.join(batch, F.col("_key").eqNullSafe(F.col(self._key)) & (F.col("_part") == F.col("part")), "full")
        changed = F.col("part").isNotNull()
        kinds = {f.name: f.dataType for f in self._fields(self.adds)}
        new = {c: F.when(F.col("is_set"), F.col(c)).otherwise(F.col(f"_old.{c}")) for c in self._set}
        for c in self._added:
            total = F.coalesce(f"_old.{c}", F.lit(0)) + F.coalesce(c, F.lit(0))
            new[c] = total.cast(kinds[c])
        rows = materialize(
            merged.select(
                F.when(changed, F.col(self._key)).otherwise(F.col("_key")).alias(self._key),
                *[v.alias(c) for c, v in new.items()],
                F.when(changed, F.col("_old")).otherwise(F.col("before")).alias("before"),
                F.when(changed, F.lit(run)).otherwise(F.col("run")).alias("run"),
                F.when(changed, F.lit(batch_id)).otherwise(F.col("batch_id")).cast("bigint").alias("batch_id"),
                F.coalesce("part", "_part").alias("part"),
                F.coalesce(changed, F.lit(False)).alias("changed"),
            ),
            "merged",
        )
        if touched:
            (
                rows.drop("changed")
                .repartition("part")
                .sortWithinPartitions("part", self._key)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("part")
                .parquet(self.path)
            )
        return rows.filter("changed").select(self._key, *held, "before")

    def rebuild(self, totals: DataFrame, run: str = "load", batch_id: int = -2) -> None:
        """Replace the whole table by one row per key, as ``update`` takes them."""
        held = self._schema()["before"].dataType
        have = {f.name for f in totals.schema}
        rows = totals.select(
            self._key,
            *[
                (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in held
            ],
            F.lit(None).cast(held).alias("before"),
            F.lit(run).alias("run"),
            F.lit(batch_id).cast("bigint").alias("batch_id"),
            self._part().alias("part"),
        )
        (
            rows.repartition("part")
            .sortWithinPartitions("part", self._key)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy("part")
            .parquet(self.path)
        )
        self.create(totals.sparkSession)
