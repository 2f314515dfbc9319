"""Dimension tables that grow with a stream: names no batch has held before get the next ids.

Ids are dense and never change. The new names of a batch lie in one folder, named by the greatest id
there was before it (the high-water mark), and are numbered from there in order of first
appearance. So the newest folder tells the mark: it is its greatest id, or, if that folder was left
by an earlier attempt of the same batch, its name; the attempt's names then count as unknown and
get the same ids once more, in the same folder. A batch without a new name writes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogflow import schemas
from catalogflow.operators.numbering import number_values
from catalogflow.plans.normalize import list_names
from catalogflow.session import materialize

# The folder of a table without names, and the run and batch of a first load.
_EMPTY, _LOADED = -1, ("load", -2)


@dataclass(frozen=True)
class GrowingDimension:
    """``id_name`` and ``name`` of all names so far, below ``path``; one writer at a time."""

    path: str
    id_name: str
    name: str

    def create(self, spark: SparkSession) -> None:
        """An empty table, unless there is one."""
        nothing = spark.createDataFrame([], self._schema())
        nothing.coalesce(1).write.mode("ignore").parquet(f"{self.path}/since={_EMPTY}")

    def load(self, dimension: DataFrame) -> None:
        """Take over a dimension made before, with its ids, in place of all there is."""
        run, batch_id = _LOADED
        rows = dimension.select(
            F.col(self.id_name).cast("bigint"),
            self.name,
            F.lit(run).alias("run"),
            F.lit(batch_id).cast("bigint").alias("batch_id"),
            F.lit(0).alias("since"),
        )
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy("since")
            .parquet(self.path)
        )

    def _schema(self) -> str:
        return f"{self.id_name} bigint, {self.name} string, run string, batch_id bigint"

    def _rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"{self._schema()}, since bigint").parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._rows(spark).select(self.id_name, self.name)

    def mark(self, spark: SparkSession, run: str, batch_id: int) -> int:
        """The greatest id before the batch: from the folders' names and the newest folder's rows."""
        rows = self._rows(spark)
        newest = rows.agg(F.max("since")).first()[0]
        if newest is None or newest == _EMPTY:
            return 0
        last = rows.filter(F.col("since") == newest)
        by = F.max(F.struct("run", "batch_id"))
        greatest, writer = last.agg(F.max(self.id_name), by).first()
        return newest if tuple(writer) == (run, batch_id) else greatest

    def learn(self, names: DataFrame, run: str, batch_id: int, *order: str) -> None:
        """Number the names of a batch that are not known, by their least ``order``.

        A null name is a name like any other. The batch's distinct names are written first: their
        size is known then, and as long as it is small they are broadcast to the table, which is
        scanned and not shuffled.
        """
        spark = names.sparkSession
        mark = self.mark(spark, run, batch_id)
        known = self.read(spark).filter(F.col(self.id_name) <= mark)
        known = known.select(F.col(self.name).alias("_known"))
        needed = materialize(names.select(self.name).distinct(), "names")
        same = F.col(self.name).eqNullSafe(F.col("_known"))
        met = known.join(needed, same, "left_semi")
        fresh = names.join(met, same, "left_anti")
        numbered = number_values(fresh, self.name, *order, name=self.id_name, start=mark + 1)
        if numbered.isEmpty():
            return
        rows = numbered.select(
            F.col(self.id_name).cast("bigint"),
            self.name,
            F.lit(run).alias("run"),
            F.lit(batch_id).cast("bigint").alias("batch_id"),
        )
        rows.write.mode("overwrite").parquet(f"{self.path}/since={mark}")


@dataclass(frozen=True)
class GrowingDimensions:
    """The dimensions of all list columns, for ``movies_job``: read by name, and learning."""

    tables: Mapping[str, GrowingDimension]
    keep_null: bool = False
    drop_empty: bool = False

    @classmethod
    def below(cls, root: str, **options: bool) -> GrowingDimensions:
        lists = schemas.LISTS.items()
        return cls({n: GrowingDimension(f"{root}/{n}", *listed[2:]) for n, listed in lists}, **options)

    def create(self, spark: SparkSession) -> None:
        for table in self.tables.values():
            table.create(spark)

    def learn(self, films: DataFrame, run: str, batch_id: int) -> None:
        """Number the unknown names of all lists of a batch, by film and position in the list."""
        for listed, (column, kind, _, name) in schemas.LISTS.items():
            names = list_names(films, column, kind, name, self.keep_null, self.drop_empty)
            self.tables[listed].learn(names, run, batch_id, "item_id", "pos")

    def reader(self, spark: SparkSession):
        return lambda listed: self.tables[listed].read(spark)
