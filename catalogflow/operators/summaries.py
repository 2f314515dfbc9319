"""Profiles from summaries that can be merged: of growing tables, of frequent values, of bins."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogflow.operators.profiling import histogram_edges
from catalogflow.session import materialize
from catalogflow.sinks import append_batch, create_table
from catalogflow.sources import read_table

# Bits of a distinct-count sketch (relative error about 1.04 / 2^7) and size of a quantile sketch
# (rank error about 0.5 %).
HLL_BITS, KLL_SIZE = 14, 600

_SKETCHED = (T.IntegerType, T.LongType, T.StringType, T.BinaryType)


_ROW = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("column", "type")]
    + [T.StructField(n, T.LongType()) for n in ("non_null", "nulls", "empty")]
    + [T.StructField(n, T.BinaryType()) for n in ("distinct_sketch", "quantile_sketch")]
)


def _summary(frame: DataFrame, column: str) -> Column:
    value, kind = F.col(f"`{column}`"), frame.schema[column].dataType
    sketched = value if isinstance(kind, _SKETCHED) else value.cast("string")
    text = isinstance(kind, T.StringType)
    numeric = isinstance(kind, T.NumericType)
    number = F.when(F.abs(value.cast("double")) < float("inf"), value.cast("double")) if numeric else None
    return F.struct(
        F.lit(column).alias("column"),
        F.lit(kind.simpleString()).alias("type"),
        F.count(value).alias("non_null"),
        F.count_if(value.isNull()).alias("nulls"),
        (F.count_if(value == "") if text else F.lit(0).cast("bigint")).alias("empty"),
        F.hll_sketch_agg(sketched, HLL_BITS).alias("distinct_sketch"),
        (F.kll_sketch_agg_double(number, KLL_SIZE) if numeric else F.lit(None).cast("binary")).alias(
            "quantile_sketch"
        ),
    )


@dataclass(frozen=True)
class ProfileStore:
    """The profile of a table that grows, from one row of sketches per column and batch.

    A batch is read once, when it is added; the profile of everything so far merges the stored rows
    and reads none of the data again. Adding a batch a second time replaces its rows.
    """

    path: str

    def create(self, spark: SparkSession) -> None:
        create_table(spark, self.path, _ROW)

    def add(self, batch: DataFrame, batch_id: int, run: str = "0") -> None:
        """Sketch a batch in one scan; of each task only one row is shuffled."""
        self.create(batch.sparkSession)
        every = F.array(*[_summary(batch, c) for c in batch.columns])
        append_batch(batch.agg(every.alias("all")).select(F.inline("all")), self.path, batch_id, run)

    def read(self, spark: SparkSession, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
        """column, type, non_null, nulls, empty, distinct_values and quantiles (both approximate).

        Quantiles are of finite numbers; a column without any, or of another type, has null.
        """
        rows = read_table(spark, self.path, _ROW)
        merged = rows.groupBy("column", "type").agg(
            *[F.sum(c).alias(c) for c in ("non_null", "nulls", "empty")],
            F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_values"),
            F.kll_merge_agg_double("quantile_sketch").alias("sketch"),
        )
        some = F.kll_sketch_get_n_double("sketch") > 0
        asked = F.array(*[F.lit(float(q)) for q in quantiles])
        found = F.when(some, F.kll_sketch_get_quantile_double("sketch", asked))
        return merged.withColumn("quantiles", found).drop("sketch")


# Most candidates of a heavy-hitter summary, per value asked for and in all, and the items that a
# task's summary tracks.
CANDIDATES_EACH, CANDIDATES, TRACKED = 20, 10_000, 20_000
# Buckets that all other values are counted in.
BUCKETS = 1 << 16


def top_values(frame: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The ``k`` most frequent non-null values with their counts, exact; of equal counts the least.

    A mergeable summary of each task names candidates. One more pass counts them exactly and all
    other values by a hash of them in ``BUCKETS`` buckets. A bucket with fewer rows than the least
    of the k best candidates cannot hold a better value; only values in the other buckets are
    counted one by one. So a column with a few frequent values is never shuffled by value, and one
    without any is counted like ``value_counts``. What is broadcast has at most ``CANDIDATES`` or
    ``BUCKETS`` rows.
    """
    values = frame.select(F.col(column).alias("_v")).filter(F.col("_v").isNotNull())
    many = min(max(CANDIDATES_EACH * k, 100), CANDIDATES)
    summary = F.expr(f"approx_top_k(_v, {many}, {max(TRACKED, many)})")
    found = values.agg(summary.alias("_s")).select(F.explode("_s").alias("_c"))
    candidates = materialize(found.select(F.col("_c.item").alias("_item")), "candidates")
    marked = values.join(F.broadcast(candidates), F.col("_v") == F.col("_item"), "left")
    known = F.col("_item").isNotNull()
    bucket = F.pmod(F.xxhash64("_v"), F.lit(BUCKETS))
    counted = materialize(
        marked.groupBy(
            known.alias("_known"),
            F.col("_item").alias("_v"),
            F.when(~known, bucket).alias("_bucket"),
        ).agg(F.count("*").alias("count")),
        "counted",
    )
    exact = counted.filter("_known").select("_v", "count")
    best = exact.orderBy(F.desc("count")).limit(k).select("count").collect()
    least = best[-1][0] if len(best) == k else 0
    open_buckets = counted.filter(~F.col("_known") & (F.col("count") >= least)).select("_bucket")
    rest = (
        marked.filter(~known)
        .withColumn("_b", bucket)
        .join(F.broadcast(open_buckets), F.col("_b") == F.col("_bucket"), "left_semi")
        .groupBy("_v")
        .agg(F.count("*").alias("count"))
    )
    return (
        exact.unionByName(rest)
        .orderBy(F.desc("count"), "_v")
        .limit(k)
        .withColumnRenamed("_v", column)
    )


# Dyadic bins of each power of two.
_STEPS = 64


def histogram_of_dyadic_bins(frame: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """``profiling.histogram`` from one pass where the edges allow, else a second over few rows.

    Rows are counted by sign, power of two and 64 steps in it, with the least and greatest value of
    each such bin; these sums can be merged and are at most some hundred thousand. With the extremes
    known a dyadic bin whose least and greatest value fall into the same bin asked for goes there
    whole; only the rows of bins that an edge cuts are read again.
    """
    value = F.col(column).cast("double")
    known = frame.select(value.alias("_v")).filter(F.abs("_v") < F.lit(float("inf")))
    power = F.greatest(F.floor(F.log2(F.abs("_v"))), F.lit(-1000)).cast("int")
    step = F.floor(F.abs("_v") * F.pow(F.lit(2.0), -power) * _STEPS).cast("int")
    dyadic = [
        F.signum("_v").cast("int").alias("_sign"),
        F.when(F.col("_v") != 0, power).alias("_power"),
        F.when(F.col("_v") != 0, step).alias("_step"),
    ]
    placed = known.select("_v", *dyadic)
    keys = ["_sign", "_power", "_step"]
    sums = materialize(
        placed.groupBy(*keys).agg(
            F.count("*").alias("n"), F.min("_v").alias("least"), F.max("_v").alias("most")
        ),
        "dyadic",
    )
    low, high = sums.agg(F.min("least"), F.max("most")).first()
    slot, edges = histogram_edges(frame.sparkSession, low, high, bins)
    sums = sums.withColumns({"_low": slot(F.col("least")), "_high": slot(F.col("most"))})
    whole = sums.filter("_low = _high").select(F.col("_low").alias("bin"), "n")
    cut = sums.filter("_low != _high").select(*[F.col(k).alias(f"{k}_cut") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"{k}_cut")) for k in keys]
    again = placed.join(cut, same, "left_semi").select(slot(F.col("_v")).alias("bin"), F.lit(1).alias("n"))
    counts = whole.unionByName(again).groupBy("bin").agg(F.sum("n").alias("count"))
    return edges.join(counts, "bin", "left").select(
        "bin", "lower", F.coalesce("count", F.lit(0)).alias("count")
    )
