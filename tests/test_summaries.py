"""Summaries that are merged, against exact results."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from catalogflow.operators import profiling, summaries
from catalogflow.operators.summaries import ProfileStore, histogram_of_dyadic_bins, top_values


def _mixed(spark, n=6000):
    return spark.range(n).select(
        "id",
        (F.col("id") % 700).cast("int").alias("small"),
        F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") / 7).alias("real"),
        F.when(F.col("id") % 4 == 0, "").otherwise(F.concat(F.lit("t"), F.col("id") % 50)).alias("text"),
        F.lit(None).cast("bigint").alias("nothing"),
        (F.col("id") % 2 == 0).alias("flag"),
        F.timestamp_seconds(F.col("id") % 90).alias("at"),
    )


def test_a_growing_table_is_profiled_from_its_batches(spark, tmp_path):
    frame, store = _mixed(spark), ProfileStore(str(tmp_path / "p"))
    for n in (0, 1, 2, 3, 2):
        store.add(frame.filter(f"id % 4 = {n}"), n)
    found = {r.column: r for r in store.read(spark, (0.1, 0.5)).collect()}
    exact = {r.column: r for r in profiling.profile(frame).collect()}
    assert found.keys() == exact.keys()
    for c, want in exact.items():
        got = found[c]
        assert (got.type, got.non_null, got.nulls, got.empty) == (want.type, want.non_null, want.nulls, want.empty)
        assert abs(got.distinct_values - want.distinct_values) <= 0.04 * want.distinct_values
    for c in ("id", "small", "real"):
        values = sorted(r[0] for r in frame.select(c).collect() if r[0] is not None)
        for share, value in zip((0.1, 0.5), found[c].quantiles):
            rank = sum(v <= value for v in values) / len(values)
            assert abs(rank - share) < 0.02
    assert found["text"].quantiles is found["flag"].quantiles is found["nothing"].quantiles is None


def test_the_stored_profile_does_not_grow_with_the_rows(spark, tmp_path):
    store = ProfileStore(str(tmp_path / "p"))
    store.add(_mixed(spark, 100), 0)
    store.add(_mixed(spark, 50_000), 1)
    sizes = [sum(f.stat().st_size for f in (tmp_path / "p").rglob(f"batch_id={n}/*.parquet")) for n in (0, 1)]
    assert sizes[1] < 400_000
    store.add(_mixed(spark, 0), 2)
    assert store.read(spark).filter("column = 'id'").first().non_null == 50_100


def _want(values, k):
    counted = Counter(v for v in values if v is not None)
    return sorted(counted.items(), key=lambda x: (-x[1], x[0]))[:k]


@pytest.mark.parametrize("kind", ["hot", "even", "ties", "few", "heavy tail"])
def test_top_values_are_exact(spark, kind):
    r = random.Random(kind)
    values = {
        "hot": [0 if i % 3 == 0 else r.randrange(5000) for i in range(20_000)],
        "even": [i % 4000 for i in range(20_000)],
        "ties": [i % 40 for i in range(400)] + [99, 98],
        "few": [1, None, 2, 2, None],
        "heavy tail": [int(r.paretovariate(0.7)) for _ in range(20_000)],
    }[kind]
    frame = spark.createDataFrame([(v,) for v in values], "v bigint").repartition(7)
    for k in (1, 10):
        assert [tuple(x) for x in top_values(frame, "v", k).collect()] == _want(values, k)


def test_values_that_the_summary_misses_are_found(spark, monkeypatch):
    """With a summary too small to be right, the buckets show which values must be counted."""
    monkeypatch.setattr(summaries, "TRACKED", 20)
    monkeypatch.setattr(summaries, "CANDIDATES_EACH", 1)
    monkeypatch.setattr(summaries, "CANDIDATES", 20)
    monkeypatch.setattr(summaries, "BUCKETS", 64)
    r = random.Random(4)
    values = [r.randrange(300) for _ in range(3000)] + [7] * 40 + [8] * 39
    frame = spark.createDataFrame([(f"v{v:03}",) for v in values], "v string").repartition(5)
    want = _want([f"v{v:03}" for v in values], 15)
    assert [tuple(x) for x in top_values(frame, "v", 15).collect()] == want


def test_only_open_buckets_are_counted_by_value(spark, monkeypatch):
    """Where a few values are frequent, no other value is shuffled by itself."""
    seen = []
    real = summaries.materialize

    def note(frame, label):
        out = real(frame, label)
        seen.append((label, out.count()))
        return out

    monkeypatch.setattr(summaries, "materialize", note)
    monkeypatch.setattr(summaries, "BUCKETS", 256)
    frame = spark.range(60_000).select(
        F.when(F.col("id") % 2 == 0, F.col("id") % 6).otherwise(F.col("id") + 100).alias("v")
    )
    assert [r.v for r in top_values(frame, "v", 3).collect()] == [0, 2, 4]
    assert dict(seen)["counted"] <= 256 + dict(seen)["candidates"]


SHAPES = {
    "uniform": [i / 3 for i in range(2000)],
    "negative": [(-1) ** i * i**1.5 for i in range(1500)],
    "tiny": [1e-310, 2e-310, 5e-324, 0.0, -0.0, 3e-308],
    "huge": [1e300, -1e300, 1.0, 2.0, 1.7e308],
    "one": [4.2] * 9,
    "zero": [0.0, 0.0],
    "odd": [float("nan"), float("inf"), 1.0, 2.0, None, -3.5, 7.25],
    "none": [],
}


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("bins", [1, 10, 50])
def test_dyadic_bins_give_the_same_histogram(spark, rows, shape, bins):
    frame = spark.createDataFrame([(v,) for v in SHAPES[shape]], "v double")
    found = histogram_of_dyadic_bins(frame, "v", bins)
    assert rows(found) == rows(profiling.histogram(frame, "v", bins))
