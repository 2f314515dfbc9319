import numpy as np
import pytest

from catalogflow.operators import profiling


@pytest.fixture
def frame(spark):
    return spark.createDataFrame(
        [(1, "a", 1.0), (2, "", None), (2, None, 1.0), (None, "a", 2.0)],
        "i bigint, s string, d double",
    )


def test_counts_per_column(frame, rows):
    assert rows(profiling.distinct_counts(frame)) == [("d", 2), ("i", 2), ("s", 2)]
    assert rows(profiling.distinct_counts(frame, approximate=True)) == [("d", 2), ("i", 2), ("s", 2)]
    assert rows(profiling.null_counts(frame)) == [("d", 1), ("i", 1), ("s", 1)]
    assert rows(profiling.empty_counts(frame)) == [("d", 0), ("i", 0), ("s", 1)]
    assert rows(profiling.column_summary(frame)) == [
        ("d", "double", 3), ("i", "bigint", 3), ("s", "string", 3),
    ]
    assert rows(profiling.profile(frame)) == [
        ("d", "double", 3, 1, 0, 2), ("i", "bigint", 3, 1, 0, 2), ("s", "string", 3, 1, 1, 2),
    ]


def test_value_counts(frame):
    assert [tuple(r) for r in profiling.value_counts(frame, "s").collect()] == [("a", 2), ("", 1)]


@pytest.mark.parametrize("bins", [10, 50])
@pytest.mark.parametrize(
    "values",
    [[0.0, 1.0, 2.5, 10.0, 10.0], [3.0, 3.0], [1.0], list(np.random.default_rng(3).normal(size=300))],
)
def test_histogram_is_numpys(spark, values, bins):
    frame = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    got = [tuple(r) for r in profiling.histogram(frame, "v", bins).orderBy("bin").collect()]
    counts, edges = np.histogram(values, bins=bins)
    assert [g[2] for g in got] == counts.tolist()
    assert [g[1] for g in got] == pytest.approx(edges[:-1].tolist())


def test_histogram_of_nothing(spark):
    frame = spark.createDataFrame([(None,)], "v double")
    assert [r["count"] for r in profiling.histogram(frame, "v", 3).collect()] == [0, 0, 0]


def test_preview_prints(frame, capsys):
    profiling.preview(frame, 2)
    assert "root" in capsys.readouterr().out
