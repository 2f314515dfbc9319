"""Dimensions that learn the names of a stream: dense ids, each given once."""

import json

import pytest
from pyspark.errors import StreamingQueryException

from catalogflow import schemas
from catalogflow.operators.numbering import number_values
from catalogflow.plans import normalize
from catalogflow.sources import replay_stream
from catalogflow.streaming import GrowingDimension, GrowingDimensions, movies_job
from catalogflow.tables import Tables


@pytest.fixture
def dimension(spark, tmp_path):
    made = GrowingDimension(str(tmp_path / "d"), "actor_id", "actor_name")
    made.create(spark)
    return made


def _names(spark, names):
    return spark.createDataFrame(list(enumerate(names)), "item_id bigint, actor_name string")


@pytest.mark.parametrize("cut", [1, 2, 3, 7, 40])
def test_ids_do_not_depend_on_the_batches(spark, rows, dimension, cut):
    names = [f"n{(i * i) % 23}" for i in range(40)] + [None, "", "n1", None]
    everything = _names(spark, names)
    for n, start in enumerate(range(0, len(names), cut)):
        if cut == 1 and start > 12:
            break
        part = everything.filter(f"item_id >= {start} AND item_id < {start + cut}")
        dimension.learn(part, "run", n, "item_id")
    seen = everything if cut > 1 else everything.filter("item_id <= 12")
    want = number_values(seen, "actor_name", "item_id", name="actor_id")
    assert rows(dimension.read(spark)) == rows(want)


def test_a_repeated_batch_gets_the_same_ids(spark, rows, dimension):
    first, second = _names(spark, ["a", "b"]), _names(spark, ["b", "c", "d"])
    dimension.learn(first, "run", 0, "item_id")
    dimension.learn(first, "run", 0, "item_id")
    dimension.learn(second, "run", 1, "item_id")
    before = rows(dimension.read(spark))
    assert before == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
    dimension.learn(second, "run", 1, "item_id")
    assert rows(dimension.read(spark)) == before
    # Another query counts its batches from 0 again; its names go on after the mark.
    dimension.learn(_names(spark, ["e", "a"]), "other", 1, "item_id")
    assert rows(dimension.read(spark)) == [*before, (5, "e")]


def test_a_batch_without_new_names_writes_nothing(spark, dimension, tmp_path):
    dimension.learn(_names(spark, ["a"]), "run", 0, "item_id")
    folders = sorted(p.name for p in (tmp_path / "d").iterdir())
    dimension.learn(_names(spark, ["a", "a"]), "run", 1, "item_id")
    dimension.learn(_names(spark, []), "run", 2, "item_id")
    assert sorted(p.name for p in (tmp_path / "d").iterdir()) == folders == ["since=-1", "since=0"]


def test_a_loaded_dimension_goes_on(spark, rows, dimension):
    loaded = spark.createDataFrame([(7, "x"), (3, "y")], "actor_id int, actor_name string")
    dimension.load(loaded)
    dimension.learn(_names(spark, ["y", "z", "x", "a"]), "run", 0, "item_id")
    assert rows(dimension.read(spark)) == [(3, "y"), (7, "x"), (8, "z"), (9, "a")]
    dimension.load(loaded)
    assert rows(dimension.read(spark)) == [(3, "y"), (7, "x")]


def test_large_dimension_is_not_shuffled_for_a_small_batch(spark, dimension, monkeypatch):
    """The known names are only filtered by the batch's; what is sorted and written is the batch's."""
    dimension.load(spark.range(1, 20_001).selectExpr("id AS actor_id", "concat('n', id) AS actor_name"))
    plans = []

    def note(frame, *args, **kwargs):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return number_values(frame, *args, **kwargs)

    monkeypatch.setattr("catalogflow.streaming.dimensions.number_values", note)
    dimension.learn(_names(spark, ["n5", "new"]), "run", 0, "item_id")
    (plan,) = plans
    known = plan[plan.index("BroadcastHashJoin", plan.index("LeftAnti") + 1) :]
    assert "LeftSemi, BuildRight" in known and "SortMergeJoin" not in known
    scanned = known[: known.index("since")]
    assert "Exchange" not in scanned
    assert dimension.read(spark).count() == 20_001


def _film(item, starring):
    return {"item_id": item, "title": "T (1999)", "genres": "g|h", "directedBy": "D",
            "starring": starring, "imdbId": "tt"}


class _Breaking(Tables):
    """Fails once after the second batch's names were learned."""

    def append(self, frame, name, batch_id, run):
        if name == "movies_actors" and batch_id == 1:
            raise RuntimeError("lost connection")
        super().append(frame, name, batch_id, run)


def test_the_job_leaves_no_name_unmatched_and_survives_a_failure(spark, rows, tmp_path):
    films = [_film(i, ", ".join(f"A{(i * 3 + k) % 17}" for k in range(4))) for i in range(24)]
    topic = tmp_path / "topic"
    topic.mkdir()
    for n in range(4):
        lines = [json.dumps(films[n * 6 : n * 6 + 3]), json.dumps(films[n * 6 + 3 : n * 6 + 6])]
        (topic / f"{n}.txt").write_text("\n".join(lines) + "\n")
    root = str(tmp_path / "t")
    dimensions = GrowingDimensions.below(f"{root}/dimensions")

    def run(tables):
        messages = replay_stream(spark, str(topic), max_files=1)
        movies_job(messages, dimensions, tables, str(tmp_path / "cp")).awaitTermination()

    with pytest.raises(StreamingQueryException):
        run(_Breaking(root))
    run(Tables(root))
    loaded = spark.createDataFrame(films)
    for listed, (column, kind, id_name, name) in schemas.LISTS.items():
        whole = normalize(loaded, column, kind, id_name, name)
        assert rows(dimensions.tables[listed].read(spark)) == rows(whole.dimension)
        bridge = Tables(root).read(spark, f"movies_{listed}")
        assert rows(bridge, "item_id", id_name) == rows(whole.bridge, "item_id", id_name)
    assert Tables(root).read(spark, "unmatched").count() == 0
