"""State that begins with loaded totals: averages over loaded and streamed ratings."""

import json

import pytest

from catalogflow import schemas
from catalogflow.operators.aggregates import average_ratings, rating_totals
from catalogflow.sources import read_table, replay_stream
from catalogflow.streaming import averages_after_load, sentiment_after_load
from catalogflow.streaming.history import averages_so_far, sentiment_so_far

OLD = [(i % 4, float(i % 5) + 0.5) for i in range(30)] + [(99, 4.0)]
NEW = [[(i % 6, float((i * 7 + f) % 6)) for i in range(20)] + [(7, 2.0)] * 40 for f in range(3)]


@pytest.fixture
def topic(tmp_path):
    folder = tmp_path / "topic"
    folder.mkdir()

    def write(n, objects):
        (folder / f"{n}.txt").write_text("".join(json.dumps(o) + "\n" for o in objects))
        return str(folder)

    return write


def _ratings(spark, pairs):
    return spark.createDataFrame(pairs, "item_id bigint, rating double")


def _messages(pairs):
    return [{"item_id": i, "user_id": 1, "rating": r} for i, r in pairs]


def test_averages_cover_loaded_and_streamed_ratings(spark, rows, topic, tmp_path):
    loaded = rating_totals(_ratings(spark, OLD))
    table, checkpoint = str(tmp_path / "running"), str(tmp_path / "cp")

    def run(history=loaded):
        messages = replay_stream(spark, str(tmp_path / "topic"), max_files=1)
        averages_after_load(messages, history, table, checkpoint).awaitTermination()

    topic(0, [*_messages(NEW[0]), {"item_id": 1, "user_id": 2, "rating": "x"}])
    run()
    assert rows(averages_so_far(spark, table, loaded)) == rows(
        average_ratings(_ratings(spark, OLD + NEW[0]))
    )
    # From its checkpoint the query goes on with its state; the history is not added again.
    topic(1, _messages(NEW[1]))
    topic(2, _messages(NEW[2]))
    run()
    run()
    everything = _ratings(spark, OLD + NEW[0] + NEW[1] + NEW[2])
    assert rows(averages_so_far(spark, table, loaded)) == rows(average_ratings(everything))
    # Every batch holds the totals so far of the items it touched, and of no others.
    versions = read_table(spark, table, schemas.RATING_TOTALS)
    first = versions.filter("batch_id = 0")
    assert rows(first, "item_id", "rating_count") == rows(
        rating_totals(_ratings(spark, OLD + NEW[0])).filter("item_id < 8"), "item_id", "rating_count"
    )


def test_a_hot_item_is_summed_before_the_shuffle(spark, topic, tmp_path):
    """What reaches the state is a row for each item and task, not one for each rating."""
    messages = replay_stream(spark, topic(0, _messages([(5, 1.0)] * 3000)))
    table = str(tmp_path / "running")
    nothing = rating_totals(_ratings(spark, []))
    query = averages_after_load(messages, nothing, table, str(tmp_path / "cp"))
    query.awaitTermination()
    (state,) = [o for p in query.recentProgress for o in p["stateOperators"] if p["numInputRows"]]
    assert state["numRowsTotal"] == 1
    assert averages_so_far(spark, table, nothing).collect() == [(5, 1.0)]
    assert read_table(spark, table, schemas.RATING_TOTALS).count() == 1


def test_an_empty_history_and_an_empty_topic(spark, rows, topic, tmp_path):
    nothing, some = rating_totals(_ratings(spark, [])), rating_totals(_ratings(spark, OLD))
    for n, (history, pairs) in enumerate([(nothing, NEW[0]), (some, [])]):
        table = str(tmp_path / f"running{n}")
        messages = replay_stream(spark, topic(0, _messages(pairs)))
        averages_after_load(messages, history, table, str(tmp_path / f"cp{n}")).awaitTermination()
        whole = _ratings(spark, pairs + (OLD if history is some else []))
        assert rows(averages_so_far(spark, table, history)) == rows(average_ratings(whole))


def test_sentiment_counters_go_on(spark, rows, topic, tmp_path):
    loaded = spark.createDataFrame([(1, 2, 0, 1), (4, 0, 0, 3)], schemas.REVIEW_TOTALS)
    texts = [(1, "so good"), (1, "bad"), (2, "plain"), (2, "good but sad"), (3, None)]
    messages = replay_stream(spark, topic(0, [{"item_id": i, "txt": t} for i, t in texts]))
    table = str(tmp_path / "running")
    sentiment_after_load(messages, loaded, table, str(tmp_path / "cp")).awaitTermination()
    assert rows(sentiment_so_far(spark, table, loaded)) == [
        (1, 3, 1, 1), (2, 0, 0, 2), (4, 0, 0, 3),
    ]


def test_the_session_keeps_its_state_store(spark, topic, tmp_path):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    messages = replay_stream(spark, topic(0, _messages(NEW[0])))
    nothing = rating_totals(_ratings(spark, []))
    averages_after_load(messages, nothing, str(tmp_path / "t"), str(tmp_path / "cp")).awaitTermination()
    assert spark.conf.get(name) == before


def test_the_state_is_kept_without_python_and_begins_once(spark, rows, topic, tmp_path):
    """No call into Python for each item and batch; a restart with another history adds nothing."""
    loaded = rating_totals(_ratings(spark, OLD))
    table, checkpoint = str(tmp_path / "running"), str(tmp_path / "cp")
    for n, history in enumerate([loaded, loaded.unionByName(loaded)]):
        messages = replay_stream(spark, topic(n, _messages(NEW[n])), max_files=1)
        query = averages_after_load(messages, history, table, checkpoint)
        query.awaitTermination()
        operators = [o["operatorName"] for p in query.recentProgress for o in p["stateOperators"]]
        assert operators and set(operators) == {"stateStoreSave"}
    found = averages_so_far(spark, table, loaded)
    assert rows(found) == rows(average_ratings(_ratings(spark, OLD + NEW[0] + NEW[1])))


def test_null_ratings_do_not_end_the_query(spark, rows, topic, tmp_path):
    """They count as little as in the loaded totals, whether an item has others or not."""
    old, new = [(1, 4.0), (2, None)], [(1, None), (2, 3.0), (3, None), (4, 2.0), (4, None)]
    loaded, table = rating_totals(_ratings(spark, old)), str(tmp_path / "running")
    messages = replay_stream(spark, topic(0, _messages(new)))
    averages_after_load(messages, loaded, table, str(tmp_path / "cp")).awaitTermination()
    assert rows(averages_so_far(spark, table, loaded)) == rows(average_ratings(_ratings(spark, old + new)))
