"""Keyed tables: only touched parts are rewritten, a repeated batch changes nothing more."""

import json
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from catalogflow.keyed import KeyedTable
from catalogflow.sources import replay_stream
from catalogflow.streaming import Catalogue, catalogue_job


@pytest.fixture
def table(spark, tmp_path):
    made = KeyedTable(str(tmp_path / "t"), "k bigint", "n bigint", "name string", parts=8)
    made.create(spark)
    return made


def _delta(spark, changes):
    """key, amount, name to set or None."""
    frame = spark.createDataFrame(changes, "k bigint, n bigint, name string")
    return frame.withColumn("is_set", F.col("name").isNotNull())


def _files(tmp_path):
    return {str(p): p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}


def test_updates_add_and_set(spark, rows, table):
    table.update(_delta(spark, [(1, 5, "a"), (2, None, "b"), (None, 7, None)]), "r", 0)
    changed = table.update(_delta(spark, [(1, 2, None), (3, 1, "c"), (2, 4, "B")]), "r", 1)
    assert rows(table.read(spark)) == rows(
        spark.createDataFrame(
            [(1, "a", 7), (2, "B", 4), (3, "c", 1), (None, None, 7)], "k bigint, name string, n bigint"
        )
    )
    assert rows(changed, "k", "name", "n", "before.n", "before.name") == rows(
        spark.createDataFrame(
            [(1, "a", 7, 5, "a"), (2, "B", 4, 0, "b"), (3, "c", 1, None, None)],
            "k bigint, name string, n bigint, bn bigint, bname string",
        )
    )
    assert rows(table.lookup(spark, 1, 3, 9)) == [(1, "a", 7), (3, "c", 1)]


def test_a_repeated_batch_changes_nothing(spark, rows, table):
    first, second = [(i, i, f"n{i}") for i in range(20)], [(i, 1, None) for i in range(10, 30)]
    table.update(_delta(spark, first), "r", 0)
    once = rows(table.update(_delta(spark, second), "r", 1))
    after = rows(table.read(spark))
    for _ in range(2):
        assert rows(table.update(_delta(spark, second), "r", 1)) == once
        assert rows(table.read(spark)) == after


def test_a_batch_that_replaced_some_parts_only_is_made_whole(spark, rows, table):
    """What an attempt left in some of its parts is taken back before the batch is applied again."""
    table.update(_delta(spark, [(i, 10, None) for i in range(40)]), "r", 0)
    batch = [(i, 1, "x") for i in range(30, 60)]
    # The first attempt reached the keys of two parts.
    part = F.pmod(F.xxhash64("k"), F.lit(8))
    table.update(_delta(spark, batch).filter(part < 2), "r", 1)
    table.update(_delta(spark, batch), "r", 1)
    want = {i: (None, 10) for i in range(30)} | {i: ("x", 11) for i in range(30, 40)}
    want |= {i: ("x", 1) for i in range(40, 60)}
    assert {r.k: (r.name, r.n) for r in table.read(spark).collect()} == want


def test_untouched_files_stay(spark, table, tmp_path):
    table.update(_delta(spark, [(i, 1, None) for i in range(200)]), "r", 0)
    before = _files(tmp_path)
    table.update(_delta(spark, [(3, 1, None), (4, 1, None)]), "r", 1)
    after = _files(tmp_path)
    gone = {f.split("part=")[1].split("/")[0] for f in before if f not in after}
    touched = spark.createDataFrame([(3,), (4,)], "k bigint").select(F.pmod(F.xxhash64("k"), F.lit(8)))
    assert gone == {str(r[0]) for r in touched.distinct().collect()}
    assert all(after[f] == when for f, when in before.items() if f in after)
    table.update(_delta(spark, []), "r", 2)
    assert _files(tmp_path) == after


def test_an_update_reads_its_parts_only(spark, table, monkeypatch):
    from catalogflow import keyed

    table.update(_delta(spark, [(i, 1, None) for i in range(200)]), "r", 0)
    plans = []

    def note(frame, label):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return keyed_materialize(frame, label)

    keyed_materialize = keyed.materialize
    monkeypatch.setattr(keyed, "materialize", note)
    table.update(_delta(spark, [(3, 1, None)]), "r", 1)
    assert re.search(r"PartitionFilters: \[[^\]]*part#", plans[1])
    assert table.lookup(spark, 3).count() == 1
    lookup = table.lookup(spark, 3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in lookup and "EqualTo(k,3)" in lookup


def test_rebuilding_replaces_the_table(spark, rows, table):
    table.update(_delta(spark, [(i, 1, "x") for i in range(50)]), "r", 0)
    table.rebuild(spark.createDataFrame([(1, 3), (None, 2)], "k bigint, n bigint"))
    assert rows(table.read(spark), "n", "name") == [(2, None), (3, None)]
    table.update(_delta(spark, [(1, 1, "y")]), "r", 0)
    assert rows(table.read(spark), "n", "name") == [(2, None), (4, "y")]


# --- the catalogue kept by one query -------------------------------------------------


def _expected(sent):
    ratings, reviews, films = defaultdict(list), defaultdict(Counter), {}
    for topic, o in sent:
        if topic == "ratings":
            ratings[o["item_id"]].append(o["rating"])
        elif topic == "reviews":
            words = o["txt"].split()
            kind = "positive" if "good" in words else "negative" if "bad" in words else "neutral"
            reviews[o["item_id"]][kind] += 1
        else:
            films[o["item_id"]] = o["title"]
    movies = {
        i: (t, round(sum(ratings[i]) / len(ratings[i]) + 1e-9, 2) if ratings[i] else 0.0,
            *(reviews[i][k] for k in ("positive", "negative", "neutral")))
        for i, t in films.items()
    }
    titles = Counter()
    for i, t in films.items():
        titles[t] += len(ratings[i])
    return movies, {t: n for t, n in titles.items() if n}


def _found(spark, catalogue):
    counters = [f"{s}_reviews" for s in ("positive", "negative", "neutral")]
    movies = catalogue.movies(spark).select("item_id", "title", "avgRating", *counters)
    titles = catalogue.ratings_per_title(spark)
    return {r[0]: tuple(r)[1:] for r in movies.collect()}, dict(map(tuple, titles.collect()))


class _Breaking(KeyedTable):
    """Fails once for the second batch, after the films and before the titles are updated."""

    def update(self, delta, run, batch_id):
        if batch_id == 1:
            raise RuntimeError("lost connection")
        return super().update(delta, run, batch_id)


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_arrival_ends_alike(spark, tmp_path, seed):
    """Late films, renamed films, equal titles, unknown films, a failure between the two tables."""
    r = random.Random(seed)
    sent = [("ratings", {"item_id": r.randrange(12), "user_id": 1, "rating": r.randrange(6)}) for _ in range(60)]
    sent += [("reviews", {"item_id": r.randrange(12), "txt": r.choice(["good", "bad", "so"])}) for _ in range(30)]
    films = [("movies", {"item_id": i, "title": f"T{i % 4}"}) for i in range(9)]
    sent += films
    r.shuffle(sent)
    # Two of the films get another title in the end.
    sent += [("movies", {"item_id": i, "title": "new"}) for i in (2, 5)]
    topics = {n: tmp_path / n for n in ("movies", "ratings", "reviews")}
    for path in topics.values():
        path.mkdir()
    catalogue = Catalogue.below(str(tmp_path / "c"), parts=4)
    breaking = Catalogue(catalogue.films, _Breaking(**vars(catalogue.titles)))

    def run(into):
        streams = {n: replay_stream(spark, str(p)) for n, p in topics.items()}
        catalogue_job(streams, into, str(tmp_path / "cp")).awaitTermination()

    cut = [0, 40, 75, len(sent) - 2, len(sent)]
    for n, (i, j) in enumerate(zip(cut, cut[1:])):
        for topic, path in topics.items():
            objects = [[o] if topic == "movies" else o for t, o in sent[i:j] if t == topic]
            (path / f"{n}.txt").write_text("".join(json.dumps(o) + "\n" for o in [*objects, "{broken"]))
        if n == 1:
            with pytest.raises(StreamingQueryException):
                run(breaking)
        run(catalogue)
        assert _found(spark, catalogue) == _expected(sent[:j])
