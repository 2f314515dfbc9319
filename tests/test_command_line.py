"""The whole way on the command line: merge, normalise, hold out, load, replay, stream."""

import json

import pytest

from catalogflow.__main__ import _dimension, main


def _lines(path, objects):
    path.write_text("".join(json.dumps(o) + "\n" for o in objects))
    return str(path)


def test_from_sources_to_snapshot(spark, rows, tmp_path, capsys):
    run = lambda *argv: main([str(a) for a in argv], spark)
    at = lambda *parts: str(tmp_path.joinpath(*parts))

    metadata = _lines(
        tmp_path / "metadata.jsonl",
        [
            {"item_id": i, "title": f"F{i} ({1990 + i})", "directedBy": "D", "starring": f"A{i}, B",
             "avgRating": 1.0, "imdbId": f"tt{i}"}
            for i in range(20)
        ],
    )
    (tmp_path / "movies.csv").write_text(
        "movieId,title,genres\n" + "".join(f'{i},"F, {i}",x|g{i % 3}\n' for i in range(20))
    )
    (tmp_path / "links.csv").write_text(
        "movieId,imdbId,tmdbId\n" + "".join(f"{i},{i},{i}\n" for i in range(20))
    )
    ratings = _lines(
        tmp_path / "ratings.jsonl",
        [{"item_id": i % 20, "user_id": i, "rating": 3.5} for i in range(200)],
    )
    reviews = _lines(
        tmp_path / "reviews.jsonl", [{"item_id": i % 20, "txt": "so good"} for i in range(60)]
    )

    run("merge", "--metadata", metadata, "--catalogue", at("movies.csv"), "--links",
        at("links.csv"), "--out", at("merged"))
    assert spark.read.json(at("merged")).filter("genres IS NOT NULL").count() == 20

    run("normalize", "--movies", at("merged"), "--out", at("tables"))
    assert rows(spark.read.json(at("tables", "genres")), "genre_id", "genre_name") == [
        (1, "x"), (2, "g0"), (3, "g1"), (4, "g2"),
    ]
    assert spark.read.json(at("tables", "movies_actors")).count() == 40
    assert spark.read.json(at("tables", "movies")).filter("year = 1990 + item_id").count() == 20

    run("holdout", "--movies", at("merged"), "--table", f"ratings={ratings}", "--table",
        f"reviews={reviews}", "--films", 4, "--out", at("split"))
    assert spark.read.json(at("split", "ratings", "split=stream")).count() == 40
    assert spark.read.json(at("split", "ratings", "split=db")).count() == 160

    tables = [f"{n}={at('split', n, 'split=db')}" for n in ("movies", "ratings", "reviews")]
    run("load", *[a for t in tables for a in ("--table", t)], "--root", at("live"))
    assert spark.read.parquet(at("live", "ratings")).count() == 160
    # dimensions as loaded serve the stream as well as those that were just written
    dims = [a for n in ("genres", "actors", "directors") for a in ("--table", f"{n}={at('tables', n)}")]
    run("load", *dims, "--root", at("loaded"))
    assert spark.read.parquet(at("live", "reviews")).first()["sentiment"] == "positive"

    for topic in ("movies", "ratings", "reviews"):
        run("replay", "--topic", topic, "--table", at("split", topic, "split=stream"), "--out",
            at("topics", topic), "--per-file", 15)
    for dimensions in ("tables", "loaded"):
        run("stream", "--root", at("live"), "--dimensions", at(dimensions), "--replay", at("topics"),
            "--max-files", 2, "--once")
    run("snapshot", "--root", at("live"), "--out", at("now"))
    now = spark.read.parquet(at("now"))
    streamed = now.join(spark.read.json(at("split", "movies", "split=stream")).select("item_id"), "item_id")
    # half stars are cut off on the wire
    assert rows(streamed, "avgRating", "positive_reviews") == [(3.0, 3)] * 4
    loaded = now.join(streamed, "item_id", "left_anti")
    assert rows(loaded, "avgRating", "positive_reviews") == [(3.5, 3)] * 16
    assert spark.read.parquet(at("live", "movies_genres")).count() == 8

    run("stream", "--root", at("learned"), "--learn", "--replay", at("topics"), "--once")
    assert spark.read.parquet(at("learned", "movies_genres")).count() == 8
    assert spark.read.parquet(at("learned", "unmatched")).isEmpty()
    assert spark.read.parquet(at("learned", "dimensions", "directors")).count() == 1

    run("compact", "--root", at("live"))
    run("compact", "--root", at("live"), "--vacuum", "--table", "ratings")
    run("serve", "--root", at("live"), "--out", at("served"))
    assert rows(spark.read.parquet(at("served"))) == rows(now)
    run("serve", "--root", at("live"), "--minutes", 60, "--out", at("served"))
    assert spark.read.parquet(at("served")).count() == 40
    run("serve", "--root", at("live"), "--table", "reviews", "--item", 3, "--out", at("served"))
    assert spark.read.parquet(at("served")).count() == 3
    run("serve", "--root", at("live"), "--per-title")
    assert "F3 (1993)" in capsys.readouterr().out

    run("profile", "--table", at("merged"))
    assert "distinct_values" in capsys.readouterr().out


def test_a_dimension_of_another_form_is_an_error(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "other int, name string").write.json(str(tmp_path / "genres"))
    with pytest.raises(ValueError):
        _dimension(spark, str(tmp_path / "genres"), "genres")


def test_stream_needs_one_source(spark):
    with pytest.raises(SystemExit):
        main(["stream", "--root", "r", "--dimensions", "d"], spark)
