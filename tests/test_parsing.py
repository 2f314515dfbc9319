from pyspark.sql import functions as F

from catalogflow.operators.parsing import (
    accepted, parse_movies, parse_ratings, parse_reviews, rejected,
)


def _messages(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_ratings(spark, rows):
    parsed = parse_ratings(
        _messages(
            spark,
            '{"item_id": 5, "user_id": 7, "rating": 4}',
            '{"item_id": "6", "user_id": 8, "rating": 4.5, "z": [1]}',
            '{"item_id": 9}',
        )
    )
    assert rows(accepted(parsed)) == [(5, 7, 4.0), (6, 8, 4.5), (9, None, None)]
    assert rejected(parsed).count() == 0


def test_bad_ratings_are_kept_apart(spark, rows):
    bad = [
        "{oops", '[{"item_id":1}]', '{"user_id":1}', "", '{"item_id":"x","rating":1}',
        '{"item_id":1,"rating":"many"}',
    ]
    parsed = parse_ratings(_messages(spark, '{"item_id":1,"user_id":2,"rating":3}', *bad, None))
    assert rows(accepted(parsed)) == [(1, 2, 3.0)]
    assert rows(rejected(parsed)) == sorted([(b,) for b in bad] + [(None,)], key=repr)


def test_binary_payload(spark, rows):
    frame = _messages(spark, '{"item_id":1,"txt":"a\\nb"}').select(F.encode("value", "utf-8").alias("value"))
    assert rows(accepted(parse_reviews(frame))) == [(1, "a\nb")]


def test_reviews_need_a_text(spark, rows):
    parsed = parse_reviews(_messages(spark, '{"item_id":1,"txt":""}', '{"item_id":1}'))
    assert rows(accepted(parsed)) == [(1, "")]
    assert rows(rejected(parsed)) == [('{"item_id":1}',)]


def test_movies(spark, rows):
    parsed = parse_movies(
        _messages(
            spark,
            '[{"item_id":1,"title":"A (1990)","positive_reviews":2},{"item_id":2,"title":"B"}]',
            '{"item_id":3,"title":"C"}',
            "[]",
        )
    )
    picked = rows(accepted(parsed), "item_id", "title", "positive_reviews", "neutral_reviews")
    assert picked == [(1, "A (1990)", 2, 0), (2, "B", 0, 0), (3, "C", 0, 0)]
    assert rejected(parsed).count() == 0


def test_bad_movies_are_kept_apart(spark, rows):
    half = '[{"item_id":1,"title":"A"},{oops]'
    untitled = '[{"item_id":1,"title":"A"},{"item_id":2}]'
    parsed = parse_movies(_messages(spark, half, untitled))
    assert rows(accepted(parsed), "item_id") == [(1,)]
    assert rows(rejected(parsed)) == [(half,), ('{"item_id":"2"}',)]


def test_each_message_is_parsed_once(spark):
    plan = accepted(parse_ratings(_messages(spark, "{}").distinct()))
    physical = plan._jdf.queryExecution().executedPlan().toString()
    assert physical.count("from_json(") == 1


def test_undeclared_fields_are_kept(spark, rows, tmp_path):
    """Nested fields, arrays and numbers come back from a stored table; declared ones are not repeated."""
    texts = [
        '{"item_id": 1, "txt": "a", "extra": {"deep": [1, {"x": 2.5}]}, "n": 7}',
        '{"item_id": "2", "txt": "b"}',
        '{"txt": "no key", "n": 1}',
        "{oops",
        "[1, 2]",
        "",
    ]
    messages = spark.createDataFrame([(t,) for t in texts], "value string")
    parsed = parse_reviews(messages, rest=True)
    assert rows(parsed.drop("rest")) == rows(parse_reviews(messages))
    path = str(tmp_path / "t")
    accepted(parsed).write.parquet(path)
    stored = spark.read.parquet(path)
    assert dict(stored.dtypes)["rest"] == "variant"
    found = stored.select(
        "item_id",
        F.try_variant_get("rest", "$.extra.deep[1].x", "double").alias("x"),
        F.try_variant_get("rest", "$.n", "int").alias("n"),
        F.to_json("rest").alias("rest"),
    )
    assert sorted(map(tuple, found.collect())) == [
        (1, 2.5, 7, '{"extra":{"deep":[1,{"x":2.5}]},"n":7}'), (2, None, None, "{}"),
    ]


def test_undeclared_fields_of_films_and_ratings(spark, rows):
    texts = [
        '[{"item_id": 1, "title": "A", "tags": ["x", "y"]}, {"item_id": 2, "title": "B"}]',
        '{"item_id": 3, "title": "C", "more": null}', "[]", "{broken", '[{"title": "no key"}, 5]',
    ]
    messages = spark.createDataFrame([(t,) for t in texts], "value string")
    parsed = parse_movies(messages, rest=True)
    good = accepted(parsed)
    assert rows(good.drop("rest")) == rows(accepted(parse_movies(messages)))
    assert sorted((r.item_id, r.rest) for r in good.select("item_id", F.to_json("rest").alias("rest")).collect()) == [
        (1, '{"tags":["x","y"]}'), (2, "{}"), (3, '{"more":null}'),
    ]
    assert parsed.filter("not ok").count() == 3
    rated = parse_ratings(
        spark.createDataFrame([('{"item_id": 1, "rating": 2, "via": "app"}',)], "value string"), rest=True
    )
    assert rated.select(F.try_variant_get("rest", "$.via", "string")).first()[0] == "app"
