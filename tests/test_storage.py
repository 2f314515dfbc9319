import json
from functools import reduce

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogflow import schemas, sinks, sources
from catalogflow.operators.aggregates import add_review_totals
from catalogflow.plans import replay, wire_ratings
from catalogflow.plans.bulkload import load_in_parts, prepare_movies, prepare_reviews
from catalogflow.sources import jdbc_options, kafka_options
from catalogflow.session import work_folder
from catalogflow.tables import Tables


def test_same_batch_twice_changes_nothing(spark, rows, tmp_path):
    table = str(tmp_path / "t")
    schema = spark.range(0).schema
    sinks.create_table(spark, table, schema)
    for batch_id, frame in ((0, spark.range(5)), (1, spark.range(2)), (0, spark.range(5))):
        sinks.append_batch(frame, table, batch_id)
        sinks.create_table(spark, table, schema)
    assert sources.read_table(spark, table, schema).count() == 7
    assert rows(sources.read_table(spark, table, schema, since=1)) == [(0, 1), (1, 1)]


def test_table_without_batches_can_be_read(spark, tmp_path):
    table = str(tmp_path / "t")
    sinks.create_table(spark, table, schemas.RATINGS)
    assert sources.read_table(spark, table, schemas.RATINGS).count() == 0


def test_compacting_keeps_the_totals(spark, rows, tmp_path):
    tables = Tables(str(tmp_path / "t"))
    tables.create(spark, "review_totals")
    whole = []
    for run in ("a", "b"):
        for n in range(3):
            batch = spark.createDataFrame([(1, 1, 0, 2), (n, 0, 1, 0)], schemas.REVIEW_TOTALS)
            tables.append(batch, "review_totals", n, run)
            tables.commit(spark, n, run)
            whole.append(batch)
        before = rows(add_review_totals(tables.read(spark, "review_totals")))
        tables.compact(spark, "review_totals")
        assert rows(add_review_totals(tables.read(spark, "review_totals"))) == before
        assert tables.visible(spark, "review_totals").filter("batch_id >= 0").count() == 1
    tables.vacuum(spark, "review_totals")
    assert rows(add_review_totals(tables.read(spark, "review_totals"))) == before
    assert rows(add_review_totals(reduce(DataFrame.unionByName, whole))) == before
    assert len(list((tmp_path / "t" / "review_totals").glob("run=compact-*/batch_id=*"))) == 1


def test_a_batch_is_seen_once_committed(spark, rows, tmp_path):
    tables = Tables(str(tmp_path / "t"))
    tables.create(spark, "unmatched")
    batch = spark.createDataFrame([("genres", "x", 1)], schemas.UNMATCHED)
    for run in ("a", "b"):
        tables.append(batch, "unmatched", 0, run)
    assert tables.read(spark, "unmatched").count() == 0
    tables.commit(spark, 0, "a")
    assert rows(tables.read(spark, "unmatched")) == [("genres", "x", 1, 0)]
    tables.commit(spark, 0, "b")
    assert tables.read(spark, "unmatched").count() == 2
    tables.replace(batch, "unmatched")
    assert rows(tables.read(spark, "unmatched"), "batch_id") == [(-2,)]


def test_replace_with_types(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([(1, "1999")], "a int, year string")
    sinks.replace_table(frame, path)
    sinks.replace_table(frame, path, {"year": "int", "a": "double"})
    assert spark.read.parquet(path).dtypes == [("a", "double"), ("year", "int")]
    assert spark.read.parquet(path).count() == 1


def test_parts_are_loaded_once_each(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    load_in_parts([spark.range(0, 3), spark.range(3, 5)], path)
    assert rows(sources.read_table(spark, path, spark.range(0).schema), "id") == [
        (i,) for i in range(5)
    ]


def test_jsonl_and_csv_keep_odd_texts(spark, rows, tmp_path):
    texts = ['say "hi", ok', "a\tb", "ü", None, "line\nbreak", "x\\y"]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    sinks.write_jsonl(frame, str(tmp_path / "j"))
    assert rows(sources.read_jsonl(spark, str(tmp_path / "j"), frame.schema)) == rows(frame)
    assert dict(sources.read_jsonl(spark, str(tmp_path / "j")).dtypes) == {"i": "bigint", "t": "string"}
    (tmp_path / "c.csv").write_text('i,t\n0,"say ""hi"", ok"\n1,"line\nbreak"\n2,\n')
    read = sources.read_csv(spark, str(tmp_path / "c.csv"), "i int, t string", multiline=True)
    assert rows(read) == [(0, 'say "hi", ok'), (1, "line\nbreak"), (2, None)]


def test_split_writes_both_sides(spark, tmp_path):
    frame = spark.range(10).withColumn("split", F.when(F.col("id") < 3, "stream").otherwise("db"))
    sinks.split_jsonl(frame, "split", str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "s" / "split=stream")).count() == 3
    assert spark.read.json(str(tmp_path / "s")).count() == 10


def test_messages_of_ten_pack_every_row(spark):
    frame = spark.range(0, 95, 1, 4).select(F.col("id").alias("item_id"), F.lit(None).cast("string").alias("t"))
    packed = [json.loads(r["value"]) for r in sinks.messages_of_ten(frame, "item_id").collect()]
    assert sorted(o["item_id"] for m in packed for o in m) == list(range(95))
    assert max(map(len, packed)) == 10 and sum(len(m) < 10 for m in packed) <= 4
    assert all([o["item_id"] for o in m] == sorted(o["item_id"] for o in m) for m in packed)
    assert packed[0][0].keys() == {"item_id", "t"}


def test_wire_truncates_toward_zero(spark, rows):
    frame = spark.createDataFrame([(1, 2, 4.5), (1, 2, -0.5)], "item_id int, user_id int, rating double")
    assert rows(wire_ratings(frame), "rating") == [(0,), (4,)]
    assert rows(wire_ratings(frame, truncate=False), "rating") == [(-0.5,), (4.5,)]


def test_replay_files_are_bounded(spark, tmp_path):
    frame = spark.range(0, 40, 1, 2).select(
        F.col("id").alias("item_id"), F.col("id").alias("user_id"), F.lit(1.0).alias("rating")
    )
    replay("ratings", frame, str(tmp_path / "r"), per_file=5)
    assert len(list((tmp_path / "r").glob("*.txt"))) == 8


def test_loaded_rows_are_seven_days_old(spark):
    as_of = F.lit("2024-01-08 00:00:00").cast("timestamp")
    reviews = spark.createDataFrame([(1, "bad")], "item_id bigint, txt string")
    row = prepare_reviews(reviews, as_of=as_of).first()
    assert (row["sentiment"], row["timestamp"]) == ("negative", "2024-01-01 07:00:00")
    assert prepare_reviews(reviews, scored=False, as_of=as_of).first()["sentiment"] == "neutral"
    movies = spark.createDataFrame([(1, "A (1990)")], "item_id bigint, title string")
    movie = prepare_movies(movies, as_of).first()
    assert (movie["avgRating"], movie["positive_reviews"], movie["year"]) == (0.0, 0, 1990)


def test_connector_options():
    assert kafka_options("b:1", "ratings", max_offsets=10) == {
        "kafka.bootstrap.servers": "b:1", "subscribe": "ratings",
        "startingOffsets": "earliest", "maxOffsetsPerTrigger": "10",
    }
    assert jdbc_options("u", "t") == {"url": "u", "dbtable": "t", "fetchsize": "10000"}
    ranged = jdbc_options("u", query="SELECT 1 AS k", partition_column="k", bounds=(0, 9), partitions=3)
    assert ranged["dbtable"] == "(SELECT 1 AS k) AS q" and ranged["numPartitions"] == "3"
    with pytest.raises(ValueError):
        jdbc_options("u")
    with pytest.raises(ValueError):
        jdbc_options("u", "t", partition_column="k")


def test_missing_connector_fails_at_once(spark):
    with pytest.raises(AnalysisException):
        sources.kafka_stream(spark, "b:1", "ratings")


def test_work_folders_lie_in_the_shared_one(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = work_folder(spark, "x"), work_folder(spark, "x")
    assert first != second and first.startswith(root)
