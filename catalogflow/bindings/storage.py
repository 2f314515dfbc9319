"""Sinks and scans: what is written must be read back."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogflow import schemas

from catalogflow.bindings import tables as t
from catalogflow.bindings.registry import query
from catalogflow.operators.aggregates import average
from catalogflow.operators.sampling import sample_rows
from catalogflow.plans import flag_holdout, flagged_holdout, normalize
from catalogflow.plans.bulkload import (
    bulk_load, load_in_parts, prepare_movies, prepare_reviews, stamp_loaded,
)
from catalogflow.functions.text import NEGATIVE_WORDS, POSITIVE_WORDS
from catalogflow.session import work_folder
from catalogflow.sinks import append_batch, create_table, replace_table, split_jsonl, write_jsonl
from catalogflow.sources import first_rows, read_csv, read_jsonl, read_table
from catalogflow.tables import Tables


@query("SELECT * FROM documents")
def roundtrip_jsonl(spark, sf):
    """Whole texts to JSON lines and back."""
    documents = t.load(spark, sf, "documents")
    path = work_folder(spark, "jsonl")
    write_jsonl(documents, path)
    return read_jsonl(spark, path, documents.schema)


@query("SELECT * FROM part")
def roundtrip_csv(spark, sf):
    part = t.load(spark, sf, "part")
    path = work_folder(spark, "csv")
    part.write.option("header", True).csv(path)
    return read_csv(spark, path, part.schema)


@query("SELECT 1000 AS read, 1000 AS known FROM (SELECT count(*) AS n FROM lineitem) WHERE n >= 1000")
def scan_first_rows(spark, sf):
    """A look at any thousand rows; which ones is open, so they are held against the table."""
    first = first_rows(t.ratings(spark, sf), 1000)
    source = t.ratings(spark, sf).distinct().withColumn("there", F.lit(1))
    found = first.join(source, first.columns, "left")
    return found.agg(
        F.count("*").cast("int").alias("read"), F.count("there").cast("int").alias("known")
    )


_HELD = "SELECT p_partkey FROM part ORDER BY md5('42:' || p_partkey), p_partkey LIMIT 10"


@query(
    f"SELECT *, CASE WHEN item_id IN ({_HELD}) THEN 'stream' ELSE 'db' END AS split "
    f"FROM ({t.RATINGS})"
)
def split_write(spark, sf):
    """One pass writes the stream side and the DB side."""
    keys = sample_rows(t.movies(spark, sf), 10, "item_id").select("item_id")
    ratings = t.ratings(spark, sf)
    path = work_folder(spark, "split")
    split_jsonl(flag_holdout(ratings, keys), "split", path)
    return read_jsonl(spark, path, f"{_ddl(ratings)}, split string")


def _ddl(frame) -> str:
    return ", ".join(f"{n} {k}" for n, k in frame.dtypes)


@query(
    "SELECT p_partkey AS item_id, CAST(p_size AS DOUBLE) AS \"avgRating\", "
    "1950 + p_size AS year FROM part"
)
def replace_with_types(spark, sf):
    """The second write replaces the first, with column types of its own."""
    part = t.load(spark, sf, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_size").alias("avgRating"),
        (F.lit(1950) + F.col("p_size")).cast("string").alias("year"),
    )
    path = work_folder(spark, "replace")
    replace_table(part, path)
    replace_table(part, path, {"avgRating": "double", "year": "int"})
    return spark.read.parquet(path)


@query(t.RATINGS)
def create_then_append(spark, sf):
    """A table created from a schema, then filled part by part, each part once."""
    lines = t.load(spark, sf, "lineitem")
    ratings = t.ratings(spark, sf)
    status = lines.select(
        F.col("l_partkey").alias("item_id"), F.col("l_suppkey").alias("user_id"),
        F.col("l_quantity").alias("rating"), "l_linestatus",
    )
    parts = [status.filter(F.col("l_linestatus") == s).drop("l_linestatus") for s in ("O", "F")]
    path = work_folder(spark, "parts")
    load_in_parts(parts, path)
    return read_table(spark, path, ratings.schema).drop("batch_id")


_AS_OF = datetime(2024, 12, 1, 12, 0, 0)


def _as_of():
    return F.lit(str(_AS_OF)).cast("timestamp_ntz")


_LOADED = "strftime(TIMESTAMP '2024-12-01 12:00:00' - INTERVAL 7 DAY + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S')"


@query(
    "SELECT item_id, title, TRY_CAST(nullif(regexp_extract(title, '\\((\\d{4})\\)', 1), '') "
    'AS INTEGER) AS year, CAST(0 AS DOUBLE) AS "avgRating", CAST(0 AS BIGINT) AS '
    f"positive_reviews, {_LOADED} AS timestamp FROM ({t.MOVIES})"
)
def bulk_load_movies(spark, sf):
    tables = Tables(work_folder(spark, "load"))
    bulk_load({"movies": prepare_movies(t.movies(spark, sf), _as_of())}, tables)
    columns = ["item_id", "title", "year", "avgRating", "positive_reviews", "timestamp"]
    return tables.read(spark, "movies").select(*columns)


@query(
    f"SELECT item_id, txt, {t.sentiment_sql('txt', POSITIVE_WORDS, NEGATIVE_WORDS)} "
    f"AS sentiment, {_LOADED} AS timestamp FROM ({t.REVIEWS})"
)
def bulk_load_reviews(spark, sf):
    tables = Tables(work_folder(spark, "load"))
    bulk_load({"reviews": prepare_reviews(t.reviews(spark, sf), as_of=_as_of())}, tables)
    return tables.read(spark, "reviews").drop("ingest_ts", "batch_id")


@query(
    f"SELECT item_id, count(*) AS ratings, CAST(sum(rating) AS DOUBLE) AS rating_sum, {t.AVERAGE} "
    f"FROM ({t.RATINGS}) GROUP BY item_id"
)
def bulk_load_ratings(spark, sf):
    """The whole ratings table loaded, and the totals it leaves."""
    tables = Tables(work_folder(spark, "load"))
    bulk_load({"ratings": stamp_loaded(t.ratings(spark, sf), _as_of())}, tables)
    counted = tables.read(spark, "ratings").groupBy("item_id").agg(F.count("*").alias("ratings"))
    totals = tables.read(spark, "rating_totals").select(
        "item_id", F.col("rating_sum").cast("double").alias("rating_sum"), average().alias("avgRating")
    )
    return counted.join(totals, "item_id")


def _bridge_sql(listed: str) -> str:
    column, kind, id_name, name = schemas.LISTS[listed]
    return (
        f"SELECT '{listed}' AS kind, item_id, {id_name} AS id FROM ({t.names_sql(column, kind, name)}) "
        f"JOIN ({t.dimension_sql(column, kind, id_name, name)}) USING ({name})"
    )


@query(" UNION ALL ".join(map(_bridge_sql, schemas.LISTS)))
def bulk_load_bridges(spark, sf):
    """Dimensions and bridges of all three lists, loaded and read back."""
    tables, movies = Tables(work_folder(spark, "load")), t.movies(spark, sf)
    found = []
    for listed, (column, kind, id_name, name) in schemas.LISTS.items():
        parts = normalize(movies, column, kind, id_name, name)
        bulk_load({listed: parts.dimension, f"movies_{listed}": parts.bridge}, tables)
        bridge = tables.read(spark, f"movies_{listed}")
        known = spark.read.parquet(tables.path(listed)).select(id_name)
        found.append(
            bridge.join(known, id_name).select(
                F.lit(listed).alias("kind"), "item_id", F.col(id_name).alias("id")
            )
        )
    return reduce(DataFrame.unionByName, found)


@query(
    " UNION ALL ".join(
        f"SELECT *, CASE WHEN item_id IN ({_HELD}) THEN 'stream' ELSE 'db' END AS split "
        f"FROM ({_bridge_sql(listed)})"
        for listed in schemas.LISTS
    )
)
def holdout_bridges(spark, sf):
    """The three bridge tables follow the films held out."""
    movies = t.movies(spark, sf)
    bridges = {
        listed: normalize(movies, *how).bridge for listed, how in schemas.LISTS.items()
    }
    flagged = flagged_holdout(movies, bridges)
    return reduce(
        DataFrame.unionByName,
        [
            flagged[listed].select(
                F.lit(listed).alias("kind"), "item_id", F.col(id_name).alias("id"), "split"
            )
            for listed, (_, _, id_name, _) in schemas.LISTS.items()
        ],
    )


@query(
    "SELECT l_partkey AS item_id, l_suppkey AS user_id, l_quantity AS rating, "
    "CAST(CASE l_linestatus WHEN 'O' THEN 0 ELSE 1 END AS BIGINT) AS batch_id FROM lineitem"
)
def append_retry(spark, sf):
    """Two batches, the first written twice: every row is there once."""
    lines = t.load(spark, sf, "lineitem")
    schema = t.ratings(spark, sf).schema
    path = work_folder(spark, "append")
    create_table(spark, path, schema)
    for batch_id, status in ((0, "O"), (0, "O"), (1, "F")):
        batch = lines.filter(F.col("l_linestatus") == status).select(
            F.col("l_partkey").alias("item_id"),
            F.col("l_suppkey").alias("user_id"),
            F.col("l_quantity").alias("rating"),
        )
        append_batch(batch, path, batch_id)
    return read_table(spark, path, schema)
