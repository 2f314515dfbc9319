"""Parsing, scalar functions, filters and samples."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from catalogflow.bindings import tables as t
from catalogflow.bindings.registry import query
from catalogflow.functions import ago_text, local_text, parse_local_text, sentiment, title_year
from catalogflow.functions.text import NEGATIVE_WORDS, POSITIVE_WORDS
from catalogflow.operators import keys, sampling
from catalogflow.operators.aggregates import average_ratings
from catalogflow.operators.parsing import (
    accepted, parse_movies, parse_ratings, parse_reviews, rejected,
)
from catalogflow.plans import rated_movies, recent_rows, wire_ratings
from catalogflow.plans.normalize import list_names
from catalogflow.sinks import message_per_row, messages_of_ten


@query(f"SELECT item_id, {t.AVERAGE} FROM ({t.RATINGS}) GROUP BY item_id")
def avg_rating(spark, sf):
    """Ratings to messages, back to rows, to the rounded average per film."""
    messages = message_per_row(wire_ratings(t.ratings(spark, sf)))
    return average_ratings(accepted(parse_ratings(messages)))


@query(
    "SELECT '{\"item_id\":' || item_id || ',\"user_id\":' || user_id || ',\"rating\":' || "
    f"CAST(rating AS BIGINT) || '}}' AS value FROM ({t.RATINGS})"
)
def encode_messages(spark, sf):
    return message_per_row(wire_ratings(t.ratings(spark, sf)))


@query(t.RATINGS)
def parse_ratings_topic(spark, sf):
    return accepted(parse_ratings(message_per_row(wire_ratings(t.ratings(spark, sf)))))


@query(
    'SELECT *, CAST(0 AS BIGINT) AS positive_reviews, CAST(0 AS BIGINT) AS negative_reviews, '
    f'CAST(0 AS BIGINT) AS neutral_reviews FROM ({t.MOVIES})'
)
def parse_movies_array(spark, sf):
    """Ten films per message and back to one row per film."""
    return accepted(parse_movies(messages_of_ten(t.movies(spark, sf), "item_id")))


@query(
    """
    SELECT CASE WHEN l_returnflag = 'A' THEN '{"item_id":' || l_partkey || ',"user_id'
                ELSE '{"user_id":' || l_suppkey || '}' END AS raw
    FROM lineitem WHERE l_returnflag IN ('A', 'R')
    """
)
def quarantine_malformed(spark, sf):
    """Messages cut short (flag A) or without a key (flag R) are kept apart."""
    item, user = F.col("l_partkey"), F.col("l_suppkey")
    flag = F.col("l_returnflag")
    cut = F.concat(F.lit('{"item_id":'), item, F.lit(',"user_id'))
    keyless = F.to_json(F.struct(user.alias("user_id")))
    whole = F.to_json(F.struct(item.alias("item_id"), user.alias("user_id")))
    value = F.when(flag == "A", cut).when(flag == "R", keyless).otherwise(whole)
    return rejected(parse_ratings(t.load(spark, sf, "lineitem").select(value.alias("value"))))


@query(
    "SELECT item_id, title, TRY_CAST(nullif(regexp_extract(title, '\\((\\d{4})\\)', 1), '') "
    f"AS INTEGER) AS year FROM ({t.MOVIES})"
)
def extract_year(spark, sf):
    return t.movies(spark, sf).select(
        "item_id", "title", title_year(F.col("title")).alias("year")
    )


@query(
    f"SELECT item_id, txt, {t.sentiment_sql('txt', POSITIVE_WORDS, NEGATIVE_WORDS)} "
    f"AS sentiment FROM ({t.REVIEWS})"
)
def sentiment_default(spark, sf):
    return t.reviews(spark, sf).withColumn("sentiment", sentiment(F.col("txt")))


# Frequent words of the four languages, standing in for word lists over real text.
_POSITIVE = ("the", "avec", "con", "mit")
_NEGATIVE = ("est", "nicht", "pero", "of")


@query(
    f"SELECT doc_id, {t.sentiment_sql('text', _POSITIVE, _NEGATIVE)} AS sentiment FROM documents"
)
def sentiment_lexicon(spark, sf):
    label = sentiment(F.col("text"), _POSITIVE, _NEGATIVE)
    return t.load(spark, sf, "documents").select("doc_id", label.alias("sentiment"))


@query(
    "SELECT event_id, strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS timestamp FROM events"
)
def ingest_time_text(spark, sf):
    return t.load(spark, sf, "events").select(
        "event_id", local_text(F.col("ts")).alias("timestamp")
    )


@query(
    "SELECT event_id, strftime(ts - INTERVAL 7 DAY + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') "
    "AS timestamp FROM events"
)
def backdated_time_text(spark, sf):
    return t.load(spark, sf, "events").select(
        "event_id", ago_text(F.col("ts"), 7).alias("timestamp")
    )


@query("SELECT event_id, epoch_us(ts) // 1000000 AS seconds FROM events")
def text_to_timestamp(spark, sf):
    text = local_text(F.col("ts"))
    return t.load(spark, sf, "events").select(
        "event_id", F.unix_seconds(parse_local_text(text)).alias("seconds")
    )


@query(
    "SELECT item_id, user_id, CAST(trunc(rating / 4) AS BIGINT) AS rating "
    f"FROM ({t.RATINGS})"
)
def wire_truncation(spark, sf):
    """Fractions of a rating are cut off on the wire."""
    quarter = t.ratings(spark, sf).withColumn("rating", F.col("rating") / 4)
    return wire_ratings(quarter)


@query(t.names_sql("starring", "mixed", "actor_name"))
def split_mixed_list(spark, sf):
    return list_names(t.movies(spark, sf), "starring", "mixed", "actor_name")


@query(t.names_sql("genres", "pipe", "genre_name"))
def split_pipe_list(spark, sf):
    return list_names(t.movies(spark, sf), "genres", "pipe", "genre_name")


@query(f"SELECT * FROM ({t.MOVIES}) WHERE item_id = 42")
def point_lookup(spark, sf):
    return keys.by_key(t.movies(spark, sf), "item_id", 42)


def _events(spark, sf):
    return t.load(spark, sf, "events").withColumn("ingest_ts", F.col("ts"))


def _latest(spark, sf):
    latest = t.load(spark, sf, "events").agg(F.max("ts").cast("string")).first()[0]
    return F.lit(latest).cast("timestamp_ntz")


@query(
    "SELECT event_id, user_id, event_type FROM events "
    "WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 1 DAY"
)
def recent_day(spark, sf):
    rows = recent_rows(_events(spark, sf), _latest(spark, sf), timedelta(days=1))
    return rows.select("event_id", "user_id", "event_type")


@query(
    "SELECT event_id, user_id, event_type FROM events "
    "WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 5 MINUTE "
    "ORDER BY ts DESC, event_id LIMIT 10"
)
def recent_minutes(spark, sf):
    """The newest ten rows of the last five minutes."""
    rows = recent_rows(_events(spark, sf), _latest(spark, sf), limit=10)
    return rows.select("event_id", "user_id", "event_type")


@query(f"SELECT * FROM ({t.RATINGS}) JOIN ({t.MOVIES}) USING (item_id)")
def ratings_join_movies(spark, sf):
    return rated_movies(t.ratings(spark, sf), t.movies(spark, sf))


@query(f"SELECT * FROM ({t.RATINGS}) ORDER BY rating DESC, item_id, user_id LIMIT 10")
def top_rows(spark, sf):
    return t.ratings(spark, sf).orderBy(F.desc("rating"), "item_id", "user_id").limit(10)


@query(f"SELECT item_id, title FROM ({t.MOVIES}) ORDER BY md5('42:' || item_id), item_id LIMIT 10")
def sample_items(spark, sf):
    return sampling.sample_rows(t.movies(spark, sf).select("item_id", "title"), 10, "item_id")


@query(
    "SELECT item_id, user_id, rating FROM (SELECT *, row_number() OVER (ORDER BY "
    "md5('42:' || item_id), item_id, user_id, rating) AS n "
    f"FROM ({t.RATINGS})) WHERE n <= 5000"
)
def sample_large(spark, sf):
    """A sample of thousands of rows takes the same way as a small one."""
    return sampling.sample_rows(t.ratings(spark, sf), 5000, "item_id")


@query(
    f"SELECT item_id, title FROM ({t.MOVIES}) "
    f"WHERE substr(md5('42:' || item_id), 1, 8) < '{round(0.05 * 2**32):08x}'"
)
def sample_fraction(spark, sf):
    return sampling.sample_fraction(
        t.movies(spark, sf).select("item_id", "title"), 0.05, "item_id"
    )


@query(
    """
    SELECT user_id AS item_id, event_type AS txt, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
      CASE WHEN event_type <> 'error' THEN value END AS amount,
      CASE WHEN event_type = 'error' THEN 'at,props' ELSE 'amount,at,props' END AS undeclared
    FROM events
    """
)
def parse_with_rest(spark, sf):
    """Reviews that carry fields nobody declared, nested ones too: kept, and read by path."""
    events = t.load(spark, sf, "events")
    amount = F.when(F.col("event_type") != "error", F.col("value"))
    known = F.to_json(F.struct(F.col("user_id").alias("item_id"), F.col("event_type").alias("txt"),
                               amount.alias("amount"), F.col("ts").cast("string").alias("at")))
    sent = F.concat(F.substring_index(known, "}", 1), F.lit(',"props":'), "props", F.lit("}"))
    parsed = accepted(parse_reviews(events.select(sent.alias("value")), rest=True))
    names = F.map_keys(F.variant_get("rest", "$", "map<string,variant>"))
    return parsed.select(
        "item_id",
        "txt",
        F.try_variant_get("rest", "$.props.k", "bigint").alias("k"),
        F.try_variant_get("rest", "$.amount", "double").alias("amount"),
        F.array_join(F.array_sort(names), ",").alias("undeclared"),
    )
