"""Roles of the driver's tables, once as DataFrames and once as SQL for the checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spelled out here, so that a wrong set in the package shows (fixed values: white space).
WHITESPACE_CLASS = (
    r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
    r"\x{202f}\x{205f}\x{3000}]"
)


def load(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def movies(spark: SparkSession, sf: str, *more: Column) -> DataFrame:
    """item_id, title, imdbId, genres, starring, directedBy from ``part``, and ``more`` of it.

    Starring has a repeated name, runs of delimiters and an empty part at the end.
    Titles of ECONOMY parts hold the key instead of a year.
    """
    key = F.col("p_partkey").cast("string")
    shown = F.when(F.col("p_type") == "ECONOMY", key).otherwise(
        (F.lit(1950) + F.col("p_size")).cast("string")
    )
    return load(spark, sf, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.concat("p_name", F.lit(" ("), shown, F.lit(")")).alias("title"),
        F.concat(F.lit("tt"), F.lpad(key, 7, "0")).alias("imdbId"),
        F.translate("p_name", " ", "|").alias("genres"),
        F.concat(
            "p_brand", F.lit(", "), "p_type", F.lit(" ,,\t"), "p_name", F.lit("\n"), "p_brand",
            F.lit(","),
        ).alias("starring"),
        F.col("p_type").alias("directedBy"),
        *more,
    )


MOVIES = r"""
SELECT p_partkey AS item_id,
  p_name || ' (' || CASE WHEN p_type = 'ECONOMY' THEN CAST(p_partkey AS VARCHAR)
                         ELSE CAST(1950 + p_size AS VARCHAR) END || ')' AS title,
  'tt' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS "imdbId",
  replace(p_name, ' ', '|') AS genres,
  p_brand || ', ' || p_type || ' ,,' || chr(9) || p_name || chr(10) || p_brand || ','
    AS starring,
  p_type AS "directedBy"
FROM part
"""


def ratings(spark: SparkSession, sf: str) -> DataFrame:
    """item_id, user_id, rating from ``lineitem``."""
    return load(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("item_id"),
        F.col("l_suppkey").alias("user_id"),
        F.col("l_quantity").alias("rating"),
    )


RATINGS = "SELECT l_partkey AS item_id, l_suppkey AS user_id, l_quantity AS rating FROM lineitem"

# One text per event type: positive, neutral without a hit, both lists, negative, and a
# word with punctuation, which is no hit.
_REVIEW_TEXTS = {
    "click": "A great buy",
    "view": "plain visit",
    "signup": "Good but\tSAD",
    "error": "Terrible page",
    "purchase": "great! value",
}


def reviews(spark: SparkSession, sf: str, *more: Column) -> DataFrame:
    """item_id, txt from ``events``, and ``more`` of it."""
    text = F.lit("")
    for kind, words in _REVIEW_TEXTS.items():
        text = F.when(F.col("event_type") == kind, words).otherwise(text)
    return load(spark, sf, "events").select(
        F.col("user_id").alias("item_id"), F.concat(text, F.lit(" "), "props").alias("txt"), *more
    )


_CASES = " ".join(
    "WHEN event_type = '{}' THEN '{}'".format(k, w.replace("\t", "' || chr(9) || '"))
    for k, w in _REVIEW_TEXTS.items()
)
REVIEWS = (
    f"SELECT user_id AS item_id, (CASE {_CASES} ELSE '' END) || ' ' || props AS txt FROM events"
)


def sentiment_sql(text: str, positive, negative) -> str:
    """The label of ``text`` in SQL, by whole tokens."""

    def hit(words) -> str:
        listed = ", ".join(f"'{w}'" for w in words)
        return f"list_has_any(string_split_regex(lower({text}), '{WHITESPACE_CLASS}+'), [{listed}])"

    good, bad = hit(positive), hit(negative)
    return (
        f"CASE WHEN {good} AND NOT {bad} THEN 'positive' "
        f"WHEN {bad} AND NOT {good} THEN 'negative' ELSE 'neutral' END"
    )


# Average to two decimals, half up, by whole numbers: ratings here are whole.
AVERAGE = (
    'CAST((200 * CAST(sum(rating) AS BIGINT) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 '
    'AS "avgRating"'
)


def names_sql(column: str, kind: str, name: str) -> str:
    """item_id, pos and name of every list entry in SQL."""
    if kind == "pipe":
        parts, part = f"string_split({column}, '|')", "parts[i]"
    else:
        parts = rf"string_split_regex({column}, '[,\t\n]+')"
        part = f"regexp_replace(parts[i], '^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$', '', 'g')"
    return (
        f"SELECT item_id, CAST(i - 1 AS INTEGER) AS pos, {part} AS {name} "
        f"FROM (SELECT item_id, {parts} AS parts FROM ({MOVIES})), "
        "unnest(range(1, len(parts) + 1)) AS u(i)"
    )


def dimension_sql(column: str, kind: str, id_name: str, name: str, start: int = 1) -> str:
    """Ids by first appearance in SQL."""
    return (
        f"SELECT row_number() OVER (ORDER BY min(item_id * 1000 + pos)) + {start - 1} "
        f"AS {id_name}, {name} FROM ({names_sql(column, kind, name)}) GROUP BY {name}"
    )
