"""Merging, normalising, splitting, aggregating and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogflow import schemas
from catalogflow.bindings import tables as t
from catalogflow.bindings.registry import query
from catalogflow.functions import sentiment
from catalogflow.functions.text import NEGATIVE_WORDS, POSITIVE_WORDS
from catalogflow.operators import aggregates, keys, profiling, summaries
from catalogflow.operators.numbering import factorize
from catalogflow.plans import (
    holdout, link_catalogue, lookup, merge_catalogue, movie_snapshot, normalize, unmatched,
)
from catalogflow.plans.normalize import list_names
from catalogflow.session import work_folder
from catalogflow.sinks import bucket_table

# --- lists -------------------------------------------------------------------------


def _bridge_sql(column: str, kind: str, id_name: str, name: str) -> str:
    return (
        f"SELECT item_id, {id_name} FROM ({t.names_sql(column, kind, name)}) "
        f"JOIN ({t.dimension_sql(column, kind, id_name, name)}) USING ({name})"
    )


def _dimension_query(listed: tuple[str, str, str, str]):
    return lambda spark, sf: normalize(t.movies(spark, sf), *listed).dimension


def _bridge_query(listed: tuple[str, str, str, str]):
    return lambda spark, sf: normalize(t.movies(spark, sf), *listed).bridge


for _name, _listed in schemas.LISTS.items():
    query(t.dimension_sql(*_listed), f"dim_{_name}")(_dimension_query(_listed))
    query(_bridge_sql(*_listed), f"bridge_{_name}")(_bridge_query(_listed))

_ACTORS = schemas.LISTS["actors"]
_KNOWN = "actor_name NOT LIKE 'Brand#1%'"


def _partial_dimension(spark, sf):
    """Actors without those of the first brands: a dimension with gaps."""
    return normalize(t.movies(spark, sf), *_ACTORS).dimension.filter(_KNOWN)


def _actor_names(spark, sf):
    return list_names(t.movies(spark, sf), "starring", "mixed", "actor_name")


@query(
    f"SELECT item_id, actor_id FROM ({t.names_sql('starring', 'mixed', 'actor_name')}) "
    f"JOIN (SELECT * FROM ({t.dimension_sql(*_ACTORS)}) WHERE {_KNOWN}) USING (actor_name)"
)
def lookup_matched(spark, sf):
    return lookup(_actor_names(spark, sf), _partial_dimension(spark, sf), "actor_name", "actor_id")


@query(
    f"SELECT item_id, actor_name FROM ({t.names_sql('starring', 'mixed', 'actor_name')}) "
    f"WHERE NOT ({_KNOWN})"
)
def lookup_unmatched(spark, sf):
    return unmatched(_actor_names(spark, sf), _partial_dimension(spark, sf), "actor_name")


@query(
    f"SELECT item_id, actor_id FROM ({t.names_sql('starring', 'mixed', 'actor_name')}) "
    f"JOIN ({t.dimension_sql(*_ACTORS)}) USING (actor_name)"
)
def bucketed_lookup(spark, sf):
    """Names looked up in a dimension that lies in buckets by name."""
    dimension = normalize(t.movies(spark, sf), *_ACTORS).dimension
    folder = work_folder(spark, "bucketed")
    table = f"actors_{folder[-32:]}"
    bucket_table(dimension, table, "actor_name", 8, folder)
    return lookup(_actor_names(spark, sf), spark.table(table), "actor_name", "actor_id")


_SPARSE_NAMES = (
    f"SELECT * FROM ({t.names_sql('starring', 'mixed', 'actor_name')}) "
    "WHERE item_id % 7 <> 0 AND actor_name <> '' "
    f"UNION ALL SELECT item_id, CAST(0 AS INTEGER), NULL FROM ({t.MOVIES}) WHERE item_id % 7 = 0"
)
_SPARSE_DIMENSION = (
    "SELECT row_number() OVER (ORDER BY min(item_id * 1000 + pos)) AS actor_id, actor_name "
    f"FROM ({_SPARSE_NAMES}) GROUP BY actor_name"
)


def _sparse(spark, sf):
    """Every seventh film has no list of actors; null lists kept, empty parts dropped, no repeats."""
    movies = t.movies(spark, sf)
    movies = movies.withColumn("starring", F.when(F.col("item_id") % 7 != 0, F.col("starring")))
    return normalize(movies, *_ACTORS, keep_null=True, drop_empty=True, dedup=True)


@query(_SPARSE_DIMENSION)
def dim_actors_sparse(spark, sf):
    return _sparse(spark, sf).dimension


@query(
    f"SELECT DISTINCT n.item_id, d.actor_id FROM ({_SPARSE_NAMES}) n JOIN ({_SPARSE_DIMENSION}) d "
    "ON n.actor_name IS NOT DISTINCT FROM d.actor_name"
)
def bridge_actors_sparse(spark, sf):
    return _sparse(spark, sf).bridge


_FACTORIZED = (
    'SELECT row_number() OVER (ORDER BY min(item_id)) - 1 AS code, "directedBy" '
    f'FROM ({t.MOVIES}) GROUP BY "directedBy"'
)


@query(
    f'SELECT item_id, "directedBy", code FROM ({t.MOVIES}) JOIN ({_FACTORIZED}) USING ("directedBy")'
)
def factorize_type(spark, sf):
    rows = t.movies(spark, sf).select("item_id", "directedBy")
    return factorize(rows, "directedBy", "item_id")[0].select("item_id", "directedBy", "code")


@query(_FACTORIZED)
def factorize_index(spark, sf):
    rows = t.movies(spark, sf).select("item_id", "directedBy")
    return factorize(rows, "directedBy", "item_id")[1]


# --- merge -------------------------------------------------------------------------

_CATALOGUE = f"SELECT item_id AS \"movieId\", title, genres FROM ({t.MOVIES})"
_LINKS = (
    'SELECT c_custkey AS "movieId", c_name AS "imdbId", c_nationkey AS "tmdbId" FROM customer'
)


def _linked(spark, sf):
    catalogue = t.movies(spark, sf).select(F.col("item_id").alias("movieId"), "title", "genres")
    links = t.load(spark, sf, "customer").select(
        F.col("c_custkey").alias("movieId"),
        F.col("c_name").alias("imdbId"),
        F.col("c_nationkey").alias("tmdbId"),
    )
    return link_catalogue(catalogue, links)


def _merged(spark, sf):
    metadata = t.movies(spark, sf, F.col("p_retailprice").alias("avgRating")).drop("genres")
    return merge_catalogue(metadata, _linked(spark, sf))


_LINKED_SQL = f'SELECT * FROM ({_CATALOGUE}) JOIN ({_LINKS}) USING ("movieId")'
_MERGED_SQL = (
    'SELECT m.item_id, m.title, l.genres, m."directedBy", m.starring, p_retailprice AS '
    f'"avgRating", m."imdbId" FROM ({t.MOVIES}) m JOIN part ON p_partkey = m.item_id '
    f'LEFT JOIN ({_LINKED_SQL}) l ON m.item_id = l."movieId"'
)


@query(_LINKED_SQL)
def catalog_inner(spark, sf):
    return _linked(spark, sf)


@query(_MERGED_SQL)
def catalog_left(spark, sf):
    return _merged(spark, sf)


@query(f"SELECT * FROM ({_MERGED_SQL}) WHERE genres IS NULL OR genres = ''")
def null_or_empty(spark, sf):
    return keys.null_or_empty(_merged(spark, sf), "genres")


# --- hold-out ----------------------------------------------------------------------

_HELD = (
    f"SELECT item_id FROM (SELECT item_id FROM ({t.MOVIES}) "
    "ORDER BY md5('42:' || item_id), item_id LIMIT 10)"
)
_IN_FRACTION = f"substr(md5('42:' || item_id), 1, 8) < '{round(0.05 * 2**32):08x}'"


def _sides(spark, sf, **how):
    dependents = {"ratings": t.ratings(spark, sf), "reviews": t.reviews(spark, sf)}
    return holdout(t.movies(spark, sf), dependents, **how)


@query(f"SELECT * FROM ({t.RATINGS}) WHERE item_id IN ({_HELD})")
def holdout_stream(spark, sf):
    return _sides(spark, sf).stream["ratings"]


@query(f"SELECT * FROM ({t.RATINGS}) WHERE item_id NOT IN ({_HELD})")
def holdout_db(spark, sf):
    return _sides(spark, sf).db["ratings"]


@query(
    'SELECT *, CAST(0 AS BIGINT) AS positive_reviews, CAST(0 AS BIGINT) AS negative_reviews, '
    f'CAST(0 AS BIGINT) AS neutral_reviews FROM ({t.MOVIES}) WHERE item_id IN ({_HELD})'
)
def holdout_movies(spark, sf):
    return _sides(spark, sf).stream["movies"]


@query(f"SELECT * FROM ({t.REVIEWS}) WHERE {_IN_FRACTION}")
def holdout_fraction_stream(spark, sf):
    return _sides(spark, sf, fraction=0.05).stream["reviews"]


@query(f"SELECT * FROM ({t.RATINGS}) WHERE NOT ({_IN_FRACTION})")
def holdout_fraction_db(spark, sf):
    return _sides(spark, sf, fraction=0.05).db["ratings"]


@query(f"SELECT item_id FROM ({t.RATINGS}) UNION ALL SELECT item_id FROM ({t.REVIEWS})")
def union_all_ids(spark, sf):
    ids = t.ratings(spark, sf).select("item_id")
    return ids.unionByName(t.reviews(spark, sf).select("item_id"))


@query(f"SELECT item_id FROM ({t.RATINGS}) UNION SELECT item_id FROM ({t.REVIEWS})")
def union_distinct_ids(spark, sf):
    return keys.distinct_keys(union_all_ids(spark, sf), "item_id")


# --- aggregates --------------------------------------------------------------------


@query(
    f"SELECT title, count(item_id) AS ratings FROM ({t.RATINGS}) JOIN ({t.MOVIES}) "
    "USING (item_id) GROUP BY title"
)
def ratings_per_title(spark, sf):
    return aggregates.ratings_per_title(t.ratings(spark, sf), t.movies(spark, sf))


@query(f"SELECT item_id, count(*) AS ratings FROM ({t.RATINGS}) GROUP BY item_id")
def ratings_per_item(spark, sf):
    return aggregates.ratings_per_item(t.ratings(spark, sf))


_SCORED = (
    f"SELECT item_id, {t.sentiment_sql('txt', POSITIVE_WORDS, NEGATIVE_WORDS)} AS sentiment "
    f"FROM ({t.REVIEWS})"
)
REVIEW_TOTALS_SQL = (
    "SELECT item_id, "
    + ", ".join(
        f"count(*) FILTER (sentiment = '{s}') AS {s}" for s in ("positive", "negative", "neutral")
    )
    + f" FROM ({_SCORED}) GROUP BY item_id"
)


def _scored(spark, sf):
    return t.reviews(spark, sf).withColumn("sentiment", sentiment(F.col("txt")))


@query(REVIEW_TOTALS_SQL)
def sentiment_counts(spark, sf):
    return aggregates.review_totals(_scored(spark, sf))


SNAPSHOT_SQL = f"""
SELECT item_id, title, coalesce(a."avgRating", 0) AS "avgRating",
  coalesce(r.positive, 0) AS positive_reviews, coalesce(r.negative, 0) AS negative_reviews,
  coalesce(r.neutral, 0) AS neutral_reviews
FROM ({t.MOVIES})
LEFT JOIN (SELECT item_id, {t.AVERAGE} FROM ({t.RATINGS}) GROUP BY item_id) a USING (item_id)
LEFT JOIN ({REVIEW_TOTALS_SQL}) r USING (item_id)
"""


@query(SNAPSHOT_SQL)
def movies_snapshot(spark, sf):
    """Every film with its average and its three counters."""
    films = t.movies(spark, sf).select(
        "item_id",
        "title",
        F.lit(0.0).alias("avgRating"),
        *[F.lit(0).cast("bigint").alias(f"{s}_reviews") for s in ("positive", "negative", "neutral")],
    )
    return movie_snapshot(
        films,
        aggregates.rating_totals(t.ratings(spark, sf)),
        aggregates.review_totals(_scored(spark, sf)),
    )


@query(
    f"SELECT item_id, {t.AVERAGE} FROM ({t.RATINGS}) WHERE item_id IN (SELECT l_partkey "
    "FROM lineitem WHERE l_shipdate = (SELECT max(l_shipdate) FROM lineitem)) GROUP BY item_id"
)
def batch_touched_avg(spark, sf):
    """Averages over all ratings of the films rated on the last day."""
    lines = t.load(spark, sf, "lineitem")
    last = lines.agg(F.max("l_shipdate").cast("string")).first()[0]
    batch = lines.filter(F.col("l_shipdate") == F.lit(last).cast("timestamp_ntz"))
    return aggregates.average_for_touched(
        t.ratings(spark, sf), batch.select(F.col("l_partkey").alias("item_id"))
    )


# --- profile -----------------------------------------------------------------------

_GAPS = (
    "SELECT event_id, user_id, nullif(event_type, 'error') AS event_type, value, "
    "CASE WHEN event_type = 'click' THEN '' ELSE props END AS props FROM events"
)
_COLUMNS = {
    "event_id": "bigint", "user_id": "bigint", "event_type": "string", "value": "double",
    "props": "string",
}
_TEXTS = [c for c, kind in _COLUMNS.items() if kind == "string"]


def _with_gaps(spark, sf):
    """Events with nulls in one column and empty texts in another."""
    kind = F.col("event_type")
    return t.load(spark, sf, "events").select(
        "event_id",
        "user_id",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        "value",
        F.when(kind == "click", "").otherwise(F.col("props")).alias("props"),
    )


_MEASURES = {
    "non_null": "count({c})",
    "nulls": "count(*) FILTER ({c} IS NULL)",
    "empty": "count(*) FILTER (CAST({c} AS VARCHAR) = '')",
    "distinct_values": "count(DISTINCT {c})",
}


def _profile_sql(*measures: str, types: bool = False) -> str:
    kind = ", '{k}' AS type" if types else ""
    columns = ", ".join(f"{_MEASURES[m]} AS {m}" for m in measures)
    one = "SELECT '{c}' AS column" + kind + f", {columns} FROM ({_GAPS})"
    one = one.replace("AS column", 'AS "column"')
    return " UNION ALL ".join(one.format(c=c, k=k) for c, k in _COLUMNS.items())


@query(_profile_sql("distinct_values"))
def distinct_counts(spark, sf):
    return profiling.distinct_counts(_with_gaps(spark, sf))


@query(_profile_sql("nulls"))
def null_counts(spark, sf):
    return profiling.null_counts(_with_gaps(spark, sf))


@query(_profile_sql("empty"))
def empty_counts(spark, sf):
    return profiling.empty_counts(_with_gaps(spark, sf))


@query(_profile_sql("non_null", types=True))
def column_summary(spark, sf):
    return profiling.column_summary(_with_gaps(spark, sf))


@query(_profile_sql("non_null", "nulls", "empty", "distinct_values", types=True))
def table_profile(spark, sf):
    return profiling.profile(_with_gaps(spark, sf))


@query("SELECT count(*) AS rows FROM lineitem")
def row_count(spark, sf):
    return profiling.row_count(t.load(spark, sf, "lineitem"))


@query("SELECT DISTINCT l_suppkey FROM lineitem")
def distinct_values(spark, sf):
    return profiling.distinct_values(t.load(spark, sf, "lineitem"), "l_suppkey")


@query("SELECT l_partkey, count(*) AS count FROM lineitem GROUP BY l_partkey")
def value_counts(spark, sf):
    return profiling.value_counts(t.load(spark, sf, "lineitem"), "l_partkey")


def _histogram_sql(table: str, column: str, bins: int) -> str:
    return (
        f"WITH e AS (SELECT min({column}) AS lo, max({column}) AS hi FROM {table}), "
        f"c AS (SELECT least(CAST(floor(({column} - lo) / (hi - lo) * {bins}) AS BIGINT), "
        f"{bins - 1}) AS bin, count(*) AS n FROM {table}, e GROUP BY 1) "
        f"SELECT b AS bin, lo + b * (hi - lo) / {bins} AS lower, coalesce(n, 0) AS count "
        f"FROM range({bins}) r(b), e LEFT JOIN c ON c.bin = b"
    )


@query(_histogram_sql("events", "value", 50))
def histogram_50(spark, sf):
    return profiling.histogram(t.load(spark, sf, "events"), "value", 50)


@query(_histogram_sql("lineitem", "l_extendedprice", 10))
def histogram_10(spark, sf):
    return profiling.histogram(t.load(spark, sf, "lineitem"), "l_extendedprice")


# --- profiles from mergeable summaries ---------------------------------------------


@query(_profile_sql("non_null", "nulls", "empty", "distinct_values", types=True))
def profile_of_batches(spark, sf):
    """The profile of a table that came in three batches, one of them twice, from stored sketches.

    The distinct counts are estimates: each is given as the exact count where it is within the
    sketch's bound (four standard errors), so another value shows.
    """
    frame = _with_gaps(spark, sf)
    store = summaries.ProfileStore(work_folder(spark, "profile"))
    key = frame.columns[0]
    for n in (0, 1, 2, 1):
        store.add(frame.filter(F.pmod(F.xxhash64(key), F.lit(3)) == n), n)
    bound = 4 * 1.04 / 2 ** (summaries.HLL_BITS / 2)
    return _within(store.read(spark).drop("quantiles"), frame, bound)


def _within(found, frame, bound: float):
    """Estimated distinct counts, each replaced by the exact one if it is off by ``bound`` at most."""
    exact = profiling.distinct_counts(frame).withColumnRenamed("distinct_values", "exact")
    off = F.abs(F.col("distinct_values") - F.col("exact"))
    value = F.when(off <= bound * F.col("exact") + 0.5, F.col("exact"))
    value = value.otherwise(F.col("distinct_values"))
    return found.join(exact, "column").withColumn("distinct_values", value).drop("exact")


@query(_profile_sql("non_null", "nulls", "empty", "distinct_values", types=True))
def table_profile_approximate(spark, sf):
    """The profile with approximate distinct counts, each within three times its 5 % deviation."""
    frame = _with_gaps(spark, sf)
    return _within(profiling.profile(frame, approximate=True), frame, 0.15)


@query(
    "SELECT l_suppkey, count(*) AS count FROM (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0 "
    "ELSE l_suppkey END AS l_suppkey FROM lineitem) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"
)
def top_values(spark, sf):
    """The ten most frequent suppliers, one of them on a third of all lines."""
    hot = F.when(F.col("l_orderkey") % 3 == 0, 0).otherwise(F.col("l_suppkey")).cast("bigint")
    return summaries.top_values(
        t.load(spark, sf, "lineitem").select(hot.alias("l_suppkey")), "l_suppkey", 10
    )


@query("SELECT l_orderkey, count(*) AS count FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25")
def top_values_even(spark, sf):
    """Keys none of which is frequent: the summary proves little and the rest is counted."""
    return summaries.top_values(t.load(spark, sf, "lineitem"), "l_orderkey", 25)


@query(_histogram_sql("events", "value", 50))
def histogram_one_pass(spark, sf):
    return summaries.histogram_of_dyadic_bins(t.load(spark, sf, "events"), "value", 50)
