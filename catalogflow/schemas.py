"""Schemas of the messages and tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of the messages. Every field travels as text and is
# cast once after parsing.
MOVIE_FIELDS = (
    "item_id", "title", "genres", "directedBy", "starring", "imdbId",
    "positive_reviews", "negative_reviews", "neutral_reviews",
)
RATING_FIELDS = ("item_id", "user_id", "rating")
REVIEW_FIELDS = ("item_id", "txt")


def _texts(names: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


MOVIE_MESSAGE = T.ArrayType(_texts(MOVIE_FIELDS))
RATING_MESSAGE = _texts(RATING_FIELDS)
REVIEW_MESSAGE = _texts(REVIEW_FIELDS)

_LONG, _TEXT, _DOUBLE, _INSTANT = T.LongType(), T.StringType(), T.DoubleType(), T.TimestampType()
_STAMP = {"timestamp": _TEXT, "ingest_ts": _INSTANT}


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, kind) for n, kind in columns.items()])


MOVIES = _schema(
    item_id=_LONG, title=_TEXT, imdbId=_TEXT, year=T.IntegerType(), positive_reviews=_LONG,
    negative_reviews=_LONG, neutral_reviews=_LONG, avgRating=_DOUBLE, **_STAMP,
)
RATINGS = _schema(item_id=_LONG, user_id=_LONG, rating=_DOUBLE, **_STAMP)
REVIEWS = _schema(item_id=_LONG, txt=_TEXT, sentiment=_TEXT, **_STAMP)

# Input files by what they hold. Ids of other catalogues are text: they may begin with zeros.
INPUTS = {
    "metadata": _schema(
        item_id=_LONG, title=_TEXT, directedBy=_TEXT, starring=_TEXT, avgRating=_DOUBLE, imdbId=_TEXT
    ),
    "catalogue": _schema(movieId=_LONG, title=_TEXT, genres=_TEXT),
    "links": _schema(movieId=_LONG, imdbId=_TEXT, tmdbId=_TEXT),
    "movies": _schema(
        item_id=_LONG, title=_TEXT, genres=_TEXT, directedBy=_TEXT, starring=_TEXT,
        avgRating=_DOUBLE, imdbId=_TEXT, year=T.IntegerType(), positive_reviews=_LONG,
        negative_reviews=_LONG, neutral_reviews=_LONG,
    ),
    "ratings": _schema(item_id=_LONG, user_id=_LONG, rating=_DOUBLE),
    "reviews": _schema(item_id=_LONG, txt=_TEXT),
}

# Additive per-batch amounts. Their sum over any set of batches is exact and does
# not depend on the order in which batches arrived.
RATING_TOTALS = _schema(item_id=_LONG, rating_sum=T.DecimalType(28, 4), rating_count=_LONG)
REVIEW_TOTALS = _schema(item_id=_LONG, positive=_LONG, negative=_LONG, neutral=_LONG)

QUARANTINE = _schema(topic=_TEXT, raw=_TEXT, ingest_ts=_INSTANT)
# The entry of a committed batch, and that of a compacted one: the batches it stands for.
COMMIT = _schema(committed_at=_INSTANT)
COMPACTION = _schema(of_run=_TEXT, of_batch=_LONG, committed_at=_INSTANT)
UNMATCHED = _schema(kind=_TEXT, name=_TEXT, item_id=_LONG)


def bridge(id_name: str) -> T.StructType:
    return _schema(item_id=_LONG, **{id_name: _LONG})


def dimension(id_name: str, name: str) -> T.StructType:
    return _schema(**{id_name: _LONG, name: _TEXT})


# List-valued movie columns (fixed values): source column, delimiter kind, dimension id and name.
LISTS = {
    "genres": ("genres", "pipe", "genre_id", "genre_name"),
    "actors": ("starring", "mixed", "actor_id", "actor_name"),
    "directors": ("directedBy", "mixed", "director_id", "director_name"),
}

for _name, (_, _, _id, _label) in LISTS.items():
    INPUTS[_name] = dimension(_id, _label)
    INPUTS[f"movies_{_name}"] = bridge(_id)
