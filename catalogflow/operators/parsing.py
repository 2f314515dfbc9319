"""Topic payloads to typed rows.

Every parser yields the typed columns plus ``ok`` and ``raw``. Rows that cannot be used
(malformed text, no key, a field that does not convert) have ``ok`` false and keep their
payload in ``raw``; nothing is dropped and nothing fails.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogflow import schemas
from catalogflow.operators.aggregates import RATING


def _payload() -> Column:
    return F.col("value").cast("string")


def _objects(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """The fields of one JSON object per message, all text, and ``raw``.

    ``inline`` parses each message once. Filters on a plain projection of ``from_json``
    would be pushed below it and repeat the parsing for every field they mention.
    """
    return messages.select(_payload().alias("raw")).select(
        "raw", F.inline(F.array(F.from_json("raw", schema)))
    )


def undeclared(raw: Column, declared: Iterable[str]) -> Column:
    """The fields of a JSON object that nobody declared, as a VARIANT object; null if it is none.

    They keep their types and nesting; ``try_variant_get`` reads them by path.
    """
    fields = F.try_variant_get(F.try_parse_json(raw), "$", "map<string,variant>")
    return F.to_variant_object(F.map_filter(fields, lambda k, _: ~k.isin(*declared)))


def _typed(
    fields: DataFrame,
    types: dict[str, str],
    required: list[str],
    fits: dict[str, str] | None = None,
    rest: bool = False,
) -> DataFrame:
    """Cast text fields; ``required`` ones must be there after the cast.

    Fields named in ``fits`` must also convert from their type to the one given there.
    With ``rest`` a VARIANT column of that name holds all other fields.
    """
    ok = F.lit(True)
    for name, target in types.items():
        value = F.col(name).try_cast(target)
        usable = (value.try_cast(fits[name]) if name in (fits or {}) else value).isNotNull()
        ok = ok & (usable if name in required else F.col(name).isNull() | usable)
    return fields.select(
        *[F.col(c).try_cast(k).alias(c) for c, k in types.items()],
        *([undeclared(F.col("raw"), types).alias("rest")] if rest else []),
        ok.alias("ok"),
        F.when(~ok, F.col("raw")).alias("raw"),
    )


def parse_ratings(messages: DataFrame, rest: bool = False) -> DataFrame:
    """item_id, user_id, rating; with ``rest`` the fields beside them."""
    types = {"item_id": "bigint", "user_id": "bigint", "rating": "double"}
    # A rating has to fit the decimal that totals are kept in, which rules out NaN as well.
    fits = {"rating": RATING}
    return _typed(_objects(messages, schemas.RATING_MESSAGE), types, ["item_id"], fits, rest)


def parse_reviews(messages: DataFrame, rest: bool = False) -> DataFrame:
    """item_id, txt; with ``rest`` the fields beside them."""
    types = {"item_id": "bigint", "txt": "string"}
    return _typed(_objects(messages, schemas.REVIEW_MESSAGE), types, ["item_id", "txt"], rest=rest)


def _single(messages: DataFrame) -> DataFrame:
    """The objects of arrays as messages of their own, undeclared fields included.

    A single object is one message; what is no JSON, or no object, stays as it is.
    """
    parsed = F.try_parse_json(F.col("raw"))
    listed = F.try_variant_get(parsed, "$", "array<variant>")
    each = messages.select(_payload().alias("raw")).select(
        "raw", F.explode_outer(F.coalesce(listed, F.array(parsed))).alias("one"), listed.alias("listed")
    )
    some = each.filter(F.col("listed").isNull() | (F.size("listed") > 0))
    return some.select(F.coalesce(F.to_json("one"), F.col("raw")).alias("raw"))


def parse_movies(messages: DataFrame, rest: bool = False) -> DataFrame:
    """One row per object of the message's array; absent counters become 0.

    With ``rest`` a VARIANT column holds the fields that are not declared.

    An empty array is a valid message without rows. A text that is no array of objects
    gives one rejected row.
    """
    if rest:
        fields = _single(messages).select(
            "raw", F.inline(F.array(F.from_json("raw", schemas.MOVIE_MESSAGE.elementType)))
        )
    else:
        arrays = messages.select(_payload().alias("raw")).select(
            "raw", F.inline(F.array(F.struct(F.from_json("raw", schemas.MOVIE_MESSAGE).alias("all"))))
        )
        objects = arrays.filter(F.col("all").isNull() | (F.size("all") > 0)).select(
            "raw", F.explode_outer("all").alias("one")
        )
        # A bad object is kept by itself, so that its neighbours are not sent twice.
        fields = objects.select("one.*", F.coalesce(F.to_json("one"), F.col("raw")).alias("raw"))
    counters = ["positive_reviews", "negative_reviews", "neutral_reviews"]
    types = {c: "string" for c in schemas.MOVIE_FIELDS} | {"item_id": "bigint"}
    types |= {c: "bigint" for c in counters}
    # A counter may travel as "0.0", as tables with gaps write whole numbers.
    whole = {c: F.regexp_replace(c, r"^\s*([+-]?\d+)\.0*\s*$", "$1") for c in counters}
    rows = _typed(fields.withColumns(whole), types, ["item_id", "title"], rest=rest)
    return rows.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in counters})


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter("ok").drop("ok", "raw")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter("not ok").select("raw")
