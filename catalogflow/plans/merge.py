"""Merging catalogue sources into one movie table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def link_catalogue(catalogue: DataFrame, links: DataFrame) -> DataFrame:
    """Catalogue rows that have a link row, with its external ids."""
    return catalogue.join(links, "movieId")


def merge_catalogue(metadata: DataFrame, linked: DataFrame) -> DataFrame:
    """All metadata rows, with genres where the catalogue knows the film.

    Title and imdbId exist on both sides; the metadata's are kept.
    """
    m = metadata.alias("m")
    c = linked.select("movieId", "genres").alias("c")
    kept = ["item_id", "title", "directedBy", "starring", "avgRating", "imdbId"]
    joined = m.join(c, F.col("m.item_id") == F.col("c.movieId"), "left")
    columns = {n: F.col(f"m.{n}") for n in kept} | {"genres": F.col("c.genres")}
    # The columns of the merged table, in order.
    order = ["item_id", "title", "genres", "directedBy", "starring", "avgRating", "imdbId"]
    return joined.select(*[columns[n].alias(n) for n in order])
