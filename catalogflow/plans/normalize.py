"""Multi-valued columns as a dimension table and a bridge table."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogflow.functions import split_list
from catalogflow.operators.numbering import number_values


class Normalized(NamedTuple):
    dimension: DataFrame
    bridge: DataFrame


def list_names(
    movies: DataFrame,
    column: str,
    kind: str,
    name: str,
    keep_null: bool = False,
    drop_empty: bool = False,
) -> DataFrame:
    """item_id, pos, ``name``: one row per list entry.

    A null list has no row, or one null entry with ``keep_null``. Empty entries stay
    unless ``drop_empty``.
    """
    expand = F.posexplode_outer if keep_null else F.posexplode
    rows = movies.select("item_id", expand(split_list(F.col(column), kind)).alias("pos", name))
    return rows.filter(~F.col(name).eqNullSafe("")) if drop_empty else rows


def lookup(names: DataFrame, dimension: DataFrame, name: str, id_name: str) -> DataFrame:
    """item_id and id of the names the dimension knows; others are dropped."""
    return names.join(dimension, name).select("item_id", id_name)


def unmatched(names: DataFrame, dimension: DataFrame, name: str) -> DataFrame:
    """Rows whose name is missing from the dimension."""
    return names.join(dimension, name, "left_anti").select("item_id", name)


def bridge_rows(
    names: DataFrame, dimension: DataFrame, name: str, id_name: str, dedup: bool = False
) -> DataFrame:
    """Ids for names the dimension was built from, a null name included.

    A name repeated within one cell gives repeated rows unless ``dedup``.
    """
    d = dimension.withColumnRenamed(name, "_known")
    rows = names.join(d, F.col(name).eqNullSafe(F.col("_known")), "left").select(
        "item_id", id_name
    )
    return rows.distinct() if dedup else rows


def normalize(
    movies: DataFrame,
    column: str,
    kind: str,
    id_name: str,
    name: str,
    keep_null: bool = False,
    drop_empty: bool = False,
    dedup: bool = False,
) -> Normalized:
    """Dimension with ids from 1 in order of first appearance, and the bridge to it.

    First appearance follows item_id, then the position in the cell.
    """
    names = list_names(movies, column, kind, name, keep_null, drop_empty)
    dimension = number_values(names, name, "item_id", "pos", name=id_name)
    return Normalized(dimension, bridge_rows(names, dimension, name, id_name, dedup))
