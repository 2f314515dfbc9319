"""Seeded samples that depend on keys only, not on layout or on the engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogflow.operators.numbering import number_rows

SEED = 42


def draw(key: str, seed: int = SEED) -> Column:
    """A pseudo-random hex text per key and seed."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def sample_rows(frame: DataFrame, n: int, key: str, seed: int = SEED) -> DataFrame:
    """The ``n`` rows with the least draws.

    Rows are counted by the leading 16 bits of their draw, which tells the least bound that
    ``n`` rows lie under; only those few more than ``n`` are then put in order and numbered.
    """
    rest = [c for c in frame.columns if c != key]
    drawn = frame.select(draw(key, seed).alias("_draw"), "*")
    lead = F.coalesce(F.conv(F.substring("_draw", 1, 4), 16, 10).cast("int"), F.lit(-1))
    counts = drawn.groupBy(lead.alias("_lead")).count()
    # At most 65,537 rows meet here, whatever the size of the table.
    reached = F.sum("count").over(Window.orderBy("_lead"))
    bounds = counts.select("_lead", reached.alias("_reached")).filter(F.col("_reached") >= n)
    bound = bounds.agg(F.min("_lead")).first()[0]
    near = drawn if bound is None else drawn.filter(lead <= bound)
    numbered = number_rows(near, "_draw", key, *rest, name="_n")
    return numbered.filter(F.col("_n") <= n).select(*frame.columns)


def in_fraction(key: str, fraction: float, seed: int = SEED) -> Column:
    """True for about ``fraction`` of the keys: all rows of a key agree.

    Compares the first 32 bits of the draw as text, so no key set and no join is needed.
    """
    bound = round(fraction * 2**32)
    if not 0 <= bound <= 2**32:
        raise ValueError("fraction lies between 0 and 1")
    if bound == 2**32:
        return F.col(key).isNotNull()
    drawn = F.substring(draw(key, seed), 1, 8) < F.lit(f"{bound:08x}")
    return F.coalesce(drawn, F.lit(False))


def sample_fraction(frame: DataFrame, fraction: float, key: str, seed: int = SEED) -> DataFrame:
    return frame.filter(in_fraction(key, fraction, seed))
