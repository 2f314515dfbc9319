"""Catalogue preparation, streaming upkeep and serving on Spark DataFrames."""

from catalogflow.session import build_session

__all__ = ["build_session"]
