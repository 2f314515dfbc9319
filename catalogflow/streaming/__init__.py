"""Structured Streaming jobs."""

from catalogflow.streaming.dimensions import GrowingDimension, GrowingDimensions
from catalogflow.streaming.history import averages_after_load, sentiment_after_load
from catalogflow.streaming.jobs import movies_job, ratings_job, reviews_job
from catalogflow.streaming.maintained import Catalogue, catalogue_job
from catalogflow.streaming.runner import await_all, run_stream
from catalogflow.streaming.stateful import running_averages, running_sentiment

__all__ = [
    "Catalogue", "catalogue_job", "GrowingDimension", "GrowingDimensions", "averages_after_load", "sentiment_after_load",
    "movies_job", "ratings_job", "reviews_job", "await_all", "run_stream", "running_averages",
    "running_sentiment",
]
