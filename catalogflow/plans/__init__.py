"""Composites: what a user of the package calls."""

from catalogflow.plans.bulkload import bulk_load, stamp_loaded
from catalogflow.plans.holdout import flag_holdout, flagged_holdout, holdout
from catalogflow.plans.merge import link_catalogue, merge_catalogue
from catalogflow.plans.normalize import bridge_rows, list_names, lookup, normalize, unmatched
from catalogflow.operators.profiling import profile
from catalogflow.plans.replay import replay, wire_ratings
from catalogflow.plans.serving import (
    current_movies, live_ratings_per_title, rated_movies, recent_rows,
)
from catalogflow.plans.snapshot import movie_snapshot

__all__ = [
    "bulk_load", "stamp_loaded", "flag_holdout", "flagged_holdout", "holdout", "link_catalogue",
    "merge_catalogue", "bridge_rows", "list_names", "lookup", "normalize", "unmatched",
    "profile", "replay", "wire_ratings", "rated_movies", "recent_rows", "movie_snapshot", "current_movies",
    "live_ratings_per_title",
]
