"""Command line: the preparation steps, the replay of tables, and the streaming jobs.

    python -m catalogflow merge --metadata M.jsonl --catalogue C.csv --links L.csv --out movies
    python -m catalogflow normalize --movies movies --out tables
    python -m catalogflow holdout --movies movies --table ratings=R.jsonl --out split
    python -m catalogflow load --table movies=split/movies/split=db --root live
    python -m catalogflow replay --topic ratings --table split/ratings/split=stream --out topics/ratings
    python -m catalogflow stream --root live --dimensions tables --servers broker:9092
    python -m catalogflow snapshot --root live --out movies_now
    python -m catalogflow compact --root live --vacuum
    python -m catalogflow serve --root live --minutes 5
    python -m catalogflow profile --table movies

Tables are read as CSV, JSON lines or Parquet by the ending of their path, JSON lines
being the default. ``--dimensions`` and the snapshot's ``--out`` may be a JDBC URL. With
spark-submit the package is given by ``--py-files``.
"""

from __future__ import annotations

import argparse
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogflow import schemas
from catalogflow.functions import title_year
from catalogflow.operators.profiling import profile
from catalogflow.plans import (
    bulk_load, current_movies, flagged_holdout, link_catalogue, live_ratings_per_title,
    merge_catalogue, normalize, replay,
)
from catalogflow.plans.bulkload import prepare_movies, prepare_reviews, stamp_loaded
from catalogflow.session import build_session, clear_work_folders
from catalogflow.sinks import replace_jdbc, split_jsonl, write_jsonl
from catalogflow.sources import kafka_stream, read_csv, read_jdbc, read_jsonl, replay_stream
from catalogflow.streaming import GrowingDimensions, await_all, movies_job, ratings_job, reviews_job
from catalogflow.streaming.progress import ProgressLog
from catalogflow.streaming.runner import INTERVALS, ONCE
from catalogflow.tables import Tables


def _read(spark: SparkSession, path: str, holds: str | None = None) -> DataFrame:
    """A table by the ending of its path; what it ``holds`` gives the schema of a text file.

    Only a table of unknown kind is read once more to infer its types.
    """
    schema = schemas.INPUTS.get(holds)
    if path.endswith(".csv"):
        return read_csv(spark, path, schema)
    return spark.read.parquet(path) if path.endswith(".parquet") else read_jsonl(spark, path, schema)


def _named(spark: SparkSession, pairs: list[str]) -> dict[str, DataFrame]:
    return {name: _read(spark, path, name) for name, path in (p.split("=", 1) for p in pairs)}


def _dimension(spark: SparkSession, path: str, listed: str) -> DataFrame:
    """A dimension as ``normalize`` writes it or as ``load`` does.

    A file of another form reads as rows of nulls, which would leave every name unmatched; the
    format is therefore taken from the files' names, and a dimension without ids is an error.
    """
    _, _, id_name, name = schemas.LISTS[listed]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    parquet = not files.filter(F.col("path").endswith(".parquet")).select("path").isEmpty()
    found = spark.read.parquet(path) if parquet else read_jsonl(spark, path, schemas.INPUTS[listed])
    if not found.isEmpty() and found.filter(F.col(id_name).isNotNull()).isEmpty():
        raise ValueError(f"{path} holds no {id_name}")
    return found.select(id_name, name)


def merge(spark: SparkSession, args) -> None:
    linked = link_catalogue(
        _read(spark, args.catalogue, "catalogue"), _read(spark, args.links, "links").drop("title")
    )
    write_jsonl(merge_catalogue(_read(spark, args.metadata, "metadata"), linked), args.out)


def normalize_lists(spark: SparkSession, args) -> None:
    movies = _read(spark, args.movies, "movies")
    for name, (column, kind, id_name, label) in schemas.LISTS.items():
        parts = normalize(movies, column, kind, id_name, label, args.keep_null, args.drop_empty)
        write_jsonl(parts.dimension, f"{args.out}/{name}")
        write_jsonl(parts.bridge, f"{args.out}/movies_{name}")
    counted = ("year", "positive_reviews", "negative_reviews", "neutral_reviews")
    rest = movies.drop(*[column for column, *_ in schemas.LISTS.values()], *counted)
    write_jsonl(rest.withColumn("year", title_year(F.col("title"))), f"{args.out}/movies")


def split(spark: SparkSession, args) -> None:
    how = {"fraction": args.fraction} if args.fraction is not None else {"n": args.films}
    tables = _named(spark, args.table)
    flagged = flagged_holdout(_read(spark, args.movies, "movies"), tables, seed=args.seed, **how)
    for name, frame in flagged.items():
        split_jsonl(frame, "split", f"{args.out}/{name}")


def load(spark: SparkSession, args) -> None:
    prepared = {}
    for name, frame in _named(spark, args.table).items():
        if name == "movies":
            frame = prepare_movies(frame)
        elif name == "reviews":
            frame = prepare_reviews(frame, scored=not args.unscored)
        elif name == "ratings":
            frame = stamp_loaded(frame)
        prepared[name] = frame
    bulk_load(prepared, Tables(args.root))


def replay_table(spark: SparkSession, args) -> None:
    replay(args.topic, _read(spark, args.table, args.topic), args.out, args.per_file)


def stream(spark: SparkSession, args) -> None:
    tables = Tables(args.root)

    def messages(topic: str) -> DataFrame:
        if args.servers:
            return kafka_stream(spark, args.servers, topic, max_offsets=args.max_offsets)
        return replay_stream(spark, f"{args.replay}/{topic}", args.max_files)

    def dimension(listed: str) -> DataFrame:
        if args.dimensions is None:
            raise ValueError("--dimensions is needed unless the names are learned (--learn)")
        if args.dimensions.startswith("jdbc:"):
            return read_jdbc(spark, url=args.dimensions, table=listed)
        return _dimension(spark, f"{args.dimensions}/{listed}", listed)

    def settings(topic: str) -> tuple[str, str]:
        return f"{args.root}/checkpoints/{topic}", ONCE if args.once else INTERVALS[topic]

    dimensions = dimension
    if args.learn:
        dimensions = GrowingDimensions.below(tables.path("dimensions"))
        dimensions.create(spark)
        for listed, table in dimensions.tables.items():
            # A table that has learned nothing yet takes over what was made before.
            if args.dimensions is not None and table.read(spark).isEmpty():
                table.load(dimension(listed))
    progress = ProgressLog(tables.path("progress")).attach(spark)
    try:
        await_all(
            [
                movies_job(messages("movies"), dimensions, tables, *settings("movies"), name="movies"),
                ratings_job(messages("ratings"), tables, *settings("ratings"), name="ratings"),
                reviews_job(messages("reviews"), tables, *settings("reviews"), name="reviews"),
            ],
            each_poll=lambda: progress.write(spark),
        )
    finally:
        progress.detach(spark)


def snapshot(spark: SparkSession, args) -> None:
    current = current_movies(spark, Tables(args.root))
    if args.out.startswith("jdbc:"):
        replace_jdbc(current, args.out, "movies")
    else:
        current.write.mode("overwrite").parquet(args.out)


def compact(spark: SparkSession, args) -> None:
    tables = Tables(args.root)
    for name in args.table or ("ratings", "reviews", "rating_totals", "review_totals"):
        if args.vacuum:
            tables.vacuum(spark, name)
        tables.compact(spark, name)


def serve(spark: SparkSession, args) -> None:
    tables = Tables(args.root)
    if args.per_title:
        found = live_ratings_per_title(spark, tables)
    elif args.item is not None:
        found = tables.lookup(spark, args.table, args.item)
    elif args.minutes is not None:
        found = tables.recent(
            spark, args.table, F.current_timestamp(), timedelta(minutes=args.minutes)
        )
    else:
        found = current_movies(spark, tables)
    if args.out:
        found.write.mode("overwrite").parquet(args.out)
    else:
        found.show(args.rows, truncate=False)


def show_profile(spark: SparkSession, args) -> None:
    profile(_read(spark, args.table), not args.exact).show(truncate=False)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser("catalogflow")
    commands = parser.add_subparsers(required=True)

    def command(name: str, run, *required: str):
        sub = commands.add_parser(name)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        sub.set_defaults(run=run)
        return sub

    command("merge", merge, "metadata", "catalogue", "links", "out")
    lists = command("normalize", normalize_lists, "movies", "out")
    lists.add_argument("--keep-null", action="store_true")
    lists.add_argument("--drop-empty", action="store_true")
    sides = command("holdout", split, "movies", "out")
    sides.add_argument("--table", action="append", default=[], help="name=path")
    sides.add_argument("--films", type=int, default=10)
    sides.add_argument("--fraction", type=float)
    sides.add_argument("--seed", type=int, default=42)
    loads = command("load", load, "root")
    loads.add_argument("--table", action="append", default=[], help="name=path")
    loads.add_argument("--unscored", action="store_true")
    topics = command("replay", replay_table, "topic", "table", "out")
    topics.add_argument("--per-file", type=int)
    streams = command("stream", stream, "root")
    streams.add_argument("--dimensions", help="folder or JDBC URL of the dimensions")
    streams.add_argument("--learn", action="store_true", help="give ids to names that no dimension knows")
    source = streams.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers")
    source.add_argument("--replay")
    streams.add_argument("--max-files", type=int)
    streams.add_argument("--max-offsets", type=int)
    streams.add_argument("--once", action="store_true")
    command("snapshot", snapshot, "root", "out")
    shown = command("profile", show_profile, "table")
    shown.add_argument("--exact", action="store_true", help="shuffles every value once")
    packed = command("compact", compact, "root")
    packed.add_argument("--table", action="append")
    packed.add_argument("--vacuum", action="store_true", help="first delete what was compacted before")
    served = command("serve", serve, "root")
    served.add_argument("--table", choices=("movies", "ratings", "reviews"), default="ratings")
    which = served.add_mutually_exclusive_group()
    which.add_argument("--minutes", type=int)
    which.add_argument("--item", type=int)
    which.add_argument("--per-title", action="store_true")
    served.add_argument("--rows", type=int, default=20)
    served.add_argument("--out")
    return parser


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = spark or build_session()
    args.run(spark, args)
    clear_work_folders(spark)


if __name__ == "__main__":
    main()
