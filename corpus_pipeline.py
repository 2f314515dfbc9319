"""From documents to token digests: the stages of a corpus pipeline, each one an operator."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogflow.llm import bag_minhash, fertility, line_templates, pair_bpe, wu_manber
from catalogflow.llm.queries import table, vocabulary
from catalogflow.session import clear_work_folders, materialize, work_folders

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return fertility.keep_good(docs, vocabulary("piece_bpe_32k.model"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops recurring lines; a document of which nothing is left goes.

    Copies keep the lines that they share with the first one: the next stage is to find them.
    """
    kept = line_templates.drop_lines(
        docs, long_tokens=line_templates.LONG_TOKENS, copy_share=line_templates.COPY_SHARE
    )
    lost_all = (F.col("n_dropped") > 0) & (F.trim("text") == "")
    return (
        kept.where(~F.coalesce(lost_all, F.lit(False)))
        .withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
        .select(docs.columns)
    )


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the least id stays."""
    return bag_minhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return wu_manber.clean(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids' digest and the decoded text's digest of each document."""
    return pair_bpe.digests(docs, vocabulary("byte_bpe_50k.json"))


# What the stage called last has written on the way to its result, by application.
_inner: dict[str, set[str]] = {}


def _tidy(stage: Stage) -> Stage:
    """Deletes what the stage before wrote on its way: its result, which ``docs`` reads, is written."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        clear_work_folders(spark, _inner.pop(application, ()))
        before = set(work_folders(spark))
        out = stage(spark, docs, sf_dir)
        _inner[application] = set(work_folders(spark)) - before
        return out

    return run_stage


#: Each stage's result is to be written before the next stage is called, as ``run`` does.
STAGES = [
    ("quality_rules", _tidy(quality)),
    ("line_dedup", _tidy(line_dedup)),
    ("near_dedup", _tidy(near_dedup)),
    ("benchmark_decontamination", _tidy(decontamination)),
    ("encoding", _tidy(encoding)),
]

#: SQL cannot express the stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
