"""Packing by deficit round-robin over one queue for each source.

The documents of a source, cut into packets of at most one sequence, queue up in the order of their
rows. Each round gives every source its quantum of tokens; a packet is sent in the first round by
whose end its source has been given as many tokens as the queue holds up to the packet's end. What a
source was given and has not yet sent is its deficit, which is carried on from round to round: the
round of a packet is ``ceil(tokens of its queue up to its end / quantum)``, so no task has to wait
for another one. Rounds follow each other, in a round the sources, and that stream is cut into
sequences; a sequence that a task's rows leave open is filled by the next task's.

Both sums (up to a packet in its queue, and in the stream) are running totals over a sorted layout
that is written once; between tasks only one number for each of them is carried.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogflow.llm.blocks import _column, blocks_of, map_arrow
from catalogflow.llm.pair_bpe import PIECES, PairIndexEncoder
from catalogflow.session import materialize

SEQUENCE = 2048
#: Tokens that all sources together are given in a round.
ROUND = 32 * SEQUENCE
BLOCK_BYTES = 4 << 20
#: Fixed value: the id after each document.
END = 1


class RankEncoder:
    """Ids of texts by a byte-level BPE file of the ``tokenizers`` format.

    The merges of such a file are numbered in the order of their ranks, so a token's id is its rank;
    then ``tiktoken`` gives the ids that the tokenizers library gives (the tests compare them).
    """

    def __init__(self, path: str):
        import tiktoken

        spec = PairIndexEncoder(path)
        if (np.diff(spec.made) <= 0).any():
            raise ValueError(f"{path} does not number its merges in the order of their ranks")
        special = set(spec.special.values())
        ranks = {token: i for i, token in enumerate(spec.bytes_of) if i not in special}
        self.ranks = tiktoken.Encoding(
            path, pat_str=PIECES, mergeable_ranks=ranks, special_tokens=spec.special
        )
        self.kind = np.dtype("<u2" if len(spec.bytes_of) <= 1 << 16 else "<u4")

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text with ``END`` behind them; special strings inside it become their ids."""
        ids = self.ranks.encode_to_numpy(text, allowed_special="all")
        return np.append(ids, END).astype(self.kind)


_loaded: dict[str, RankEncoder] = {}


def encoder(path: str) -> RankEncoder:
    """The encoder of a file, loaded once in each Python worker."""
    if path not in _loaded:
        _loaded[path] = RankEncoder(path)
    return _loaded[path]


_PACKET = "packet bigint, doc_tokens bigint, start bigint, length bigint, ids binary"


def _packets(docs: DataFrame, path: str) -> DataFrame:
    """The packets of all documents, written once: row, the documents' columns, and their ids.

    ``row`` numbers the documents, equal ones too, by task and place; ids are numbers of two bytes
    if the vocabulary allows, else of four.
    """
    schema = T.StructType([T.StructField("row", T.LongType()), docs.schema["id"], docs.schema["source"]])
    schema = T.StructType([*schema, *T._parse_datatype_string(_PACKET)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, codec = count(TaskContext.get().partitionId() << 33), encoder(path)
        for batch in batches:
            for at, texts in blocks_of(batch.column(1), BLOCK_BYTES):
                of, packet, tokens, start, length, ids = [], [], [], [], [], []
                for i, text in enumerate(texts):
                    found = codec.encode(text)
                    n = len(found)
                    for k, s in enumerate(range(0, n, SEQUENCE)):
                        of.append(i)
                        packet.append(k)
                        tokens.append(n)
                        start.append(s)
                        length.append(min(SEQUENCE, n - s))
                        ids.append(found[s : s + SEQUENCE].tobytes())
                rows = np.fromiter((next(numbers) for _ in texts), np.int64, len(texts))
                taken = pa.array(of, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows[np.array(of, np.int64)]),
                        batch.column(0).slice(at, len(texts)).take(taken),
                        batch.column(2).slice(at, len(texts)).take(taken),
                        *(pa.array(c, pa.int64()) for c in (packet, tokens, start, length)),
                        pa.array(ids, pa.binary()),
                    ],
                    names=schema.names,
                )

    return materialize(map_arrow(docs.select("id", "text", "source"), run, schema), "packets")


def running_total(frame: DataFrame, value: str, *order: str, name: str) -> DataFrame:
    """Adds to each row the sum of ``value`` over all rows before it in ``order``.

    Rows are sorted into ranges, which are written once; between ranges one sum each is carried.
    ``order`` has to tell all rows apart.
    """
    laid_out = materialize(
        frame.orderBy(*order).withColumn("_part", F.spark_partition_id()), f"total-{name}"
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        laid_out.groupBy("_part")
        .agg(F.sum(value).alias("_sum"))
        .select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_part").orderBy(*order)
    here = F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    # One row for each range of the sort, however large the data.
    return (
        laid_out.join(F.broadcast(parts), "_part")
        .withColumn(name, F.col("_before") + F.coalesce(here, F.lit(0)))
        .drop("_part", "_before")
    )


def _rounds(packets: DataFrame, weights: Mapping[str | None, float] | None) -> DataFrame:
    """The packets' places: row, packet, source, start, length and the round each is sent in.

    Without ``weights`` a source's share is its share of all tokens, so all queues end together.
    """
    queues = running_total(
        packets.select("row", "packet", "source", "start", "length"),
        "length", "source", "row", "packet", name="sent",
    )
    sources = queues.groupBy("source").agg(
        F.sum("length").alias("tokens"), F.min("sent").alias("begins")
    )
    if weights is None:
        share = F.col("tokens").cast("double")
        whole = sources.agg(F.sum("tokens")).first()[0] or 1
    else:
        share = F.lit(1.0)
        for source, weight in weights.items():
            share = F.when(F.col("source").eqNullSafe(F.lit(source)), float(weight)).otherwise(share)
        whole = sources.agg(F.sum(share)).first()[0] or 1
    quantum = F.greatest(F.floor(share * ROUND / float(whole)), F.lit(1)).cast("bigint")
    given = sources.select(F.col("source").alias("_source"), "begins", quantum.alias("quantum"))
    end = F.col("sent") - F.col("begins") + F.col("length")
    return (
        queues.join(given, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("round", F.ceil(end / F.col("quantum")).cast("bigint"))
        .select("row", "packet", "source", "start", "length", "round")
    )


def _cut_into_pieces(placed: DataFrame) -> DataFrame:
    """Packets cut where a sequence ends: at most two pieces each."""
    first = F.expr(f"at div {SEQUENCE}")
    last = F.expr(f"(at + length - 1) div {SEQUENCE}")
    return placed.withColumn("sequence_id", F.explode(F.sequence(first, last))).select(
        "row",
        "packet",
        "sequence_id",
        F.greatest(F.col("at"), F.col("sequence_id") * SEQUENCE).alias("begin"),
        F.least(F.col("at") + F.col("length"), (F.col("sequence_id") + 1) * SEQUENCE).alias("end"),
        "at",
    )


def _with_ids(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        for batch in batches:
            kind = kind or encoder(path).kind
            skip, length = (batch.column(c).to_numpy() * kind.itemsize for c in ("skip", "length"))
            ids = [
                np.frombuffer(data[s : s + n], kind).astype("<u4").tobytes()
                for data, s, n in zip(batch.column("ids").to_pylist(), skip.tolist(), length.tolist())
            ]
            columns = [c for c in batch.schema.names if c not in ("skip", "ids")]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, columns), pa.array(ids, pa.binary())], names=[*columns, "ids"]
            )

    return run


def pack(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Mapping[str | None, float] | None = None,
) -> DataFrame:
    """Pieces of documents in sequences of 2,048 tokens, each window mixed as the sources' weights say.

    id, start, length, doc_tokens, sequence_id, offset, and ``ids`` as little-endian unsigned 32-bit
    numbers. Every sequence but the last is full, so less than one sequence of padding is needed in
    all. ``weights`` gives sources their shares of a round (1 where it names none); without it they
    are the sources' shares of all tokens. As long as no queue has run dry, what a source has sent
    by the end of a round is less than one packet short of its share.

    A null or empty text is one token, the end of a document; a null source is a queue of its own;
    repeated rows and null ids are documents of their own. Any other column is ignored. A single
    text is encoded in one piece, everything after that goes by packets of at most one sequence, so
    neither a long text nor a source with most of the rows makes a large task.
    """
    picked = docs.select(
        _column(docs, id_col).alias("id"),
        _column(docs, text_col).alias("text"),
        _column(docs, source_col).alias("source"),
    )
    packets = _packets(picked, path)
    placed = running_total(
        _rounds(packets, weights), "length", "round", "source", "row", "packet", name="at"
    )
    pieces = _cut_into_pieces(placed)
    skip = F.col("begin") - F.col("at")
    cut = packets.drop("length", "source").join(pieces, ["row", "packet"]).select(
        F.col("id"),
        (F.col("start") + skip).alias("start"),
        (F.col("end") - F.col("begin")).alias("length"),
        "doc_tokens",
        "sequence_id",
        (F.col("begin") % SEQUENCE).alias("offset"),
        skip.alias("skip"),
        "ids",
    )
    schema = T.StructType([f for f in cut.schema if f.name not in ("skip", "ids")]).add("ids", "binary")
    return map_arrow(cut, _with_ids(path), schema).withColumnRenamed("id", id_col)
