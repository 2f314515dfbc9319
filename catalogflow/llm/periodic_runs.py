"""Stretches of words that repeat with a period, by tiles of each period octave.

Octave k holds the periods 2^k .. 2^(k+1)-1. For each octave a document is exploded into
overlapping tiles around boundaries (anchors) that lie 2^k words apart; tiles at whose anchors no
such period can hold are not made. Tiles are dealt to tasks and solved on their own: Z-functions to
the right and to the left of an anchor say, for every period, how far the words agree with those
one period on. What a tile holds of a run is a fragment; fragments of one document and period meet
in a shuffle and are stitched where they overlap by a period.

Why no run is lost: a run of period q in octave k has at least 4q words. Its words from the start up
to one period before the end recur q words later. So at every anchor c between its start and its
end - q - w the words c .. c + w - 1 recur within 2^(k+1) words, where w is 2^(k+1) + 1 (5 for
period 1, whose runs have 6 words). That range has 2^k places or more, so an anchor lies in it less
than 2^k words from its start and one as near to its end. A tile reaches 2^k words to the left of
its anchor and 5 * 2^k (7 for period 1) to the right, which covers the rest, and the fragments of
neighbouring anchors share more than a period.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogflow.llm.blocks import blocks_of, id_and_text, map_arrow, ragged, sha256, words_of
from catalogflow.llm.pair_bpe import Numbers
from catalogflow.session import materialize

MIN_LENGTH, MIN_EXPONENT = 6, 4
BLOCK_BYTES = 8 << 20
#: Anchors of one octave that follow each other share a tile up to about so many words.
TILE_WORDS = 4096
#: Rows of an Arrow batch of tiles hold about so many bytes.
BATCH_BYTES = 4 << 20

_TILE = "octave int, first bigint, anchors int, low bigint, codes binary"
_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def z_function(s: list[int]) -> list[int]:
    """For each place of ``s`` the number of items that agree with the beginning of ``s``."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def prime_factors(n: int) -> list[int]:
    found, p = [], 2
    while p * p <= n:
        if n % p == 0:
            found.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return found + [n] * (n > 1)


def window(octave: int) -> int:
    """So many words from an anchor on have to recur within 2^(octave+1) words."""
    return (2 << octave) + 1 if octave else MIN_LENGTH - 1


def reach(octave: int) -> int:
    """So many words from an anchor on belong to its tile."""
    return max(5 << octave, MIN_LENGTH + 1)


def fragments_at(words: list[int], anchor: int, octave: int) -> Iterator[tuple[int, int, int]]:
    """period, start, end of what repeats across ``anchor``, at least twice, with a primitive period."""
    least, most = 1 << octave, min((2 << octave) - 1, len(words) - anchor)
    if most < least:
        return
    after = z_function(words[anchor:])
    before = words[:anchor][::-1]
    behind = z_function([*before, -1, *words[: anchor + most][::-1]])
    for q in range(least, most + 1):
        ahead = after[q] if q < len(after) else 0
        back = behind[anchor + 1 + most - q]
        if ahead + back >= q and not any(
            after[q // p] >= q - q // p for p in prime_factors(q)
        ):
            yield q, anchor - back, anchor + q + ahead


def solve_tile(
    words: list[int], octave: int, first: int, anchors: int, low: int
) -> list[tuple[int, int, int]]:
    """period, start, end of the fragments of a tile, numbered as in the document."""
    step = 1 << octave
    held: dict[int, list[tuple[int, int]]] = {}
    for c in range(first, first + anchors * step, step):
        begin, end = max(c - step, low) - low, c + reach(octave) - low
        for q, s, e in fragments_at(words[begin:end], c - low - begin, octave):
            s, e = s + begin + low, e + begin + low
            parts = held.setdefault(q, [])
            if parts and s <= parts[-1][1] - q:
                s, e = min(s, parts[-1][0]), max(e, parts[-1][1])
                parts.pop()
            parts.append((s, e))
    return [(q, s, e) for q, parts in held.items() for s, e in parts]


def tiles_of(texts: list[list[bytes]]) -> Iterator[tuple[int, int, int, int, int, bytes]]:
    """text, octave, first anchor, number of anchors, first word and word codes of all tiles."""
    number = Numbers()
    sizes = np.array([len(w) for w in texts], np.int64)
    total = int(sizes.sum())
    codes = np.fromiter((number[w] for words in texts for w in words), np.int32, total)
    starts = np.cumsum(sizes) - sizes
    keys = np.repeat(np.arange(len(texts)), sizes) * max(len(number), 1) + codes
    order = np.argsort(keys, kind="stable")
    recurs = np.full(total, np.iinfo(np.int64).max)
    same = keys[order[1:]] == keys[order[:-1]]
    recurs[order[:-1][same]] = (order[1:] - order[:-1])[same]
    for octave in range(max(int(sizes.max(initial=0)), 1).bit_length()):
        width, step = window(octave), 1 << octave
        docs = np.flatnonzero(sizes >= max(MIN_LENGTH, MIN_EXPONENT * step))
        if not len(docs):
            return
        rare = np.concatenate([[0], np.cumsum(recurs >= 2 * step)])
        each = (sizes[docs] - width) // step + 1
        doc = np.repeat(docs, each)
        anchor = ragged(np.zeros(len(docs), np.int64), each) * step
        at = starts[doc] + anchor
        passing = rare[at + width] == rare[at]
        doc, anchor = doc[passing], anchor[passing]
        if not len(doc):
            continue
        fresh = np.r_[True, (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1] + step)]
        place = np.arange(len(doc))
        place -= np.maximum.accumulate(np.where(fresh, place, 0))
        cuts = np.flatnonzero(fresh | (place % max(TILE_WORDS // step, 1) == 0))
        for i, j in zip(cuts.tolist(), np.r_[cuts[1:], len(doc)].tolist()):
            d, first, last = int(doc[i]), int(anchor[i]), int(anchor[j - 1])
            low, high = max(first - step, 0), min(last + reach(octave), int(sizes[d]))
            words = codes[starts[d] + low : starts[d] + high]
            yield d, octave, first, j - i, low, words.tobytes()


def _exploded(docs: DataFrame, with_text: bool) -> DataFrame:
    """A row for each document and one for each of its tiles, written once.

    ``row`` numbers the documents, equal ones too, by task and place; the rows are written before
    they are used, so the numbers stay. The words of a document without a tile are all kept.
    """
    kind = docs.schema["id"].dataType
    schema = T.StructType(
        [
            T.StructField("row", T.LongType()),
            T.StructField("id", kind),
            *T._parse_datatype_string(f"n_words bigint, kept string, text string, {_TILE}"),
        ]
    )
    types = pa.schema([(f.name, t) for f, t in zip(schema, _arrow_types(docs))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = count(TaskContext.get().partitionId() << 33)
        for batch in batches:
            for start, texts in blocks_of(batch.column(1), BLOCK_BYTES):
                words = [words_of(t) for t in texts]
                rows = [next(numbers) for _ in texts]
                tiled, out, held = set(), [], 0
                for d, *tile in tiles_of(words):
                    tiled.add(d)
                    out.append({"row": rows[d], **dict(zip(_TILE_NAMES, tile))})
                    held += len(tile[-1]) + 100
                    if held > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(out, types)
                        out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, types)
                joined = [b" ".join(w) for w in words]
                plain = [None if d in tiled else j for d, j in enumerate(joined)]
                kept = [j if with_text or j is None else sha256(j) for j in plain]
                columns = {
                    "row": rows,
                    "id": batch.column(0).slice(start, len(texts)),
                    "n_words": [len(w) for w in words],
                    "kept": kept,
                    "text": [j if d in tiled else None for d, j in enumerate(joined)],
                }
                nothing = [None] * len(texts)
                yield pa.RecordBatch.from_arrays(
                    [_array(columns.get(f.name, nothing), f.type) for f in types], schema=types
                )

    return materialize(map_arrow(docs, run, schema), "tiles")


_TILE_NAMES = [f.split()[0] for f in _TILE.split(", ")]


def _arrow_types(docs: DataFrame) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    long, text = pa.int64(), pa.string()
    kind = to_arrow_type(docs.schema["id"].dataType)
    return [long, kind, long, text, text, pa.int32(), long, pa.int32(), long, pa.binary()]


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values.cast(kind)
    if kind == pa.string():
        return pa.array([v.decode() if isinstance(v, bytes) else v for v in values], kind)
    return pa.array(values, kind)


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [
            (t["row"], *fragment)
            for i in range(batch.num_rows)
            for t in batch.slice(i, 1).to_pylist()
            for fragment in solve_tile(
                np.frombuffer(t["codes"], np.int32).tolist(),
                t["octave"], t["first"], t["anchors"], t["low"],
            )
        ]
        columns = zip(*found) if found else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), pa.int64()) for c in columns], names=["row", "period", "low", "high"]
        )


def _stitched(tiles: DataFrame) -> DataFrame:
    """row, period, start, length of all runs."""
    # As many tasks as a shuffle has: tiles are small for the work that they make.
    tasks = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = tiles.repartition(tasks, "row", "octave", "first")
    found = map_arrow(dealt, _solve, "row bigint, period bigint, low bigint, high bigint")
    ordered = Window.partitionBy("row", "period").orderBy("low", "high")
    reached = F.max("high").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col("low") > reached - F.col("period"), F.lit(True))
    return (
        found.withColumn("begins", begins)
        .withColumn("run", F.count_if("begins").over(ordered))
        .groupBy("row", "period", "run")
        .agg(F.min("low").alias("start"), F.max("high").alias("end"))
        .withColumn("length", F.col("end") - F.col("start"))
        .where(F.col("length") >= F.greatest(F.lit(MIN_LENGTH), MIN_EXPONENT * F.col("period")))
        .select("row", "start", "length", "period")
    )


def _collapse(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                words = row["text"].encode().split(b" ")
                stays = np.ones(len(words), bool)
                for r in row["runs"] or ():
                    stays[r["start"] + r["period"] : r["start"] + r["length"]] = False
                left = b" ".join(words[w] for w in np.flatnonzero(stays).tolist())
                kept.append(left.decode() if with_text else sha256(left))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "n_words", "runs")), pa.array(kept, pa.string())],
                names=["id", "n_words", "runs", "kept"],
            )

    return run


def collapse_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True
) -> DataFrame:
    """id, n_words, runs, and the text without the repetitions in its runs.

    A run is a longest stretch of words ``[^\\x20\\x09-\\x0D]+`` whose words one period apart are
    equal, of at least 4 periods and 6 words, with its smallest period. ``runs`` holds start (a word
    number from 0), length and period, ordered by start, then period. Of each run the first period
    stays; a word goes if any run drops it. ``text`` is what stays, joined by one space;
    with ``with_text`` false its SHA-256 stands in its place, as ``kept_sha256``.

    A null, empty or blank text has no words and no runs and leaves an empty text. Repeated rows and
    null ids stay as they are, each row on its own. Any other column is ignored. One row of the
    result, as of the input, is in memory at a time, and the tiles of one block of texts.
    """
    picked = id_and_text(docs, id_col, text_col)
    exploded = _exploded(picked, with_text)
    tiles = exploded.where("octave IS NOT NULL").select("row", *_TILE_NAMES)
    whole = exploded.where("octave IS NULL")
    runs = (
        _stitched(tiles)
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))
    )
    none = F.array().cast(_RUNS)
    plain = whole.where("text IS NULL").select("id", "n_words", none.alias("runs"), "kept")
    tiled = whole.where("text IS NOT NULL").join(runs, "row", "left")
    tiled = tiled.select("id", "n_words", "text", F.coalesce("runs", none).alias("runs"))
    schema = T.StructType([f for f in tiled.schema if f.name != "text"]).add("kept", "string")
    out = plain.unionByName(map_arrow(tiled, _collapse(with_text), schema))
    name = "text" if with_text else "kept_sha256"
    return out.select(F.col("id").alias(id_col), "n_words", "runs", F.col("kept").alias(name))


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period; of equal ones the first, then the shortest period."""

    def compare(a: Column, b: Column) -> Column:
        sign = F.signum(b["length"] * a["period"] - a["length"] * b["period"])
        sign = F.when(sign != 0, sign).otherwise(F.signum(a["start"] - b["start"]))
        return F.when(sign != 0, sign).otherwise(F.signum(a["period"] - b["period"])).cast("int")

    return F.get(F.array_sort(runs, compare), F.lit(0))
