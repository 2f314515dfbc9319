"""Benchmark decontamination by Wu-Manber search for many patterns at once.

Text and patterns are brought to one form: words of the letters, digits and non-ASCII bytes,
lower-cased in A-Z, with one space around each. All patterns are compared by their first ``m``
bytes, m being the shortest length. A shift table says for each block of ``BLOCK`` bytes how
far the window of m bytes can move on, because no pattern has that block nearer to its end;
most positions are so never looked at. Where the shift is 0, the block's bucket gives the
patterns that end their first m bytes with it; the hash of their first bytes picks among them,
and a direct comparison of all bytes confirms. Many cursors run over a block of texts in step.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogflow.llm.blocks import blocks_of, id_and_text, map_arrow

WINDOW = 10
BLOCK = 5
#: Bits of the shift table.
TABLE_BITS = 20
#: Patterns searched in one pass over the documents; more patterns take more passes. At most
#: this many windows, of at most ``PATTERN_BYTES`` together, are sent to the tasks at once.
PATTERNS_PER_PASS = 500_000
PATTERN_BYTES = 64 << 20
BLOCK_BYTES = 8 << 20
LANES = 4096

#: Fixed value: the bytes that belong to words.
WORD = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_FORM = bytes(
    b + 32 if 65 <= b <= 90 else b if re.fullmatch(WORD, bytes([b])) else 32 for b in range(256)
)


def normal(text: str) -> bytes:
    """The words of a text, lower-cased in A-Z, joined by one space."""
    return b" ".join(text.encode("utf-8").translate(_FORM).split())


def windows_of(words: list[bytes], size: int = WINDOW) -> list[bytes]:
    """All runs of ``size`` words; a shorter text, unless empty, is one window."""
    if not words:
        return []
    return [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


def _hash(data: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A hash of ``size`` bytes from each position."""
    value = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            value = value * np.uint64(0x100000001B3) + data[at + k]
        value *= np.uint64(0x9E3779B97F4A7C15)
    return value


class WuManber:
    """The tables for one set of patterns, each a window with a space before and after."""

    def __init__(self, windows: list[bytes]):
        self.patterns = sorted({b" " + w + b" " for w in windows})
        self.m = min(map(len, self.patterns))
        self.block = min(BLOCK, self.m)
        m, size = self.m, self.block
        data = np.frombuffer(b"".join(p[:m] for p in self.patterns), np.uint8)
        firsts = np.arange(len(self.patterns)) * m
        self.shift = np.full(1 << TABLE_BITS, m - size + 1, np.int64)
        for end in range(size, m + 1):
            slot = self._slot(data, firsts + end - size)
            np.minimum.at(self.shift, slot, m - end)
        # Bucket key: the last block of the first m bytes, then the hash of the first bytes.
        keys = self._key(data, firsts)
        order = np.argsort(keys, kind="stable")
        self.keys, self.bucket = keys[order], order

    def _slot(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        return (_hash(data, at, self.block) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def _key(self, data: np.ndarray, first: np.ndarray) -> np.ndarray:
        suffix = _hash(data, first + self.m - self.block, self.block)
        with np.errstate(over="ignore"):
            return suffix * np.uint64(31) + _hash(data, first, min(8, self.m))

    def search(self, text: bytes) -> list[tuple[int, int]]:
        """First byte and number of each pattern found, in any order."""
        n = len(text)
        if n < self.m:
            return []
        data = np.frombuffer(text, np.uint8)
        size = self.block
        # A cursor is the last byte of its window; each owns a stretch of last bytes.
        stretch = max(256, -(-n // LANES))
        cursor = np.arange(self.m - 1, n, stretch)
        limit = np.minimum(cursor + stretch, n)
        found = []
        while len(cursor):
            step = self.shift[self._slot(data, cursor - size + 1)]
            hit = cursor[step == 0]
            if len(hit):
                found.append(hit)
            cursor = cursor + np.maximum(step, 1)
            on = cursor < limit
            cursor, limit = cursor[on], limit[on]
        if not found:
            return []
        first = np.concatenate(found) - self.m + 1
        keys = self._key(data, first)
        low = np.searchsorted(self.keys, keys, side="left")
        high = np.searchsorted(self.keys, keys, side="right")
        out = []
        for at, a, b in zip(first[high > low].tolist(), low[high > low], high[high > low]):
            for number in self.bucket[a:b].tolist():
                pattern = self.patterns[number]
                if text[at : at + len(pattern)] == pattern:
                    out.append((at, number))
        return out


class Searcher:
    """Searches windows of full size and, by a table of their own, the shorter ones."""

    def __init__(self, items: list[tuple[str, bytes]]):
        """``items``: pairs of an item's id and one of its windows."""
        self.of: dict[bytes, set[str]] = {}
        for item, window in items:
            self.of.setdefault(b" " + window + b" ", set()).add(item)
        by_words: dict[int, list[bytes]] = {}
        for _, window in items:
            by_words.setdefault(window.count(b" ") + 1, []).append(window)
        self.tables = [WuManber(w) for _, w in sorted(by_words.items())]

    def hits(self, texts: list[str]) -> list[tuple[int, list[tuple[int, int, set[str]]]]]:
        """For each text its number of words and the word spans found, with their items."""
        parts = [normal(t) for t in texts]
        joined = b"\x00 " + b" \x00 ".join(parts) + b" \x00"
        starts = np.cumsum([0, *(len(p) + 3 for p in parts)])[:-1] + 1
        out = [(p.count(b" ") + 1 if p else 0, []) for p in parts]
        spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        for table in self.tables:
            found = table.search(joined)
            if not found:
                continue
            at = np.array([a for a, _ in found])
            doc = np.searchsorted(starts, at, side="right") - 1
            word = np.searchsorted(spaces, at) - np.searchsorted(spaces, starts[doc])
            for (_, number), d, w in zip(found, doc.tolist(), word.tolist()):
                pattern = table.patterns[number]
                out[d][1].append((w, w + pattern.count(b" ") - 1, self.of[pattern]))
        return out


def benchmark_windows(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """The distinct (item, window) rows of the benchmark; an item without words has none."""

    def run(batches):
        for batch in batches:
            ids, found = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = sorted(set(windows_of(normal(text or "").split())))
                ids += [item] * len(own)
                found += own
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(found, pa.binary())], names=["item", "window"]
            )

    frame = id_and_text(benchmark, item_col, text_col)
    frame = frame.select(F.col("id").cast("string").alias("id"), "text")
    return map_arrow(frame, run, "item string, window binary").distinct()


def passes(windows: DataFrame) -> list[list[tuple[str, bytes]]]:
    """The windows in lists of bounded size, one for each pass over the documents.

    The number of passes follows the count and the bytes of the windows. A window goes by its
    hash to one pass, with all its items; only one pass's windows are held at a time.
    """
    n, size = windows.agg(F.count("*"), F.sum(F.length("window") + 16)).first()
    rounds = max(1, -(-(n or 0) // (PATTERNS_PER_PASS // 2)), -(-(size or 0) // (PATTERN_BYTES // 2)))
    part = F.pmod(F.xxhash64("window"), F.lit(rounds))
    for i in range(rounds):
        yield [
            (r.item, bytes(r.window)) for r in windows.where(part == i).toLocalIterator()
        ]


def search(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Every occurrence set of each document: id, text, n_words, spans, items.

    ``spans`` are the word spans [start, end) of all windows found, ``items`` the distinct ids
    (as strings, sorted) of the items they belong to. Documents without words or hits have
    empty lists, a null text has no words; repeated rows stay repeated. An item whose id is
    null hits words but is not listed. An empty benchmark finds nothing. The benchmark's
    windows are sent to the tasks in passes of bounded size, and each pass adds to the lists.
    """
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType)])
    for field in T._parse_datatype_string(
        "text string, n_words bigint, spans array<struct<start: bigint, end: bigint>>, "
        "items array<string>"
    ):
        schema = schema.add(field)
    out = id_and_text(docs, id_col, text_col).select(
        "id",
        "text",
        F.lit(0).cast("bigint").alias("n_words"),
        F.expr("cast(array() as array<struct<start: bigint, end: bigint>>)").alias("spans"),
        F.expr("cast(array() as array<string>)").alias("items"),
    )
    spark = docs.sparkSession
    for windows in passes(benchmark_windows(benchmark, item_col, item_text_col)):
        out = _one_pass(spark, out, windows, schema)
    return out.withColumnRenamed("id", id_col)


_held: dict[str, Searcher] = {}


def _one_pass(spark: SparkSession, docs: DataFrame, windows, schema: T.StructType) -> DataFrame:
    sent, tag = spark.sparkContext.broadcast(windows), uuid.uuid4().hex

    def run(batches):
        # The tables are built once in each Python worker.
        if tag not in _held:
            _held.clear()
            _held[tag] = Searcher(sent.value)
        searcher = _held[tag]
        for batch in batches:
            for start, texts in blocks_of(batch.column(1), BLOCK_BYTES):
                part = batch.slice(start, len(texts))
                found = searcher.hits(texts)
                spans, items = [], []
                for (_, hits), own, known in zip(
                    found, part.column(3).to_pylist(), part.column(4).to_pylist()
                ):
                    cover = sorted({(a, b) for a, b, _ in hits} | {(s["start"], s["end"]) for s in own})
                    spans.append([{"start": a, "end": b} for a, b in merged(cover)])
                    named = set(known).union(*(i for _, _, i in hits))
                    items.append(sorted(i for i in named if i is not None))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array([n for n, _ in found], pa.int64()),
                        pa.array(spans, part.schema.field(3).type),
                        pa.array(items, pa.list_(pa.string())),
                    ],
                    names=["id", "text", "n_words", "spans", "items"],
                )

    return map_arrow(docs, run, schema)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of sorted spans."""
    out: list[tuple[int, int]] = []
    for a, b in spans:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, **columns: str) -> DataFrame:
    """id, n_words, n_hit, n_items, items_sha256 and contaminated of each document.

    n_hit counts the words inside any occurrence of a window; items_sha256 is the digest of the
    sorted ids joined by commas (of the empty string if there are none). See ``search``.
    """
    found = search(docs, benchmark, **columns)
    first = found.columns[0]
    n_hit = F.aggregate(
        "spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"]
    )
    return found.select(
        F.col(first),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs, with all columns."""
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{text_col}`").alias("text"))
    found = search(rows, benchmark, "row", "text", item_col, item_text_col)
    return found.where(F.size("spans") == 0).select("row.*")
