"""Substring dedup by relative Lempel-Ziv parsing over blocks that are found by content.

The corpus is its own reference. It is indexed in blocks: every run of 35 words (a window) has
one anchor, the least hashed 10-word sequence in it, and the block of an anchor holds each
distinct stretch of words around it once. A stretch is what all consecutive windows with the
same anchor cover. So a window can occur only in the block of its own anchor, and a document
needs to be compared with no others, though it is parsed against all of them.

A document is factored from left to right into stretches. A stretch that its block holds from
another place as well is copied as a whole; neighbouring ones join to one long factor. At the
boundary of a factor the stretch itself is new but its anchor is known: there the windows are
compared one by one with those of the block's other stretches. Every word of a factor or window
found so is removed.

Words are compared by 128-bit hashes. Only anchors that occur twice leave the first pass; the
texts of documents with windows still to be compared are the only ones kept for the last one.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogflow.llm.blocks import blocks_of, id_and_text, map_arrow, mixed, sha256, words_of
from catalogflow.session import materialize

WINDOW = 35
ANCHOR = 10
BLOCK_BYTES = 4 << 20

_BASES = (0x9E3779B97F4A7C17, 0xC2B2AE3D27D4EB4F)


@lru_cache(4)
def _powers(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2**64."""
    out = []
    for base in (_BASES[which], pow(_BASES[which], -1, 1 << 64)):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps))
    return out[0], out[1]


class Hashes:
    """Hashes of any run of the words of some documents."""

    def __init__(self, documents: list[list[bytes]]):
        self.lengths = np.array([len(d) for d in documents], np.int64)
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        digest = xxhash.xxh3_128_digest
        data = b"".join([digest(w) for d in documents for w in d])
        both = np.frombuffer(data, "<u8").reshape(-1, 2)
        self.n = len(both)
        room = 1 << max(10, int(self.n).bit_length())
        self.sums, self.back = [], []
        for which in (0, 1):
            up, down = _powers(room, which)
            self.sums.append(np.r_[np.uint64(0), np.cumsum(both[:, which] * up[: self.n])])
            self.back.append(down)

    def of(self, start: np.ndarray, length, which: int) -> np.ndarray:
        sums = self.sums[which]
        return mixed((sums[start + length] - sums[start]) * self.back[which][start])


def stretches(h: Hashes) -> tuple[np.ndarray, ...]:
    """Document, first word, number of windows, anchor hash and hash of each stretch."""
    none = np.zeros(0, np.int64)
    if h.n < WINDOW:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    n = h.n - ANCHOR + 1
    anchors = h.of(np.arange(n), ANCHOR, 0)
    bits = np.uint64(max(24, int(n).bit_length()))
    # The least hash, and of equal ones the leftmost.
    least = (anchors >> bits << bits) | np.arange(n, dtype=np.uint64)
    room, width = WINDOW - ANCHOR + 1, 1
    while 2 * width <= room:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if room > width:
        least = np.minimum(least[: len(least) - (room - width)], least[room - width :])
    at = (least & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    doc = np.repeat(np.arange(len(h.lengths)), h.lengths)[: len(at)]
    whole = np.arange(len(at)) + WINDOW <= h.ends[doc]
    first = np.flatnonzero(whole)
    if not len(first):
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    new = np.r_[True, (at[first[1:]] != at[first[:-1]]) | (doc[first[1:]] != doc[first[:-1]])]
    head = np.flatnonzero(new)
    count = np.diff(np.r_[head, len(first)])
    start = first[head]
    anchor = at[start]
    span = h.of(start, count - 1 + WINDOW, 1) ^ mixed((anchor - start).astype(np.uint64))
    return doc[start], start - h.starts[doc[start]], count, anchors[anchor], span


def _factors(docs: DataFrame, kind: str) -> DataFrame:
    """A row for each stretch: document (id, v), anchor, span, start and n, its windows."""

    def run(batches):
        for batch in batches:
            for first, texts in blocks_of(batch.column(1), BLOCK_BYTES):
                doc, start, n, anchor, span = stretches(Hashes([words_of(t) for t in texts]))
                rows = pa.array(first + doc)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(2).take(rows),
                        pa.array(anchor.view(np.int64)),
                        pa.array(span.view(np.int64)),
                        pa.array(start.astype(np.int32)),
                        pa.array(n.astype(np.int32)),
                    ],
                    names=["id", "v", "anchor", "span", "start", "n"],
                )

    schema = f"id {kind}, v int, anchor bigint, span bigint, start int, n int"
    return map_arrow(docs, run, schema)


def removed_words(n_words: int, cover: list[tuple[int, int]]) -> np.ndarray:
    """Which words are covered by the half-open runs."""
    edges = np.zeros(n_words + 1, np.int64)
    if cover:
        a = np.array(cover, np.int64)
        np.add.at(edges, a[:, 0], 1)
        np.add.at(edges, a[:, 1], -1)
    return np.cumsum(edges)[:-1] > 0


def _result(words: list[bytes], gone: np.ndarray, want_text: bool) -> tuple:
    kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words)
    return len(words), int(gone.sum()), sha256(kept), kept.decode("utf-8") if want_text else None


#: What is to be done with a stretch: remove it, compare its windows, or only show them.
_COPY, _COMPARE, _SHOW = range(3)


def _parse(joined: DataFrame, kind: str, want_text: bool) -> DataFrame:
    """Results of documents that are done, and of the others what the last pass needs."""

    def run(batches):
        for batch in batches:
            for first, texts in blocks_of(batch.column(1), BLOCK_BYTES):
                part = batch.slice(first, len(texts))
                documents = [words_of(t) for t in texts]
                plans = part.column(3).to_pylist()
                hashes, at = None, []
                seen = [i for i, p in enumerate(plans) if p and any(x["what"] for x in p)]
                if seen:
                    hashes = Hashes([documents[i] for i in seen])
                    at = dict(zip(seen, hashes.starts.tolist()))
                out = {k: [] for k in ("n_words", "n_removed", "sha", "kept", "text", "cover", "windows")}
                for i, (words, plan) in enumerate(zip(documents, plans)):
                    plan = plan or []
                    cover = [
                        (x["start"], x["start"] + x["n"] + WINDOW - 1)
                        for x in plan
                        if x["what"] == _COPY
                    ]
                    windows = []
                    for x in plan:
                        if x["what"] != _COPY:
                            own = np.arange(x["start"], x["start"] + x["n"])
                            a = hashes.of(at[i] + own, WINDOW, 0).view(np.int64).tolist()
                            b = hashes.of(at[i] + own, WINDOW, 1).view(np.int64).tolist()
                            own = own.tolist() if x["what"] == _COMPARE else [-1] * len(own)
                            windows += [
                                {"a": p, "b": q, "start": s} for p, q, s in zip(a, b, own)
                            ]
                    later = any(x["what"] == _COMPARE for x in plan)
                    done = (
                        (len(words), None, None, None)
                        if later
                        else _result(words, removed_words(len(words), cover), want_text)
                    )
                    for name, value in zip(("n_words", "n_removed", "sha", "kept"), done):
                        out[name].append(value)
                    out["text"].append(texts[i] if later else None)
                    out["cover"].append(
                        [{"start": a, "end": b} for a, b in cover] if later else None
                    )
                    out["windows"].append(windows or None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2)]
                    + [pa.array(out[n], t) for n, t in types.items()],
                    names=["id", "v", *types],
                )

    types = {
        "n_words": pa.int64(),
        "n_removed": pa.int64(),
        "sha": pa.string(),
        "kept": pa.string(),
        "text": pa.string(),
        "cover": pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
        "windows": pa.list_(
            pa.struct([("a", pa.int64()), ("b", pa.int64()), ("start", pa.int32())])
        ),
    }
    schema = (
        f"id {kind}, v int, n_words bigint, n_removed bigint, sha string, kept string, text string, "
        "cover array<struct<start: int, end: int>>, "
        "windows array<struct<a: bigint, b: bigint, start: int>>"
    )
    return map_arrow(joined, run, schema)


def _finish(pending: DataFrame, kind: str, want_text: bool) -> DataFrame:
    def run(batches):
        for batch in batches:
            for first, texts in blocks_of(batch.column(1), BLOCK_BYTES):
                part = batch.slice(first, len(texts))
                out = []
                for text, cover, starts in zip(
                    texts, part.column(2).to_pylist(), part.column(3).to_pylist()
                ):
                    words = words_of(text)
                    runs = [(x["start"], x["end"]) for x in cover]
                    runs += [(s, s + WINDOW) for s in starts or ()]
                    out.append(_result(words, removed_words(len(words), runs), want_text))
                columns = list(zip(*out))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                    names=["id", "n_words", "n_removed", "sha", "kept"],
                )

    schema = f"id {kind}, n_words bigint, n_removed bigint, sha string, kept string"
    return map_arrow(pending, run, schema)


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True
) -> DataFrame:
    """id, n_words, n_removed, kept_sha256 and, if asked for, ``kept_text`` of each document.

    Every word inside a 35-word window whose words also start anywhere else, in the same or
    another document, is removed; windows are judged on the input. The kept words are joined
    by one space. A null, empty or short text keeps all its words. A repeated row repeats all
    its windows, so both rows lose them; rows that share an id are told apart by their text.
    A null id is an id like any other. Other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = id_and_text(docs, id_col, text_col).withColumn("v", F.hash("text"))
    factors = _factors(rows, kind)
    known = materialize(
        factors.groupBy("anchor").count().where(F.col("count") > 1).select("anchor"), "anchors"
    )
    near = materialize(factors.join(known, "anchor"), "near")
    place = F.struct("id", "v", "start", "n")
    spans = materialize(
        near.groupBy("anchor", "span").agg(F.count("*").alias("c"), F.min(place).alias("one")), "spans"
    )
    mixed_blocks = spans.groupBy("anchor").agg(F.count("*").alias("d")).where(F.col("d") > 1)
    copied = near.join(spans.where("c > 1").select("anchor", "span"), ["anchor", "span"]).select(
        "id", "v", F.struct(F.lit(_COPY).alias("what"), "start", "n").alias("x")
    )
    compared = spans.join(mixed_blocks, "anchor", "left_semi").select(
        "one.id",
        "one.v",
        F.struct(
            F.when(F.col("c") == 1, _COMPARE).otherwise(_SHOW).alias("what"), "one.start", "one.n"
        ).alias("x"),
    )
    plans = (
        copied.unionByName(compared)
        .groupBy(F.col("id").alias("plan_id"), F.col("v").alias("plan_v"))
        .agg(F.collect_set("x").alias("plan"))
    )
    joined = rows.join(
        plans, rows["id"].eqNullSafe(plans["plan_id"]) & rows["v"].eqNullSafe(plans["plan_v"]), "left"
    ).select("id", "text", "v", "plan")
    parsed = materialize(_parse(joined, kind, with_text), "parsed")

    windows = parsed.where("windows is not null").select("id", "v", F.explode("windows").alias("w"))
    windows = windows.select("id", "v", "w.a", "w.b", "w.start")
    # A document's repeated row shows the same stretch again, which is already copied.
    twice = materialize(
        windows.groupBy("a", "b").count().where(F.col("count") > 1).select("a", "b"), "twice"
    )
    starts = (
        windows.where("start >= 0")
        .join(twice, ["a", "b"])
        .groupBy(F.col("id").alias("s_id"), F.col("v").alias("s_v"))
        .agg(F.collect_set("start").alias("starts"))
    )
    later = parsed.where("text is not null").select("id", "text", "cover", "v")
    pending = later.join(
        starts, later["id"].eqNullSafe(starts["s_id"]) & later["v"].eqNullSafe(starts["s_v"]), "left"
    ).select("id", "text", "cover", "starts")
    done = parsed.where("text is null").select("id", "n_words", "n_removed", "sha", "kept")
    out = done.unionByName(_finish(pending, kind, with_text))
    columns = [F.col("id").alias(id_col), "n_words", "n_removed", F.col("sha").alias("kept_sha256")]
    return out.select(*columns, *[F.col("kept").alias("kept_text")] * with_text)
