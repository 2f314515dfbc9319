"""Near-duplicate classes by BagMinHash.

A document is the multiset of its 5-word runs. A signature is drawn from Poisson processes: an
occurrence count w is cut into the dyadic levels [0, 1), [1, 2), [2, 4), ..., and each run and
level has a process over time whose rate is the level's width. A point has a random component
and a random height inside its level and counts only if the height is below w. So two documents
share exactly the points below the lesser count, and the chance that the earliest points of a
component agree is the weighted Jaccard similarity. Points are made in order of time and only
up to the time at which all components are likely to be filled; if one is not, the limit is
doubled.

``BANDS`` bands of ``ROWS`` components make buckets: a pair at 0.8 misses all of them with
probability 6e-5. Documents with equal words are one class from the start. In each bucket
every document is verified against one hub; what is not linked to the hub's class by that is
compared further (see ``_rest``), except where the two distances to the hub rule a link out:
the distance is a metric. Verification counts the overlap of the two multisets exactly.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogflow.llm.blocks import blocks_of, id_and_text, map_arrow, mixed, ragged, words_of
from catalogflow.llm.components import components
from catalogflow.session import materialize

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 6
PARITY_BITS = 1024
BLOCK_BYTES = 3 << 20
#: Texts signed together, and points made at once for a few of them.
GROUP, STEPS = 64, 4096

_PRIMES = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) | 1 for k in range(SHINGLE)], np.uint64)


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each 5-word run; of all words if there are fewer, none if none."""
    if not words:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)
    size = min(SHINGLE, len(data))
    n = len(data) - size + 1
    out = np.zeros(n, np.uint64)
    for k, each in enumerate(mixed(data ^ _PRIMES[:size, None])):
        out += each[k : k + n]
    return mixed(out)


def _uniform(keys: np.ndarray) -> np.ndarray:
    """Uniform numbers in (0, 1)."""
    return ((keys >> np.uint64(11)).view(np.int64).astype(np.float64) + 0.5) / float(1 << 53)


_POINT, _GAP, _PLACE = (np.uint64(c) for c in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], m: int) -> np.ndarray:
    """The m components of each bag (hashes, counts), as point hashes; 0 for an empty bag."""
    out = np.zeros((len(bags), m), np.uint64)
    todo = np.array([i for i, (h, _) in enumerate(bags) if len(h)], np.int64)
    slack = np.log(m) + 3.0
    while len(todo):
        whole = np.zeros(len(todo), bool)
        # Short texts have as many points as long ones: memory follows their number.
        for at in range(0, len(todo), GROUP):
            group = todo[at : at + GROUP]
            found, filled = _earliest([bags[i] for i in group], slack, m)
            out[group], whole[at : at + GROUP] = found, filled.all(axis=1)
        todo, slack = todo[~whole], 2 * slack
    return out


def _earliest(bags, slack: float, m: int) -> tuple[np.ndarray, np.ndarray]:
    """The earliest point of each component up to the limit of time, and where there is one."""
    doc = np.repeat(np.arange(len(bags)), [len(h) for h, _ in bags])
    element = np.concatenate([h for h, _ in bags])
    weight = np.concatenate([c for _, c in bags]).astype(np.float64)
    total = np.bincount(doc, weights=weight, minlength=len(bags))
    limit, cell = (slack / total)[doc], doc * m
    # One process for each run and level: key, rate, share of its heights below the count.
    processes = []
    low, width = 0.0, 1.0
    with np.errstate(over="ignore"):
        while len(element):
            key = mixed(element ^ mixed(np.full(1, int(low * 2 + 1), np.uint64)))
            share = np.minimum((weight - low) / width, 1.0)
            processes.append((key, np.full(len(key), width * m), share, cell, limit))
            low, width = low + width, (1.0 if low == 0 else 2 * width)
            on = np.flatnonzero(weight > low)
            element, weight, cell, limit = element[on], weight[on], cell[on], limit[on]
        cell, time, point = _points(*map(np.concatenate, zip(*processes)), m)
    first = np.full(len(bags) * m, np.inf)
    np.minimum.at(first, cell, time)
    on = np.flatnonzero(time == first[cell])
    found = np.zeros(len(bags) * m, np.uint64)
    found[cell[on]] = point[on]
    return found.reshape(-1, m), np.isfinite(first).reshape(-1, m)


def _points(key, rate, share, cell, limit, m: int) -> tuple[np.ndarray, ...]:
    """Cell, time and hash of the points up to each process's limit, those below the count only.

    Few processes take many steps at once, so that an array is never much shorter than ``STEPS``
    while there are points left: a short text has as many points as a long one.
    """
    out = []
    time, step = np.zeros(len(key)), 0
    while len(key):
        many = min(STEPS // len(key), int(((limit - time) * rate).max()) + 2)
        steps = np.arange(step + 1, step + 1 + max(many, 1), dtype=np.uint64)
        step += len(steps)
        point = mixed(key + (steps * _POINT)[:, None])
        times = np.log(_uniform(mixed(point ^ _GAP))) / -rate
        times[0] += time
        np.add.accumulate(times, axis=0, out=times)
        at = np.flatnonzero(times <= limit)
        of, point = at % len(key), point.ravel()[at]
        place = mixed(point ^ _PLACE)
        # The remainder by m: dividing by one number is much faster than ``%``.
        part = (place - place // np.uint64(m) * np.uint64(m)).astype(np.int64)
        below = np.flatnonzero(_uniform(mixed(place)) < share[of])
        out.append((cell[of[below]] + part[below], times.ravel()[at[below]], point[below]))
        time = times[-1]
        on = np.flatnonzero(time <= limit)
        key, rate, share, cell, limit, time = (x[on] for x in (key, rate, share, cell, limit, time))
    return tuple(map(np.concatenate, zip(*out)))


def parities(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The parity of the runs in each of ``PARITY_BITS`` groups, a run's occurrences dealt one by one."""
    which = ragged(np.zeros(len(counts), np.int64), counts).astype(np.uint64)
    odd = mixed(np.repeat(hashes, counts) + which * _POINT) >> np.uint64(8)
    bits = np.bincount((odd % np.uint64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view("<i8")


def unequal(a: str, b: str) -> Column:
    """In how many groups the parities differ: at most the difference of the two multisets."""
    found = [F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k])) for k in range(PARITY_BITS // 64)]
    return reduce(Column.__add__, found)


def _signed(rows: DataFrame, id_type: T.DataType) -> DataFrame:
    """For each row: key of its words (null if none), number of shingles and bucket hashes."""
    schema = T.StructType([T.StructField("id", id_type)])
    for field in T._parse_datatype_string("v bigint, key binary, n int, bands array<bigint>, parity array<bigint>"):
        schema = schema.add(field)

    def run(batches):
        for batch in batches:
            for first, texts in blocks_of(batch.column(1), BLOCK_BYTES):
                part = batch.slice(first, len(texts))
                words = [words_of(t) for t in texts]
                bags = [np.unique(shingle_hashes(w), return_counts=True) for w in words]
                found = signatures(bags, BANDS * ROWS).reshape(len(words), BANDS, ROWS)
                band = np.zeros((len(words), BANDS), np.uint64)
                for k in range(ROWS):
                    band = mixed(band * np.uint64(0x9E3779B97F4A7C15) + found[:, :, k])
                band = mixed(band ^ np.arange(BANDS, dtype=np.uint64)).view(np.int64)
                parity = [parities(*bag) for bag in bags]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(2),
                        pa.array(
                            [xxhash.xxh3_128_digest(b" ".join(w)) if w else None for w in words],
                            pa.binary(),
                        ),
                        pa.array([int(c.sum()) for _, c in bags], pa.int32()),
                        *(
                            pa.array([x if w else None for x, w in zip(found, words)], pa.list_(pa.int64()))
                            for found in (band, parity)
                        ),
                    ],
                    names=["id", "v", "key", "n", "bands", "parity"],
                )

    return map_arrow(rows, run, schema)


def overlap(left: Counter, right: Counter) -> float:
    """Weighted Jaccard similarity of two multisets."""
    if len(left) > len(right):
        left, right = right, left
    least = sum(min(n, right[x]) for x, n in left.items() if x in right)
    return least / (left.total() + right.total() - least)


def bag_of(text: str) -> Counter:
    words = words_of(text)
    size = min(SHINGLE, len(words))
    return Counter(zip(*(words[k : len(words) - size + 1 + k] for k in range(size)))) if words else Counter()


def _verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, similarity) of distinct pairs of nodes; ``texts`` has node and text."""

    def run(batches):
        last, bag = None, None
        for batch in batches:
            out = []
            for text_a, text_b in zip(batch.column(2), batch.column(3)):
                text_a = text_a.as_py()
                if text_a != last:
                    last, bag = text_a, bag_of(text_a)
                out.append(overlap(bag, bag_of(text_b.as_py())))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.float64())], names=["a", "b", "s"]
            )

    own = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    hub = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    joined = pairs.join(own, "b").join(hub, "a").select("a", "b", "text_a", "text_b")
    return map_arrow(
        joined, run, T.StructType([*pairs.select("a", "b").schema, T.StructField("s", T.DoubleType())])
    )


def classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """id, class_id (the least id of its class), class_size, text_hash and ``first`` of each row.

    Two documents are linked if the weighted Jaccard similarity of their 5-word runs is
    ``similarity`` or more; a class is a connected component of links. ``first`` marks the
    document with the class's id. A text of fewer than five words is one run of all of them; a
    text without words, or null, is linked to nothing. Repeated rows are copies of each other;
    a null id sorts last. Other columns are ignored.
    """
    rows = id_and_text(docs, id_col, text_col).withColumn("v", F.xxhash64("text"))
    id_type = docs.schema[id_col].dataType
    signed = materialize(_signed(rows, id_type), "signed")
    worded = signed.where("key is not null")
    # A null id is greater than any other, so it never names a class that has another id.
    node = F.struct(F.col("id").isNull().alias("none"), "id", "v")
    reps = materialize(
        worded.groupBy("key").agg(
            F.min(node).alias("node"),
            F.min("n").alias("n"),
            F.min("bands").alias("bands"),
            F.min("parity").alias("parity"),
        ),
        "classes",
    )
    banded = reps.select("node", "n", F.explode("bands").alias("bucket"))
    shared = materialize(
        banded.groupBy("bucket")
        .agg(F.min("node").alias("hub"), F.count("*").alias("c"))
        .where("c > 1")
        .drop("c"),
        "hubs",
    )
    members = materialize(banded.join(shared, "bucket"), "members")
    wanted = members.select("node").distinct()
    wanted = wanted.select(F.col("node.id").alias("w_id"), F.col("node.v").alias("w_v"), "node")
    texts = rows.join(
        wanted, rows["id"].eqNullSafe(wanted["w_id"]) & rows["v"].eqNullSafe(wanted["w_v"])
    ).select("node", "text")
    # Repeated rows would give a node its text several times.
    texts = materialize(texts.dropDuplicates(["node"]), "texts")

    pairs = members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    scored = materialize(_verify(pairs.distinct(), texts), "hub_pairs")
    links = scored.where(F.col("s") >= similarity).select("a", "b")
    roots = components(links)

    rest = _rest(members, scored, roots, reps.select(F.col("node").alias("k_node"), "parity"), similarity)
    more = _verify(rest, texts).where(F.col("s") >= similarity).select("a", "b")
    more = materialize(more, "more_links")
    if not more.isEmpty():
        roots = components(links.unionByName(more))
    roots = materialize(roots, "roots")

    of = reps.join(roots, reps["node"] == roots["node"], "left").select(
        F.col("key").alias("r_key"),
        F.coalesce("root", reps["node"]).alias("root"),
        reps["node"].alias("rep"),
    )
    named = signed.join(of, signed["key"] == of["r_key"], "left").select("id", "v", "root")
    sizes = named.where("root is not null").groupBy("root").count()
    sizes = sizes.select(F.col("root").alias("s_root"), F.col("count").alias("size"))
    return named.join(sizes, F.col("root") == F.col("s_root"), "left").select(
        F.col("id").alias(id_col),
        F.coalesce("root.id", "id").alias("class_id"),
        F.coalesce("size", F.lit(1)).alias("class_size"),
        F.col("v").alias("text_hash"),
        (
            F.col("root").isNull()
            | (F.col("root.id").eqNullSafe(F.col("id")) & (F.col("root.v") == F.col("v")))
        ).alias("first"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each class the one with the least id, all columns.

    Of repeated rows (equal id and text) one stays. Rows without words all stay.
    """
    found = classes(docs, id_col, text_col)
    state = (
        found.groupBy(F.col(f"`{id_col}`").alias("s_id"), F.col("text_hash").alias("s_v"))
        .agg(F.min("first").alias("stays"), (F.max("class_size") > 1).alias("copied"))
        .where("copied")
    )
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{id_col}`").alias("id"), F.xxhash64(f"`{text_col}`").alias("v"))
    joined = rows.join(
        state, rows["id"].eqNullSafe(state["s_id"]) & (rows["v"] == state["s_v"]), "left"
    )
    alone = joined.where(F.col("stays").isNull())
    chosen = joined.where("stays").dropDuplicates(["id", "v"])
    return alone.unionByName(chosen).select("row.*")


def _rest(
    members: DataFrame,
    scored: DataFrame,
    roots: DataFrame,
    parity: DataFrame,
    similarity: float,
) -> DataFrame:
    """Pairs that the hubs leave open.

    A member of a bucket is open if it is not in the hub's component. An open member is paired
    with the members of the hub's component and with the others that are open at the same hub,
    in however few buckets they meet. Only pairs are left whose sizes, parities and distances to
    the hub allow the link; each of the three is a bound that no linked pair breaks.
    """
    root_of = roots.select(F.col("node").alias("r_node"), "root")
    near = scored.select(F.col("a").alias("hub"), F.col("b").alias("node"), (1 - F.col("s")).alias("d"))
    rows = members.join(near, ["hub", "node"], "left").withColumn("d", F.coalesce("d", F.lit(0.0)))
    rows = rows.join(root_of, F.col("node") == F.col("r_node"), "left").drop("r_node")
    rows = rows.withColumn("root", F.coalesce("root", "node"))
    hubs = root_of.select(F.col("r_node"), F.col("root").alias("hub_root"))
    rows = rows.join(hubs, F.col("hub") == F.col("r_node"), "left").drop("r_node")
    rows = rows.withColumn("open", F.col("root") != F.coalesce("hub_root", "hub"))
    rows = rows.select("bucket", "hub", "node", "n", "d", "root", "open")
    # Only buckets with an open member leave anything to do.
    wanted = rows.where("open").select("bucket").distinct()
    rows = rows.join(wanted, "bucket", "left_semi").join(parity, F.col("node") == F.col("k_node"))
    rows = materialize(rows.drop("k_node"), "open")
    reach = 1 - similarity + 1e-9
    fits = F.least("x.n", "y.n") >= F.greatest("x.n", "y.n") * (similarity - 1e-9)
    # The overlap is at most half of what the sizes leave over the unequal groups.
    sizes = F.col("x.n") + F.col("y.n")
    fits &= unequal("x.parity", "y.parity") * (1 + similarity) <= sizes * (1 - similarity) + 1e-6
    # Two nodes meet once for each hub, in however many of its buckets they are.
    at_hub = rows.drop("bucket").dropDuplicates(["hub", "node"])
    x = at_hub.where("open").alias("x")
    y = at_hub.where("not open and d > 0").alias("y")
    near_hub = x.join(
        y,
        (F.col("x.hub") == F.col("y.hub"))
        & (F.col("x.root") != F.col("y.root"))
        & fits
        & (F.abs(F.col("x.d") - F.col("y.d")) <= reach),
    )
    x, y = at_hub.where("open").alias("x"), at_hub.where("open").alias("y")
    open_pairs = x.join(
        y,
        (F.col("x.hub") == F.col("y.hub"))
        & (F.col("x.root") != F.col("y.root"))
        & (F.col("x.node") < F.col("y.node"))
        & fits
        & (F.abs(F.col("x.d") - F.col("y.d")) <= reach),
    )
    pair = [F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")]
    return near_hub.select(pair).unionByName(open_pairs.select(pair)).distinct()
