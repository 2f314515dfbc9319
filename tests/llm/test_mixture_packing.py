"""Pieces against the tokenizers library, and the mix of the windows against plain round-robin."""

import zlib
from collections import Counter, defaultdict, deque
from functools import cache

import numpy as np
import pytest
import tokenizers
from pyspark.sql import functions as F

from catalogflow.llm import mixture_packing, queries
from tests.llm.conftest import ODD_ROWS, strange_texts

SF = "/root/testdata/sf0.001"
SEQUENCE = 2048


@pytest.fixture(scope="module")
def path():
    return "/opt/tokenizers/byte_bpe_50k.json"


@cache
def library_of(path):
    return tokenizers.Tokenizer.from_file(path)


def ids_of(path, text):
    library = library_of(path)
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def test_ids_equal_the_library(path, sample):
    odd = ["  a  b ", " x", "x ", "a  b", "a \x1c b", "a\x85 b", " \n a\n b \n", "　 a", " ", "a <|endoftext|> b"]
    texts = odd + strange_texts(400) + [r.text for r in sample.limit(80).collect()]
    texts += ["a" * 50_000, " " * 50_000 + "x", "\n \n" * 20_000]
    codec = mixture_packing.encoder(path)
    for text in texts:
        assert codec.encode(text).tolist() == ids_of(path, text)


def laid_out(pieces):
    """The sequences' pieces in order; they must leave no gap."""
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
    for number, parts in sequences.items():
        parts.sort(key=lambda p: p.offset)
        at = 0
        for p in parts:
            assert p.offset == at and p.length > 0
            at += p.length
        assert at == SEQUENCE or number == max(sequences)
    assert sorted(sequences) == list(range(len(sequences)))
    return [p for number in sorted(sequences) for p in sequences[number]]


def test_query_holds_every_id_once(spark, path):
    found = queries.op11_mixture_packing(spark, SF).collect()
    laid_out(found)
    of = defaultdict(list)
    for p in found:
        of[p.doc_id].append(p)
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(of) == len(docs)
    for d in docs:
        ids, at = np.array(ids_of(path, d.text), "<u4"), 0
        for p in sorted(of[d.doc_id], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            at += p.length
            assert p.ids_crc32 == zlib.crc32(ids[p.start : at].tobytes())
        assert at == len(ids)


def round_robin(queues, quanta):
    """The packets in the order in which deficit round-robin sends them."""
    queues = {s: deque(q) for s, q in queues.items()}
    deficit, sent = Counter(), []
    while any(queues.values()):
        for s in sorted(queues, key=lambda s: (s is not None, s)):
            deficit[s] += quanta[s]
            while queues[s] and queues[s][0][1] <= deficit[s]:
                packet = queues[s].popleft()
                deficit[s] -= packet[1]
                sent.append(packet)
    return sent


@pytest.mark.parametrize("weights", [None, {"a": 3.0, "b": 1.0, None: 0.5}])
def test_order_is_that_of_deficit_round_robin(spark, path, weights):
    """One source with most of the rows, one with one long text, one without a name."""
    text = "lorem ipsum dolor sit amet "
    rows = [(i, text * (i % 50 + 1), "a") for i in range(300)]
    rows += [(1000, text * 9000, "b")] + [(2000 + i, text * 30, None) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    picked = docs.select(F.col("doc_id").alias("id"), "text", "source")
    packets = mixture_packing._packets(picked, path)
    order = packets.orderBy("source", "row", "packet").collect()
    pieces = mixture_packing.pack(docs, path, weights=weights).collect()
    # Another run deals the rows out alike, so documents have the same places in their queues.
    queues, tokens = defaultdict(list), Counter()
    for p in order:
        queues[p.source].append(((p.id, p.start), p.length))
        tokens[p.source] += p.length
    share = weights or tokens
    whole = sum(share.values())
    quanta = {s: max(int(share[s] * mixture_packing.ROUND / whole), 1) for s in queues}
    want = [(d, s) for (d, s), _ in round_robin(queues, quanta)]
    got = [(p.doc_id, p.start) for p in laid_out(pieces) if p.start % SEQUENCE == 0]
    assert got == want


def test_windows_hold_the_sources_shares(spark, path):
    """Over every stretch of rounds each source has its share, less than a packet aside."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    pieces = laid_out(mixture_packing.pack(docs, path).drop("ids").collect())
    total = Counter()
    for p in pieces:
        total[source[p.doc_id]] += p.length
    whole, sent, seen = sum(total.values()), Counter(), 0
    for p in pieces:
        sent[source[p.doc_id]] += p.length
        seen += p.length
        for s in sent:
            # In the middle of a round one source may have had all of its quantum, others none.
            slack = 2 * SEQUENCE + mixture_packing.ROUND * total[s] / whole
            assert abs(sent[s] - seen * total[s] / whole) <= slack


def test_odd_rows(spark, path, odd, empty):
    odd = odd.withColumn("source", F.when(F.col("doc_id") > 4, "x"))
    pieces = mixture_packing.pack(odd, path).collect()
    laid_out(pieces)
    found, want = Counter(), Counter()
    for p in pieces:
        found[p.doc_id] += p.length
    for i, t in ODD_ROWS:
        want[i] += len(ids_of(path, t))
    assert found == want
    nothing = mixture_packing.pack(empty.withColumn("source", F.lit("x")), path)
    assert nothing.count() == 0
    assert nothing.columns == [
        "doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids",
    ]
