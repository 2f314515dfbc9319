"""Byte-level BPE by an index of pair occurrences.

The pieces of a block of texts (``pre-tokens``, each distinct one once) lie in one array of
symbols. An index maps each mergeable pair to all its positions in that array. Ranks with
positions are taken in ascending order from a heap; one step merges every position of the
rank, takes the two symbols out of their neighbours' pairs, and adds the new pairs to the
lists of their ranks. So the number of steps follows the number of active ranks, not the
length of the text.
"""

from __future__ import annotations

import heapq
import json

import numpy as np
import regex
from pyspark.sql import DataFrame

from catalogflow.llm.blocks import map_texts, ragged, sha256

#: Fixed value: the pattern that cuts text into pieces before any merge.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

BLOCK_BYTES = 8 << 20


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file, and its byte.

    Printable bytes of Latin-1 stand for themselves; the others take the code points from 256.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Numbers(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


class PairIndexEncoder:
    """Encodes and decodes with a byte-level BPE file of the ``tokenizers`` format."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
        of_character = byte_characters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = (
            regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))))
            if self.special
            else None
        )
        self.pieces = regex.compile(PIECES)
        self.bytes_of = [b""] * (max([*vocabulary.values(), *self.special.values()]) + 1)
        for token, i in vocabulary.items():
            self.bytes_of[i] = bytes(of_character[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode("utf-8")
        self.of_byte = np.array(
            [vocabulary[c] for c, _ in sorted(of_character.items(), key=lambda x: x[1])], np.int64
        )
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        self.left = np.array([vocabulary[a] for a, _ in pairs], np.int64)
        self.right = np.array([vocabulary[b] for _, b in pairs], np.int64)
        self.made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        self.width = len(self.bytes_of)
        keys = self.left * self.width + self.right
        self.by_key = np.argsort(keys, kind="stable")
        self.keys = keys[self.by_key]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 if it never merges."""
        keys = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.by_key[at], -1)

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of the pieces one after another, and each piece's start and number of ids."""
        lengths = np.array([len(p) for p in pieces], np.int64)
        symbols = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        n = len(symbols)
        if not n:
            return symbols, np.zeros(len(pieces), np.int64), lengths
        ends = np.cumsum(lengths)
        following = np.arange(1, n + 1)
        following[ends[lengths > 0] - 1] = -1
        before = np.arange(-1, n - 1)
        before[(ends - lengths)[lengths > 0]] = -1

        lists: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(at: np.ndarray) -> None:
            """Put the pairs that start at these positions on the lists of their ranks."""
            rank = self.ranks(symbols[at], symbols[following[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(np.diff(rank)) + 1
            for r, part in zip(rank[np.r_[0, cuts]].tolist(), np.split(at, cuts)):
                if r not in lists:
                    lists[r] = []
                    heapq.heappush(active, r)
                lists[r].append(part)

        add(np.flatnonzero(following >= 0))
        while active:
            r = heapq.heappop(active)
            found = lists.pop(r)
            at = np.sort(np.concatenate(found))
            at = at[(symbols[at] == self.left[r]) & np.r_[True, at[1:] != at[:-1]]]
            after = following[at]
            there = (after >= 0) & (symbols[after] == self.right[r])
            at, after = at[there], after[there]
            if len(at) > 1 and self.left[r] == self.right[r]:
                # Of overlapping pairs in a run the first, third, ... merge.
                chained = np.r_[False, after[:-1] == at[1:]]
                place = np.arange(len(at))
                place -= np.maximum.accumulate(np.where(chained, 0, place))
                at, after = at[place % 2 == 0], after[place % 2 == 0]
            if not len(at):
                continue
            symbols[at] = self.made[r]
            symbols[after] = -1
            beyond = following[after]
            following[at] = beyond
            before[beyond[beyond >= 0]] = at[beyond >= 0]
            ahead = before[at]
            changed = np.concatenate([at[beyond >= 0], ahead[ahead >= 0]])
            if len(changed):
                add(changed)
        kept = np.cumsum(np.r_[0, symbols >= 0])
        starts, counts = kept[ends - lengths], kept[ends] - kept[ends - lengths]
        return symbols[symbols >= 0], starts, counts

    def encode_texts(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, by one pair index over the distinct pieces of all of them."""
        number = Numbers()
        numbered: list[list[tuple[np.ndarray, int]]] = []
        for text in texts:
            parts, start = [], 0
            for hit in self.special_at.finditer(text) if self.special_at else ():
                parts.append((text[start : hit.start()], self.special[hit.group()]))
                start = hit.end()
            parts.append((text[start:], -1))
            numbered.append(
                [
                    (
                        np.fromiter(
                            map(number.__getitem__, self.pieces.findall(part)), np.int64
                        ),
                        special,
                    )
                    for part, special in parts
                ]
            )
        flat, starts, counts = self.encode_pieces([p.encode("utf-8") for p in number])
        out = []
        for parts in numbered:
            ids = []
            for pieces, special in parts:
                ids.append(flat[ragged(starts[pieces], counts[pieces])])
                if special >= 0:
                    ids.append(np.array([special]))
            out.append(np.concatenate(ids).astype("<u4"))
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


_loaded: dict[str, PairIndexEncoder] = {}


def encoder(path: str) -> PairIndexEncoder:
    """The encoder of a file, loaded once in each Python worker."""
    if path not in _loaded:
        _loaded[path] = PairIndexEncoder(path)
    return _loaded[path]


def encode(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The ids of each text and the text decoded from them: id, ids array<int>, decoded string.

    A null or empty text has no ids and decodes to an empty text. Repeated rows stay repeated.
    Strings of special tokens inside a text become their ids, as the file says. Any other
    column of ``docs`` is ignored.
    """

    def block():
        codec = encoder(path)

        def run(texts):
            ids = codec.encode_texts(texts)
            return {
                "ids": [i.astype("int32") for i in ids],
                "decoded": [codec.decode(i) for i in ids],
            }

        return run

    return map_texts(docs, id_col, text_col, "ids array<int>, decoded string", block, BLOCK_BYTES)


def digests(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, n_tokens, ids_sha256 and decoded_sha256 of ``encode``, made in the same task.

    The ids are hashed as little-endian unsigned 32-bit integers, the decoded text as UTF-8.
    Nulls, empty texts and repeated rows as in ``encode``.
    """

    def block():
        codec = encoder(path)

        def run(texts):
            ids = codec.encode_texts(texts)
            return {
                "n_tokens": [len(i) for i in ids],
                "ids_sha256": [sha256(i.tobytes()) for i in ids],
                "decoded_sha256": [sha256(codec.decode(i).encode("utf-8")) for i in ids],
            }

        return run

    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_texts(docs, id_col, text_col, schema, block, BLOCK_BYTES)
