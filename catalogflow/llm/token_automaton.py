"""Token counts by a compiled finite-state transducer.

The BPE of a vocabulary is compiled into a deterministic transducer over symbols: the bytes of
a word, the last one marked as word end. A state holds what the encoding of the rest can depend
on: the longest suffix read so far that begins some token, and for each position in it the last
token of the encoding up to there. A transition is annotated with the number of tokens that it
emits (negative where a longer token replaces several), and every word end leads back to the
start. Transitions are made when they are first needed and kept in a table of bounded size.

Counting reads the symbols of a block as chunks of equal length, all in step. The state map of
a chunk that holds a word end is constant after it, so one pass from the start state gives its
exit; the maps are composed from left to right, and where the entry turns out not to be the
start state, the part up to the first word end is read again from the true entry.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex
from tokenizers.normalizers import NFC, Lowercase
from tokenizers.pre_tokenizers import Split

from catalogflow.llm.blocks import map_texts
from catalogflow.llm.pair_bpe import byte_characters

BLOCK_BYTES = 4 << 20
CHUNK = 1024
MAX_CELLS = 1 << 25

#: Fixed value: what is split off at an apostrophe that begins a word.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

_SPACE, _OTHER, _LETTER, _DIGIT = range(4)


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of every code point, white space, letter, digit or other, by the library's tables."""
    points = _points()
    text = "".join(map(chr, points.tolist()))
    table = np.full(0x110000, _OTHER, np.uint8)
    for pattern, kind in ((r"\s+", _SPACE), (r"\p{L}+", _LETTER), (r"\p{N}+", _DIGIT)):
        runs = Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(text)
        for _, (a, b) in runs:
            table[points[a:b]] = kind
    return table


def _points() -> np.ndarray:
    """The code points of the planes that hold or may come to hold letters and marks.

    What lies beyond is private or not assigned: no letter, digit or space, and left as it is.
    """
    return np.r_[np.arange(0xD800), np.arange(0xE000, 0x40000), np.arange(0xE0000, 0xE1000)]


@lru_cache(1)
def foreign() -> np.ndarray:
    """Of every code point whether Python's and the library's tables may treat it differently.

    Those are the code points that Python's tables do not know, and those whose lower case or normal
    form is another one in the library.
    """
    points = _points()
    table = np.ones(0x110000, bool)
    table[points] = False
    for start in range(0, len(points), 4096):
        part = points[start : start + 4096]
        text = "\n".join(map(chr, part.tolist()))
        for own, theirs in (
            (lower(text), Lowercase().normalize_str(text)),
            (unicodedata.normalize("NFC", text), NFC().normalize_str(text)),
        ):
            if own != theirs:
                own, theirs = own.split("\n"), theirs.split("\n")
                if len(own) == len(theirs) == len(part):
                    table[part] |= [a != b for a, b in zip(own, theirs)]
                else:
                    table[part] = True
        table[part] |= [unicodedata.category(chr(c)) == "Cn" for c in part.tolist()]
    return table


def lower(text: str) -> str:
    """Lower case by character: no rule looks at a sigma's neighbours."""
    return text.replace("Σ", "σ").lower()


def normal(text: str) -> str:
    """NFC and lower case, by the library where its tables may say something else than Python's."""
    if not text.isascii():
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        if foreign()[points].any():
            return Lowercase().normalize_str(NFC().normalize_str(text))
    return lower(unicodedata.normalize("NFC", text))


class Transducer:
    """The deterministic transducer of a BPE file with a word-end suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        suffix = spec["model"]["end_of_word_suffix"]
        of_character = byte_characters()

        def symbols(token: str) -> str:
            """A token as a string of symbols: a byte, plus 256 if it ends the word."""
            ends = token.endswith(suffix)
            found = [of_character[c] for c in (token[: -len(suffix)] if ends else token)]
            if ends:
                found[-1] += 256
            return "".join(map(chr, found))

        vocabulary = spec["model"]["vocab"]
        self.symbols_of = {i: symbols(t) for t, i in vocabulary.items()}
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.merges = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.merges[vocabulary[a], vocabulary[b]] = (rank, vocabulary[a + b])
        self.base = {s: i for i, s in self.symbols_of.items() if len(s) == 1}
        self.tokens = {
            s: i for i, s in self.symbols_of.items() if len(s) == 1 or self._encode(s) == [i]
        }
        self.prefixes = {s[:n] for s in self.tokens for n in range(1, len(s))} | {""}
        # An entry of the table holds the next state above 8 bits for the tokens emitted.
        if max(map(len, self.tokens)) > 127:
            raise ValueError("a token has more than 127 bytes")
        self.fits: dict[tuple[int, int], bool] = {}
        self.forget()

    def _encode(self, symbols: str) -> list[int]:
        """The encoding of a short string by its definition: the lowest rank merges first."""
        ids = [self.base[s] for s in symbols]
        while True:
            found = [(self.merges[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in self.merges]
            if not found:
                return ids
            _, i = min(found)
            ids[i : i + 2] = [self.merges[ids[i], ids[i + 1]][1]]

    def _fit(self, left: int, right: int) -> bool:
        """Whether the two tokens, side by side, stay as they are."""
        key = (left, right)
        if key not in self.fits:
            if len(self.fits) > 1 << 20:
                self.fits.clear()
            self.fits[key] = self._encode(self.symbols_of[left] + self.symbols_of[right]) == [
                left,
                right,
            ]
        return self.fits[key]

    def forget(self) -> None:
        """Start with an empty table; state 0 is the start."""
        self.states = [("", ((-1, 0),))]
        self.number = {self.states[0]: 0}
        self.columns = np.full(512, -1, np.int64)
        self.table = np.full((1024, 32), -1, np.int32)

    def _step(self, state: int, symbol: int) -> tuple[int, int]:
        """The next state and the tokens emitted.

        The history lists, from the present position back, the last token up to there (-1 at
        the start of the word) and how many tokens fewer there were.
        """
        suffix, history = self.states[state]
        read = suffix + chr(symbol)
        for back in range(len(read) - 1, -1, -1):
            token = self.tokens.get(read[len(read) - 1 - back :])
            if token is None:
                continue
            last, fewer = history[back]
            if last < 0 or self._fit(last, token):
                break
        else:
            raise ValueError("no token fits")
        emitted = 1 - fewer
        if symbol >= 256:
            return 0, emitted
        start = next(i for i in range(len(read) + 1) if read[i:] in self.prefixes)
        kept = len(read) - start
        past = ((token, 0), *((t, n + emitted) for t, n in history[:kept]))
        key = (read[start:], past)
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
        return self.number[key], emitted

    def _fill(self, states: np.ndarray, symbols: np.ndarray) -> None:
        """Put missing transitions into the table."""
        for state, symbol in zip(states.tolist(), symbols.tolist()):
            following, emitted = self._step(state, symbol)
            if len(self.states) > len(self.table):
                grown = np.full((2 * len(self.table), self.table.shape[1]), -1, np.int32)
                grown[: len(self.table)] = self.table
                self.table = grown
            self.table[state, self.columns[symbol]] = following << 8 | (emitted + 128)

    def read(self, symbols: np.ndarray, lanes: np.ndarray, lengths: np.ndarray, entry: np.ndarray):
        """Read runs of symbols in step: what each symbol emits, and each run's exit state.

        ``lanes`` are the runs' first positions. Emissions are returned by run and step.
        """
        state = entry.copy()
        emitted = np.zeros((int(lengths.max(initial=0)), len(lanes)), np.int16)
        order = np.argsort(-lengths, kind="stable")
        sorted_lengths = lengths[order]
        for step in range(len(emitted)):
            on = order[: int(np.searchsorted(-sorted_lengths, -step, side="left"))]
            symbol = symbols[lanes[on] + step]
            packed = self.table[state[on], self.columns[symbol]]
            if packed.min() < 0:
                missing = np.flatnonzero(packed < 0)
                pairs = np.unique(state[on][missing] << 9 | symbol[missing])
                self._fill(pairs >> 9, pairs & 511)
                packed = self.table[state[on], self.columns[symbol]]
            state[on] = packed >> 8
            emitted[step, on] = (packed & 255) - 128
        return emitted, state

    def emissions(self, symbols: np.ndarray) -> np.ndarray:
        """Tokens emitted at each symbol of a run of whole words, chunk by chunk."""
        n = len(symbols)
        if not n:
            return np.zeros(0, np.int64)
        if self.table.size > MAX_CELLS:
            self.forget()
        new = np.unique(symbols)
        new = new[self.columns[new] < 0]
        self.columns[new] = self.columns.max() + 1 + np.arange(len(new))
        if (width := int(self.columns.max()) + 1) > self.table.shape[1]:
            grown = np.full((len(self.table), width + 8), -1, np.int32)
            grown[:, : self.table.shape[1]] = self.table
            self.table = grown
        lanes = np.arange(0, n, CHUNK)
        lengths = np.minimum(CHUNK, n - lanes)
        start = np.zeros(len(lanes), np.int64)
        emitted, exits = self.read(symbols, lanes, lengths, start)
        out = np.zeros((len(lanes), CHUNK), np.int16)
        out[:, : len(emitted)] = emitted.T
        # The part before the first word end depends on the entry; after it the map is constant.
        is_end = np.zeros(len(lanes) * CHUNK, bool)
        is_end[:n] = symbols >= 256
        is_end = is_end.reshape(len(lanes), CHUNK)
        constant = is_end.any(axis=1)
        heads = np.where(constant, is_end.argmax(axis=1) + 1, lengths)
        entries = np.r_[0, exits[:-1]]
        known = np.r_[True, constant[:-1]]
        redo = np.flatnonzero(known & (entries != 0))
        while len(redo):
            emitted, exited = self.read(symbols, lanes[redo], heads[redo], entries[redo])
            for i, lane in enumerate(redo.tolist()):
                out[lane, : heads[lane]] = emitted[: heads[lane], i]
            # A chunk without a word end hands its exit on to the next one.
            on = redo[~constant[redo] & (redo + 1 < len(lanes))]
            exits[redo[~constant[redo]]] = exited[~constant[redo]]
            entries[on + 1] = exits[on]
            redo = on + 1
            redo = redo[entries[redo] != 0]
        return out.reshape(-1)[:n].astype(np.int64)

    def stream(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The symbols of all texts, each text's end among them, and its special tokens."""
        special = np.zeros(len(texts), np.int64)
        clean = []
        for i, text in enumerate(texts):
            for content in self.special:
                if content in text:
                    special[i] += text.count(content)
                    text = text.replace(content, "\n")
            clean.append(normal(text))
        joined = "\n".join(clean) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        kind = classes()[points]
        before = np.r_[np.uint8(_SPACE), kind[:-1]]
        starts = (kind != before) | (kind == _DIGIT)
        # An apostrophe alone between words takes the letters of a contraction with it.
        quote = np.flatnonzero((points == ord("'")) & starts)
        quote = quote[quote + 1 < len(points)]
        quote = quote[kind[quote + 1] == _LETTER]
        for letters in CONTRACTIONS:
            hit = quote
            for k, c in enumerate(letters):
                hit = hit[np.minimum(hit + 1 + k, len(points) - 1) == hit + 1 + k]
                hit = hit[points[hit + 1 + k] == ord(c)]
            starts[hit + 1] = False
            after = hit + 1 + len(letters)
            starts[after[kind[after] != _SPACE]] = True
            quote = np.setdiff1d(quote, hit, assume_unique=True)
        space = kind == _SPACE
        ends = np.r_[starts[1:] | space[1:], True] & ~space
        width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        data = np.frombuffer(joined.encode("utf-8"), np.uint8).astype(np.int64)
        last = np.cumsum(width) - 1
        data[last[ends]] += 256
        symbols = data[np.repeat(~space, width)]
        kept = np.cumsum(np.where(space, 0, width))
        cut = np.cumsum([len(t) + 1 for t in clean]) - 1
        return symbols, kept[cut], special

    def counts(self, texts: list[str]) -> np.ndarray:
        """The number of tokens of each text."""
        if not texts:
            return np.zeros(0, np.int64)
        symbols, ends, special = self.stream(texts)
        total = np.cumsum(np.r_[0, self.emissions(symbols)])
        return np.diff(np.r_[0, total[ends]]) + special


_compiled: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """The transducer of a file, kept with its table in each Python worker."""
    if path not in _compiled:
        _compiled[path] = Transducer(path)
    return _compiled[path]


def token_counts(
    docs: DataFrame,
    path: str,
    limit: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of each whole text.

    A null or empty text has 0 of both. Strings of special tokens inside a text count as one
    token each. Repeated rows stay repeated; other columns of ``docs`` are ignored. Beyond
    ``MAX_CELLS`` the table starts anew, so its memory is bounded whatever the texts.
    """

    def block():
        machine = transducer(path)

        def run(texts):
            return {
                "n_bytes": [len(t.encode("utf-8")) for t in texts],
                "n_tokens": machine.counts(texts),
            }

        return run

    counted = map_texts(
        docs, id_col, text_col, "n_bytes bigint, n_tokens bigint", block, BLOCK_BYTES
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
