"""Quality rules by tokeniser fertility.

A public vocabulary reads ordinary text of a language at a steady rate. Each document is
measured by characters per token, the share of tokens that fall back to single bytes, and the
entropy of its tokens; a document outside the band of its language (of its script where the
language is unknown) is rejected. Bands come from the quartiles of all documents of the group
that pass the base rules: from ``REACH`` interquartile ranges below the lower to as many above
the upper one. Quartiles are read from counts over a fixed grid, so they are exact to one cell
and do not depend on how rows lie in partitions.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalogflow.llm.blocks import map_texts, ragged, words_of
from catalogflow.llm.pair_bpe import Numbers
from catalogflow.session import materialize

BLOCK_BYTES = 6 << 20
#: Tokens over which one entropy is taken; a document's is the mean over its runs.
ENTROPY_RUN = 128
#: Interquartile ranges from the quartile to the end of the band.
REACH = 4.0
#: Bands are broadcast if they are no more than this.
FEW_BANDS = 10_000
#: Cells of the grid in one unit of a measure.
GRID = 1000
#: The least interquartile range taken for each measure.
LEAST_RANGE = {"chars_per_token": 0.1, "fallback_share": 0.01, "token_entropy": 0.01}

#: What counts as a symbol, and what separates words.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\x0b\x0c"

#: First code points of runs that mostly hold one script.
SCRIPTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"),
    (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0780, "Other"), (0x0900, "Devanagari"),
    (0x0980, "Other"), (0x0E00, "Thai"), (0x0E80, "Other"), (0x1E00, "Latin"),
    (0x1F00, "Greek"), (0x2000, "Other"), (0x3040, "Kana"), (0x3100, "Han"),
    (0xA000, "Other"), (0xAC00, "Hangul"), (0xD7B0, "Other"),
)


def script_of(text: str) -> str:
    """The script of most letters; Other if there are none."""
    letters = "".join(filter(str.isalpha, set(text)))
    if not letters:
        return "Other"
    if all(c < "ɐ" for c in letters):
        return "Latin"
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    counts: dict[str, int] = {}
    values, number = np.unique(points, return_counts=True)
    runs = np.searchsorted([p for p, _ in SCRIPTS], values, side="right") - 1
    for value, n, r in zip(values.tolist(), number.tolist(), runs.tolist()):
        if chr(value).isalpha():
            name = SCRIPTS[r][1]
            counts[name] = counts.get(name, 0) + n
    return min(counts, key=lambda name: (-counts[name], name))


def repeat_words(words: np.ndarray) -> int:
    """Words inside 3-word windows that are found twice or more; words are given as numbers."""
    if len(words) < 4:
        return 0
    words = words.astype(np.int64)
    width = int(words.max()) + 1
    if width > 2_000_000:
        _, words = np.unique(words, return_inverse=True)
        width = int(words.max()) + 1
    pairs = words[:-1] * width + words[1:]
    if width > 2_000_000:
        _, pairs = np.unique(pairs, return_inverse=True)
    windows = pairs[:-1] * width + words[2:]
    _, at, count = np.unique(windows, return_inverse=True, return_counts=True)
    twice = count[at] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(twice)] |= twice
    return int(covered.sum())


class Meter:
    """Measures blocks of texts with a SentencePiece model that has byte pieces."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array(
            [self.model.is_byte(i) for i in range(self.model.get_piece_size())], bool
        )

    def __call__(self, texts: list[str]) -> dict[str, list]:
        number = Numbers()
        own = [np.fromiter(map(number.__getitem__, words_of(t)), np.int64) for t in texts]
        encoded = self.model.encode([w.decode("utf-8") for w in number], num_threads=1)
        counts = np.fromiter(map(len, encoded), np.int64, len(encoded))
        flat = np.fromiter(chain.from_iterable(encoded), np.int64, int(counts.sum()))
        starts = np.cumsum(counts) - counts
        n_words = np.array([len(w) for w in own], np.int64)
        repeated = np.array([repeat_words(w) for w in own], np.int64)
        spaces = [sum(map(t.count, SPACES)) for t in texts]
        word_chars = np.array([len(t) - n for t, n in zip(texts, spaces)], np.int64)
        n_tokens, fallback, entropy = [], [], []
        for words in own:
            ids = flat[ragged(starts[words], counts[words])]
            n_tokens.append(len(ids))
            fallback.append(int(self.is_byte[ids].sum()) / max(1, len(ids)))
            entropy.append(mean_entropy(ids, len(self.is_byte)))
        return {
            "n_words": n_words,
            "word_chars": word_chars,
            "n_symbols": [sum(map(t.count, SYMBOLS)) for t in texts],
            "n_dup_lines": [duplicate_lines(t) for t in texts],
            "n_repeat_words": repeated,
            "base_failed": (n_words < 50) | (100 * repeated > 50 * n_words),
            "chars_per_token": word_chars / np.maximum(1, n_tokens),
            "fallback_share": fallback,
            "token_entropy": entropy,
            "script": [script_of(t) for t in texts],
        }


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def mean_entropy(ids: np.ndarray, width: int) -> float:
    """Entropy of the tokens over that of as many different ones, as the mean over runs.

    Runs have equal length, so long and short texts compare; the last one ends with the text
    and may overlap the one before. A shorter text is one run.
    """
    n = len(ids)
    if n < 2:
        return 0.0
    size = min(n, ENTROPY_RUN)
    starts = np.arange(0, n - size + 1, size)
    if starts[-1] + size < n:
        starts = np.append(starts, n - size)
    run = np.repeat(np.arange(len(starts)), size)
    keys = np.sort(run * width + ids[ragged(starts, np.full(len(starts), size))])
    cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
    count = np.diff(cuts)
    return float(1 - (count * np.log2(count)).sum() / (len(starts) * size * np.log2(size)))


_meters: dict[str, Meter] = {}


def meter(path: str) -> Meter:
    if path not in _meters:
        _meters[path] = Meter(path)
    return _meters[path]


SCHEMA = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, chars_per_token double, "
    "fallback_share double, token_entropy double, script string"
)


def measure(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple = ()
) -> DataFrame:
    """The base counts and the three measures of each document's whole text."""
    return map_texts(docs, id_col, text_col, SCHEMA, lambda: meter(path), BLOCK_BYTES, keep)


def bands(measured: DataFrame, reach: float = REACH) -> DataFrame:
    """For each ``kind``, language or script: low and high of every measure."""
    names = list(LEAST_RANGE)
    cells = measured.where(~F.col("base_failed")).select(
        "kind",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(n).alias("measure"), F.floor(F.col(n) * GRID).alias("cell"))
                    for n in names
                ]
            )
        ).alias("x"),
    )
    counted = cells.groupBy("kind", "x.measure", "x.cell").count()
    order = Window.partitionBy("kind", "measure").orderBy("cell")
    total = Window.partitionBy("kind", "measure")
    below = counted.withColumn("below", F.sum("count").over(order)).withColumn(
        "all", F.sum("count").over(total)
    )

    def quartile(share: float):
        return F.min(F.when(F.col("below") >= F.col("all") * share, F.col("cell"))) / GRID

    ends = below.groupBy("kind", "measure").agg(
        quartile(0.25).alias("q1"), quartile(0.75).alias("q3")
    )
    least = F.create_map(*[F.lit(x) for n in names for x in (n, LEAST_RANGE[n])])
    width = F.greatest(F.col("q3") - F.col("q1"), least[F.col("measure")]) * reach
    ends = ends.select("kind", "measure", (F.col("q1") - width).alias("low"), (F.col("q3") + width).alias("high"))
    return ends.groupBy("kind").agg(
        *[
            F.max(F.when(F.col("measure") == n, F.col(end))).alias(f"{n}_{end}")
            for n in names
            for end in ("low", "high")
        ]
    )


def keep_good(docs: DataFrame, path: str, **settings) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all columns; see there for the settings."""
    text_col, lang_col = settings.pop("text_col", "text"), settings.pop("lang_col", "lang")
    settings.pop("id_col", None)
    rows = docs.select(
        F.struct("*").alias("row"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang")
    )
    measured = materialize(_of_kind(measure(rows, path, "row", "text", ("lang",)), "lang"), "fertility")
    return _judged(measured, **settings).where("kept").select("row.*")


def judge(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    reach: float = REACH,
) -> DataFrame:
    """The counts, the measures and ``kept`` of each document.

    ``kept`` is false if the base rules fail (under 50 words, or more than half of the words in
    repeated 3-word windows) or any measure lies outside the band of the document's language;
    where that is null, of its script. A null or empty text has no words and fails. A group of
    which no document passes the base rules has no band and keeps none. Repeated rows are
    measured and counted each; other columns are ignored.
    """
    measured = measure(docs, path, id_col, text_col, (lang_col,))
    measured = materialize(_of_kind(measured, lang_col), "fertility")
    return _judged(measured, reach).select(
        id_col,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        *[F.round(n, 6).alias(n) for n in LEAST_RANGE],
    )


def _of_kind(measured: DataFrame, lang_col: str) -> DataFrame:
    """Adds the group whose band holds: the language, or else the script."""
    return measured.withColumn(
        "kind",
        F.coalesce(
            F.concat(F.lit("lang "), F.col(f"`{lang_col}`").cast("string")),
            F.concat(F.lit("script "), F.col("script")),
        ),
    )


def _judged(measured: DataFrame, reach: float = REACH) -> DataFrame:
    inside = F.lit(True)
    for n in LEAST_RANGE:
        inside &= F.col(n).between(F.col(f"{n}_low"), F.col(f"{n}_high"))
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(False))
    # One row for each language or script. Sent to the documents where they are counted to be few;
    # else Spark joins them and splits a group that most documents belong to at run time.
    found = materialize(bands(measured, reach), "bands")
    if found.count() <= FEW_BANDS:
        found = F.broadcast(found)
    return measured.join(found, "kind", "left").withColumn("kept", kept)
