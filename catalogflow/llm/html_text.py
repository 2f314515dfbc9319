"""Main text of HTML pages by a linear-chain conditional random field over leaf blocks.

Each leaf block of the page is a position of the chain, labelled article or not. Its features
are the tags and names of its ancestors and simple properties of its text. The field is trained
by gradient ascent on the likelihood of labelled pages, and pages are decoded by Viterbi.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogflow.llm.blocks import map_texts
from catalogflow.llm.html_blocks import Block, blocks
from catalogflow.llm.labelled_pages import labelled_pages

#: Labelled pages that the field is trained on, and the rounds of training.
TRAINING_PAGES = 400
ROUNDS = 250
BLOCK_BYTES = 4 << 20


def path_features(path: tuple[str, ...]) -> list[str]:
    """Features of the ancestors: every tag and every word of their names, and the last tag."""
    found = set()
    for ancestor in path:
        tag, *names = ancestor.split(" ")
        found.add(f"in {tag}")
        found.update(f"name {n}" for n in names)
        found.update(f"{tag} {n}" for n in names)
    blocks_only = [a.split(" ")[0] for a in path if a.split(" ")[0] not in ("b", "i", "a", "span", "em", "strong")]
    if blocks_only:
        found.add(f"leaf {blocks_only[-1]}")
        found.add("leaf " + " ".join(blocks_only[-2:]))
    return sorted(found)


def text_features(block: Block) -> list[str]:
    n = len(block.text)
    words = block.text.count(" ") + 1
    links = block.link_chars / n
    return [
        f"words {min(6, words.bit_length())}",
        "links " + ("all" if links > 0.9 else "many" if links > 0.4 else "some" if links else "none"),
        "sentence" if block.text[-1] in ".?!" else "no sentence",
        f"commas {min(2, block.text.count(','))}",
    ]


class Field:
    """Weights of a chain with two labels."""

    def __init__(self, pages: list[tuple[str, list[int]]], rounds: int = ROUNDS, penalty: float = 1e-3):
        chains = [(blocks(html), labels) for html, labels in pages]
        chains = [(b, y) for b, y in chains if b]
        names = sorted(
            {f for b, _ in chains for x in b for f in (*path_features(x.path), *text_features(x))}
        )
        self.number = {name: i for i, name in enumerate(names)}
        length, n = max((len(b) for b, _ in chains), default=0), len(chains)
        x = np.zeros((n, length, len(names) + 1), np.float32)
        y, on = np.zeros((n, length), np.int64), np.zeros((n, length), bool)
        for i, (b, labels) in enumerate(chains):
            for j, block in enumerate(b):
                for f in (*path_features(block.path), *text_features(block)):
                    x[i, j, self.number[f]] = 1
                x[i, j, -1] = 1
                y[i, j], on[i, j] = labels[j], True
        self.weights = np.zeros(len(names) + 1)
        self.change = np.zeros((2, 2))
        self.first = np.zeros(2)
        self._train(x, y, on, rounds, penalty)
        self.paths: dict[tuple[str, ...], float] = {}

    def _train(self, x, y, on, rounds, penalty) -> None:
        """Adam on the penalised likelihood; one weight per feature for the label article."""
        n, length, width = x.shape
        flat = x.reshape(-1, width)
        gold = (y == 1) & on
        pairs = on[:, 1:]
        wanted = np.zeros((2, 2))
        np.add.at(wanted, (y[:, :-1][pairs], y[:, 1:][pairs]), 1)
        begun = np.bincount(y[:, 0], minlength=2)
        sizes = (width, 4, 2)
        theta = np.zeros(sum(sizes))
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, rounds + 1):
            w, change, first = theta[:width], theta[width : width + 4].reshape(2, 2), theta[-2:]
            score = np.zeros((n, length, 2))
            score[:, :, 1] = (flat @ w.astype(np.float32)).reshape(n, length)
            ahead = np.zeros((n, length, 2))
            ahead[:, 0] = score[:, 0] + first
            for t in range(1, length):
                moved = np.logaddexp.reduce(ahead[:, t - 1, :, None] + change, axis=1) + score[:, t]
                ahead[:, t] = np.where(on[:, t, None], moved, ahead[:, t - 1])
            back = np.zeros((n, length, 2))
            for t in range(length - 2, -1, -1):
                moved = np.logaddexp.reduce(
                    change + (score[:, t + 1] + back[:, t + 1])[:, None, :], axis=2
                )
                back[:, t] = np.where(on[:, t + 1, None], moved, 0)
            whole = np.logaddexp.reduce(ahead[:, -1], axis=1)
            single = np.exp(ahead + back - whole[:, None, None]) * on[:, :, None]
            double = np.exp(
                ahead[:, :-1, :, None]
                + change
                + (score[:, 1:] + back[:, 1:])[:, :, None, :]
                - whole[:, None, None, None]
            ) * pairs[:, :, None, None]
            gradient = np.concatenate(
                [
                    (gold - single[:, :, 1]).reshape(-1).astype(np.float32) @ flat,
                    (wanted - double.sum(axis=(0, 1))).ravel(),
                    begun - single[:, 0].sum(axis=0),
                ]
            ) / n - penalty * theta
            m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
            theta = theta + 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        self.weights = np.round(theta[:width], 6)
        self.change, self.first = np.round(theta[width : width + 4].reshape(2, 2), 6), np.round(theta[-2:], 6)

    def _sum(self, features: list[str]) -> float:
        return float(sum(self.weights[self.number[f]] for f in features if f in self.number))

    def scores(self, page: list[Block]) -> list[float]:
        out = []
        for block in page:
            of_path = self.paths.get(block.path)
            if of_path is None:
                if len(self.paths) > 100_000:
                    self.paths.clear()
                of_path = self.paths[block.path] = self._sum(path_features(block.path))
            out.append(of_path + self._sum(text_features(block)) + float(self.weights[-1]))
        return out

    def label(self, page: list[Block]) -> list[int]:
        """The likeliest labels, by Viterbi; ties go to "not the article"."""
        if not page:
            return []
        (c00, c01), (c10, c11) = self.change.tolist()
        a, b = self.first.tolist()
        best, came = None, []
        for score in self.scores(page):
            if best is None:
                best = (a, b + score)
            else:
                x, y = best
                came.append((0 if x + c00 >= y + c10 else 1, 0 if x + c01 >= y + c11 else 1))
                best = (max(x + c00, y + c10), max(x + c01, y + c11) + score)
        labels = [0 if best[0] >= best[1] else 1]
        for step in reversed(came):
            labels.append(step[labels[-1]])
        return labels[::-1]

    def text(self, html: str) -> str:
        page = blocks(html)
        return " ".join(b.text for b, label in zip(page, self.label(page)) if label)


@lru_cache(1)
def trained() -> Field:
    """The field trained on the labelled pages; equal in every process."""
    return Field(labelled_pages(TRAINING_PAGES))


def main_text(
    pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ()
) -> DataFrame:
    """id, text and n_chars (code points) of each page, and the columns named in ``keep``.

    White space inside a block becomes one space; the article's blocks are joined by one space
    in page order. A null or empty page has an empty text. Repeated rows stay repeated.
    """
    sent = pages.sparkSession.sparkContext.broadcast(trained())

    def block():
        return lambda texts: {"text": [sent.value.text(t) for t in texts]}

    found = map_texts(pages, id_col, html_col, "text string", block, BLOCK_BYTES, keep)
    return found.select(
        id_col, *[F.col(f"`{c}`") for c in keep], "text", F.length("text").cast("bigint").alias("n_chars")
    )
