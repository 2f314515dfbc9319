"""Language identification in two steps: the family first, then the language within it.

Each step is a set of one-versus-one linear support vector machines over the shares of hashed
byte n-grams of the whole text. Since a machine is linear in the shares, its value for a text is
the mean of one weight per n-gram, so prediction is a table lookup and no vector is built.
Machines are trained here, on a bounded sample of labelled texts.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogflow.llm.blocks import map_arrow, map_texts

#: Cells that n-grams are hashed to, and the lengths of n-grams in bytes.
CELLS = 4096
ORDERS = (1, 2, 3, 4)
#: The most texts that are learned from: of one language, and of all together.
SAMPLE_PER_LANGUAGE = 300
SAMPLE = 8000
BLOCK_BYTES = 8 << 20
UNKNOWN = "und"

#: Language codes by family. Another code is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ast ca es fr gl it la oc pt rm ro sc",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd gv kw",
    "uralic": "et fi hu se",
    "indo-aryan": "bn gu hi mr ne or pa sa si ur",
    "iranian": "fa ku ps tg",
    "turkic": "az kk ky tk tr tt ug uz",
    "semitic": "am ar he mt ti",
    "dravidian": "kn ml ta te",
    "sinitic": "yue zh",
    "austronesian": "id jv mg ms su tl",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

#: ASCII bytes that are no letters count as spaces.
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def family_of(language: str) -> str:
    return _FAMILY.get(language.lower().split("-")[0].split("_")[0], f"only {language}")


def cells(text: str) -> np.ndarray:
    """The cell of every n-gram of a text."""
    data = np.frombuffer((" " + text.lower() + " ").encode("utf-8").translate(_LETTERS), np.uint8)
    code, out = np.zeros(len(data), np.uint32), []
    for n in range(1, max(ORDERS) + 1):
        if len(data) < n:
            break
        code = (code[: len(data) - n + 1] << np.uint32(8)) | data[n - 1 :]
        if n in ORDERS:
            # Multiplicative hashing: the top bits of the product.
            mixed = (code ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA77)
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0xC2B2AE3D)
            out.append(mixed >> np.uint32(20))
    return np.concatenate(out)


def shares(text: str) -> np.ndarray:
    found = np.bincount(cells(text), minlength=CELLS)
    return (found / found.sum()).astype(np.float32)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def train_machine(x: np.ndarray, y: np.ndarray, c: float = 1.0, epochs: int = 60) -> np.ndarray:
    """A linear support vector machine (hinge loss), by dual coordinate descent.

    ``x`` has a last column of ones for the offset; ``y`` is 1 or -1. Rows are visited in a
    fixed pseudo-random order, so equal input gives an equal machine.
    """
    order = np.random.default_rng(0)
    norms, alpha, w = (x * x).sum(axis=1), np.zeros(len(x)), np.zeros(x.shape[1])
    for _ in range(epochs):
        worst = 0.0
        for i in order.permutation(len(x)):
            gradient = y[i] * (x[i] @ w) - 1
            value = min(max(alpha[i] - gradient / norms[i], 0.0), c)
            if value != alpha[i]:
                worst = max(worst, abs(value - alpha[i]))
                w += (value - alpha[i]) * y[i] * x[i]
                alpha[i] = value
        if worst < 1e-3:
            break
    return w


class Hierarchy:
    """The machines between families and, in each family, between its languages."""

    def __init__(self, labels: list[str], vectors: np.ndarray):
        """``vectors``: the shares of each labelled text."""
        self.families: dict[str, list[str]] = {}
        for language in sorted(set(labels)):
            self.families.setdefault(family_of(language), []).append(language)
        self.machines: list[tuple[str, str]] = []
        weights, offsets = [], []
        # Frequent n-grams vary more; this puts all cells on a like scale.
        self.scale = 1 / np.sqrt(vectors.mean(axis=0) + 1e-4) if len(vectors) else np.ones(CELLS)
        scaled = np.c_[vectors * self.scale, np.ones(len(vectors))]
        scaled[:, :-1] *= 10
        of = np.array(labels)
        of_family = np.array([family_of(x) for x in labels])
        groups = [(sorted(self.families), of_family)]
        groups += [(languages, of) for languages in self.families.values()]
        for names, mark in groups:
            for a, b in combinations(names, 2):
                rows = (mark == a) | (mark == b)
                w = train_machine(scaled[rows], np.where(mark[rows] == a, 1.0, -1.0))
                self.machines.append((a, b))
                weights.append(w[:-1] * self.scale * 10)
                offsets.append(w[-1])
        self.weights = np.array(weights, np.float32).reshape(-1, CELLS)
        self.offsets = np.array(offsets)

    def predict(self, text: str) -> tuple[str, float]:
        """The language and a confidence from 0 to 1."""
        if not self.families or not has_letter(text):
            return UNKNOWN, 0.0
        at = cells(text)
        margins = {
            pair: float(w[at].mean(dtype=np.float64)) + b
            for pair, w, b in zip(self.machines, self.weights, self.offsets)
        }
        family, sure = self._winner(sorted(self.families), margins)
        language, within = self._winner(self.families[family], margins)
        return language, sure * within

    @staticmethod
    def _winner(names: list[str], margins: dict) -> tuple[str, float]:
        """The name that wins most machines (ties: the greater sum of margins, then the name)."""
        if len(names) == 1:
            return names[0], 1.0
        wins, total, sure = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0), {n: [] for n in names}
        for a, b in combinations(names, 2):
            margin = margins[a, b]
            wins[a if margin > 0 else b] += 1
            chance = 1 / (1 + np.exp(-2 * np.clip(margin, -30, 30)))
            for name, value, p in ((a, margin, chance), (b, -margin, 1 - chance)):
                total[name] += value
                sure[name].append(p)
        best = min(names, key=lambda n: (-wins[n], -total[n], n))
        return best, float(np.mean(sure[best]))


def held_out(id_col: Column) -> Column:
    """Documents that are never learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> Hierarchy:
    """Machines from a sample of ``docs``: the rows of least id hash of each language.

    At most ``SAMPLE_PER_LANGUAGE`` texts of a language and about ``SAMPLE`` in all are used;
    their n-gram shares are made in the tasks, and only those go to the driver.
    """
    known = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{text_col}`").alias("text"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
    ).where("lang is not null and text is not null and id is not null")
    known = known.where(~held_out(F.col("id"))).withColumn("place", F.xxhash64("id"))
    counts = known.groupBy("lang").count()
    n_languages = max(1, counts.count())
    most = max(2, min(SAMPLE_PER_LANGUAGE, SAMPLE // n_languages))
    # A first cut by hash leaves about twice the rows wanted, a rank the rest.
    share = F.lit(2.0 * most) / F.col("count")
    cut = known.join(F.broadcast(counts) if n_languages <= SAMPLE else counts, "lang").where(
        (F.col("count") <= 2 * most) | (F.pmod("place", F.lit(1 << 30)) < share * (1 << 30))
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "id", "text"))
    sample = cut.withColumn("rank", rank).where(F.col("rank") <= most).select("lang", "text")

    def run(batches):
        for batch in batches:
            rows = [
                (lang, shares(text).astype("<f2").tobytes())
                for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                if has_letter(text)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())],
                names=["lang", "shares"],
            )

    rows = sorted(tuple(r) for r in map_arrow(sample, run, "lang string, shares binary").collect())
    vectors = np.array([np.frombuffer(v, "<f2") for _, v in rows], np.float32).reshape(-1, CELLS)
    return Hierarchy([r[0] for r in rows], vectors)


def predict(
    docs: DataFrame,
    model: Hierarchy,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id, lang_pred and score of each whole text.

    A null text, or one without a letter, is ``und`` with score 0, and so is every text if
    nothing was learned. Only the text is looked at. Repeated rows stay repeated.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def block():
        def run(texts):
            found = [sent.value.predict(t) for t in texts]
            return {"lang_pred": [x for x, _ in found], "score": [s for _, s in found]}

        return run

    return map_texts(docs, id_col, text_col, "lang_pred string, score double", block, BLOCK_BYTES)


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """Learns from the labelled rows that are not held out, then predicts every row.

    id, held_out, lang_pred, score. A null id is neither held out nor learned from.
    """
    found = predict(docs, learn(docs, id_col, text_col, lang_col), id_col, text_col)
    return found.select(
        id_col, held_out(F.col(f"`{id_col}`")).alias("held_out"), "lang_pred", "score"
    )
