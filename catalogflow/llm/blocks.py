"""Helpers for operators that run over Arrow batches inside Spark tasks."""

from __future__ import annotations

import hashlib
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns that an operator reads, under fixed names; all others stay behind."""
    return docs.select(_column(docs, id_col).alias("id"), _column(docs, text_col).alias("text"))


_shipped: set[str] = set()


def map_arrow(frame: DataFrame, run, schema: str) -> DataFrame:
    """``mapInArrow``, with this package sent to the executors once in each application."""
    context = frame.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="catalogflow-code-")) / "catalogflow.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)
    return frame.mapInArrow(run, schema)


def _column(frame: DataFrame, name: str) -> Column:
    return frame[f"`{name.replace('`', '``')}`"]


def map_texts(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    schema: str,
    block: Callable[[], Callable[[list[str]], dict[str, list]]],
    block_bytes: int,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One output row per document: its id and what ``block()`` finds for blocks of texts.

    The columns named in ``keep`` follow as they are.

    ``block`` is called once per task and returns the function that takes a list of texts (null
    is passed as an empty text) and returns a list per column of ``schema``. A block ends at
    ``block_bytes``; a longer text is a block of its own, so memory follows the longest text
    and not the batch.
    """
    frame = docs.select(
        _column(docs, id_col).alias("id"),
        _column(docs, text_col).alias("text"),
        *[_column(docs, c).alias(f"keep_{i}") for i, c in enumerate(keep)],
    )
    kept = [f"keep_{i}" for i in range(len(keep))]
    result = T._parse_datatype_string(schema)
    names = result.names
    types = T.StructType([frame.schema["id"], *result, *(frame.schema[k] for k in kept)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in batches:
            work = work or block()
            ids = batch.column(0)
            for start, texts in blocks_of(batch.column(1), block_bytes):
                found = work(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(start, len(texts)),
                        *(pa.array(found[n]) for n in names),
                        *(batch.column(2 + i).slice(start, len(texts)) for i in range(len(keep))),
                    ],
                    names=["id", *names, *kept],
                )

    out = map_arrow(frame, run, types)
    for name, column in zip(["id", *kept], [id_col, *keep]):
        out = out.withColumnRenamed(name, column)
    return out


def blocks_of(column: pa.Array, block_bytes: int) -> Iterator[tuple[int, list[str]]]:
    """Runs of rows of at most ``block_bytes`` of text, with the number of their first row."""
    sizes = np.nan_to_num(
        pc.binary_length(column).to_numpy(zero_copy_only=False).astype("float64")
    )
    start, held = 0, 0.0
    for i, size in enumerate(sizes):
        if i > start and held + size > block_bytes:
            yield start, [t or "" for t in column.slice(start, i - start).to_pylist()]
            start, held = i, 0.0
        held += size
    if start < len(column):
        yield start, [t or "" for t in column.slice(start).to_pylist()]


def words_of(text: str) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text: ``bytes.split`` cuts at just these bytes."""
    return text.encode("utf-8").split()


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers ``starts[i] .. starts[i] + lengths[i] - 1`` of all i, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def mixed(keys: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): spreads every input bit over the whole result."""
    z = keys.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        z ^= z >> np.uint64(30)
        z *= np.uint64(0xBF58476D1CE4E5B9)
        z ^= z >> np.uint64(27)
        z *= np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return z
