"""Small helpers that the text operators share inside their tasks.

A word is a run of bytes outside `\\x20\\x09-\\x0D`, which is what `bytes.split()` returns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = b" \t\n\x0b\x0c\r"
CHUNK_CHARS = 500_000


def words(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def chunks(sizes: Iterable[int], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows of about `limit` characters; a longer row stands alone."""
    lo = total = hi = 0
    for hi, n in enumerate(sizes):
        if hi > lo and total + n > limit:
            yield lo, hi
            lo, total = hi, 0
        total += n
    if total or hi >= lo:
        yield lo, hi + 1


def text_batches(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Each Arrow batch cut into pieces of bounded text, so that a task's memory does not follow the batch size."""
    for batch in batches:
        if batch.num_rows:
            sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
            for lo, hi in chunks(sizes):
                piece = batch.slice(lo, hi - lo)
                yield piece, piece.column(column).to_pylist()


def per_text(df: DataFrame, id_col: str, text_col: str, work: Callable[[list[str | None]], dict[str, object]], schema: str) -> DataFrame:
    """Runs `work` over the texts of (id, text) rows; it returns the new columns in the order of `schema`."""

    def task(batches):
        for batch, texts in text_batches(batches):
            made = work(texts)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(x if isinstance(x, pa.Array) else pa.array(x) for x in made.values())],
                                             names=["doc_id", *made])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(task, f"doc_id long, {schema}")


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of all ranges, one range after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class WordHashes(dict):
    """64-bit hashes of words, remembered within a Python worker."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, said: list[bytes]) -> np.ndarray:
        if len(self) > self.LIMIT:
            self.clear()
        return np.fromiter(map(self.__getitem__, said), np.uint64, len(said))


_MEMORY: dict[object, object] = {}


def remembered(key: object, made: Callable[[], object]) -> object:
    """What tasks of a Python worker hand on to the next ones. A worker keeps one such thing: that of the operator before goes first."""
    if key not in _MEMORY:
        _MEMORY.clear()
        _MEMORY[key] = made()
    return _MEMORY[key]


def word_hashes() -> WordHashes:
    """One memory of words per Python worker, whichever operator its tasks belong to."""
    return remembered("hashes", WordHashes)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive words, from the words' hashes."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    acc = np.full(m, n, np.uint64)
    for j in range(n):
        acc = (acc ^ hashes[j:j + m]) * np.uint64(0x9E3779B97F4A7C15)
        acc ^= acc >> np.uint64(29)
    return acc
