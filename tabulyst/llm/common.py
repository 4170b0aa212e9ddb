"""What several operators share: tables, tokenizer files, text batches and their memos."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


#: Rows of a batch that a Python task gets.
BATCH_ROWS = 2000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@functools.cache
def _shipped(application: str) -> None:
    root = Path(__file__).resolve().parents[1]
    folder = Path(tempfile.mkdtemp(prefix="package-"))
    with zipfile.ZipFile(folder / f"{root.name}.zip", "w") as to:
        for p in sorted(root.rglob("*.py")):
            to.write(p, p.relative_to(root.parent))
    SparkSession.getActiveSession().sparkContext.addPyFile(str(folder / f"{root.name}.zip"))


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for a session: tasks import it, wherever
    the driver was started. Python tasks of the session get batches of BATCH_ROWS at most: rows are
    whole documents, and both sides of a task hold a batch several times over."""
    _shipped(spark.sparkContext.applicationId)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def tokenizer_file(name: str) -> str:
    """Where the installed public vocabulary ``name`` lies; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def file_bytes(path: str) -> bytes:
    """A vocabulary file, read on the driver: a few MB that travel with the task."""
    return Path(path).read_bytes()


#: Per Python worker: the tokenizer and memos last used, by what they were made from. Workers
#: outlive tasks, so a vocabulary is parsed once and common words are encoded once; what
#: another operator left is dropped first.
_LOADED: dict = {}


def loaded(key, make):
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = make()
    return _LOADED[key]


class Memo(dict):
    """Encodings by piece of text; emptied when it would hold over ``most`` pieces."""

    def __init__(self, most: int):
        super().__init__()
        self.most = most

    def missing(self, pieces: set) -> list:
        """The pieces that the memo lacks; all of them, if it had to be emptied to make room."""
        new = [p for p in pieces if p not in self]
        if len(self) + len(new) > self.most:
            self.clear()
            return list(pieces)
        return new


def spans_of(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of ``texts`` with about ``most`` characters (or one text)."""
    at = size = 0
    for i, t in enumerate(texts):
        if i > at and size + len(t) > most:
            yield at, i
            at, size = i, 0
        size += len(t)
    if at < len(texts):
        yield at, len(texts)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


#: Latin-1's letters, numbers and white space, as ranges of a character class.
LETTERS, DIGITS, BLANKS = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", "\\t-\\r \\x85\\xa0"


def is_latin(text: str) -> bool:
    """Whether every character is one of Latin-1's, for which plain classes suffice."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def utf8_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1 + column.offset)[column.offset :]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64 over unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def numbers(count: int, seed: int) -> np.ndarray:
    """``count`` fixed pseudo-random unsigned 64-bit values."""
    with np.errstate(over="ignore"):
        return mixed((np.arange(1, count + 1, dtype=np.uint64) + np.uint64(seed << 32)) * np.uint64(0x9E3779B97F4A7C15))
