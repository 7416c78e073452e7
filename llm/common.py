"""Shared pieces: the folder for written tables, and vectorised words and hashes for Arrow batches.

Words are ``[^\\x20\\x09-\\x0D]+``, which is what ``bytes.split()`` gives. All hashes are 64-bit
polynomials modulo 2**64 over random byte values, mixed at the end. They are the same in every
process, so that they can be shuffle keys.
"""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that are hashed at once; bounds the memory of a Python worker.
CHUNK_BYTES = 1 << 20
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    Where it is unset, a temporary folder serves local sessions only; on a cluster that is an error,
    because executors would not see each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back, which cuts its lineage."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(doc_id: str = "doc_id", text: str = "text"):
    """Tells apart rows that share an id."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * np.uint64(0x9E3779B97F4A7C15))


BYTE_VALUE = stream(1, 256)
SEPARATOR = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, at least n of each; kept by the worker."""
    if seed not in _POWERS or len(_POWERS[seed][0]) < n:
        base = int(stream(seed, 1)[0]) | 1
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            row = np.full(max(n, CHUNK_BYTES + 4096), b, np.uint64)
            row[0] = 1
            both.append(np.multiply.accumulate(row))
        _POWERS[seed] = tuple(both)
    return _POWERS[seed]


def prefix(values: np.ndarray, seed: int) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(seed, len(values) + 1)[0][: len(values)], out=out[1:])
    return out


def spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """Hashes of the spans start:end, wherever they stand."""
    return mix((sums[end] - sums[start]) * powers(seed, len(sums))[1][start] + (end - start).astype(np.uint64))


class Words:
    """The words of some rows: hash of each word, and where each row's words begin.

    ``first`` has one entry more than there are rows; row i has the words first[i]:first[i + 1].
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data, offsets = (LOWER[data] if lower else data), np.asarray(offsets, np.int64)
        word = ~SEPARATOR[data]
        before, after = np.empty_like(word), np.empty_like(word)
        if len(word):
            before[0], before[1:] = False, word[:-1]
            after[-1], after[:-1] = False, word[1:]
            inside = offsets[(offsets > 0) & (offsets < len(word))]
            before[inside] = False
            after[inside - 1] = False
        self.start = np.flatnonzero(word & ~before)
        self.end = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.hash = spans(prefix(BYTE_VALUE[self.data], 2), self.start, self.end, 2)
        self._sums: dict[int, np.ndarray] = {}

    def span_hash(self, start: np.ndarray, end: np.ndarray, seed: int = 3) -> np.ndarray:
        """Hashes of the word sequences start:end."""
        if seed not in self._sums:
            self._sums[seed] = prefix(self.hash, seed)
        return spans(self._sums[seed], start, end, seed)

    def window_starts(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows of ``size`` words of one row, and each window's row."""
        n = np.maximum(self.count - size + 1, 0)
        row = np.repeat(np.arange(len(n)), n)
        return np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + self.first[:-1][row], row


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES):
    """(first row, end row, bytes, offsets) of runs of rows with about ``limit`` bytes; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values))


def list_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a column of lists without nulls."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], offsets - offsets[0]
