"""Embedding vectors held as ARRAY<FLOAT>."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.arrow_udf(T.ArrayType(T.FloatType()))
def decode_embedding(blobs: pa.Array) -> pa.Array:
    """Little-endian 4-byte floats packed in BINARY; a whole batch is one view of its bytes."""
    blobs = blobs.cast(pa.large_binary())
    _, offsets, data = blobs.buffers()
    offsets = np.frombuffer(offsets, np.int64)[blobs.offset : blobs.offset + len(blobs) + 1] if offsets else np.zeros(1, np.int64)
    if (np.diff(offsets) % 4).any():
        raise ValueError("an embedding's length in bytes is no multiple of 4")
    first, last = (int(offsets[0]), int(offsets[-1])) if len(blobs) else (0, 0)
    values = np.frombuffer(data, np.uint8)[first:last].copy().view("<f4") if data else np.zeros(0, "<f4")
    missing = pa.array(blobs.is_null().to_numpy(zero_copy_only=False))
    return pa.ListArray.from_arrays(pa.array(((offsets - first) // 4).astype(np.int32)), pa.array(values.astype(np.float32)), mask=missing)


@F.arrow_udf(T.BinaryType())
def encode_embedding(vectors: pa.Array) -> pa.Array:
    """The reverse; NULL components are not allowed."""
    ends = np.asarray(vectors.offsets, np.int64)
    data = np.ascontiguousarray(vectors.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]].astype("<f4"))
    validity = vectors.is_valid().to_pylist()
    at = (4 * (ends - ends[0])).tolist()
    raw = data.tobytes()
    return pa.array([raw[a:b] if v else None for a, b, v in zip(at, at[1:], validity)], pa.binary())


def matrix(vectors: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(usable, values): which rows are vectors of so many finite numbers, and those rows as a matrix of DOUBLE."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    ends = np.asarray(vectors.offsets, np.int64)
    usable = np.asarray(vectors.is_valid()) & (np.diff(ends) == length)
    values = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)
    rows = values[ends[:-1][usable, None] + np.arange(length)]
    finite = np.isfinite(rows).all(axis=1)
    usable[np.flatnonzero(usable)[~finite]] = False
    return usable, rows[finite]


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def dot_literal(a: Column, query: list[float]) -> Column:
    """Dot product with a known vector, summed in the order of its entries like ``dot``."""
    return dot(a, F.lit([float(q) for q in query]))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine; 0 when either vector has no length."""
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))
