"""Small helpers the operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sessionflow.sources.bindings import table  # noqa: F401
from sessionflow.storage import hand_off, new_folder  # noqa: F401


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def give_back() -> None:
    """Returns memory that arrays have left to the system: Python workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def planes(values: np.ndarray, kind: str) -> bytes:
    """An array as its first bytes, then its second bytes and so on: shuffles pack equal bytes side by side well."""
    return np.ascontiguousarray(values.astype(kind)).view(np.uint8).reshape(-1, np.dtype(kind).itemsize).T.tobytes()


def from_planes(raw: bytes | pa.Buffer, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def rows_of(b: pa.RecordBatch, *columns: str) -> Iterator[list[pa.Buffer]]:
    """The bytes of binary columns row by row, where they lie."""
    for i in range(len(b)):
        yield [b.column(c)[i].as_buffer() for c in columns]


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
