"""Approximate nearest neighbours by randomly rotated one-bit codes.

Every vector, less the mean of all, is rotated by a random orthogonal matrix and kept as the signs of its components,
with its length and its inner product with the code. A query's rotated components are rounded to four bits; counting
bits of packed words then estimates all inner products of a block, each with a bound on its error. Vectors whose bound
reaches the k-th best exact score are scored again on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionflow.llm.frames import batch, hand_off
from sessionflow.llm.set_join import ddl
from sessionflow.llm.vectors import best, groups, in_blocks, matrix, usable

SEED, QUERY_BITS = 7, 4
#: Width of the error bounds in units of their deviation; larger: more vectors scored again.
CONFIDENCE = 1.9
INDEX = "row bigint, vec_id bigint, v array<double>, code binary, length double, aligned double"
FOUND = pa.schema([("row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
MEANS = pa.schema([("n", pa.int64()), ("total", pa.list_(pa.float64()))])


@lru_cache(maxsize=4)
def rotation(dims: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def _packed(signs: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words, the rest zero."""
    n, dims = signs.shape
    wide = np.zeros((n, -(-dims // 64) * 64), bool)
    wide[:, :dims] = signs
    return np.packbits(wide, axis=1, bitorder="little").view(np.uint64)


def _totals(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dims), 0
        for b in batches:
            total += matrix(b.column("v"), dims).sum(axis=0)
            n += len(b)
        if n:
            yield batch(MEANS, n=[n], total=[total])

    return run


def _indexed(mean: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, dims = rotation(len(mean)), len(mean)
        for b in batches:
            turned = (matrix(b.column("v"), dims) - mean) @ turn
            length = np.linalg.norm(turned, axis=1)
            signs = turned > 0
            aligned = np.abs(turned).sum(axis=1) / np.where(length > 0, length, 1) / np.sqrt(dims)
            codes = pa.array([c.tobytes() for c in _packed(signs)], pa.binary())
            added = [codes, pa.array(length), pa.array(aligned)]
            yield pa.RecordBatch.from_arrays([*b.columns, *added], names=[*b.schema.names, "code", "length", "aligned"])

    return run


def build_index(vectors: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """The index table (row, vec_id, v, code, length, aligned) of every usable vector, and the mean of them all."""
    rows = usable(vectors, zero=False)
    dims = rows.agg(F.max(F.size("v")).alias("d")).first().d or 1
    sums = rows.mapInArrow(_totals(dims), "n bigint, total array<double>")
    at = sums.agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("total", F.lit(i))) for i in range(dims)]).alias("t")).first()
    mean = np.array(at.t) / at.n if at.n else np.zeros(dims)
    return hand_off(rows.mapInArrow(_indexed(mean), INDEX), "ann-index"), mean


def estimates(codes: np.ndarray, length: np.ndarray, aligned: np.ndarray, mean: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (queries x rows) and how far off they may be."""
    dims = len(mean)
    turned = queries @ rotation(dims)
    low = turned.min(axis=1, keepdims=True)
    step = (turned.max(axis=1, keepdims=True) - low) / (2**QUERY_BITS - 1)
    step[step == 0] = 1
    levels = np.rint((turned - low) / step).astype(np.uint8)
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
    dots = np.zeros((len(queries), len(codes)))
    for bit in range(QUERY_BITS):
        planes = _packed((levels >> bit) & 1 == 1)
        for w in range(codes.shape[1]):
            dots += np.bitwise_count(planes[:, w, None] & codes[None, :, w]).astype(float) * (1 << bit)
    # sum over set bits of the rounded query, less the sum over the others
    signed = 2 * (step * dots + low * ones) - (step[:, 0] * levels.sum(axis=1) + low[:, 0] * dims)[:, None]
    scale = np.where(aligned > 0, length / np.where(aligned > 0, aligned, 1), 0)
    estimate = signed / np.sqrt(dims) * scale + (queries @ mean)[:, None]
    norm = np.linalg.norm(queries, axis=1)[:, None]
    spread = np.sqrt(np.maximum(1 - aligned**2, 0) / max(dims - 1, 1)) * scale
    rounding = step * np.sqrt(dims) / 2 / np.sqrt(dims) * scale
    return estimate, CONFIDENCE * norm * spread + rounding


def _search(k: int, mean: np.ndarray):
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, queries = groups(batches)
        if not len(rows) or not len(queries):
            return
        one = lambda t, c: t.column(c).combine_chunks()
        vectors, asked = matrix(one(rows, "v"), len(mean)), matrix(one(queries, "v"), len(mean))
        codes = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint64).reshape(len(rows), -1)
        length, aligned = rows.column("length").to_numpy(), rows.column("aligned").to_numpy()
        ids, query_ids, query_rows = rows.column("vec_id").to_numpy(), queries.column("vec_id").to_numpy(), queries.column("row").to_numpy()
        step = max(1, (1 << 21) // len(rows))  # queries at once
        for first in range(0, len(asked), step):
            some = slice(first, first + step)
            estimate, off = estimates(codes, length, aligned, mean, asked[some])
            for q, row, query_id, guess, upper in zip(asked[some], query_rows[some], query_ids[some], estimate, estimate + off, strict=True):
                own = ids == query_id
                guess[own] = upper[own] = -np.inf
                n = len(ids) - int(own.sum())
                if not n:
                    continue
                likely = np.argpartition(guess, -min(2 * k, n))[-min(2 * k, n) :]
                scores = np.einsum("ij,j->i", vectors[likely], q)
                least = np.sort(scores)[-min(k, n)]
                again = np.flatnonzero((upper >= least) & ~own)
                again = np.union1d(again, likely)
                scores = np.einsum("ij,j->i", vectors[again], q)
                order = np.lexsort((ids[again], -scores))[:k]
                yield batch(FOUND, row=[row] * len(order), query_id=[query_id] * len(order), vec_id=ids[again[order]], score=scores[order])

    return run


def nearest(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose vec_id ``every`` divides, its k nearest found.

    Nearness: largest inner product of the original vectors in double precision, ties to the smaller vec_id; rows of the
    query's own vec_id are no candidates. Vectors that are null, all zero or hold null or non-finite components take no
    part, nor do rows without vec_id. Shorter vectors count as ended by zeros. Repeated rows count each time. Fewer than
    k candidates: all of them. The mean is taken over all vectors, and every vector is indexed.
    """
    index, mean = build_index(vectors)
    queries = index.filter(F.pmod("vec_id", F.lit(every)) == 0)
    return best(in_blocks(index, queries, _search(k, mean), ddl(FOUND)), k)
