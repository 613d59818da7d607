"""Exact top-k search by inner product without random access.

Within a block each dimension has a list of the rows, sorted by component. The queries of a group read all lists from their
better end, a stretch at a time, and sum what they meet. A row's lower bound takes the worst component of each list it was
not met in, its upper bound the component where that list stands. A query stops when no other row's upper bound reaches the
lower bound of its k-th best; the scores of the rows that may still belong to the best k are then resolved.

How far a list has been read is the same for all queries of a group, so what they have met and the bounds of all their rows
are matrix products. One block is searched first: the k-th best there is a lower bound that all other blocks start from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionflow.llm import vectors as blocks
from sessionflow.llm.frames import batch, hand_off
from sessionflow.llm.set_join import ddl
from sessionflow.llm.vectors import best, best_rows, groups, in_blocks, matrix, usable

SCALE = 256
#: Up to which share of the lists the queries read before the bounds are compared.
SHARES = (0.5, 0.7, 0.8, 0.9, 1.0)
#: Queries that read together; bounds a task's memory.
TOGETHER = 256
FOUND = pa.schema([("row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


class Lists:
    """The sorted lists of a block. ``read`` notes the share of the lists read by each query."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        order = np.argsort(vectors, axis=0, kind="stable")
        self.values = np.take_along_axis(vectors, order, axis=0)  # each dimension ascending
        self.place = np.empty(order.shape, np.int32)  # of every row in the list of each dimension
        np.put_along_axis(self.place, order, np.arange(len(vectors), dtype=np.int32)[:, None], axis=0)
        self.read: list[float] = []

    def search(self, queries: np.ndarray, k: int, least: np.ndarray, own: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the rows that may be among its k best, with their scores, at least all that reach ``least``.

        ``own``: queries x rows, rows that take no part.
        """
        n, out = len(self.vectors), [None] * len(queries)
        todo = np.arange(len(queries))
        for share in SHARES:
            depth = min(n, int(np.ceil(n * share)))
            up, down = np.maximum(queries[todo], 0.0), np.minimum(queries[todo], 0.0)  # read from the large end, the small end
            met_up, met_down = self.place >= n - depth, self.place < depth
            unseen = np.hstack([~met_up, ~met_down]).astype(np.float64)
            score = np.hstack([up, down]) @ np.hstack([self.vectors * met_up, self.vectors * met_down]).T
            front = np.hstack([up * self.values[n - depth], down * self.values[depth - 1]])
            worst = np.hstack([up * self.values[0], down * self.values[-1]])
            high, low = front @ unseen.T, worst @ unseen.T
            high += score
            low += score
            high[own[todo]] = low[own[todo]] = -np.inf
            bound = least[todo]
            if n > k:
                low.partition(n - k, axis=1)
                bound = np.maximum(bound, low[:, n - k])
            may = high >= np.maximum(bound, np.finfo(np.float64).min)[:, None]
            stop = may.sum(axis=1) <= max(4 * k, n // 64)  # outsiders cannot qualify: the few that may are resolved
            stop |= depth == n
            for at in np.flatnonzero(stop).tolist():
                ids = np.flatnonzero(may[at])
                out[todo[at]] = ids, self.vectors[ids] @ queries[todo[at]]
                self.read.append(depth / n)
            todo = todo[~stop]
            if not len(todo):
                break
        return out


def _search(k: int):
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, queries = groups(batches)
        if not len(rows) or not len(queries):
            return
        column = lambda t, c: t.column(c).combine_chunks() if isinstance(t.column(c), pa.ChunkedArray) else t.column(c)
        a, b = column(rows, "v"), column(queries, "v")
        dims = max(int(np.diff(x.offsets.to_numpy()).max()) for x in (a, b))
        lists, asked = Lists(matrix(a, dims)), matrix(b, dims)  # whole numbers: sums in double precision are exact
        ids, asking = rows.column("vec_id").to_numpy(), queries.column("vec_id").to_numpy()
        row, least = queries.column("row").to_numpy(), column(queries, "least").fill_null(-np.inf).to_numpy()
        for first in range(0, len(asked), TOGETHER):
            part = slice(first, first + TOGETHER)
            found = lists.search(asked[part], k, least[part], asking[part, None] == ids)
            for i, (held, scores) in enumerate(found):
                order = np.lexsort((ids[held], -scores))[:k]
                n = len(order)
                yield batch(FOUND, row=[row[first + i]] * n, query_id=[asking[first + i]] * n, vec_id=ids[held[order]], score=scores[order].astype(np.int64))

    return run


def exact_top_k(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose vec_id ``every`` divides, the k rows of highest score.

    Components count as floor(256 * x). Score: integer inner product, ties to the smaller vec_id; rows of the query's own
    vec_id are no candidates. Null vectors and those with null or non-finite components take no part, nor do rows without
    vec_id. Shorter vectors count as ended by zeros. A repeated row is a candidate (and a query) each time. Fewer than k
    candidates: all of them. Other columns are ignored.
    """
    rows = usable(vectors)
    rows = rows.select("row", "vec_id", F.transform("v", lambda x: F.floor(x * SCALE).cast("double")).alias("v"), F.lit(None).cast("double").alias("least"))
    queries = rows.filter(F.pmod("vec_id", F.lit(every)) == 0)
    n_blocks = max(1, -(-rows.agg(F.count("*").alias("n")).first().n // blocks.BLOCK_ROWS))
    first = F.pmod(F.xxhash64("row", F.lit("first")), F.lit(n_blocks)) == 0
    begun = hand_off(in_blocks(rows.filter(first), queries, _search(k), ddl(FOUND)), "top-k-first")
    if n_blocks == 1:
        return best(begun, k)
    kth = best_rows(begun, k).filter(F.col("rank") == k).select("row", F.col("score").cast("double").alias("least"))
    bounded = queries.drop("least").join(kth, "row", "left").select(*rows.columns)
    return best(begun.unionByName(in_blocks(rows.filter(~first), bounded, _search(k), ddl(FOUND))), k)
