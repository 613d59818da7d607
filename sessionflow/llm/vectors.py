"""Vector tables cut into blocks, and queries met with them block by block."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Most vectors and most queries in a group on average; bounds a task's memory.
BLOCK_ROWS, BLOCK_QUERIES = 8192, 1024


def usable(vectors: DataFrame, zero: bool = True) -> DataFrame:
    """(row, vec_id, v): rows with an id and a vector of finite numbers; ``zero``: with those of zeros only.

    ``row`` tells repeated rows apart. It depends on the order of the input, which a second run of a task reads alike.
    """
    v = F.col("embedding").cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    kept = F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.forall(v, finite)
    if not zero:
        kept &= F.exists(v, lambda x: x != 0)
    ids = vectors.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    return ids.filter(kept).select("row", "vec_id", v.alias("v"))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A list column as rows of ``dims`` doubles; shorter vectors end in zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dims))
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


def in_blocks(rows: DataFrame, queries: DataFrame, search: Callable, schema: str) -> DataFrame:
    """Applies ``search`` to every block of rows with every block of queries.

    ``rows`` and ``queries`` have the same columns, with ``row``. Each block goes to as many groups as there are blocks
    of queries and the other way round, so the work is rows x queries and a group stays within bounds whatever the ids.
    """
    counts = rows.agg(F.count("*").alias("n")).first().n, queries.agg(F.count("*").alias("n")).first().n
    n_blocks, n_query_blocks = (max(1, -(-n // most)) for n, most in zip(counts, (BLOCK_ROWS, BLOCK_QUERIES), strict=True))
    block = lambda n: F.pmod(F.xxhash64("row"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    left = rows.select(F.lit(False).alias("asks"), *rows.columns, block(n_blocks).alias("block"), every(n_query_blocks).alias("query_block"))
    right = queries.select(F.lit(True).alias("asks"), *rows.columns, every(n_blocks).alias("block"), block(n_query_blocks).alias("query_block"))
    # bounded groups, dealt to as many partitions as there are groups
    both = left.unionByName(right).withColumn("deal", F.col("block") * n_query_blocks + F.col("query_block"))
    return both.groupBy("deal").applyInArrow(search, schema)


def best_rows(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query with their rank: highest score, then smallest vec_id."""
    order = W.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def best(found: DataFrame, k: int) -> DataFrame:
    return best_rows(found, k).select("query_id", "rank", "vec_id", "score")


def groups(batches: Iterator[pa.RecordBatch]) -> tuple[pa.Table, pa.Table]:
    """Rows and queries of a group."""
    both = pa.Table.from_batches(list(batches)).combine_chunks()
    asks = both.column("asks")
    return both.filter(pa.compute.invert(asks)), both.filter(asks)
