"""Sinks for micro-batches. Rows are written by the executors and never pass through the driver."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

WAIT = {"availableNow": True}

# Rows per bulk insert of the two document collections.
SESSION_CHUNK = 100
RECOMMENDATION_CHUNK = 50


def write_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    """Write one micro-batch as its own folder of a parquet table; a replayed batch replaces its first attempt."""
    batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def write_and_reread(batch: DataFrame, batch_id: int, path: str) -> DataFrame:
    """Write a micro-batch and go on from what was written, so that later steps of the batch do not compute it again."""
    write_batch(batch, batch_id, path)
    return batch.sparkSession.read.schema(batch.schema).parquet(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All batches written so far, with their batch_id."""
    with_id = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType(), True)])
    return spark.read.schema(with_id).parquet(path)


def latest_rows(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last written row per key of an update-mode log: an upsert done when reading, combined on the map side."""
    values = [c for c in log.columns if c not in {*keys, "batch_id"}]
    return (
        log.groupBy(*keys)
        .agg(F.max_by(F.struct(*values), "batch_id").alias("_row"))
        .select(*keys, "_row.*")
    )


def write_documents(batch: DataFrame, uri: str, database: str, collection: str, chunk: int, **options: str) -> None:
    """Append rows to a document collection by its Spark connector, in unordered bulk inserts of ``chunk`` rows."""
    batch.write.format("mongodb").mode("append").options(
        **{
            "connection.uri": uri,
            "database": database,
            "collection": collection,
            "maxBatchSize": str(chunk),
            "ordered": "false",
            **options,
        }
    ).save()


def show_batch(batch: DataFrame, batch_id: int, rows: int = 50) -> None:
    """Debug sink: print the first rows of a batch."""
    print(f"batch {batch_id}")
    batch.show(rows, truncate=False)


def start_console(stream: DataFrame, checkpoint: str, every: str = "10 seconds", rows: int = 50) -> StreamingQuery:
    """Debug query: changed rows on the console."""
    return (
        stream.writeStream.outputMode("update")
        .format("console")
        .option("numRows", rows)
        .option("truncate", False)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
        .start()
    )


def start(
    stream: DataFrame,
    each_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start a query that hands every micro-batch to ``each_batch``. The checkpoint makes restarts exact."""
    writer = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "20 seconds"}))
    )
    return (writer.queryName(name) if name else writer).start()


def run_to_table(
    stream: DataFrame, path: str, checkpoint: str, mode: str = "append", trigger: dict | None = None
) -> StreamingQuery:
    """Run a query into the batch table at ``path`` until the available input is used up."""
    query = start(stream, lambda batch, batch_id: write_batch(batch, batch_id, path), checkpoint, mode, trigger or WAIT)
    query.awaitTermination()
    return query
