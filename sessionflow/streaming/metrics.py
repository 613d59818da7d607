"""What a stream tells about its micro-batches: counts observed in passing, samples, sketches, progress reports.

Each is stored by batch, so that a replayed batch replaces its own and every batch counts once.
"""

from __future__ import annotations

import json
import logging

from pyarrow import fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from sessionflow.functions.draws import digest
from sessionflow.sources.events import CORRUPT
from sessionflow.streaming import sinks

log = logging.getLogger(__name__)


def event_counts() -> list[Column]:
    """Counts of all, playable and skipped events."""
    return [
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("event_type") == "play").alias("plays"),
        F.count_if(F.col("event_type") == "skip").alias("skips"),
    ]


def message_counts() -> list[Column]:
    """Counts of decoded messages: unreadable ones, ones without a readable time, and the readable events by type."""
    readable = F.col(CORRUPT).isNull()
    return [
        F.count(F.lit(1)).alias("messages"),
        F.count_if(~readable).alias("corrupt"),
        F.count_if(readable & F.col("event_time").isNull()).alias("bad_time"),
        F.count_if(readable & (F.col("event_type") == "play")).alias("plays"),
        F.count_if(readable & (F.col("event_type") == "skip")).alias("skips"),
    ]


def write_counted(batch: DataFrame, batch_id: int, path: str, counts: list[Column], counts_path: str, keep: Column) -> None:
    """Write the rows of a micro-batch where ``keep`` holds, and the counts of all its rows as a table of their own.

    One pass does both. Both tables have a folder per batch, so a replay replaces them and no batch is ever left out.
    """
    seen = Observation()
    sinks.write_batch(batch.observe(seen, *counts).filter(keep), batch_id, path)
    found = seen.get
    kinds = ", ".join(f"{name} bigint" for name in found)
    sinks.write_batch(batch.sparkSession.createDataFrame([tuple(found.values())], kinds), batch_id, counts_path)


# Fixed value: sample events of a micro-batch.
SAMPLE_EVENTS = 3
#: Size of a distinct-count sketch is 2 to this power; its standard error is about 1.04 / sqrt(2 ** SKETCH_BITS), 1.6 %.
SKETCH_BITS = 12


def sample_events(batch: DataFrame, key: str, seed: str = "sample", n: int = SAMPLE_EVENTS) -> DataFrame:
    """``n`` rows of a micro-batch, the same whenever it is replayed: those whose keys have the least digests.

    Each task keeps ``n`` rows, and of these the least are the batch's.
    """
    return batch.withColumn("_ticket", digest(seed, F.col(key))).orderBy("_ticket", key).limit(n).drop("_ticket")


def write_distincts(batch: DataFrame, batch_id: int, path: str, columns: list[str]) -> None:
    """Store one sketch per column of a micro-batch, from which distinct counts over any batches can be estimated."""
    sketches = [F.hll_sketch_agg(F.col(c).cast("string"), SKETCH_BITS).alias(c) for c in columns]
    sinks.write_batch(batch.agg(*sketches), batch_id, path)


def distinct_counts(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """One row: the estimated distinct values of each column over all stored batches; nulls are no values."""
    stored = spark.read.schema(", ".join(f"{c} binary" for c in columns)).parquet(path)
    united = stored.agg(*[F.hll_union_agg(c).alias(c) for c in columns])
    return united.select(*[F.hll_sketch_estimate(c).alias(c) for c in columns])


def dropped_late_rows(query: StreamingQuery) -> int:
    """State rows dropped behind the watermark, over the newest micro-batches that Spark keeps reports of (100)."""
    return sum(
        state["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for state in (progress if isinstance(progress, dict) else json.loads(progress.json))["stateOperators"]
    )


class LogProgress(StreamingQueryListener):
    """Logs the observed counts of every micro-batch of every query."""

    def onQueryStarted(self, event):
        log.info("stream %s started", event.id)

    def onQueryProgress(self, event):
        for name, row in (event.progress.observedMetrics or {}).items():
            log.info("batch %s %s %s", event.progress.batchId, name, row.asDict())

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        log.info("stream %s ended", event.id)


class StoreProgress(StreamingQueryListener):
    """Stores every progress report as a file of its own below ``path``, named by query and batch.

    Spark itself keeps the newest 100 reports. A batch that is repeated replaces its report; idle reports, which repeat the
    number of a batch without input, do not.
    """

    def __init__(self, path: str):
        self.files, self.root = fs.FileSystem.from_uri(path)
        self.files.create_dir(self.root, recursive=True)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        report = event.progress
        row = json.loads(report.json)
        states = row.get("stateOperators", [])
        name = f"{self.root}/{report.id}-{report.batchId}.json"
        if not report.numInputRows and self.files.get_file_info(name).type != fs.FileType.NotFound:
            return
        out = {
            "query_id": str(report.id),
            "batch": report.batchId,
            "at": row["timestamp"],
            "rows": report.numInputRows,
            "late_rows": sum(s["numRowsDroppedByWatermark"] for s in states),
            "state_rows": sum(s["numRowsTotal"] for s in states),
            "state_bytes": sum(s["memoryUsedBytes"] for s in states),
            "watermark": row.get("eventTime", {}).get("watermark"),
            "milliseconds": row.get("durationMs", {}).get("triggerExecution", 0),
        }
        with self.files.open_output_stream(name) as file:
            file.write(json.dumps(out).encode())

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


PROGRESS = (
    "query_id string, batch bigint, at string, rows bigint, late_rows bigint, state_rows bigint, state_bytes bigint, "
    "watermark string, milliseconds bigint"
)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The stored reports, one row per query and batch."""
    return spark.read.schema(PROGRESS).json(path)
