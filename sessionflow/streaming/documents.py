"""A keyed document store on files as a sink of streams: upserts by key, each micro-batch committed once.

Tasks write the rows of a batch into files with names of their own, which nobody reads yet. When all tasks are done, the
driver stores the batch's list of files under the batch's number, by renaming a complete file. A batch that is replayed after
a failure finds its list there and takes its new files back; files of killed tasks are in no list and are never read.
Of the documents of a key the one of the latest batch holds. ``compact`` rewrites them as one base.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from sessionflow.streaming import sinks
from sessionflow.workers import ship

FORMAT = "documents"
_LISTS = "batch bigint, upto bigint, files array<string>"


@dataclass
class Written(WriterCommitMessage):
    """The file that a task has written, if it had rows."""

    name: str | None
    rows: int


class _Store:
    """The files of a store, by way of its address."""

    def __init__(self, path: str):
        self.path = path

    def _open(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path)

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        files, root = self._open()
        files.create_dir(f"{root}/data", recursive=True)
        name, rows, writer = f"{uuid.uuid4().hex}.parquet", 0, None
        try:
            for b in batches:
                writer = writer or pq.ParquetWriter(f"{root}/data/{name}", b.schema, filesystem=files)
                writer.write_batch(b)
                rows += b.num_rows
        finally:
            if writer:
                writer.close()
        return Written(name if writer else None, rows)

    def drop(self, messages: Sequence[Written | None]) -> None:
        files, root = self._open()
        for m in messages:
            if m and m.name and files.get_file_info(f"{root}/data/{m.name}").type != fs.FileType.NotFound:
                files.delete_file(f"{root}/data/{m.name}")

    def commit(self, messages: Sequence[Written | None], name: str, batch: int, upto: int) -> None:
        """Stores the list of files under ``name``; a list that is there already stays, and the files go."""
        files, root = self._open()
        files.create_dir(f"{root}/lists", recursive=True)
        target = f"{root}/lists/{name}.json"
        if files.get_file_info(target).type != fs.FileType.NotFound:
            self.drop(messages)
            return
        made = f"{root}/lists/_{uuid.uuid4().hex}"  # names with an underscore are passed over by readers
        with files.open_output_stream(made) as out:
            out.write(json.dumps({"batch": batch, "upto": upto, "files": [m.name for m in messages if m and m.name]}).encode())
        files.move(made, target)


class StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, store: _Store):
        self.store = store

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.store.write(iterator)

    def commit(self, messages, batchId: int) -> None:
        self.store.commit(messages, f"batch-{batchId}", batchId, -1)

    def abort(self, messages, batchId: int) -> None:
        self.store.drop(messages)


class TableWriter(DataSourceArrowWriter):
    """Writes a table as one batch, or as the base that holds the documents of all batches up to one."""

    def __init__(self, store: _Store, batch: int, base: bool):
        self.store, self.batch, self.base = store, batch, base

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.store.write(iterator)

    def commit(self, messages) -> None:
        self.store.commit(messages, f"{'base' if self.base else 'batch'}-{self.batch}", self.batch, self.batch if self.base else -1)

    def abort(self, messages) -> None:
        self.store.drop(messages)


class DocumentStore(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> StreamWriter:
        return StreamWriter(_Store(self.options["path"]))

    def writer(self, schema: T.StructType, overwrite: bool) -> TableWriter:
        base = "upto" in self.options
        return TableWriter(_Store(self.options["path"]), int(self.options["upto" if base else "batch"]), base)


def _register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(DocumentStore)


def start_documents(rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Upsert the rows of a stream in append mode into the store at ``path``, which all executors reach."""
    _register(rows.sparkSession)
    writer = rows.writeStream.format(FORMAT).outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "20 seconds"})).start()


def upsert(batch: DataFrame, batch_id: int, path: str) -> None:
    """Upsert one micro-batch, for queries that do more with a batch than store it. A replayed batch changes nothing."""
    _register(batch.sparkSession)
    batch.write.format(FORMAT).mode("append").option("path", path).option("batch", batch_id).save()


def read_documents(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The document of each key: that of the latest batch; of several in one batch the one of greatest values.

    Only files of committed lists are read. The empty store has no documents.
    """
    try:
        lists = spark.read.schema(_LISTS).json(f"{path}/lists")
    except AnalysisException:  # nothing committed yet
        return spark.createDataFrame([], schema)
    base = lists.agg(F.max("upto").alias("upto")).first().upto
    base = -1 if base is None else base
    valid = lists.filter((F.col("upto") == base) | (F.col("batch") > base)) if base >= 0 else lists
    named = valid.select(F.col("batch").alias("_batch"), F.explode("files").alias("_file"))
    if named.isEmpty():
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(f"{path}/data").withColumn("_file", F.col("_metadata.file_name"))
    values = [c for c in schema.names if c not in set(keys)]
    latest = F.max_by(F.struct(*values), F.struct("_batch", F.struct(*values))).alias("_row")
    return rows.join(named, "_file").groupBy(*keys).agg(latest).select(*keys, "_row.*").select(*schema.names)


def compact(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> None:
    """Write the documents so far as one base. Batches that are committed meanwhile stay beside it."""
    _register(spark)
    upto = spark.read.schema(_LISTS).json(f"{path}/lists").agg(F.max("batch").alias("batch")).first().batch
    if upto is not None:
        read_documents(spark, path, schema, keys).write.format(FORMAT).mode("append").option("path", path).option("upto", upto).save()
