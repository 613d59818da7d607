"""The co-occurrence model kept by a stream: state per session, changes of pair counts per micro-batch.

A session's pairs are its plays with its last track. When plays arrive, the session's state (plays per track, last play)
tells how the pairs change: new plays are added to the old last track, or, where the last track changes, all pairs of the old
one are taken back and those of the new one added. The changes of a batch are stored in a folder of their own; their sum is
the model of all plays so far, and no play is ever read again.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from sessionflow.streaming import sinks
from sessionflow.streaming.sessions import DELAY
from sessionflow.workers import ship

#: How long after its last play a session is kept.
KEEP_SECONDS = 36 * 3600
#: Where state lies; the processor needs this store, whatever the session's own choice.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
PARTITIONS = "spark.sql.shuffle.partitions"
CHANGES = "last_track bigint, track_id bigint, change bigint"
#: Sessions are dealt to so many keys of the state by a hash; a checkpoint holds for the number it was made with.
BUCKETS = 8192
#: When the first session is due, and of each session, pickled, the last play and how often each track was played.
BUCKET = "timer bigint, sessions binary"
_ORDER = ("event_time", "event_id")
_PLAY = ("_us_last", "event_id_last", "track_id", "n_sum")


def combine(plays: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(_bucket, event_time, play): the plays of a track in a session that a task sees together, as one row.

    The row carries the last of them. A session with very many plays so reaches its state as a few rows per track and task.
    ``play`` is the pickled (keys, None, time in microseconds, event_id, track_id, number of plays): one value is read much
    faster in the state's Python workers than seven, and a null can't turn a column of integers into floats there.
    """
    keys = list(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = pa.Table.from_batches([b]).sort_by([(c, "ascending") for c in _ORDER])
            rows = rows.append_column("n", pa.array([1] * len(rows), pa.int64()))
            groups = rows.group_by(["_bucket", *keys, "track_id"], use_threads=False)
            found = groups.aggregate([("event_time", "last"), ("_us", "last"), ("event_id", "last"), ("n", "sum")])
            parts = [*(found[c].to_pylist() for c in keys), [None] * len(found), *(found[c].to_pylist() for c in _PLAY)]
            packed = pa.array([pickle.dumps(play, pickle.HIGHEST_PROTOCOL) for play in zip(*parts, strict=True)], pa.binary())
            found = pa.table({"_bucket": found["_bucket"], "event_time": found["event_time_last"], "play": packed})
            yield from found.cast(pa.schema([b.schema.field("_bucket"), b.schema.field("event_time"), ("play", pa.binary())])).to_batches()

    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
    slim = plays.select(bucket.alias("_bucket"), *keys, "track_id", *_ORDER, F.unix_micros("event_time").alias("_us"))
    return slim.mapInArrow(run, T.StructType([slim.schema["_bucket"], slim.schema["event_time"], T.StructField("play", T.BinaryType())]))


def _add(before: tuple | None, last: Sequence, new: dict[int, int], changes: list[tuple]) -> tuple:
    """The state of a session (time and id of its last play, its track, plays by track) with new plays; adds to ``changes``."""
    held = {}
    if before is not None:
        *old, held = before
        if (last[0], last[1]) <= (old[0], old[1]):
            last = old
        if old[2] != last[2]:
            changes += [(old[2], t, -n) for t, n in held.items() if old[2] is not None and t != old[2]]
            changes += [(last[2], t, n) for t, n in held.items() if last[2] is not None and t != last[2]]
    changes += [(last[2], t, n) for t, n in new.items() if last[2] is not None and t != last[2]]
    for track, n in new.items():
        held[track] = held.get(track, 0) + n
    return (*last, held)


class SessionPairs(StatefulProcessor):
    """For each session of a bucket: plays by track and the last play; gives the changes of the pair counts.

    Each call to the state store costs the same however little it brings, and so does each key's answer, while most sessions
    have few tracks. So a key is a bucket of sessions: its value is read once and written once per batch, and it has one timer,
    for the session that is due first, which is put off when it comes and not with each play. Rows are (keys, event_time, time
    in microseconds, event_id, track_id, number of plays).
    """

    def __init__(self, keep_seconds: int = KEEP_SECONDS):
        self.keep_ms = keep_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.bucket = handle.getValueState("bucket", BUCKET)

    def _due(self, us: int) -> int:
        return us // 1000 + self.keep_ms

    def _keep(self, timer: int, sessions: dict) -> None:
        self.bucket.update((timer, pickle.dumps(sessions, pickle.HIGHEST_PROTOCOL)))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[tuple]:
        came: dict[tuple, tuple[list, dict[int, int]]] = {}
        for row in rows:
            *names, _, us, event_id, track, n = row
            session = tuple(names)
            if session in came:
                last, new = came[session]
                if (us, event_id) > (last[0], last[1]):
                    last[:] = us, event_id, track
            else:
                came[session] = [us, event_id, track], (new := {})
            if track is not None:
                new[track] = new.get(track, 0) + n
        if not came:
            return
        before = self.bucket.get()
        timer, sessions = (None, {}) if before is None else (before[0], pickle.loads(before[1]))
        changes = []
        for session, (last, new) in came.items():
            sessions[session] = _add(sessions.get(session), last, new, changes)
        due = min(self._due(sessions[session][0]) for session in came)
        earlier = timer is None or due < timer
        self._keep(due if earlier else timer, sessions)
        if earlier:
            self.handle.registerTimer(due)
        yield from changes

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[tuple]:
        before = self.bucket.get()
        if before is not None and before[0] == expiredTimerInfo.getExpiryTimeInMs():  # else a timer before it saw to the rest
            now = timerValues.getCurrentWatermarkInMs()
            sessions = {session: held for session, held in pickle.loads(before[1]).items() if self._due(held[0]) > now}
            if sessions:
                timer = min(self._due(held[0]) for held in sessions.values())
                self._keep(timer, sessions)
                self.handle.registerTimer(timer)
            else:
                self.bucket.clear()
        return iter([])

    def close(self) -> None:
        pass


class PackedPairs(SessionPairs):
    """The same for plays as ``combine`` packs them, in frames."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        plays = (pickle.loads(play) for frame in rows for play in frame["play"])
        changes = list(super().handleInputRows(key, plays, timerValues))
        if changes:
            yield pd.DataFrame(changes, columns=["last_track", "track_id", "change"])


def pair_changes(plays: DataFrame, keys: Sequence[str] = ("user_id", "session_id"), delay: str = DELAY, keep_seconds: int = KEEP_SECONDS) -> DataFrame:
    """(last_track, track_id, change): how the pair counts change with the plays of a stream.

    Plays (keys, track_id, event_time, event_id) have bigint track and event ids. A session is forgotten once the watermark
    has passed its last play by ``keep_seconds``; what it added to the model stays. A play without a track counts as a last
    play, but makes no pair, as in ``cooccurrence_counts``. State is one value per bucket of sessions, with an entry per track
    of a session; sessions of a bucket are told apart by their keys as Python values (numbers, strings, dates).
    """
    ship(plays.sparkSession)
    plays.sparkSession.conf.set(*STATE_STORE)
    watched = combine(plays.filter(F.col("event_time").isNotNull()), keys).withWatermark("event_time", delay)
    return watched.groupBy("_bucket").transformWithStateInPandas(PackedPairs(keep_seconds), CHANGES, "Update", "EventTime")


def run_pair_model(plays: DataFrame, folder: str, trigger: dict | None = None, partitions: int | None = None, **options) -> StreamingQuery:
    """Keep the model below ``folder`` until the available plays are used up; a restart goes on where it was.

    ``partitions`` says in how many the state lies (by default the session's shuffle partitions). Each costs its files and a
    worker in every batch, however few its sessions. A folder keeps the number it began with.
    """
    changes, conf = pair_changes(plays, **options), plays.sparkSession.conf

    def store(batch: DataFrame, batch_id: int) -> None:
        summed = batch.groupBy("last_track", "track_id").agg(F.sum("change").alias("change")).filter("change != 0")
        sinks.write_batch(summed, batch_id, f"{folder}/changes")

    before = conf.get(PARTITIONS)
    conf.set(PARTITIONS, str(partitions or before))
    try:  # the query takes a copy of the session's settings
        query = sinks.start(changes, store, f"{folder}/checkpoint", mode="update", trigger=trigger or sinks.WAIT)
    finally:
        conf.set(PARTITIONS, before)
    query.awaitTermination()
    return query


def _folded(spark: SparkSession, folder: str) -> int:
    """The last batch that a fold holds, or -1."""
    try:
        return spark.read.schema("upto bigint").parquet(f"{folder}/folds").agg(F.max("upto")).first()[0]
    except AnalysisException:  # no fold yet
        return -1


def pair_model(spark: SparkSession, folder: str) -> DataFrame:
    """(last_track, track_id, pair_count) of all plays so far: the last fold and the changes since."""
    upto = _folded(spark, folder)
    changes = sinks.read_batches(spark, f"{folder}/changes", T._parse_datatype_string(CHANGES)).filter(F.col("batch_id") > upto).drop("batch_id")
    if upto >= 0:
        base = spark.read.schema("last_track bigint, track_id bigint, pair_count bigint").parquet(f"{folder}/base/upto={upto}")
        changes = changes.unionByName(base.withColumnRenamed("pair_count", "change"))
    return changes.groupBy("last_track", "track_id").agg(F.sum("change").alias("pair_count")).filter("pair_count > 0")


def fold_model(spark: SparkSession, folder: str) -> None:
    """Merge the changes so far into one table, so that reading does not grow with the number of batches.

    Readers go over to it when its number is stored, after it is complete; a fold that failed is never looked at.
    """
    stored = spark.read.schema("batch_id bigint").parquet(f"{folder}/changes").agg(F.max("batch_id")).first()[0]
    upto = _folded(spark, folder)
    if stored is None or stored <= upto:
        return
    model = pair_model(spark, folder)
    model.write.mode("overwrite").parquet(f"{folder}/base/upto={stored}")
    spark.createDataFrame([(stored,)], "upto bigint").write.mode("append").parquet(f"{folder}/folds")
