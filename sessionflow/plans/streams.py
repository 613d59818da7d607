"""Streaming queries: the event table as a file stream, run until its input is used up, read back from the sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionflow import schemas
from sessionflow.plans.sessions import WIDE_SECONDS, WIDE_WINDOW, WINDOWS, window_bounds
from sessionflow.plans.sql import EVENTS, PLAYS, TRACKS, model, next_track
from sessionflow.sources import bindings as B
from sessionflow.sources import events as E
from sessionflow.storage import new_folder
from sessionflow.streaming import metrics, recommendations, sessions, sinks

DELAY_US = 60_000_000
TUMBLING_SECONDS = 120
LATE_USERS = 10


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.listening_events(E.table_stream(spark, f"{sf_dir}/events.parquet", schemas.EVENT_TABLE))


def _play_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_stream(spark, sf_dir).filter(F.col("event_type") == "play")


def _enriched_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.enrich_stream(_play_stream(spark, sf_dir), B.tracks(spark, sf_dir))


def _batches(spark: SparkSession, folder: str, like: DataFrame) -> DataFrame:
    return sinks.read_batches(spark, f"{folder}/out", like.schema)


def stream_sessions_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final session windows of two minutes, put together from track-list slices in every micro-batch."""
    folder = new_folder(spark, "tumbling")
    pieces = sessions.session_piece_stream(_enriched_stream(spark, sf_dir))

    def store(batch: DataFrame, batch_id: int) -> None:
        stored = sinks.write_and_reread(batch, batch_id, f"{folder}/lists")
        sinks.write_batch(sessions.sessions_of_pieces(stored), batch_id, f"{folder}/out")

    sinks.start(pieces, store, f"{folder}/checkpoint", trigger=sinks.WAIT).awaitTermination()
    done = _batches(spark, folder, sessions.sessions_of_pieces(pieces))
    return done.select(*window_bounds(), "session_id", "user_id", "track_count", "first_artist", "last_track")


def stream_session_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The track lists of the final session windows, one row per slice of the window."""
    folder = new_folder(spark, "lists")
    pieces = sessions.session_piece_stream(
        _enriched_stream(spark, sf_dir), window=WIDE_WINDOW, piece_seconds=WIDE_SECONDS // 6
    )
    sinks.run_to_table(pieces, f"{folder}/out", f"{folder}/checkpoint")
    return _batches(spark, folder, pieces).select(
        *window_bounds(), "session_id", "slice_no", F.array_join("tracks", ",").alias("tracks")
    )


def stream_sessions_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final session windows of six hours, each written once."""
    folder = new_folder(spark, "append")
    stream = sessions.session_stream(_enriched_stream(spark, sf_dir), window=WIDE_WINDOW)
    sinks.run_to_table(stream, f"{folder}/out", f"{folder}/checkpoint")
    return _batches(spark, folder, stream).select(
        *window_bounds(), "session_id", "user_id", "track_count", "first_artist", "last_track", "has_multiple_tracks"
    )


def stream_sessions_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session windows as they change, the newest row per window and session: also the windows still open."""
    folder = new_folder(spark, "update")
    stream = sessions.session_stream(_enriched_stream(spark, sf_dir), window=WIDE_WINDOW)
    sinks.run_to_table(stream, f"{folder}/out", f"{folder}/checkpoint", mode="update")
    return sinks.latest_rows(_batches(spark, folder, stream), sessions.KEYS).select(
        *window_bounds(), "session_id", "user_id", "track_count", "first_artist", "last_track", "has_multiple_tracks"
    )


def stream_late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window counts when one user in ten delivers late: windows closed by then do not change any more.

    The events on time are streamed first; the late ones arrive after a restart from the same checkpoint.
    """
    folder = new_folder(spark, "late")
    events = B.table(spark, sf_dir, "events")
    is_late = F.col("user_id") % LATE_USERS == 0

    def window_counts() -> DataFrame:
        stream = B.listening_events(spark.readStream.schema(schemas.EVENT_TABLE).parquet(f"{folder}/in"))
        return (
            stream.withWatermark("event_time", sessions.DELAY)
            .groupBy(F.window("event_time", WIDE_WINDOW).alias("window"), "user_id")
            .agg(F.count(F.lit(1)).alias("events"))
        )

    for arrival in (events.filter(~is_late), events.filter(is_late)):
        arrival.write.mode("append").parquet(f"{folder}/in")
        sinks.run_to_table(window_counts(), f"{folder}/out", f"{folder}/checkpoint")
    return _batches(spark, folder, window_counts()).select(*window_bounds(), "user_id", "events")


def stream_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "recommendations")
    plays = _play_stream(spark, sf_dir)
    recommendations.start_recommendations(
        plays, f"{folder}/out", f"{folder}/checkpoint", trigger=sinks.WAIT
    ).awaitTermination()
    chosen = F.col("next_track_recommendation")
    stored = spark.read.parquet(f"{folder}/out")
    return sinks.latest_rows(stored, ["user_id", "session_id"]).select(
        "user_id",
        "session_id",
        "last_track",
        chosen["track"].alias("next_track"),
        chosen["strategy"].alias("strategy"),
        chosen["weight"].alias("weight"),
    )


def stream_play_log_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays stored by a stream, and the model over all of them."""
    folder = new_folder(spark, "play-log")
    plays = _play_stream(spark, sf_dir)
    recommendations.run_play_log(plays, f"{folder}/out", f"{folder}/checkpoint", trigger=sinks.WAIT)
    chosen = F.col("next_track_recommendation")
    return recommendations.recommend_from_log(spark, f"{folder}/out", plays.schema).select(
        "user_id",
        "session_id",
        "last_track",
        chosen["track"].alias("next_track"),
        chosen["strategy"].alias("strategy"),
        chosen["weight"].alias("weight"),
    )


def stream_sink_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every micro-batch is written twice, as after a failure between write and commit; its rows count once."""
    folder = new_folder(spark, "replay")
    plays = _play_stream(spark, sf_dir)

    def store_twice(batch: DataFrame, batch_id: int) -> None:
        for _ in range(2):
            sinks.write_batch(batch, batch_id, f"{folder}/out")

    sinks.start(plays, store_twice, f"{folder}/checkpoint", trigger=sinks.WAIT).awaitTermination()
    return _batches(spark, folder, plays).select("event_id", "user_id", "track_id", "session_id")


def stream_batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored counts of every micro-batch, summed."""
    folder = new_folder(spark, "metrics")

    def store(batch: DataFrame, batch_id: int) -> None:
        counts = metrics.event_counts()
        metrics.write_counted(batch, batch_id, f"{folder}/out", counts, f"{folder}/counts", F.col("event_type") == "play")

    sinks.start(_event_stream(spark, sf_dir), store, f"{folder}/checkpoint", trigger=sinks.WAIT).awaitTermination()
    counted = spark.read.schema("events bigint, plays bigint, skips bigint").parquet(f"{folder}/counts")
    return counted.agg(*[F.sum(c).alias(c) for c in ("events", "plays", "skips")])


QUERIES = {
    "stream_sessions_tumbling": stream_sessions_tumbling,
    "stream_session_lists": stream_session_lists,
    "stream_sessions_append": stream_sessions_append,
    "stream_sessions_update": stream_sessions_update,
    "stream_late_data": stream_late_data,
    "stream_recommendations": stream_recommendations,
    "stream_play_log_recommendations": stream_play_log_recommendations,
    "stream_sink_idempotent": stream_sink_idempotent,
    "stream_batch_metrics": stream_batch_metrics,
}

_CLOSED = f"(SELECT max(us) - {DELAY_US} FROM plays)"
_TUMBLING = WINDOWS.replace(str(WIDE_SECONDS), str(TUMBLING_SECONDS))
_RECS = f"""
WITH {PLAYS}, {model("plays", "user_id, session_id", "us, event_id")},
{next_track("edges", "cooccurrence", "s.user_id, s.session_id")}
SELECT user_id, session_id, last_track, next_track, strategy, weight FROM recs"""

ORACLES = {
    "stream_sessions_tumbling": f"""
WITH {PLAYS}, {TRACKS}, {_TUMBLING}
SELECT window_start, window_end, session_id, user_id, track_count, first_artist, last_track
FROM windows WHERE window_end * 1000000 <= {_CLOSED}""",
    "stream_session_lists": f"""
WITH {PLAYS}, slices AS (
  SELECT us // {WIDE_SECONDS}000000 * {WIDE_SECONDS} AS window_start, us // {WIDE_SECONDS // 6}000000 AS slice_no,
    session_id, string_agg(track_id, ',' ORDER BY us, event_id) AS tracks
  FROM plays GROUP BY ALL)
SELECT window_start, window_start + {WIDE_SECONDS} AS window_end, session_id, slice_no, tracks
FROM slices WHERE (window_start + {WIDE_SECONDS}) * 1000000 <= {_CLOSED}""",
    "stream_sessions_append": f"""
WITH {PLAYS}, {TRACKS}, {WINDOWS}
SELECT *, track_count > 1 AS has_multiple_tracks FROM windows WHERE window_end * 1000000 <= {_CLOSED}""",
    "stream_sessions_update": f"""
WITH {PLAYS}, {TRACKS}, {WINDOWS} SELECT *, track_count > 1 AS has_multiple_tracks FROM windows""",
    "stream_late_data": f"""
WITH {EVENTS},
marked AS (
  SELECT *, us // {WIDE_SECONDS}000000 * {WIDE_SECONDS} AS window_start,
    user_id % {LATE_USERS} = 0 AS late FROM ev),
kept AS (
  SELECT * FROM marked WHERE NOT late OR (window_start + {WIDE_SECONDS}) * 1000000
    > (SELECT max(us) - {DELAY_US} FROM marked WHERE NOT late))
SELECT window_start, window_start + {WIDE_SECONDS} AS window_end, user_id, count(*) AS events FROM kept
WHERE (window_start + {WIDE_SECONDS}) * 1000000 <= (SELECT max(us) - {DELAY_US} FROM ev)
GROUP BY ALL""",
    "stream_recommendations": _RECS,
    "stream_play_log_recommendations": _RECS,
    "stream_sink_idempotent": f"WITH {PLAYS} SELECT event_id, user_id, track_id, session_id FROM plays",
    "stream_batch_metrics": f"""
WITH {EVENTS}
SELECT count(*) AS events, count(*) FILTER (event_type = 'play') AS plays, count(*) FILTER (event_type = 'skip') AS skips FROM ev""",
}
