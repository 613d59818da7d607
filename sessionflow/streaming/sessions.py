"""Windowed sessions on a stream of plays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionflow.operators.sessions import window_sessions

# Watermark delay and tumbling window of the session stream.
DELAY = "1 minute"
WINDOW = "2 minutes"
PIECE_SECONDS = 10
KEYS = ("window", "session_id", "user_id")


def session_stream(plays: DataFrame, window: str = WINDOW, delay: str = DELAY, artist: str = "artist") -> DataFrame:
    """Session windows with count, first artist and last track. State per key is constant, however long the session."""
    return window_sessions(plays.withWatermark("event_time", delay), window, artist)


def session_piece_stream(
    plays: DataFrame,
    window: str = WINDOW,
    delay: str = DELAY,
    artist: str = "artist",
    piece_seconds: int = PIECE_SECONDS,
) -> DataFrame:
    """Session windows with their track lists, one row per slice of ``piece_seconds`` (which divides the window).

    The track list is kept per slice, so a session with very many plays spreads over the tasks. All slices of a
    window are final in the same micro-batch.
    """
    order = F.struct("event_time", "event_id")
    slice_no = F.floor(F.unix_timestamp("event_time") / piece_seconds)
    return (
        plays.withWatermark("event_time", delay)
        .groupBy(
            F.window("event_time", window).alias("window"), "session_id", "user_id", slice_no.alias("slice_no")
        )
        .agg(
            F.array_sort(F.collect_list(F.struct("event_time", "event_id", "track_id"))).alias("_plays"),
            F.count(F.lit(1)).alias("track_count"),
            F.min_by(artist, order).alias("first_artist"),
            F.max_by("track_id", order).alias("last_track"),
        )
        .select(
            "window",
            "session_id",
            "user_id",
            "slice_no",
            F.transform("_plays", lambda p: p["track_id"]).alias("tracks"),
            "track_count",
            "first_artist",
            "last_track",
        )
    )


def sessions_of_pieces(pieces: DataFrame) -> DataFrame:
    """One row per session window from its slices, inside a micro-batch."""
    return (
        pieces.groupBy(*KEYS)
        .agg(
            F.sum("track_count").alias("track_count"),
            F.min_by("first_artist", "slice_no").alias("first_artist"),
            F.max_by("last_track", "slice_no").alias("last_track"),
        )
        .withColumn("has_multiple_tracks", F.col("track_count") > 1)
        .withColumn("processing_time", F.current_timestamp())
    )
