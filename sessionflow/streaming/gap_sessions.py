"""Sessions by inactivity gap on a stream: merging windows in state, final once the watermark has passed them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionflow.operators.sessions import summary_columns
from sessionflow.streaming.sessions import DELAY

# Fixed value: the pause after which a user's next event opens a new session.
GAP_SECONDS = 8 * 3600
#: Merges the events of a session inside each task before the shuffle, so that a user with very many events sends little.
MERGE_FIRST = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def gap_session_stream(events: DataFrame, user: str = "user_id", gap_seconds: int = GAP_SECONDS, delay: str = DELAY) -> DataFrame:
    """(user, window, events, first_us, last_us, first_track, last_track) of the closed sessions of a stream of events.

    A session ends with an event that the user's next one follows after more than the gap; the window goes on for the gap
    and a microsecond, so that an event exactly one gap later still belongs to it, as in ``assign_sessions``. State is one
    row per open session, whatever its events. Late events join or bridge sessions as long as these are open. Events without
    a time or a user are dropped: they belong to no session.
    """
    events.sparkSession.conf.set(MERGE_FIRST, "true")
    usable = events.filter(F.col("event_time").isNotNull() & F.col(user).isNotNull()).withColumn("_track", F.col("track_id"))
    order = ("event_time", "event_id")
    return (
        usable.withWatermark("event_time", delay)
        .groupBy(F.session_window("event_time", f"{gap_seconds} seconds 1 microsecond").alias("window"), user)
        .agg(
            *[c for c in summary_columns("_track", order)],
            F.min(F.unix_micros("event_time")).alias("first_us"),
            F.max(F.unix_micros("event_time")).alias("last_us"),
        )
        .select(user, "window", F.col("track_count").alias("events"), "first_us", "last_us", F.col("first_artist").alias("first_track"), "last_track")
    )
