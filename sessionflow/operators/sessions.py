"""Session operators: summaries, track lists, last track, recent tracks, session assignment by inactivity gap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionflow.operators.skew import (
    DEFAULT_SKEW,
    HotKeys,
    SkewPolicy,
    hot_keys,
    lookup_join,
    with_position,
    with_previous,
)

#: Longest track list in one output row; a longer session continues in further rows.
LIST_PIECE = 1000


def _order(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def last_tracks(plays: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """(keys, last_track, track_count). The last track is that of the greatest order value, combined map-side."""
    return plays.groupBy(*keys).agg(
        F.max_by("track_id", _order(order)).alias("last_track"),
        F.count(F.lit(1)).alias("track_count"),
    )


def multi_track_sessions(sessions: DataFrame) -> DataFrame:
    """Sessions with more than one play."""
    return sessions.filter(F.col("track_count") > 1)


def track_lists(
    plays: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    piece: int = LIST_PIECE,
    skew: SkewPolicy | None = DEFAULT_SKEW,
) -> DataFrame:
    """(keys, piece_no, tracks): each session's tracks in order, cut into rows of at most ``piece`` tracks.

    Nothing is dropped; a session of any length is a sequence of bounded arrays, so no task has to hold it whole.
    """
    return (
        with_position(plays, keys, order, "_pos", skew)
        .withColumn("piece_no", F.floor(F.col("_pos") / piece))
        .groupBy(*keys, "piece_no")
        .agg(F.array_sort(F.collect_list(F.struct("_pos", "track_id"))).alias("_list"))
        .select(*keys, "piece_no", F.transform("_list", lambda e: e["track_id"]).alias("tracks"))
    )


def summary_columns(artist: str = "artist", order: Sequence[str] = ("event_time", "event_id")) -> list[Column]:
    """The aggregates of a session window; constant state per key, on a stream too."""
    return [
        F.count(F.lit(1)).alias("track_count"),
        F.min_by(artist, _order(order)).alias("first_artist"),
        F.max_by("track_id", _order(order)).alias("last_track"),
    ]


def window_sessions(plays: DataFrame, window: str = "2 minutes", artist: str = "artist") -> DataFrame:
    """Tumbling-window sessions: (window, session_id, user_id, track_count, first_artist, last_track, flag)."""
    return (
        plays.groupBy(F.window("event_time", window).alias("window"), "session_id", "user_id")
        .agg(*summary_columns(artist))
        .withColumn("has_multiple_tracks", F.col("track_count") > 1)
    )


def recent_tracks(
    events: DataFrame, user: str, order: Sequence[str], n: int = 5, skew: SkewPolicy | None = DEFAULT_SKEW
) -> DataFrame:
    """Each event with the ``n`` tracks its user played just before it, oldest first."""
    return with_previous(events, [user], order, "track_id", n, "recent_tracks", skew)


def last_n_tracks(events: DataFrame, user: str, order: Sequence[str], n: int = 5) -> DataFrame:
    """(user, recent_tracks): each user's last ``n`` plays, oldest first. Each task ranks and keeps ``n`` per user."""
    newest = Window.partitionBy(user).orderBy(*[F.desc(c) for c in order])
    return (
        events.withColumn("_back", F.row_number().over(newest))
        .filter(F.col("_back") <= n)
        .groupBy(user)
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("_back")).alias("o"), "track_id"))).alias("_list"))
        .select(user, F.transform("_list", lambda e: e["track_id"]).alias("recent_tracks"))
    )


def _gap_bucket(micros: Column, gap_seconds: int) -> Column:
    """Start of the gap-wide time bucket, in microseconds."""
    return micros - F.pmod(micros, F.lit(gap_seconds * 1_000_000))


def session_starts(events: DataFrame, user: str, gap_seconds: int) -> DataFrame:
    """(user, bucket, session_no, session_start_us): sessions split where a user pauses longer than the gap.

    Two events of a user in the same gap-wide bucket are always in one session. So events shrink to the first and last
    time per bucket before the shuffle, and the window per user runs over at most history/gap rows.
    """
    gap = F.lit(gap_seconds * 1_000_000)
    spans = (
        events.select(user, F.unix_micros("event_time").alias("_us"))
        .groupBy(user, _gap_bucket(F.col("_us"), gap_seconds).alias("bucket"))
        .agg(F.min("_us").alias("_first"), F.max("_us").alias("_last"))
    )
    by_time = Window.partitionBy(user).orderBy("bucket")
    running = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.lag("_last").over(by_time)
    return (
        spans.withColumn("_new", before.isNull() | (F.col("_first") - before > gap))
        .withColumn("session_no", F.sum(F.col("_new").cast("long")).over(running))
        .withColumn("session_start_us", F.max(F.when(F.col("_new"), F.col("_first"))).over(running))
        .select(user, "bucket", "session_no", "session_start_us")
    )


def assign_sessions(
    events: DataFrame, user: str = "user_id", gap_seconds: int = 8 * 3600, skew: SkewPolicy | None = DEFAULT_SKEW
) -> DataFrame:
    """Add session_no (from 1 per user) and session_start_us to every event.

    One window per user. Hot users go the other way: their sessions come from bucket spans and are joined back.
    """
    hot = HotKeys((user,), None) if skew is None else hot_keys(events, [user], skew)
    if hot.table is None:
        return _assign_by_window(events, user, gap_seconds)
    heavy = F.broadcast(hot.table.select(user))
    of_heavy = events.join(heavy, user, "left_semi")
    bucketed = of_heavy.withColumn("bucket", _gap_bucket(F.unix_micros("event_time"), gap_seconds))
    joined = lookup_join(bucketed, session_starts(of_heavy, user, gap_seconds), [user, "bucket"], skew=skew)
    return _assign_by_window(events.join(heavy, user, "left_anti"), user, gap_seconds).unionByName(
        joined.drop("bucket")
    )


def _assign_by_window(events: DataFrame, user: str, gap_seconds: int) -> DataFrame:
    by_time = Window.partitionBy(user).orderBy("_us")
    before = F.lag("_us").over(by_time)
    is_new = before.isNull() | (F.col("_us") - before > F.lit(gap_seconds * 1_000_000))
    return (
        events.withColumn("_us", F.unix_micros("event_time"))
        .withColumn("_new", is_new)
        .withColumn("session_no", F.sum(F.col("_new").cast("long")).over(by_time))
        .withColumn("session_start_us", F.max(F.when(F.col("_new"), F.col("_us"))).over(by_time))
        .drop("_us", "_new")
    )


def assign_from_sessions(
    events: DataFrame, sessions: DataFrame, user: str = "user_id", gap_seconds: int = 8 * 3600, skew: SkewPolicy | None = DEFAULT_SKEW
) -> DataFrame:
    """The events of stored sessions (user, first_us, last_us) with session_no (from 1 per user) and session_start_us.

    All events of a user in one gap-wide bucket belong to one session, so a session is found by an equality join on its
    buckets. Events of sessions that are not stored are left out.
    """
    by_start = Window.partitionBy(user).orderBy("first_us")
    step = F.lit(gap_seconds * 1_000_000).cast("bigint")
    numbered = sessions.withColumn("session_no", F.row_number().over(by_start).cast("long"))
    buckets = numbered.select(
        user,
        F.col("first_us").alias("session_start_us"),
        F.col("last_us").alias("_last"),
        "session_no",
        F.explode(F.sequence(_gap_bucket(F.col("first_us"), gap_seconds), _gap_bucket(F.col("last_us"), gap_seconds), step)).alias("_bucket"),
    )
    us = F.unix_micros("event_time")
    joined = lookup_join(events.withColumn("_bucket", _gap_bucket(us, gap_seconds)), buckets, [user, "_bucket"], "inner", skew)
    return joined.filter(us.between(F.col("session_start_us"), F.col("_last"))).drop("_bucket", "_last")
