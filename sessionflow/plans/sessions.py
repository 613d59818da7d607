"""Session queries over baskets (orders) and plays (events)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionflow.operators import sessions as S
from sessionflow.operators.recommend import enrich_sessions, generate_recommendations
from sessionflow.operators.skew import hot_keys
from sessionflow.plans.sql import BASKETS, PLAYS, TRACKS, model, next_track
from sessionflow.sources import bindings as B
from sessionflow.sources import events as E

WIDE_WINDOW = "6 hours"
WIDE_SECONDS = 6 * 3600
SHORT_PIECE = 4
KEYS = ("user_id", "session_id")


def window_bounds() -> list:
    return [
        F.unix_seconds("window.start").alias("window_start"),
        F.unix_seconds("window.end").alias("window_end"),
    ]


def _window_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    plays = E.enrich(B.plays(spark, sf_dir), B.tracks(spark, sf_dir), B.skew_of(spark, sf_dir, "events"))
    return S.window_sessions(plays, WIDE_WINDOW)


def session_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _window_sessions(spark, sf_dir).select(
        *window_bounds(), "session_id", "user_id", "track_count", "first_artist", "last_track", "has_multiple_tracks"
    )


def session_track_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    skew = B.skew_of(spark, sf_dir, "lineitem")
    lists = S.track_lists(B.baskets(spark, sf_dir), ["session_id"], B.BASKET_ORDER, SHORT_PIECE, skew)
    return lists.select("session_id", "piece_no", F.array_join("tracks", ",").alias("tracks"))


def basket_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.last_tracks(B.baskets(spark, sf_dir), ["session_id"], B.BASKET_ORDER)


def session_last_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        basket_sessions(spark, sf_dir)
        .join(B.basket_users(spark, sf_dir), "session_id")
        .select("session_id", "user_id", "last_track")
    )


def multi_track_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.multi_track_sessions(basket_sessions(spark, sf_dir)).select("session_id", "last_track", "track_count")


def recent_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    skew = B.skew_of(spark, sf_dir, "events")
    recent = S.recent_tracks(B.plays(spark, sf_dir), "user_id", B.EVENT_ORDER, skew=skew)
    return recent.select("event_id", "user_id", F.array_join("recent_tracks", ",").alias("recent_tracks"))


def enriched_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    skew = B.skew_of(spark, sf_dir, "events")
    plays = B.plays(spark, sf_dir)
    hot = None if skew is None else hot_keys(plays, KEYS, skew)
    recommendations = generate_recommendations(plays, KEYS, B.EVENT_ORDER, skew=skew)
    return enrich_sessions(_window_sessions(spark, sf_dir), recommendations, KEYS, skew, hot).select(
        *window_bounds(), *KEYS, "track_count", "last_track", "recommended_track", "rec_strategy"
    )


QUERIES = {
    "session_summary": session_summary,
    "session_track_lists": session_track_lists,
    "session_last_track": session_last_track,
    "multi_track_sessions": multi_track_sessions,
    "recent_tracks": recent_tracks,
    "enriched_sessions": enriched_sessions,
}

WINDOWS = f"""
windows AS (
  SELECT CAST(floor(us / {WIDE_SECONDS}000000.0) AS BIGINT) * {WIDE_SECONDS} AS window_start,
         CAST(floor(us / {WIDE_SECONDS}000000.0) AS BIGINT) * {WIDE_SECONDS} + {WIDE_SECONDS} AS window_end,
         session_id, user_id, count(*) AS track_count,
         arg_min(artist, (us, event_id)) AS first_artist, arg_max(track_id, (us, event_id)) AS last_track
  FROM plays LEFT JOIN tracks USING (track_id) GROUP BY ALL)"""

ORACLES = {
    "session_summary": f"""
WITH {PLAYS}, {TRACKS}, {WINDOWS}
SELECT *, track_count > 1 AS has_multiple_tracks FROM windows""",
    "session_track_lists": f"""
WITH {BASKETS},
placed AS (
  SELECT *, (row_number() OVER (PARTITION BY session_id ORDER BY line_no, track_id) - 1) // {SHORT_PIECE} AS piece_no
  FROM baskets)
SELECT session_id, piece_no, string_agg(track_id, ',' ORDER BY line_no, track_id) AS tracks
FROM placed GROUP BY session_id, piece_no""",
    "session_last_track": f"""
WITH {BASKETS}
SELECT session_id, user_id, arg_max(track_id, (line_no, track_id)) AS last_track
FROM baskets GROUP BY session_id, user_id""",
    "multi_track_sessions": f"""
WITH {BASKETS}
SELECT session_id, arg_max(track_id, (line_no, track_id)) AS last_track, count(*) AS track_count
FROM baskets GROUP BY session_id HAVING count(*) > 1""",
    "recent_tracks": f"""
WITH {PLAYS}
SELECT event_id, user_id, coalesce(array_to_string(list(track_id) OVER (
  PARTITION BY user_id ORDER BY us, event_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), ','), '') AS recent_tracks
FROM plays""",
    "enriched_sessions": f"""
WITH {PLAYS}, {TRACKS}, {WINDOWS}, {model("plays", "user_id, session_id", "us, event_id")},
{next_track("edges", "cooccurrence", "s.user_id, s.session_id")}
SELECT window_start, window_end, w.user_id, w.session_id, w.track_count, w.last_track,
  r.next_track AS recommended_track, r.strategy AS rec_strategy
FROM windows w LEFT JOIN recs r ON r.user_id = w.user_id AND r.session_id = w.session_id""",
}
