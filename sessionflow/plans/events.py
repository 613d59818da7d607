"""Event queries: JSON messages, event time, play filter, enrichment, sessions by inactivity, batch counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionflow.functions.times import format_iso
from sessionflow.operators.lengths import DEFAULT_SECONDS, LEAST_PLAYS, length_sketches, merge_sketches, typical_lengths
from sessionflow.operators.profiles import classify_play
from sessionflow.operators.sessions import assign_sessions
from sessionflow.operators.skew import lookup_join
from sessionflow.plans.sql import EVENTS, PLAYS, TRACKS
from sessionflow.sources import bindings as B
from sessionflow.sources import events as E

GAP_SECONDS = 8 * 3600


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    devices = F.array(F.lit("mobile"), F.lit("desktop"), F.lit("tablet"))
    enriched = E.enrich(B.events(spark, sf_dir), B.tracks(spark, sf_dir), B.skew_of(spark, sf_dir, "events")).withColumn(
        "device_type", F.get(devices, F.pmod("event_id", F.lit(3)).cast("int"))
    )
    return E.to_event_record(enriched)


def event_json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.encode(_records(spark, sf_dir)).select(F.col("key").alias("event_key"), F.col("value").alias("event_json"))


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as messages with the defects a topic has: (event_id, value binary).

    Some texts are cut off, some times are unreadable, some have no fraction, some user ids are numbers, and every
    message has a field nobody knows.
    """
    event_id = F.col("event_id")
    time = (
        F.when(event_id % 89 == 0, F.lit("junk"))
        .when(event_id % 4 == 1, F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss"))
        .when(event_id % 4 == 2, F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SS"))
        .otherwise(format_iso(F.col("event_time")))
    )
    rest = [
        F.col("track_id").cast("string").alias("track_id"),
        F.col("session_id"),
        time.alias("timestamp"),
        F.col("event_type"),
        F.lit("?").alias("x"),
    ]
    text = F.to_json(F.struct(F.col("user_id").cast("string").alias("user_id"), *rest))
    with_number = F.to_json(F.struct(F.col("user_id").alias("user_id"), *rest))
    value = F.when(event_id % 97 == 0, F.substring(text, 1, 20)).when(event_id % 83 == 0, with_number).otherwise(text)
    events = B.spread(B.table(spark, sf_dir, "events"), "event_id")
    return B.listening_events(events).select("event_id", value.cast("binary").alias("value"))


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.decode(raw_messages(spark, sf_dir).withColumnRenamed("event_id", "message_id"), carry=("message_id",))


def event_json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = [F.coalesce(c, F.lit("")).alias(c) for c in ("user_id", "track_id", "session_id", "event_type")]
    return _decoded(spark, sf_dir).select("message_id", *text, F.col(E.CORRUPT).isNotNull().alias("is_corrupt"))


def event_time_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = E.with_event_time(E.valid_events(_decoded(spark, sf_dir)))
    return timed.select(
        "message_id", F.coalesce(F.unix_micros("event_time"), F.lit(-1).cast("bigint")).alias("event_us")
    )


def plays_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    played = E.plays_of(E.valid_events(_decoded(spark, sf_dir)))
    return played.select("message_id", "user_id", "track_id", F.unix_micros("event_time").alias("event_us"))


def event_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = E.enrich(B.plays(spark, sf_dir), B.tracks(spark, sf_dir), B.skew_of(spark, sf_dir, "events"))
    return enriched.select("event_id", "user_id", "track_id", "artist", "song_title", "genre", "emotion")


def session_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = assign_sessions(B.events(spark, sf_dir), "user_id", GAP_SECONDS, B.skew_of(spark, sf_dir, "events"))
    return assigned.select("event_id", "user_id", "session_no", "session_start_us")


def play_skip_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events against the typical length of their track, which the plays themselves give."""
    skew = B.skew_of(spark, sf_dir, "events")
    typical = typical_lengths(length_sketches(B.plays(spark, sf_dir)), B.tracks(spark, sf_dir), skew=skew)
    joined = lookup_join(B.events(spark, sf_dir), typical, ["track_id"], "left", skew)
    known = F.coalesce("typical", F.lit(DEFAULT_SECONDS).cast("bigint"))
    return joined.select("event_id", "duration_played", classify_play(F.col("duration_played"), known).alias("outcome"))


def typical_play_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typical length of every track, from sketches of two halves of the plays united."""
    plays, tracks = B.plays(spark, sf_dir), B.tracks(spark, sf_dir)
    halves = [length_sketches(plays.filter(F.col("event_id") % 2 == i)) for i in range(2)]
    united = merge_sketches(halves[0].unionByName(halves[1]), "track_id")
    return typical_lengths(united, tracks, skew=B.skew_of(spark, sf_dir, "events"))


def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = E.with_event_time(_decoded(spark, sf_dir))
    return decoded.agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col(E.CORRUPT).isNotNull()).alias("corrupt"),
        F.count_if(F.col(E.CORRUPT).isNull() & F.col("event_time").isNull()).alias("bad_time"),
        F.count_if(E.is_play()).alias("plays"),
    )


QUERIES = {
    "event_json_encode": event_json_encode,
    "event_json_parse": event_json_parse,
    "event_time_parse": event_time_parse,
    "plays_filter": plays_filter,
    "event_enrichment": event_enrichment,
    "session_assign": session_assign,
    "play_skip_classify": play_skip_classify,
    "batch_metrics": batch_metrics,
    "typical_play_lengths": typical_play_lengths,
}

_TYPICAL = f"""
own AS (SELECT track_id, count(*) AS n, quantile_disc(duration_played, 0.5) AS med FROM plays GROUP BY track_id),
of_genre AS (SELECT genre, quantile_disc(duration_played, 0.5) AS med FROM plays JOIN tracks USING (track_id) GROUP BY genre),
typical AS (
  SELECT t.track_id, CAST(coalesce(CASE WHEN o.n >= {LEAST_PLAYS} THEN o.med END, g.med, {DEFAULT_SECONDS}) AS BIGINT) AS typical
  FROM tracks t LEFT JOIN own o USING (track_id) LEFT JOIN of_genre g USING (genre))"""

_MESSAGES = EVENTS + """,
msg AS (
  SELECT event_id AS message_id, event_id % 97 = 0 AS is_corrupt, event_id % 89 = 0 AS bad_time,
         CAST(user_id AS VARCHAR) AS user_id, CAST(track_id AS VARCHAR) AS track_id, session_id, event_type,
         CASE event_id % 4 WHEN 1 THEN us - us % 1000000 WHEN 2 THEN us - us % 10000 ELSE us END AS event_us
  FROM ev)"""

ORACLES = {
    "event_json_encode": f"""
WITH {EVENTS}, {TRACKS}
SELECT CAST(e.user_id AS VARCHAR) AS event_key,
  '{{"event_id":"' || e.event_id || '","user_id":"' || e.user_id || '","track_id":"' || e.track_id
  || '","artist":"' || t.artist || '","song_title":"' || t.song_title
  || '","timestamp":"' || strftime(e.event_time, '%Y-%m-%dT%H:%M:%S.%f')
  || '","session_id":"' || e.session_id || '","event_type":"' || e.event_type
  || '","duration_played":' || e.duration_played || ',"genre":"' || t.genre || '","emotion":"' || t.emotion
  || '","device_type":"' || CASE e.event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END
  || '"}}' AS event_json
FROM ev e JOIN tracks t USING (track_id)""",
    "event_json_parse": f"""
WITH {_MESSAGES}
SELECT message_id, is_corrupt,
  CASE WHEN is_corrupt THEN '' ELSE user_id END AS user_id,
  CASE WHEN is_corrupt THEN '' ELSE track_id END AS track_id,
  CASE WHEN is_corrupt THEN '' ELSE session_id END AS session_id,
  CASE WHEN is_corrupt THEN '' ELSE event_type END AS event_type
FROM msg""",
    "event_time_parse": f"""
WITH {_MESSAGES}
SELECT message_id, CASE WHEN bad_time THEN -1 ELSE event_us END AS event_us FROM msg WHERE NOT is_corrupt""",
    "plays_filter": f"""
WITH {_MESSAGES}
SELECT message_id, user_id, track_id, event_us FROM msg
WHERE NOT is_corrupt AND NOT bad_time AND event_type = 'play'""",
    "event_enrichment": f"""
WITH {PLAYS}, {TRACKS}
SELECT event_id, user_id, track_id, artist, song_title, genre, emotion FROM plays LEFT JOIN tracks USING (track_id)""",
    "session_assign": f"""
WITH {EVENTS},
marked AS (
  SELECT *, CASE WHEN us - lag(us) OVER w > {GAP_SECONDS}000000 OR lag(us) OVER w IS NULL THEN 1 ELSE 0 END AS is_new
  FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)),
numbered AS (
  SELECT *, CAST(sum(is_new) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT)
    AS session_no FROM marked)
SELECT event_id, user_id, session_no, min(us) OVER (PARTITION BY user_id, session_no) AS session_start_us
FROM numbered""",
    "play_skip_classify": f"""
WITH {PLAYS}, {TRACKS}, {_TYPICAL}, timed AS (
  SELECT event_id, duration_played, coalesce(typical, {DEFAULT_SECONDS}) AS typical FROM ev LEFT JOIN typical USING (track_id))
SELECT event_id, duration_played,
  CASE WHEN duration_played >= floor(typical * CAST(0.7 AS DOUBLE)) THEN 'play'
       WHEN duration_played <= least(typical, 30) THEN 'skip' ELSE 'partial' END AS outcome
FROM timed""",
    "typical_play_lengths": f"""
WITH {PLAYS}, {TRACKS}, {_TYPICAL}
SELECT track_id, typical FROM typical""",
    "batch_metrics": f"""
WITH {_MESSAGES}
SELECT count(*) AS messages, count(*) FILTER (is_corrupt) AS corrupt, count(*) FILTER (bad_time AND NOT is_corrupt) AS bad_time,
  count(*) FILTER (NOT is_corrupt AND NOT bad_time AND event_type = 'play') AS plays FROM msg""",
}
