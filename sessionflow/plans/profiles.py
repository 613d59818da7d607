"""Profile queries: engagement, taste profiles, candidates, seeded draws."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionflow.operators import candidates as K
from sessionflow.operators import profiles as P
from sessionflow.operators.skew import SkewPolicy
from sessionflow.plans.sql import EVENTS, TRACKS
from sessionflow.sources import bindings as B
from sessionflow.sources import events as E
from sessionflow.storage import hand_off

PICK_SEED = "pick"
TASTE_SEED = "taste"


def _heard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.enrich(B.events(spark, sf_dir), B.tracks(spark, sf_dir), B.skew_of(spark, sf_dir, "events"))


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.user_profiles(_heard(spark, sf_dir), B.EVENT_ORDER)


def engagement_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.engagement_stats(_heard(spark, sf_dir))


def user_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profiles(spark, sf_dir).select(
        P.user_name(F.col("user_id")).alias("user_name"),
        F.array_join("preferred_genres", ",").alias("preferred_genres"),
        F.array_join("preferred_emotions", ",").alias("preferred_emotions"),
        F.array_join("recent_tracks", ",").alias("recent_tracks"),
        "skip_rate",
    )


def _stored_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles as a written table: the candidate operators read them several times."""
    return hand_off(_profiles(spark, sf_dir), "profiles")


def _skew(spark: SparkSession, sf_dir: str) -> SkewPolicy | None:
    return B.skew_of(spark, sf_dir, "events", "part")


def preference_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = K.candidate_segments(
        _stored_profiles(spark, sf_dir), B.tracks(spark, sf_dir), _skew(spark, sf_dir)
    )
    return segments.select("user_id", "n_preferred", "matched")


def recent_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    tracks = B.tracks(spark, sf_dir)
    skew = _skew(spark, sf_dir)
    segments = hand_off(K.candidate_segments(_stored_profiles(spark, sf_dir), tracks, skew), "segments")
    return K.exclude_recent(segments, K.track_positions(tracks, skew), skew).select(
        "user_id",
        "n_preferred",
        F.size("excluded").cast("bigint").alias("n_excluded"),
        "n_available",
    )


def candidate_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.pick_candidate(
        _stored_profiles(spark, sf_dir), B.tracks(spark, sf_dir), PICK_SEED, _skew(spark, sf_dir)
    )


def weighted_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two artists per customer, drawn with the number of tracks of each artist as weight."""
    users = B.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    weights = B.tracks(spark, sf_dir).groupBy("artist").agg(F.count(F.lit(1)).alias("tracks"))
    return P.weighted_pick(users, weights, "artist", "tracks", TASTE_SEED, 2).withColumn(
        "pick_no", F.col("pick_no").cast("bigint")
    )


def taste_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two genres and one emotion per user, drawn without replacement by the user's plays of them."""
    plays = E.enrich(B.plays(spark, sf_dir), B.tracks(spark, sf_dir), B.skew_of(spark, sf_dir, "events"))
    return P.taste_draw(plays, TASTE_SEED)


QUERIES = {
    "engagement_stats": engagement_stats,
    "user_profiles": user_profiles,
    "preference_candidates": preference_candidates,
    "recent_exclusion": recent_exclusion,
    "candidate_pick": candidate_pick,
    "weighted_pick": weighted_pick,
    "taste_draw": taste_draw,
}

_HEARD = f"""
{EVENTS}, {TRACKS},
heard AS (
  SELECT ev.*, genre, emotion FROM ev LEFT JOIN tracks USING (track_id) WHERE event_type IN ('play', 'skip')),
played AS (SELECT * FROM heard WHERE event_type = 'play')"""
_STATS = """
count(*) AS events,
  CAST(count(*) FILTER (event_type = 'skip') AS DOUBLE) / count(*) AS skip_rate,
  coalesce(CAST(sum(duration_played) FILTER (event_type = 'play') AS DOUBLE)
    / nullif(count(*) FILTER (event_type = 'play'), 0), 180.0) AS average_play_duration"""
_PROFILES = f"""
{_HEARD},
genres AS (
  SELECT user_id, genre, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, genre) AS rank
  FROM played WHERE genre IS NOT NULL GROUP BY user_id, genre QUALIFY rank <= 2),
emotions AS (
  SELECT user_id, emotion, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, emotion) AS rank
  FROM played WHERE emotion IS NOT NULL GROUP BY user_id, emotion QUALIFY rank <= 1),
recent AS (
  SELECT user_id, track_id, us, event_id,
    row_number() OVER (PARTITION BY user_id ORDER BY us DESC, event_id DESC) AS back
  FROM played QUALIFY back <= 5)"""
_CANDIDATES = f"""
{_PROFILES},
matches AS (
  SELECT u.user_id, t.track_id, t.genre, t.emotion, g.rank AS genre_rank,
    EXISTS (SELECT 1 FROM recent r WHERE r.user_id = u.user_id AND r.track_id = t.track_id) AS is_recent
  FROM (SELECT DISTINCT user_id FROM played) u CROSS JOIN tracks t
  LEFT JOIN genres g ON g.user_id = u.user_id AND g.genre = t.genre
  LEFT JOIN emotions e ON e.user_id = u.user_id AND e.emotion = t.emotion
  WHERE g.rank IS NOT NULL OR e.rank IS NOT NULL),
sizes AS (
  SELECT user_id, count(*) AS n_preferred, count(*) FILTER (is_recent) AS n_recent FROM matches GROUP BY user_id),
available AS (
  SELECT m.*, row_number() OVER (
    PARTITION BY m.user_id ORDER BY coalesce(genre_rank, 99), genre, track_id) - 1 AS place,
    count(*) OVER (PARTITION BY m.user_id) AS n
  FROM matches m JOIN sizes s USING (user_id) WHERE NOT is_recent OR n_recent = n_preferred)"""

ORACLES = {
    "engagement_stats": f"""
WITH {_HEARD}
SELECT 'all' AS scope, '' AS key, {_STATS} FROM heard
UNION ALL SELECT 'genre', genre, {_STATS} FROM heard GROUP BY genre
UNION ALL SELECT 'user', CAST(user_id AS VARCHAR), {_STATS} FROM heard GROUP BY user_id""",
    "user_profiles": f"""
WITH {_PROFILES}
SELECT 'user_' || CASE WHEN user_id < 100 THEN lpad(CAST(user_id AS VARCHAR), 3, '0') ELSE CAST(user_id AS VARCHAR) END
    AS user_name,
  coalesce((SELECT string_agg(genre, ',' ORDER BY rank) FROM genres g WHERE g.user_id = u.user_id), '') AS preferred_genres,
  coalesce((SELECT string_agg(emotion, ',' ORDER BY rank) FROM emotions e WHERE e.user_id = u.user_id), '') AS preferred_emotions,
  (SELECT string_agg(track_id, ',' ORDER BY back DESC) FROM recent r WHERE r.user_id = u.user_id) AS recent_tracks,
  (SELECT CAST(count(*) FILTER (event_type = 'skip') AS DOUBLE) / count(*) FROM heard) AS skip_rate
FROM (SELECT DISTINCT user_id FROM played) u""",
    "preference_candidates": f"""
WITH {_CANDIDATES} SELECT user_id, n_preferred, true AS matched FROM sizes""",
    "recent_exclusion": f"""
WITH {_CANDIDATES}
SELECT user_id, n_preferred, CASE WHEN n_recent = n_preferred THEN 0 ELSE n_recent END AS n_excluded,
  CASE WHEN n_recent = n_preferred THEN n_preferred ELSE n_preferred - n_recent END AS n_available FROM sizes""",
    "candidate_pick": f"""
WITH {_CANDIDATES}
SELECT user_id, track_id FROM available
WHERE place = CAST('0x' || substr(md5(user_id || '#{PICK_SEED}'), 1, 15) AS BIGINT) % n""",
    "weighted_pick": f"""
WITH {TRACKS},
weights AS (SELECT artist, count(*) AS w FROM tracks GROUP BY artist),
line AS (SELECT artist, CAST(sum(w) OVER (ORDER BY md5(artist), artist) AS BIGINT) AS high, w FROM weights),
drawn AS (
  SELECT c_custkey AS user_id, pick_no, CAST('0x' || substr(md5(c_custkey || '#' || pick_no || '#{TASTE_SEED}'), 1, 15)
    AS BIGINT) % (SELECT count(*) FROM tracks) AS spot
  FROM customer CROSS JOIN (SELECT unnest([1, 2]) AS pick_no))
SELECT user_id, CAST(pick_no AS BIGINT) AS pick_no, artist FROM drawn JOIN line ON spot >= high - w AND spot < high""",
    "taste_draw": f"""
WITH {_HEARD},
counted AS (
  SELECT user_id, 'genre' AS dim, genre AS value, 2 AS k, count(*) AS n FROM played WHERE genre IS NOT NULL GROUP BY user_id, genre
  UNION ALL
  SELECT user_id, 'emotion', emotion, 1, count(*) FROM played WHERE emotion IS NOT NULL GROUP BY user_id, emotion),
keyed AS (
  SELECT *, -ln((CAST('0x' || substr(md5(user_id || '#' || value || '#{TASTE_SEED}-' || dim), 1, 15) AS BIGINT) + 1)
    / CAST({1 << 60} AS DOUBLE)) / n AS key FROM counted)
SELECT user_id, dim, CAST(row_number() OVER (PARTITION BY user_id, dim ORDER BY key, value) AS BIGINT) AS pick_no, value
FROM keyed QUALIFY pick_no <= k""",
}
