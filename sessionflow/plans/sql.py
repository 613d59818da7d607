"""SQL fragments the comparison queries share: the domain views over the driver's tables."""

from __future__ import annotations

EVENTS = """
ev AS (
  SELECT event_id, user_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS track_id,
         user_id || '-' || strftime(ts, '%Y%m%d') AS session_id,
         ts AS event_time, epoch_us(ts) AS us,
         CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'play'
              WHEN event_type = 'error' THEN 'skip' ELSE event_type END AS event_type,
         CAST(floor(value) AS INTEGER) AS duration_played
  FROM events)"""

PLAYS = EVENTS + """,
plays AS (SELECT * FROM ev WHERE event_type = 'play')"""

TRACKS = """
tracks AS (
  SELECT p_partkey AS track_id, p_brand AS artist, p_name AS song_title, lower(p_type) AS genre,
         CASE p_size % 4 WHEN 0 THEN 'happy' WHEN 1 THEN 'sad' WHEN 2 THEN 'calm' ELSE 'neutral' END AS emotion
  FROM part)"""

BASKETS = """
baskets AS (
  SELECT l_orderkey AS session_id, o_custkey AS user_id, l_partkey AS track_id, l_linenumber AS line_no
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

SPACE = r"\s\x0B\x1C-\x1F\x85\p{Z}"


def strip(text: str) -> str:
    return f"regexp_replace({text}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"


def _name(text: str) -> str:
    return f"regexp_replace({strip(f'lower({text})')}, '[^\\p{{L}}\\p{{N}}_{SPACE}-]', '', 'g')"


def track_id(artist: str, title: str) -> str:
    return f"'track_' || substr(md5({_name(artist)} || '||' || {_name(title)}), 1, 12)"


def popularity(source: str) -> str:
    """pop: the five most played rows of a source, ranked."""
    return f"""
pop AS (
  SELECT track_id, CAST(n AS DOUBLE) / t AS weight, row_number() OVER (ORDER BY n DESC, track_id) AS rank
  FROM (SELECT track_id, count(*) AS n, (SELECT count(*) FROM {source}) AS t FROM {source} GROUP BY track_id)
  QUALIFY rank <= 5)"""


def model(source: str, keys: str, order: str) -> str:
    """sess (last track per session), pairs, top (ranked edges) and pop of a play source."""
    using = keys.replace(" ", "")
    return f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS pos,
         count(*) OVER (PARTITION BY {keys}) AS track_count,
         last_value(track_id) OVER (PARTITION BY {keys} ORDER BY {order}
           ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_track
  FROM {source}),
sess AS (SELECT {keys}, any_value(user_id) AS owner, any_value(last_track) AS last_track, count(*) AS track_count
         FROM ranked GROUP BY {using}),
pairs AS (
  SELECT last_track, track_id, count(*) AS pair_count
  FROM ranked WHERE track_count > 1 AND last_track <> track_id GROUP BY last_track, track_id),
weights AS (
  SELECT *, CAST(pair_count AS DOUBLE) / sum(pair_count) OVER (PARTITION BY last_track) AS weight FROM pairs),
edges AS (
  SELECT *, row_number() OVER (PARTITION BY last_track ORDER BY weight DESC, track_id) AS rank
  FROM weights QUALIFY rank <= 5),
moves AS (
  SELECT last_track, track_id, count(*) AS pair_count FROM (
    SELECT lag(track_id) OVER (PARTITION BY {keys} ORDER BY {order}) AS last_track, track_id FROM {source})
  WHERE last_track IS NOT NULL GROUP BY last_track, track_id),
move_edges AS (
  SELECT *, row_number() OVER (PARTITION BY last_track ORDER BY weight DESC, track_id) AS rank
  FROM (SELECT *, CAST(pair_count AS DOUBLE) / sum(pair_count) OVER (PARTITION BY last_track) AS weight FROM moves)
  QUALIFY rank <= 5),
{popularity(source).strip()}"""


def next_track(edges: str, strategy: str, keys: str) -> str:
    """recs: the chosen track per session, edges first, then popularity."""
    return f"""
recs AS (
  SELECT {keys}, s.last_track, s.track_count, s.owner,
         coalesce(e.track_id, p.track_id) AS next_track,
         CASE WHEN e.track_id IS NOT NULL THEN '{strategy}' ELSE 'popularity' END AS strategy,
         coalesce(e.weight, p.weight) AS weight
  FROM sess s
  LEFT JOIN (SELECT * FROM {edges} WHERE rank = 1) e ON e.last_track = s.last_track
  LEFT JOIN (SELECT * FROM pop WHERE rank = 1) p ON true)"""
