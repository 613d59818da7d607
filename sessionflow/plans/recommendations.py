"""Popularity, co-occurrence, transition and combined recommendation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionflow.operators import edges as G
from sessionflow.operators import popularity as P
from sessionflow.operators import recommend as R
from sessionflow.operators.sessions import last_tracks
from sessionflow.operators.skew import SkewPolicy
from sessionflow.plans.sql import BASKETS, PLAYS, model, next_track
from sessionflow.sources import bindings as B

TOP_N = R.DEFAULT_TOP_N
SESSION = ["session_id"]
USER_SESSION = ["user_id", "session_id"]


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.play_counts(B.baskets(spark, sf_dir))


def track_play_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir)


def popularity_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.popularity_weights(_counts(spark, sf_dir))


def popularity_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.popularity_topn(_counts(spark, sf_dir), TOP_N)


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_tracks(B.baskets(spark, sf_dir), SESSION, B.BASKET_ORDER)


def _skew(spark: SparkSession, sf_dir: str) -> SkewPolicy | None:
    return B.skew_of(spark, sf_dir, "lineitem")


def cooccurrence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.cooccurrence_counts(B.baskets(spark, sf_dir), SESSION, B.BASKET_ORDER, _skew(spark, sf_dir))


def cooccurrence_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.edge_weights(cooccurrence_counts(spark, sf_dir), "cooccurrence_weight", _skew(spark, sf_dir))


def cooccurrence_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.edge_topn(cooccurrence_counts(spark, sf_dir), TOP_N, "cooccurrence_weight").withColumn(
        "rank", F.col("rank").cast("bigint")
    )


def cooccurrence_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cooccurrence_counts(spark, sf_dir).agg(
        F.count_distinct("last_track").alias("last_tracks"),
        F.count_distinct("track_id").alias("tracks"),
        F.count(F.lit(1)).alias("pairs"),
    )


def recommendations_cooc(spark: SparkSession, sf_dir: str) -> DataFrame:
    topn = G.edge_topn(cooccurrence_counts(spark, sf_dir), TOP_N, "cooccurrence_weight")
    skew = _skew(spark, sf_dir)
    hot = R.hot_last_tracks(B.baskets(spark, sf_dir), skew)
    return R.session_edge_lists(_sessions(spark, sf_dir), topn, "cooccurrence_weight", skew, hot).select(
        "session_id",
        "last_track",
        F.coalesce(F.array_join(F.transform("recs", lambda r: r["track"].cast("string")), ","), F.lit("")).alias(
            "tracks"
        ),
        F.coalesce(F.size("recs"), F.lit(0)).cast("bigint").alias("n_tracks"),
        F.coalesce(F.get("recs", F.lit(0))["weight"], F.lit(0.0)).alias("top_weight"),
    )


def _recommended(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.generate_recommendations(
        B.baskets(spark, sf_dir), SESSION, B.BASKET_ORDER, TOP_N, _skew(spark, sf_dir)
    )


def _play_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.generate_recommendations(
        B.plays(spark, sf_dir), USER_SESSION, B.EVENT_ORDER, TOP_N, B.skew_of(spark, sf_dir, "events")
    )


def _next_columns() -> list:
    chosen = F.col("next_track_recommendation")
    return [
        "last_track",
        chosen["track"].alias("next_track"),
        chosen["strategy"].alias("strategy"),
        chosen["weight"].alias("weight"),
    ]


def recommendations_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    def tracks(field: str):
        return F.array_join(F.transform(field, lambda r: r["track"].cast("string")), ",")

    return _recommended(spark, sf_dir).select(
        "session_id",
        *_next_columns(),
        tracks("recommendations.popularity").alias("popularity_tracks"),
        tracks("recommendations.cooccurrence").alias("cooccurrence_tracks"),
    )


def recommendations_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user of a session is joined last, one row per session."""
    return (
        _recommended(spark, sf_dir)
        .select("session_id", *_next_columns())
        .join(B.basket_users(spark, sf_dir), "session_id")
    )


def recommendations_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _play_recommendations(spark, sf_dir).select(*USER_SESSION, *_next_columns())


def recommendation_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.recommendation_stats(_recommended(spark, sf_dir), _sessions(spark, sf_dir))


def recommendation_stats_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = last_tracks(B.plays(spark, sf_dir), USER_SESSION, B.EVENT_ORDER)
    return R.recommendation_stats(_play_recommendations(spark, sf_dir), sessions)


def recommendation_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    sampled = R.sample_recommendations(_play_recommendations(spark, sf_dir), USER_SESSION, 3)
    return sampled.withColumns(
        {c: F.col(c).cast("bigint") for c in ("popularity_tracks", "cooccurrence_tracks")}
    )


def markov_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.transition_counts(B.baskets(spark, sf_dir), SESSION, B.BASKET_ORDER, _skew(spark, sf_dir))


def markov_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.edge_topn(markov_transitions(spark, sf_dir), TOP_N, "transition_weight").withColumn(
        "rank", F.col("rank").cast("bigint")
    )


def recommendations_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.generate_transition_recommendations(
        B.baskets(spark, sf_dir), SESSION, B.BASKET_ORDER, TOP_N, _skew(spark, sf_dir)
    ).select("session_id", *_next_columns())


QUERIES = {
    "track_play_counts": track_play_counts,
    "popularity_weights": popularity_weights,
    "popularity_topn": popularity_topn,
    "cooccurrence_counts": cooccurrence_counts,
    "cooccurrence_weights": cooccurrence_weights,
    "cooccurrence_topn": cooccurrence_topn,
    "cooccurrence_coverage": cooccurrence_coverage,
    "recommendations_cooc": recommendations_cooc,
    "recommendations_full": recommendations_full,
    "recommendations_next": recommendations_next,
    "recommendations_plays": recommendations_plays,
    "recommendation_stats": recommendation_stats,
    "recommendation_stats_plays": recommendation_stats_plays,
    "recommendation_samples": recommendation_samples,
    "markov_transitions": markov_transitions,
    "markov_topn": markov_topn,
    "recommendations_markov": recommendations_markov,
}

_BASKET_MODEL = f"{BASKETS}, {model('baskets', 'session_id', 'line_no, track_id')}"
_PLAY_MODEL = f"{PLAYS}, {model('plays', 'user_id, session_id', 'us, event_id')}"
_BASKET_RECS = f"{_BASKET_MODEL}, {next_track('edges', 'cooccurrence', 's.session_id')}"
_PLAY_RECS = f"{_PLAY_MODEL}, {next_track('edges', 'cooccurrence', 's.user_id, s.session_id')}"
_STATS = """
SELECT count(*) AS total_sessions,
  count(*) FILTER (strategy = 'popularity') AS popularity_recommendations,
  count(*) FILTER (strategy = 'cooccurrence') AS cooccurrence_recommendations,
  round(100.0 * CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM sess), 2) AS coverage_rate
FROM recs"""

ORACLES = {
    "track_play_counts": "SELECT l_partkey AS track_id, count(*) AS play_count FROM lineitem GROUP BY l_partkey",
    "popularity_weights": """
SELECT l_partkey AS track_id, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM lineitem) AS popularity_weight
FROM lineitem GROUP BY l_partkey""",
    "popularity_topn": """
SELECT l_partkey AS track_id, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM lineitem) AS popularity_weight
FROM lineitem GROUP BY l_partkey ORDER BY popularity_weight DESC, track_id LIMIT 5""",
    "cooccurrence_counts": f"WITH {_BASKET_MODEL} SELECT last_track, track_id, pair_count FROM pairs",
    "cooccurrence_weights": f"""
WITH {_BASKET_MODEL} SELECT last_track, track_id, weight AS cooccurrence_weight FROM weights""",
    "cooccurrence_topn": f"""
WITH {_BASKET_MODEL} SELECT last_track, track_id, weight AS cooccurrence_weight, rank FROM edges""",
    "cooccurrence_coverage": f"""
WITH {_BASKET_MODEL}
SELECT count(DISTINCT last_track) AS last_tracks, count(DISTINCT track_id) AS tracks, count(*) AS pairs FROM pairs""",
    "recommendations_cooc": f"""
WITH {_BASKET_MODEL}
SELECT s.session_id, s.last_track, coalesce(string_agg(e.track_id, ',' ORDER BY e.rank), '') AS tracks,
  count(e.track_id) AS n_tracks, coalesce(max(CASE WHEN e.rank = 1 THEN e.weight END), 0.0) AS top_weight
FROM sess s LEFT JOIN edges e ON e.last_track = s.last_track GROUP BY s.session_id, s.last_track""",
    "recommendations_full": f"""
WITH {_BASKET_RECS}
SELECT r.session_id, r.last_track, r.next_track, r.strategy, r.weight,
  (SELECT string_agg(track_id, ',' ORDER BY rank) FROM pop) AS popularity_tracks,
  coalesce(l.tracks, '') AS cooccurrence_tracks
FROM recs r LEFT JOIN (
  SELECT last_track, string_agg(track_id, ',' ORDER BY rank) AS tracks FROM edges GROUP BY last_track) l
ON l.last_track = r.last_track""",
    "recommendations_next": f"""
WITH {_BASKET_RECS}
SELECT session_id, owner AS user_id, last_track, next_track, strategy, weight FROM recs""",
    "recommendations_plays": f"""
WITH {_PLAY_RECS}
SELECT user_id, session_id, last_track, next_track, strategy, weight FROM recs""",
    "recommendation_stats": f"WITH {_BASKET_RECS} {_STATS}",
    "recommendation_stats_plays": f"WITH {_PLAY_RECS} {_STATS}",
    "recommendation_samples": f"""
WITH {_PLAY_RECS}
SELECT user_id, session_id, last_track, next_track, strategy, round(weight, 3) AS weight,
  (SELECT count(*) FROM pop) AS popularity_tracks,
  (SELECT count(*) FROM edges e WHERE e.last_track = recs.last_track) AS cooccurrence_tracks
FROM recs ORDER BY user_id, session_id LIMIT 3""",
    "markov_transitions": f"WITH {_BASKET_MODEL} SELECT last_track, track_id, pair_count FROM moves",
    "markov_topn": f"""
WITH {_BASKET_MODEL} SELECT last_track, track_id, weight AS transition_weight, rank FROM move_edges""",
    "recommendations_markov": f"""
WITH {_BASKET_MODEL}, {next_track("move_edges", "transition", "s.session_id")}
SELECT session_id, last_track, next_track, strategy, weight FROM recs""",
}
