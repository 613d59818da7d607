"""Next-track recommendations per session: co-occurrence (or transitions) first, popularity as the fallback."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionflow.operators.edges import (
    cooccurrence_counts,
    edge_lists,
    edge_topn,
    transition_counts,
)
from sessionflow.operators.popularity import play_counts, popularity_list, popularity_topn
from sessionflow.operators.sessions import last_tracks
from sessionflow.operators.skew import DEFAULT_SKEW, HotKeys, SkewPolicy, hot_keys, hot_keys_together, lookup_join

DEFAULT_TOP_N = 5
EMPTY_LIST = "array<struct<track:{0},weight:double>>"


def hot_last_tracks(plays: DataFrame, skew: SkewPolicy | None) -> HotKeys | None:
    """Tracks that may be the last of very many sessions, found in the plays: no session has to be built for it."""
    return None if skew is None else hot_keys(plays, ["track_id"], skew).renamed("last_track")


def session_edge_lists(
    sessions: DataFrame,
    topn: DataFrame,
    weight: str,
    skew: SkewPolicy | None = DEFAULT_SKEW,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Sessions with the edge list of their last track in ``recs`` (null when it has none)."""
    return lookup_join(sessions, edge_lists(topn, weight), ["last_track"], "left", skew, hot)


def recommend(
    sessions: DataFrame,
    topn: DataFrame,
    popular: DataFrame,
    weight: str = "cooccurrence_weight",
    strategy: str = "cooccurrence",
    skew: SkewPolicy | None = DEFAULT_SKEW,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Sessions with ``recommendations`` and ``next_track_recommendation``; only sessions that have one.

    ``sessions`` carries last_track; ``topn`` are ranked edges; ``popular`` the global top-N table.
    """
    track_type = dict(sessions.dtypes)["last_track"]
    empty = F.array().cast(EMPTY_LIST.format(track_type))
    joined = (
        session_edge_lists(sessions, topn, weight, skew, hot)
        .withColumn("_edges", F.coalesce("recs", empty))
        .withColumn("_popular", popularity_list(popular))
    )

    def head(items: str, name: str):
        first = F.get(items, F.lit(0))
        choice = F.struct(first["track"].alias("track"), F.lit(name).alias("strategy"), first["weight"].alias("weight"))
        return F.when(first.isNotNull(), choice)

    return (
        joined.withColumn(
            "recommendations", F.struct(F.col("_popular").alias("popularity"), F.col("_edges").alias(strategy))
        )
        .withColumn("next_track_recommendation", F.coalesce(head("_edges", strategy), head("_popular", "popularity")))
        .filter(F.col("next_track_recommendation").isNotNull())
        .drop("recs", "_edges", "_popular")
    )


def generate_recommendations(
    plays: DataFrame,
    keys: Sequence[str] = ("user_id", "session_id"),
    order: Sequence[str] = ("event_time", "event_id"),
    top_n: int = DEFAULT_TOP_N,
    skew: SkewPolicy | None = DEFAULT_SKEW,
) -> DataFrame:
    """Recommendations for every session of ``plays``; empty input gives an empty result.

    A lazy plan. With a skew policy one job over a sample of the plays looks for hot sessions and hot tracks beforehand.
    """
    keys = list(keys)
    hot_sessions, hot_tracks = (None, None) if skew is None else hot_keys_together(plays, [keys, ["track_id"]], skew)
    sessions = last_tracks(plays, keys, order)
    pairs = cooccurrence_counts(plays, keys, order, skew, hot_sessions)
    recommended = recommend(
        sessions.drop("track_count"),
        edge_topn(pairs, top_n, "cooccurrence_weight"),
        popularity_topn(play_counts(plays), top_n),
        skew=skew,
        hot=None if hot_tracks is None else hot_tracks.renamed("last_track"),
    )
    return recommended.withColumn("timestamp", F.current_timestamp())


def generate_transition_recommendations(
    plays: DataFrame,
    keys: Sequence[str] = ("user_id", "session_id"),
    order: Sequence[str] = ("event_time", "event_id"),
    top_n: int = DEFAULT_TOP_N,
    skew: SkewPolicy | None = DEFAULT_SKEW,
) -> DataFrame:
    """As above, with first-order transitions from the last track instead of co-occurrence."""
    keys = list(keys)
    return recommend(
        last_tracks(plays, keys, order).drop("track_count"),
        edge_topn(transition_counts(plays, keys, order, skew), top_n, "transition_weight"),
        popularity_topn(play_counts(plays), top_n),
        weight="transition_weight",
        strategy="transition",
        skew=skew,
        hot=hot_last_tracks(plays, skew),
    ).withColumn("timestamp", F.current_timestamp())


def recommendation_stats(recommendations: DataFrame, sessions: DataFrame, strategy: str = "cooccurrence") -> DataFrame:
    """One row: recommended sessions, sessions per strategy, and their share of all input sessions in percent."""
    chosen = F.col("next_track_recommendation.strategy")
    all_sessions = sessions.agg(F.count(F.lit(1))).scalar()
    return recommendations.agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.count_if(chosen == "popularity").alias("popularity_recommendations"),
        F.count_if(chosen == strategy).alias(f"{strategy}_recommendations"),
    ).withColumn(
        "coverage_rate",
        F.coalesce(F.round(F.try_divide(F.lit(100.0) * F.col("total_sessions"), all_sessions), 2), F.lit(0.0)),
    )


def sample_recommendations(
    recommendations: DataFrame, keys: Sequence[str] = ("user_id", "session_id"), n: int = 3
) -> DataFrame:
    """A readable report of ``n`` recommendations, first keys first."""
    chosen = F.col("next_track_recommendation")
    return (
        recommendations.orderBy(*keys)
        .limit(n)
        .select(
            *keys,
            "last_track",
            chosen["track"].alias("next_track"),
            chosen["strategy"].alias("strategy"),
            F.round(chosen["weight"], 3).alias("weight"),
            F.size("recommendations.popularity").alias("popularity_tracks"),
            F.size("recommendations.cooccurrence").alias("cooccurrence_tracks"),
        )
    )


def enrich_sessions(
    sessions: DataFrame,
    recommendations: DataFrame,
    keys: Sequence[str] = ("user_id", "session_id"),
    skew: SkewPolicy | None = DEFAULT_SKEW,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Window sessions with the recommended track and strategy of their session; null where there is none."""
    picks = recommendations.select(
        *keys,
        F.col("next_track_recommendation.track").alias("recommended_track"),
        F.col("next_track_recommendation.strategy").alias("rec_strategy"),
    )
    return lookup_join(sessions, picks, keys, "left", skew, hot)
