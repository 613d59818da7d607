"""Weighted directed edges last_track -> track: co-occurrence within sessions and first-order transitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionflow.operators.skew import DEFAULT_SKEW, HotKeys, SkewPolicy, lookup_join, with_last, with_previous
from sessionflow.storage import hand_off


def cooccurrence_counts(
    plays: DataFrame, keys: Sequence[str], order: Sequence[str], skew: SkewPolicy | None = DEFAULT_SKEW, hot: HotKeys | None = None
) -> DataFrame:
    """(last_track, track_id, pair_count): each play paired with the last track of its session.

    Linear in the plays: a play meets only its session's one last track, and repeats count. A session with a single
    play pairs that play with itself only, which is no pair.
    """
    return (
        with_last(plays.select(*keys, "track_id", *[c for c in order if c != "track_id"]), keys, order, "track_id", "last_track", skew, hot)
        .filter(F.col("last_track") != F.col("track_id"))
        .groupBy("last_track", "track_id")
        .agg(F.count(F.lit(1)).alias("pair_count"))
    )


def transition_counts(
    plays: DataFrame, keys: Sequence[str], order: Sequence[str], skew: SkewPolicy | None = DEFAULT_SKEW
) -> DataFrame:
    """(last_track, track_id, pair_count): how often a track directly follows another within a session."""
    return (
        with_previous(plays, keys, order, "track_id", 1, "_before", skew)
        .select(F.get("_before", F.lit(0)).alias("last_track"), "track_id")
        .filter(F.col("last_track").isNotNull())
        .groupBy("last_track", "track_id")
        .agg(F.count(F.lit(1)).alias("pair_count"))
    )


def edge_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("last_track").agg(F.sum("pair_count").alias("total_count"))


def edge_weights(counts: DataFrame, weight: str, skew: SkewPolicy | None = DEFAULT_SKEW) -> DataFrame:
    """(last_track, track_id, weight): pair count over the total of its last track."""
    if skew is not None:  # read three times from here on
        counts = hand_off(counts, "pairs")
    joined = lookup_join(counts, edge_totals(counts), ["last_track"], skew=skew)
    return joined.select(
        "last_track", "track_id", (F.col("pair_count") / F.col("total_count")).alias(weight)
    )


def edge_topn(counts: DataFrame, n: int, weight: str) -> DataFrame:
    """(last_track, track_id, weight, rank): the ``n`` heaviest edges of every last track, ties broken by track id.

    Ranked by count, which orders edges of one last track as the weight does: the limit then cuts each map task's
    output to ``n`` rows per last track before the shuffle. The totals are joined to the survivors on the same key.
    """
    heaviest = Window.partitionBy("last_track").orderBy(F.desc("pair_count"), F.asc("track_id"))
    return (
        counts.withColumn("rank", F.row_number().over(heaviest))
        .filter(F.col("rank") <= n)
        .join(edge_totals(counts), "last_track")
        .select("last_track", "track_id", (F.col("pair_count") / F.col("total_count")).alias(weight), "rank")
    )


def edge_lists(topn: DataFrame, weight: str) -> DataFrame:
    """(last_track, recs): the top edges of each last track as array<struct<track, weight>> in rank order."""
    return (
        topn.groupBy("last_track")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("rank", F.col("track_id").alias("track"), F.col(weight).alias("weight")))
            ).alias("_ranked")
        )
        .select(
            "last_track",
            F.transform(
                "_ranked", lambda r: F.struct(r["track"].alias("track"), r["weight"].alias("weight"))
            ).alias("recs"),
        )
    )
