"""Track popularity: plays per track, share of all plays, global top N."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def play_counts(plays: DataFrame) -> DataFrame:
    """(track_id, play_count)."""
    return plays.groupBy("track_id").agg(F.count(F.lit(1)).alias("play_count"))


def popularity_weights(counts: DataFrame) -> DataFrame:
    """(track_id, popularity_weight): share of all plays. The total is a scalar subquery over the same counts."""
    total = counts.agg(F.sum("play_count")).scalar()
    return counts.select("track_id", (F.col("play_count") / total).alias("popularity_weight"))


def popularity_topn(counts: DataFrame, n: int) -> DataFrame:
    """The ``n`` most played tracks with their weight, ties broken by track id.

    Ranked by count: the order is that of the weights, and each task keeps only ``n`` rows (no global window).
    """
    total = counts.agg(F.sum("play_count")).scalar()
    return (
        counts.orderBy(F.desc("play_count"), F.asc("track_id"))
        .limit(n)
        .select("track_id", (F.col("play_count") / total).alias("popularity_weight"))
    )


def popularity_list(topn: DataFrame) -> Column:
    """The top-N table as one array<struct<track, weight>> in rank order, as a scalar subquery."""
    ranked = F.array_sort(
        F.collect_list(F.struct((-F.col("popularity_weight")).alias("o"), F.col("track_id").alias("track")))
    )
    return topn.agg(
        F.transform(ranked, lambda r: F.struct(r["track"].alias("track"), (-r["o"]).alias("weight")))
    ).scalar()
