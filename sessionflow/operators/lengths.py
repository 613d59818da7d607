"""Typical play lengths from mergeable quantile sketches: per track, with its genre as the fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionflow.operators.skew import DEFAULT_SKEW, SkewPolicy, lookup_join

#: Size of a sketch. Up to so many plays it is exact; beyond, ranks are off by about 1.7 / k, 0.2 % here.
SKETCH_K = 1024
#: Plays a track needs for a typical length of its own.
LEAST_PLAYS = 3
# Fixed value: length in seconds where neither the track nor its genre has been played.
DEFAULT_SECONDS = 180


def length_sketches(plays: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """(track_id, plays, sketch): a sketch of the play lengths of every track, built on the map side first.

    Null lengths take no part. Sketches of several days or batches are united by ``merge_sketches``.
    """
    timed = plays.filter(F.col("duration_played").isNotNull())
    sketch = F.kll_sketch_agg_bigint(F.col("duration_played").cast("bigint"), k).alias("sketch")
    return timed.groupBy("track_id").agg(F.count(F.lit(1)).alias("plays"), sketch)


def merge_sketches(sketches: DataFrame, by: str, k: int = SKETCH_K) -> DataFrame:
    """(by, plays, sketch): the sketches of each ``by`` united; no play is read again."""
    return sketches.groupBy(by).agg(F.sum("plays").alias("plays"), F.kll_merge_agg_bigint("sketch", k).alias("sketch"))


def median_length(sketch: str):
    """The least length that half of the plays do not exceed."""
    return F.kll_sketch_get_quantile_bigint(sketch, F.lit(0.5))


def typical_lengths(sketches: DataFrame, tracks: DataFrame, least_plays: int = LEAST_PLAYS, skew: SkewPolicy | None = DEFAULT_SKEW) -> DataFrame:
    """(track_id, typical): the median play length of every track of ``tracks`` (track_id, genre).

    A track of fewer than ``least_plays`` plays takes the median of its genre, a genre without plays the default.
    """
    own = tracks.select("track_id", "genre").join(sketches, "track_id", "left")
    genres = merge_sketches(own.filter(F.col("sketch").isNotNull() & F.col("genre").isNotNull()), "genre")
    genres = genres.select("genre", median_length("sketch").alias("_of_genre"))
    joined = lookup_join(own, genres, ["genre"], "left", skew)
    typical = F.when(F.col("plays") >= least_plays, median_length("sketch"))
    return joined.select("track_id", F.coalesce(typical, "_of_genre", F.lit(DEFAULT_SECONDS).cast("bigint")).alias("typical"))
