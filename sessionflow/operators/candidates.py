"""Candidate tracks per user: tracks of a preferred genre or a preferred emotion, minus the recently played ones.

The set of all (user, candidate) pairs is about users times catalog, so it is never built. A user's candidates are a
few *segments* of numbered lists instead: the whole list of each preferred genre, then the list of each preferred
emotion without the ranges that belong to those genres. Counting, testing for a recent track and picking the r-th
candidate are arithmetic on a handful of segments, and the picked position is joined to its track.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionflow.functions.draws import draw
from sessionflow.operators.skew import DEFAULT_SKEW, SkewPolicy, hot_keys, lookup_join, with_position
from sessionflow.storage import hand_off

GENRE, EMOTION, ALL = "genre", "emotion", "all"


def track_positions(tracks: DataFrame, skew: SkewPolicy | None = DEFAULT_SKEW) -> DataFrame:
    """(list, list_key, pos, track_id, genre, emotion): each track's place in its genre, its emotion and the catalog.

    Lists are ordered by genre, then track id, so the tracks of one genre are one range of an emotion's list.
    """
    listed = tracks.select("track_id", "genre", "emotion").select(
        "*",
        F.inline(
            F.array(
                F.struct(F.lit(GENRE).alias("list"), F.col("genre").alias("list_key")),
                F.struct(F.lit(EMOTION).alias("list"), F.col("emotion").alias("list_key")),
                F.struct(F.lit(ALL).alias("list"), F.lit("").alias("list_key")),
            )
        ),
    )
    return with_position(listed, ["list", "list_key"], ["genre", "track_id"], "pos", skew)


def candidate_segments(profiles: DataFrame, tracks: DataFrame, skew: SkewPolicy | None = DEFAULT_SKEW) -> DataFrame:
    """(user_id, recent_tracks, segments, n_preferred, matched).

    segments: array<struct<list, list_key, start, size, gaps>> where ``start`` is the rank of the segment's first
    candidate and ``gaps`` are the (position, length) ranges of the list that do not count. A user whose preferences
    match nothing gets the whole catalog.
    """
    cells = tracks.groupBy("emotion", "genre").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("emotion").orderBy("genre").rowsBetween(Window.unboundedPreceding, -1)
    ranges = cells.withColumn("at", F.coalesce(F.sum("n").over(before), F.lit(0)))
    genre_sizes = cells.groupBy("genre").agg(F.sum("n").alias("genre_size"))
    emotion_sizes = cells.groupBy("emotion").agg(F.sum("n").alias("emotion_size"))
    catalog_size = cells.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()

    wanted = profiles.select(
        "user_id", "recent_tracks", F.array_distinct("preferred_genres").alias("genres"), "preferred_emotions"
    )
    pairs = wanted.select(
        "user_id", "recent_tracks", "preferred_emotions", F.posexplode_outer("genres").alias("_g", "genre")
    ).select(
        "user_id", "recent_tracks", "_g", "genre",
        F.posexplode_outer(F.array_distinct("preferred_emotions")).alias("_e", "emotion"),
    )
    # every lookup keeps the rows, so the hot keys of all three are those of the rows they started from
    sized = pairs
    for sizes, keys in ((genre_sizes, ["genre"]), (emotion_sizes, ["emotion"]), (ranges, ["emotion", "genre"])):
        hot = None if skew is None else hot_keys(pairs, keys, skew)
        sized = lookup_join(sized, sizes, keys, "left", skew, hot)
    gap_type = "array<struct<at:bigint,n:bigint>>"
    segment_type = f"array<struct<list:string,list_key:string,size:bigint,gaps:{gap_type}>>"
    no_gaps = F.array().cast(gap_type)
    gathered = sized.groupBy("user_id").agg(
        F.any_value("recent_tracks").alias("recent_tracks"),
        F.array_sort(
            F.collect_set(F.when(F.col("genre_size").isNotNull(), F.struct("_g", "genre", "genre_size")))
        ).alias("_genres"),
        F.array_sort(
            F.collect_set(F.when(F.col("emotion_size").isNotNull(), F.struct("_e", "emotion", "emotion_size")))
        ).alias("_emotions"),
        F.array_sort(F.collect_list(F.when(F.col("n").isNotNull(), F.struct("at", "n", "_e")))).alias("_gaps"),
    )
    genre_segments = F.transform(
        "_genres",
        lambda g: F.struct(
            F.lit(GENRE).alias("list"), g["genre"].alias("list_key"), g["genre_size"].alias("size"), no_gaps.alias("gaps")
        ),
    ).cast(segment_type)

    def emotion_segment(e: Column) -> Column:
        own = F.transform(
            F.filter("_gaps", lambda g: g["_e"] == e["_e"]), lambda g: F.struct(g["at"].alias("at"), g["n"].alias("n"))
        )
        covered = F.aggregate(own, F.lit(0).cast("long"), lambda total, g: total + g["n"])
        return F.struct(
            F.lit(EMOTION).alias("list"),
            e["emotion"].alias("list_key"),
            (e["emotion_size"] - covered).alias("size"),
            own.alias("gaps"),
        )

    emotion_segments = F.transform("_emotions", emotion_segment).cast(segment_type)
    whole = F.array(
        F.struct(
            F.lit(ALL).alias("list"),
            F.lit("").alias("list_key"),
            catalog_size.cast("long").alias("size"),
            no_gaps.alias("gaps"),
        )
    ).cast(segment_type)
    found = (
        gathered.withColumn("_found", F.filter(F.concat(genre_segments, emotion_segments), lambda s: s["size"] > 0))
        .withColumn("matched", F.size("_found") > 0)
        .withColumn("_found", F.when(F.col("matched"), F.col("_found")).otherwise(whole))
    )
    started = F.transform(
        "_found",
        lambda s, i: F.struct(
            s["list"].alias("list"),
            s["list_key"].alias("list_key"),
            _total(F.slice("_found", F.lit(1), i)).alias("start"),
            s["size"].alias("size"),
            s["gaps"].alias("gaps"),
        ),
    )
    return found.select(
        "user_id",
        "recent_tracks",
        started.alias("segments"),
        _total(F.col("_found")).alias("n_preferred"),
        "matched",
    )


def _total(segments: Column) -> Column:
    return F.aggregate(segments, F.lit(0).cast("long"), lambda total, s: total + s["size"])


def exclude_recent(
    segments: DataFrame, positions: DataFrame, skew: SkewPolicy | None = DEFAULT_SKEW
) -> DataFrame:
    """Add ``excluded`` (ascending ranks of recent tracks among the candidates) and ``n_available``.

    A user whose candidates are all recent may get recent tracks again.
    """
    places = positions.groupBy("track_id").agg(
        F.max("genre").alias("genre"),
        F.max("emotion").alias("emotion"),
        F.max(F.when(F.col("list") == GENRE, F.col("pos"))).alias("genre_pos"),
        F.max(F.when(F.col("list") == EMOTION, F.col("pos"))).alias("emotion_pos"),
        F.max(F.when(F.col("list") == ALL, F.col("pos"))).alias("all_pos"),
    )
    recent = lookup_join(
        segments.select("user_id", "segments", F.explode(F.array_distinct("recent_tracks")).alias("track_id")),
        places,
        ["track_id"],
        skew=skew,
    )
    holds = (
        lambda s: ((s["list"] == GENRE) & (s["list_key"] == F.col("genre")))
        | ((s["list"] == EMOTION) & (s["list_key"] == F.col("emotion")))
        | (s["list"] == ALL)
    )
    own = F.get(F.filter("segments", holds), F.lit(0))
    skipped = F.aggregate(
        F.filter("_own.gaps", lambda g: g["at"] < F.col("emotion_pos")),
        F.lit(0).cast("long"),
        lambda total, g: total + g["n"],
    )
    in_list = (
        F.when(F.col("_own.list") == GENRE, F.col("genre_pos"))
        .when(F.col("_own.list") == EMOTION, F.col("emotion_pos") - skipped)
        .otherwise(F.col("all_pos"))
    )
    ranks = (
        recent.withColumn("_own", own)
        .filter(F.col("_own").isNotNull())
        .groupBy("user_id")
        .agg(F.array_sort(F.collect_list(F.col("_own.start") + in_list)).alias("_ranks"))
    )
    none = F.array().cast("array<bigint>")
    left = F.col("n_preferred") - F.size(F.coalesce("_ranks", none))
    return (
        segments.join(ranks, "user_id", "left")
        .withColumn("excluded", F.when(left > 0, F.coalesce("_ranks", none)).otherwise(none))
        .withColumn("n_available", F.col("n_preferred") - F.size("excluded"))
        .drop("_ranks")
    )


def candidate_at(available: DataFrame, positions: DataFrame, rank: str) -> DataFrame:
    """The track at the 0-based ``rank`` column among each user's available candidates (rank < n_available).

    Candidates run through the segments in order; excluded ranks are stepped over.
    """
    among_all = F.aggregate("excluded", F.col(rank), lambda r, e: r + F.when(e <= r, 1).otherwise(0))
    own = F.get(
        F.filter(
            "segments", lambda s: (s["start"] <= F.col("_rank")) & (F.col("_rank") < s["start"] + s["size"])
        ),
        F.lit(0),
    )
    in_list = F.aggregate(
        "_own.gaps",
        F.col("_rank") - F.col("_own.start"),
        lambda p, g: p + F.when(g["at"] <= p, g["n"]).otherwise(0),
    )
    return (
        available.withColumn("_rank", among_all)
        .withColumn("_own", own)
        .select(
            "user_id",
            rank,
            F.col("_own.list").alias("list"),
            F.col("_own.list_key").alias("list_key"),
            in_list.alias("pos"),
        )
        .join(positions.select("list", "list_key", "pos", "track_id"), ["list", "list_key", "pos"])
        .select("user_id", rank, "track_id")
    )


def pick_candidate(
    profiles: DataFrame, tracks: DataFrame, seed: str, skew: SkewPolicy | None = DEFAULT_SKEW
) -> DataFrame:
    """(user_id, track_id): one available candidate per user, drawn evenly with a seed.

    Numbered tracks and segments are each read more than once, so they are written tables.
    """
    positions = hand_off(track_positions(tracks, skew), "positions")
    segments = hand_off(candidate_segments(profiles, tracks, skew), "segments")
    available = exclude_recent(segments, positions, skew)
    drawn = available.filter(F.col("n_available") > 0).withColumn(
        "_draw", F.pmod(draw(seed, F.col("user_id")), F.col("n_available"))
    )
    return candidate_at(drawn, positions, "_draw").select("user_id", "track_id")
