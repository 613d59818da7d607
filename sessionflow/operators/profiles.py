"""Listening behaviour per user and genre, taste profiles, weighted draws."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionflow.functions.draws import draw
from sessionflow.operators.prefix import running_sum
from sessionflow.operators.sessions import last_n_tracks

# Defaults where no event tells, bounds of a skip, shortest share of a play, profile sizes.
DEFAULT_SKIP_RATE = 0.2
DEFAULT_PLAY_SECONDS = 180
LONGEST_SKIP = 30
PLAY_SHARE = 0.7
PREFERRED_GENRES = 2
PREFERRED_EMOTIONS = 1
RECENT_TRACKS = 5
#: Buckets of the line at least; with more values there is one for each.
PICK_BUCKETS = 1024


def classify_play(duration: Column, typical: Column) -> Column:
    """``play`` from 70 % of the typical length on, ``skip`` up to 30 s (or the length, if shorter), else ``partial``."""
    return (
        F.when(duration >= F.floor(typical * PLAY_SHARE), F.lit("play"))
        .when(duration <= F.least(typical, F.lit(LONGEST_SKIP)), F.lit("skip"))
        .otherwise(F.lit("partial"))
    )


def engagement_stats(events: DataFrame) -> DataFrame:
    """(scope, key, events, skip_rate, average_play_duration) overall, per genre and per user, in one pass."""
    is_play = F.col("event_type") == "play"
    heard = events.filter(F.col("event_type").isin("play", "skip")).select(
        "genre", F.col("user_id").cast("string").alias("user"), is_play.alias("_play"), "duration_played"
    )
    scope = F.when(F.grouping("genre") == 0, "genre").when(F.grouping("user") == 0, "user").otherwise("all")
    return heard.groupingSets([[], ["genre"], ["user"]], "genre", "user").agg(
        scope.alias("scope"),
        F.coalesce("genre", "user", F.lit("")).alias("key"),
        F.count(F.lit(1)).alias("events"),
        F.coalesce(
            F.try_divide(F.count_if(~F.col("_play")), F.count(F.lit(1))), F.lit(DEFAULT_SKIP_RATE)
        ).alias("skip_rate"),
        F.coalesce(
            F.try_divide(F.sum(F.when(F.col("_play"), F.col("duration_played"))), F.count_if(F.col("_play"))),
            F.lit(float(DEFAULT_PLAY_SECONDS)),
        ).alias("average_play_duration"),
    ).drop("genre", "user")


def preferences(plays: DataFrame, user: str, dim: str, n: int) -> DataFrame:
    """(user, preferred): each user's ``n`` most played values of ``dim``, most played first, ties by name.

    Plays without a value are no taste; a user with no other plays has an empty list.
    """
    most = Window.partitionBy(user).orderBy(F.col(dim).isNull(), F.desc("_plays"), F.asc(dim))
    return (
        plays.groupBy(user, dim)
        .agg(F.count(F.lit(1)).alias("_plays"))
        .withColumn("_rank", F.row_number().over(most))
        .filter((F.col("_rank") <= n) | F.col(dim).isNull())
        .groupBy(user)
        .agg(F.array_sort(F.collect_list(F.when(F.col(dim).isNotNull(), F.struct("_rank", dim)))).alias("_ranked"))
        .select(user, F.transform("_ranked", lambda r: r[dim]).alias(f"preferred_{dim}s"))
    )


def skip_rate(events: DataFrame) -> Column:
    """Overall skip rate as a scalar subquery, 0.2 where nothing was heard."""
    heard = events.filter(F.col("event_type").isin("play", "skip"))
    rate = F.try_divide(F.count_if(F.col("event_type") == "skip"), F.count(F.lit(1)))
    return heard.agg(F.coalesce(rate, F.lit(DEFAULT_SKIP_RATE))).scalar()


def user_profiles(events: DataFrame, order: Sequence[str] = ("event_time", "event_id")) -> DataFrame:
    """One profile per user with a play: preferred genres and emotions, skip rate, last tracks.

    ``events`` carries user_id, track_id, genre, emotion and event_type.
    """
    plays = events.filter(F.col("event_type") == "play")
    return (
        preferences(plays, "user_id", "genre", PREFERRED_GENRES)
        .join(preferences(plays, "user_id", "emotion", PREFERRED_EMOTIONS), "user_id")
        .join(last_n_tracks(plays, "user_id", order, RECENT_TRACKS), "user_id")
        .withColumn("skip_rate", skip_rate(events))
    )


def user_name(user: Column) -> Column:
    """7 -> ``user_007``."""
    return F.format_string("user_%03d", user)


def weighted_pick(
    users: DataFrame, weights: DataFrame, value: str, weight: str, seed: str, picks: int, user: str = "user_id"
) -> DataFrame:
    """(user, pick_no, value): ``picks`` independent draws per user, with replacement, by integer weight.

    The values lie one after another on a line, each as long as its weight. The line is cut into equal buckets, as
    many as there are values, so a draw finds its value by an equality on the bucket and a range test within it: among
    about two values on average, whatever their number and weights.
    """
    line = running_sum(
        weights.select(F.col(value), F.col(weight).cast("long").alias("_w")).withColumn("_h", F.md5(F.col(value))),
        F.col("_w"),
        ["_h", value],
        "_low",
    ).withColumn("_high", F.col("_low") + F.col("_w"))
    total = weights.agg(F.sum(F.col(weight).cast("long"))).scalar()
    values = weights.agg(F.count(F.lit(1))).scalar()
    width = F.floor(total / F.greatest(values, F.lit(PICK_BUCKETS).cast("bigint"))) + 1
    pieces = line.filter(F.col("_w") > 0).select(
        value,
        "_low",
        "_high",
        F.explode(F.sequence(F.floor(F.col("_low") / width), F.floor((F.col("_high") - 1) / width))).alias("_bucket"),
    )
    drawn = (
        users.select(user, F.explode(F.sequence(F.lit(1), F.lit(picks))).alias("pick_no"))
        .withColumn("_at", F.pmod(draw(seed, F.col(user), F.col("pick_no")), total))
        .withColumn("_bucket", F.floor(F.col("_at") / width))
    )
    return (
        drawn.join(pieces, "_bucket")
        .filter((F.col("_at") >= F.col("_low")) & (F.col("_at") < F.col("_high")))
        .select(user, "pick_no", value)
    )


def weighted_sample(weights: DataFrame, by: str, value: str, weight: str, seed: str, k: int) -> DataFrame:
    """(by, pick_no, value): ``k`` values drawn without replacement for each ``by``, by weight, or all if there are fewer.

    Every pair of ``by`` and value draws an exponential key -ln(u) / weight, and the ``k`` least keys win, which is the law of
    draws one after another. The least keys of parts give the least of the whole, so each task sends ``k`` rows per ``by`` at
    most. Weights that are null or not positive, and null values, take no part; ``weights`` has each value once per ``by``.
    """
    usable = weights.filter((F.col(weight) > 0) & F.col(value).isNotNull())
    even = (draw(seed, F.col(by), F.col(value)) + 1) / F.lit(float(1 << 60))  # above 0, up to 1
    least = Window.partitionBy(by).orderBy("_key", value)
    drawn = usable.withColumn("_key", -F.log(even) / F.col(weight)).withColumn("pick_no", F.row_number().over(least))
    return drawn.filter(F.col("pick_no") <= k).select(by, F.col("pick_no").cast("bigint").alias("pick_no"), value)


def taste_draw(plays: DataFrame, seed: str, genres: int = PREFERRED_GENRES, emotions: int = PREFERRED_EMOTIONS, user: str = "user_id") -> DataFrame:
    """(user, dim, pick_no, value): genres and emotions drawn for each user, by how often the user played them."""
    parts = []
    for dim, k in (("genre", genres), ("emotion", emotions)):
        heard = plays.groupBy(user, dim).agg(F.count(F.lit(1)).alias("_plays"))
        drawn = weighted_sample(heard, user, dim, "_plays", f"{seed}-{dim}", k)
        parts.append(drawn.select(user, F.lit(dim).alias("dim"), "pick_no", F.col(dim).alias("value")))
    return parts[0].unionByName(parts[1])
