"""Catalog preparation: clean tracks, quarantine, index, chunk numbers, dimension ids, statistics, samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionflow.functions.draws import digest
from sessionflow.functions.music import (
    audio_features,
    key_number,
    similar_is_bad,
    similar_items,
    similar_tracks,
)
from sessionflow.functions.text import flag_columns, flag_tags, strip, track_id
from sessionflow.operators.prefix import number_rows

# Raw column -> catalog column, required columns, defaults, rows per chunk.
COLUMN_NAMES = {
    "Artist(s)": "artist",
    "song": "song_title",
    "Genre": "genre",
    "Tempo": "tempo",
    "Key": "key",
    "Loudness (db)": "loudness",
    "Similar Songs": "similar_songs",
}
REQUIRED = ("artist", "song_title")
DEFAULT_EMOTION = "neutral"
DEFAULT_GENRE = "unknown"
DEFAULT_TEMPO = 120.0
DEFAULT_LOUDNESS = -10.0
DEFAULT_KEY = 0
CHUNK_SIZE = 10_000
#: Column with the text of a raw line that is no JSON object.
CORRUPT = "_corrupt_record"


def require_columns(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Fail when the plan is built, before any job, if a required column is absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def _unreadable(column: str) -> Column:
    return F.col(column).isNotNull() & F.col(column).try_cast("double").isNull()


def parse_catalog(raw: DataFrame, carry: tuple[str, ...] = ("order_key",)) -> DataFrame:
    """Every raw row as a typed track, with ``reject_reason`` set where the row is unusable.

    Where ``raw`` has the text of malformed lines, so has the result, in ``line``.
    """
    lines = [F.col(CORRUPT).alias("line")] if CORRUPT in raw.columns else []
    malformed = F.col(CORRUPT).isNotNull() if lines else F.lit(False)
    named = raw.withColumns(
        {"_tags": flag_tags(flag_columns(raw.columns)), "_features": audio_features(raw.columns)}
    ).withColumnsRenamed(COLUMN_NAMES)
    require_columns(named, REQUIRED)
    have = set(named.columns)
    named = named.withColumns(
        {c: F.lit(None).cast("string") for c in ("emotion", *COLUMN_NAMES.values()) if c not in have}
    )
    named = named.withColumn("_similar", similar_items(F.col("similar_songs")))
    reason = (
        F.when(malformed, "malformed line")
        .when(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in REQUIRED]), "missing name")
        .when(_unreadable("tempo"), "bad tempo")
        .when(_unreadable("loudness"), "bad loudness")
        .when(similar_is_bad(F.col("_similar")), "bad similar songs")
    )
    return named.select(
        *carry,
        track_id(F.col("artist"), F.col("song_title")).alias("track_id"),
        strip(F.col("artist")).alias("artist"),
        strip(F.col("song_title")).alias("song_title"),
        F.coalesce(F.lower("emotion"), F.lit(DEFAULT_EMOTION)).alias("emotion"),
        F.coalesce(F.lower("genre"), F.lit(DEFAULT_GENRE)).alias("genre"),
        F.coalesce(F.col("tempo").try_cast("double"), F.lit(DEFAULT_TEMPO)).alias("tempo"),
        F.coalesce(key_number(F.col("key")), F.lit(DEFAULT_KEY)).alias("key"),
        F.coalesce(F.col("loudness").try_cast("double"), F.lit(DEFAULT_LOUDNESS)).alias("loudness"),
        F.col("_tags").alias("contextual_tags"),
        similar_tracks(F.col("_similar")).alias("similar_tracks"),
        F.col("_features").alias("audio_features"),
        reason.alias("reject_reason"),
        *lines,
    )


def clean_tracks(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason", "line")


def quarantined(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNotNull())


def with_chunk(tracks: DataFrame, chunk_size: int = CHUNK_SIZE, order: str = "order_key") -> DataFrame:
    """Add ``row_no`` (0-based along ``order``, a unique bigint) and ``chunk_no`` (from 1)."""
    numbered = number_rows(tracks, [order], "row_no")
    return numbered.withColumn("chunk_no", F.floor(F.col("row_no") / chunk_size) + 1)


def chunk_file(chunk_no: Column) -> Column:
    return F.format_string("tracks_chunk_%04d.json", chunk_no)


def track_index(chunked: DataFrame, order: str = "order_key") -> DataFrame:
    """One row per track id; of several rows the last in ``order`` wins. Combined on the map side."""
    latest = F.max_by(
        F.struct("artist", "song_title", "genre", "emotion", chunk_file(F.col("chunk_no")).alias("chunk_file")), order
    )
    return chunked.groupBy("track_id").agg(latest.alias("_track")).select("track_id", "_track.*")


def dimension_ids(tracks: DataFrame, dim: str, order: str = "order_key") -> DataFrame:
    """(dim, value, id): distinct values of a column numbered from 0 in order of first appearance."""
    values = (
        tracks.filter(F.col(dim).isNotNull()).groupBy(F.col(dim).alias("value")).agg(F.min(order).alias("_first"))
    )
    numbered = number_rows(values, ["_first", "value"], "id")
    return numbered.select(F.lit(dim).alias("dim"), "value", "id")


def distribution(tracks: DataFrame, dim: str) -> DataFrame:
    """(dim, tracks)."""
    return tracks.groupBy(dim).agg(F.count(F.lit(1)).alias("tracks"))


def catalog_stats(tracks: DataFrame) -> DataFrame:
    """(metric, key, value): totals and the genre and emotion histograms."""
    totals = (
        tracks.agg(
            F.count(F.lit(1)).alias("total_tracks"),
            F.count_distinct("track_id").alias("distinct_tracks"),
            F.count_distinct("artist").alias("unique_artists"),
            F.count_if(F.size("similar_tracks") > 0).alias("tracks_with_similar"),
        )
        .unpivot([], ["total_tracks", "distinct_tracks", "unique_artists", "tracks_with_similar"], "metric", "value")
        .select("metric", F.lit("").alias("key"), "value")
    )
    histograms = [
        distribution(tracks, dim).select(
            F.lit(f"{dim}_distribution").alias("metric"), F.col(dim).alias("key"), F.col("tracks").alias("value")
        )
        for dim in ("genre", "emotion")
    ]
    return totals.unionByName(histograms[0]).unionByName(histograms[1])


def head_sample(tracks: DataFrame, n: int = 1000, order: str = "order_key") -> DataFrame:
    """The first ``n`` tracks; each task keeps ``n`` rows at most."""
    return tracks.orderBy(order).limit(n)


def even_sample(
    tracks: DataFrame, max_tracks: int, seed: str, stratum: str = "chunk_no", key: str = "order_key"
) -> DataFrame:
    """A seeded random sample of at most ``max_tracks`` rows, taken evenly from the strata.

    Every stratum gives at most ``max_tracks // strata + 1`` rows. The literal limit lets each task cut its own output
    first; the exact quota, which depends on the number of strata, follows.
    """
    strata = tracks.agg(F.count_distinct(stratum)).scalar()
    lottery = Window.partitionBy(stratum).orderBy("_ticket", key)
    return (
        tracks.withColumn("_ticket", digest(seed, F.col(key)))
        .withColumn("_drawn", F.row_number().over(lottery))
        .filter(F.col("_drawn") <= max_tracks + 1)
        .filter(F.col("_drawn") <= F.floor(F.lit(max_tracks) / strata) + 1)
        .orderBy("_ticket", key)
        .limit(max_tracks)
        .drop("_ticket", "_drawn")
    )


def union_chunks(*chunks: DataFrame) -> DataFrame:
    """Chunks of one catalog as one table, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), chunks)
