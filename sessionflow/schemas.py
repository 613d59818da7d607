"""Explicit schemas; no stream or JSON source ever infers its schema."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType(), True) for name in names]


#: A listening event as a producer publishes it.
EVENT = T.StructType(
    _strings("event_id", "user_id", "track_id", "artist", "song_title", "timestamp", "session_id", "event_type")
    + [T.StructField("duration_played", T.IntegerType(), True)]
    + _strings("genre", "emotion", "device_type")
)

#: The message envelope of the event topic.
MESSAGE = T.StructType(
    [T.StructField("key", T.BinaryType(), True), T.StructField("value", T.BinaryType(), True)]
)

#: Columns every raw catalog line may carry, next to any number of ``Good for ...`` flags. All text: a number that
#: does not parse must reach the quarantine instead of failing the scan.
RAW_CATALOG_COLUMNS = (
    "Artist(s)",
    "song",
    "emotion",
    "Genre",
    "Tempo",
    "Key",
    "Loudness (db)",
    "Energy",
    "Danceability",
    "Similar Songs",
)


def raw_catalog(flag_columns: list[str]) -> T.StructType:
    """Schema of a raw catalog line with the given ``Good for ...`` flag columns."""
    return T.StructType(_strings(*RAW_CATALOG_COLUMNS, *flag_columns))


WEIGHTED_TRACK = T.StructType(
    [T.StructField("track", T.StringType(), True), T.StructField("weight", T.DoubleType(), True)]
)

#: One recommendation row per (user, session).
RECOMMENDATION = T.StructType(
    [
        *_strings("user_id", "session_id", "last_track"),
        T.StructField(
            "recommendations",
            T.StructType(
                [
                    T.StructField("popularity", T.ArrayType(WEIGHTED_TRACK), True),
                    T.StructField("cooccurrence", T.ArrayType(WEIGHTED_TRACK), True),
                ]
            ),
        ),
        T.StructField(
            "next_track_recommendation",
            T.StructType([*_strings("track", "strategy"), T.StructField("weight", T.DoubleType(), True)]),
        ),
        T.StructField("timestamp", T.TimestampType(), True),
    ]
)

#: Parts table shape of the file stream the driver's events come from.
EVENT_TABLE = T.StructType(
    [
        T.StructField("event_id", T.LongType(), True),
        T.StructField("ts", T.TimestampNTZType(), True),
        T.StructField("user_id", T.LongType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("props", T.StringType(), True),
    ]
)
