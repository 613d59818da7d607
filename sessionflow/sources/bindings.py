"""Binds the driver's tables to the domain views: baskets, plays, catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sessionflow.operators.skew import DEFAULT_SKEW, SkewPolicy, policy_for

#: The policy the registered queries use for inputs large enough to have hot keys.
QUERY_SKEW = DEFAULT_SKEW


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stored table. Its schema is read from the files once; later reads name it and start no job for it."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """For costly work per row: a table of fewer file splits than cores is spread over all of them by ``key``.

    A large table has splits enough and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def skew_of(spark: SparkSession, sf_dir: str, *names: str) -> SkewPolicy | None:
    """The skew policy for a query over these tables; None where all of them are small."""
    return policy_for(*[table(spark, sf_dir, name) for name in names], skew=QUERY_SKEW)


# -- baskets: an order is a session, its parts are the tracks in line order -------------------------------------------


def baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(session_id, track_id, line_no). A session belongs to one user, so the user is joined per session, not per row."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("session_id"),
        F.col("l_partkey").alias("track_id"),
        F.col("l_linenumber").alias("line_no"),
    )


#: Total order of the rows of one basket; line numbers alone repeat.
BASKET_ORDER = ("line_no", "track_id")


def basket_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(session_id, user_id), one row per session."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("session_id"), F.col("o_custkey").alias("user_id")
    )


# -- plays: the event table as listening events ------------------------------------------------------------------------


def event_kind(event_type: Column) -> Column:
    """view, click and purchase are plays, error is a skip; anything else keeps its own name."""
    return (
        F.when(event_type.isin("view", "click", "purchase"), F.lit("play"))
        .when(event_type == "error", F.lit("skip"))
        .otherwise(event_type)
    )


def listening_events(raw: DataFrame) -> DataFrame:
    """Typed listening events from the raw event table; works on a batch frame and on a stream.

    The upstream session id is the user's calendar day. Event time is a real TIMESTAMP, which watermarks require.
    """
    event_time = F.col("ts").cast("timestamp")
    return raw.select(
        "event_id",
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("track_id"),
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format(event_time, "yyyyMMdd")).alias("session_id"),
        event_time.alias("event_time"),
        event_kind(F.col("event_type")).alias("event_type"),
        F.floor("value").cast("int").alias("duration_played"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listening_events(table(spark, sf_dir, "events"))


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).filter(F.col("event_type") == "play")


#: Total order of a user's events.
EVENT_ORDER = ("event_time", "event_id")


# -- catalog: parts as raw track lines ---------------------------------------------------------------------------------

# The 24 key names in the order p_size % 24 picks them.
KEY_NAMES = (
    "C Maj", "C# Maj", "D Maj", "Eb Maj", "E Maj", "F Maj", "F# Maj", "G Maj", "Ab Maj", "A Maj", "Bb Maj", "B Maj",
    "C min", "C# min", "D min", "Eb min", "E min", "F min", "Gb min", "G min", "Ab min", "A min", "Bb min", "b MIN",
)

#: Flag columns of the bound raw catalog.
FLAG_COLUMNS = ["Good for Party", "Good for Work/Study", "Good for Morning Routine"]


def raw_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as raw catalog rows: (order_key, the raw columns as text, the flags as text).

    Odd rows carry the defects a raw catalog has: missing artist, missing genre, text in a number field, padding.
    """
    key = F.col("p_partkey")
    size = F.col("p_size")
    names = F.array(*[F.lit(name) for name in KEY_NAMES])
    first_word = F.split("p_name", " ")[0]
    similar_objects = F.concat(
        F.lit('[{"track_id": "'), "p_name", F.lit('", "similarity": 0.85}, {"other": 1}, "'), first_word, F.lit('"]')
    )
    similar_strings = F.concat(
        F.lit('["'), "p_name", F.lit('", "'), F.col("p_type"), F.lit('", " '), first_word, F.lit('", "w"]')
    )
    return table(spark, sf_dir, "part").select(
        key.alias("order_key"),
        F.when(key % 50 == 7, None)
        .when(key % 3 == 0, F.concat(F.lit(" "), F.upper("p_brand"), F.lit("\t")))
        .otherwise(F.col("p_brand"))
        .alias("Artist(s)"),
        F.col("p_name").alias("song"),
        F.when(size % 4 == 0, "Happy").when(size % 4 == 1, "sad").when(size % 4 == 2, "Calm").alias("emotion"),
        F.when(key % 11 == 0, None).otherwise(F.col("p_type")).alias("Genre"),
        F.when(key % 13 == 0, None)
        .when(key % 97 == 5, "fast")
        .otherwise(F.floor("p_retailprice").cast("string"))
        .alias("Tempo"),
        F.when(key % 10 == 9, None).otherwise(F.get(names, F.pmod(size, F.lit(24)))).alias("Key"),
        F.when(key % 17 == 0, None)
        .when(key % 101 == 3, "loud")
        .otherwise(F.concat(F.lit("-"), size.cast("string"), F.lit(".5")))
        .alias("Loudness (db)"),
        F.when(key % 19 == 4, "x").otherwise(size.cast("string")).alias("Energy"),
        F.when(key % 23 == 0, None).otherwise((size + 10).cast("string")).alias("Danceability"),
        F.when(key % 5 == 0, None)
        .when(key % 5 == 1, similar_objects)
        .when(key % 5 == 2, similar_strings)
        .when(key % 5 == 3, F.col("p_name"))
        .otherwise("[]")
        .alias("Similar Songs"),
        F.when(size % 2 == 0, "1").otherwise("0").alias(FLAG_COLUMNS[0]),
        F.when(size % 3 == 0, "1").when(size % 3 == 1, "0").alias(FLAG_COLUMNS[1]),
        F.when(size % 5 == 0, "1.0").otherwise("0.0").alias(FLAG_COLUMNS[2]),
    )


# Emotion of a part by p_size % 4.
EMOTIONS = ("happy", "sad", "calm", "neutral")


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as tracks the event table's track ids point to: (track_id, artist, song_title, genre, emotion)."""
    emotions = F.array(*[F.lit(e) for e in EMOTIONS])
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("track_id"),
        F.col("p_brand").alias("artist"),
        F.col("p_name").alias("song_title"),
        F.lower("p_type").alias("genre"),
        F.get(emotions, F.pmod("p_size", F.lit(4))).alias("emotion"),
    )
