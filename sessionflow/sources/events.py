"""Event messages: reading topics and tables as streams, JSON decode and encode, publishing, enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionflow import schemas
from sessionflow.functions.times import format_iso, parse_iso
from sessionflow.operators.skew import DEFAULT_SKEW, SkewPolicy, lookup_join

CORRUPT = "_corrupt_record"
DEFAULT_TOPIC = "user-tracks"

# How the event topic is read and written unless the caller says otherwise.
KAFKA_READ = {"startingOffsets": "latest", "failOnDataLoss": "false"}
KAFKA_WRITE = {"kafka.acks": "1", "kafka.retries": "3"}


def message_stream(
    spark: SparkSession, source: str = "kafka", path: str | None = None, **options: str
) -> DataFrame:
    """A stream of (key, value) messages, from a Kafka topic or from files of such messages.

    For Kafka pass at least ``kafka.bootstrap.servers``; ``subscribe`` defaults to the event topic.
    """
    if source == "kafka":
        options = {"subscribe": DEFAULT_TOPIC, **KAFKA_READ, **options}
        return spark.readStream.format("kafka").options(**options).load()
    return spark.readStream.format(source).schema(schemas.MESSAGE).options(**options).load(path)


def table_stream(
    spark: SparkSession, path: str, schema: T.StructType, **options: str
) -> DataFrame:
    """A parquet table as a file stream; the path may be a folder of files or one single file."""
    reader = spark.readStream.schema(schema).options(**options)
    first = spark.read.schema(schema).parquet(path).select("_metadata.file_path").first()
    folder, name = path.rstrip("/").rsplit("/", 1)
    if first is not None and first["file_path"].rstrip("/").endswith(f"/{name}"):
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def decode(messages: DataFrame, schema: T.StructType = schemas.EVENT, carry: tuple[str, ...] = ()) -> DataFrame:
    """Messages as events. A message that is no JSON object of the schema keeps its text in ``_corrupt_record``.

    The one-element array keeps later filters above the decode, so that each message is decoded once.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    event = F.from_json(
        F.col("value").cast("string"), with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    return messages.select(*carry, F.inline(F.array(event)))


def valid_events(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def corrupt_messages(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(CORRUPT).isNotNull())


def with_event_time(events: DataFrame) -> DataFrame:
    return events.withColumn("event_time", parse_iso(F.col("timestamp")))


def is_play() -> Column:
    return F.col("event_time").isNotNull() & (F.col("event_type") == "play")


def plays_of(events: DataFrame) -> DataFrame:
    """Events with a readable time that are plays."""
    return with_event_time(events).filter(is_play())


def enrich(events: DataFrame, tracks: DataFrame, skew: SkewPolicy | None = DEFAULT_SKEW) -> DataFrame:
    """Batch events with artist, title, genre and emotion of their track; an unknown track keeps nulls."""
    attrs = tracks.select("track_id", "artist", "song_title", "genre", "emotion")
    return lookup_join(events, attrs, ["track_id"], "left", skew=skew)


def enrich_stream(events: DataFrame, tracks: DataFrame) -> DataFrame:
    """The same for a stream; Spark broadcasts the table only if its size allows it."""
    return events.join(tracks.select("track_id", "artist", "song_title", "genre", "emotion"), "track_id", "left")


def to_event_record(events: DataFrame) -> DataFrame:
    """Typed, enriched events in the published shape: ids as text, ISO time."""
    have = set(events.columns)
    columns = []
    for field in schemas.EVENT.fields:
        if field.name == "timestamp":
            columns.append(format_iso(F.col("event_time")).alias("timestamp"))
        elif field.name in have:
            columns.append(F.col(field.name).cast(field.dataType).alias(field.name))
        else:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
    return events.select(*columns)


def encode(records: DataFrame) -> DataFrame:
    """Events as messages: the user id is the key, the event as JSON is the value."""
    return records.select(
        F.col("user_id").cast("string").alias("key"), F.to_json(F.struct(*records.columns)).alias("value")
    )


def publish(records: DataFrame, sink: str = "kafka", path: str | None = None, **options: str) -> None:
    """Write events as messages, from the executors, to a Kafka topic or to files."""
    messages = encode(records)
    if sink == "kafka":
        messages.write.format("kafka").options(**{"topic": DEFAULT_TOPIC, **KAFKA_WRITE, **options}).save()
    else:
        binary = messages.select(F.col("key").cast("binary"), F.col("value").cast("binary"))
        binary.write.format(sink).options(**options).mode("append").save(path)
