"""Raw catalog files, prepared catalog tables, and the catalog job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionflow import schemas
from sessionflow.operators import catalog as C
from sessionflow.operators.catalog import CORRUPT
from sessionflow.operators.prefix import running_sum
from sessionflow.storage import hand_off

SAMPLE_SIZE = 1000


def read_raw_catalog(
    spark: SparkSession, path: str, flag_columns: list[str], order_column: str | None = None
) -> DataFrame:
    """JSON lines with an explicit schema; splits of the files are read in parallel."""
    schema = schemas.raw_catalog(flag_columns)
    if order_column:
        schema = schema.add(order_column, "long")
    return spark.read.schema(schema).json(path)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, file, value): the lines of text files, numbered from 0 over all files in order of their paths.

    Every split of a file is read from its offset on in one task, so file, offset and the order within the task place a line.
    The lines are written once with that place; counts per split, summed over the splits before, give the rest. No line is
    sorted or sent elsewhere to be numbered, and a line that cannot be parsed has its number like any other.
    """
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_offset")]
    lines = spark.read.text(path).select("value", *place, F.monotonically_increasing_id().alias("_id"))
    lines = hand_off(lines, "raw-lines")
    splits = lines.groupBy("file", "_offset").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = running_sum(splits, F.col("_n"), ["file", "_offset"], "_before").drop("_n")
    line_no = F.col("_before") + F.col("_id") - F.col("_first")
    return lines.join(before, ["file", "_offset"]).select(line_no.alias("line_no"), "file", "value")


def read_raw_lines(spark: SparkSession, path: str, flag_columns: list[str]) -> DataFrame:
    """Raw catalog files as they come: ``order_key`` is the line's number, ``_corrupt_record`` the text of a line that is no
    JSON object. Blank lines are no rows, but count as lines."""
    schema = schemas.raw_catalog(flag_columns).add(CORRUPT, "string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    lines = numbered_lines(spark, path).filter(F.trim("value") != "")
    return lines.select(F.col("line_no").alias("order_key"), F.inline(F.array(F.from_json("value", schema, options))))


def write_raw_catalog(raw: DataFrame, path: str) -> None:
    raw.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw.columns])).alias("value")).write.text(path)


def read_tracks(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/tracks")


def read_chunk(spark: SparkSession, folder: str, chunk_file: str) -> DataFrame:
    """The tracks of one chunk by the name that the index holds; only that chunk's folder is read."""
    return read_tracks(spark, folder).filter(F.col("chunk_file") == chunk_file)


def read_dimensions(spark: SparkSession, folder: str) -> DataFrame:
    """(dim, value, id) of genres and emotions."""
    return spark.read.parquet(f"{folder}/dimensions")


def prepare_catalog(
    raw: DataFrame, folder: str, chunk_size: int = C.CHUNK_SIZE, sample_size: int = SAMPLE_SIZE
) -> DataFrame:
    """The catalog job: tracks, quarantine, dimension ids, index, statistics and sample as tables below ``folder``.

    The tracks are written once, each chunk in a folder ``chunk_file=`` with the name that the index holds; everything else reads that table, so the raw rows are parsed once and a lost
    executor never sends a later step back to them. Lines that are no JSON are kept in the quarantine with their text, where
    ``raw`` has it (see ``read_raw_lines``). Returns the statistics table.
    """
    spark = raw.sparkSession
    parsed = C.parse_catalog(raw)
    parsed.write.mode("overwrite").parquet(f"{folder}/parsed")
    stored = spark.read.schema(parsed.schema).parquet(f"{folder}/parsed")
    C.quarantined(stored).write.mode("overwrite").parquet(f"{folder}/quarantine")
    valid = C.clean_tracks(stored)
    chunked = C.with_chunk(valid, chunk_size).withColumn("chunk_file", C.chunk_file(F.col("chunk_no")))
    chunked.write.mode("overwrite").partitionBy("chunk_file").parquet(f"{folder}/tracks")
    tracks = read_tracks(spark, folder)
    C.union_chunks(C.dimension_ids(tracks, "genre"), C.dimension_ids(tracks, "emotion")).write.mode(
        "overwrite"
    ).parquet(f"{folder}/dimensions")
    C.track_index(tracks).write.mode("overwrite").parquet(f"{folder}/index")
    C.catalog_stats(tracks).write.mode("overwrite").json(f"{folder}/stats")
    C.head_sample(tracks, sample_size).write.mode("overwrite").json(f"{folder}/sample")
    return spark.read.schema("metric string, key string, value bigint").json(f"{folder}/stats")


def prepare_catalog_files(
    spark: SparkSession, path: str, folder: str, flag_columns: list[str], chunk_size: int = C.CHUNK_SIZE, sample_size: int = SAMPLE_SIZE
) -> DataFrame:
    """The catalog job on raw files, in the order of their lines."""
    return prepare_catalog(read_raw_lines(spark, path, flag_columns), folder, chunk_size, sample_size)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """(track_id, artist, song_title, genre, emotion, chunk_file)."""
    return spark.read.parquet(f"{folder}/index")


def read_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """The rejected rows with their reason, and the text of lines that are no JSON."""
    return spark.read.parquet(f"{folder}/quarantine")
