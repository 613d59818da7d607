"""Catalog queries over parts as raw catalog rows, and text functions over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionflow.functions.music import audio_features as feature_map
from sessionflow.functions.music import key_number, similar_items
from sessionflow.functions.music import similar_tracks as similar_list
from sessionflow.functions.text import flag_tags, split_tags, track_id
from sessionflow.operators import catalog as C
from sessionflow.plans.sql import SPACE, strip
from sessionflow.plans.sql import track_id as sql_track_id
from sessionflow.sources import bindings as B
from sessionflow.sources import catalogs
from sessionflow.storage import new_folder

CHUNK = 250
SAMPLE_MAX = 500
SEED = "catalog"
BROKEN = 41


def _text(name: str, alias: str):
    return F.coalesce(F.col(f"`{name}`"), F.lit("")).alias(alias)


def catalog_json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows written as JSON lines to the shared folder and scanned back with the explicit schema."""
    folder = new_folder(spark, "raw-catalog")
    catalogs.write_raw_catalog(B.raw_catalog(spark, sf_dir), folder)
    scanned = catalogs.read_raw_catalog(spark, folder, B.FLAG_COLUMNS, "order_key")
    return scanned.select(
        "order_key",
        _text("Artist(s)", "artist"),
        _text("song", "song"),
        _text("emotion", "emotion"),
        _text("Genre", "genre"),
        _text("Tempo", "tempo"),
        _text("Key", "key_name"),
        _text("Loudness (db)", "loudness"),
        _text("Similar Songs", "similar_songs"),
    )


def _raw_file(spark: SparkSession, sf_dir: str) -> str:
    """The raw rows as files of JSON lines in order, without a column for it; some lines are broken."""
    folder = new_folder(spark, "raw-file")
    raw = B.raw_catalog(spark, sf_dir).orderBy("order_key")
    names = [F.col(f"`{c}`") for c in raw.columns if c != "order_key"]
    broken = F.concat(F.lit('{"song": broken '), F.col("order_key").cast("string"))
    line = F.when(F.col("order_key") % BROKEN == 3, broken).otherwise(F.to_json(F.struct(*names)))
    raw.select(line.alias("value")).write.text(folder)
    return folder


def catalog_raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of raw files in order, with the text of those that are no JSON."""
    scanned = catalogs.read_raw_lines(spark, _raw_file(spark, sf_dir), B.FLAG_COLUMNS)
    return scanned.select(F.col("order_key").alias("line_no"), _text("song", "song"), _text(C.CORRUPT, "line"))


def catalog_file_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index that the catalog job makes of raw files."""
    folder = new_folder(spark, "catalog-job")
    catalogs.prepare_catalog_files(spark, _raw_file(spark, sf_dir), folder, B.FLAG_COLUMNS, CHUNK)
    return catalogs.read_index(spark, folder)


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.parse_catalog(B.raw_catalog(spark, sf_dir))


def _tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean_tracks(_parsed(spark, sf_dir))


def _chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.with_chunk(_tracks(spark, sf_dir), CHUNK)


def catalog_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tracks(spark, sf_dir).select(
        "order_key", "track_id", "artist", "song_title", "emotion", "genre", "tempo", "key", "loudness"
    )


def catalog_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.quarantined(_parsed(spark, sf_dir)).select("order_key", "reject_reason")


def catalog_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two differently ordered halves of the catalog put together again."""
    tracks = _tracks(spark, sf_dir)
    first = tracks.filter(F.col("genre") < "m").select("order_key", "track_id", "genre")
    second = tracks.filter(~(F.col("genre") < "m")).select("genre", "track_id", "order_key")
    return C.union_chunks(first, second)


def catalog_track_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.track_index(_chunked(spark, sf_dir))


def catalog_chunk_no(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunked(spark, sf_dir).select(
        "order_key", "row_no", "chunk_no", C.chunk_file(F.col("chunk_no")).alias("chunk_file")
    )


def catalog_head_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.head_sample(_tracks(spark, sf_dir), catalogs.SAMPLE_SIZE).select("order_key", "track_id")


def catalog_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.even_sample(_chunked(spark, sf_dir), SAMPLE_MAX, SEED).select("order_key", "chunk_no")


def catalog_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.catalog_stats(_tracks(spark, sf_dir))


def genre_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.distribution(_tracks(spark, sf_dir), "genre")


def emotion_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.distribution(_tracks(spark, sf_dir), "emotion")


def dim_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    tracks = _tracks(spark, sf_dir)
    return C.union_chunks(C.dimension_ids(tracks, "genre"), C.dimension_ids(tracks, "emotion"))


def track_id_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.spread(B.table(spark, sf_dir, "documents"), "doc_id").select(
        "doc_id", track_id(F.col("source"), F.col("text")).alias("track_id")
    )


def tag_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = B.spread(B.table(spark, sf_dir, "documents"), "doc_id").select("doc_id", split_tags(F.col("text")).alias("tags"))
    return tagged.select(
        "doc_id", F.size("tags").cast("bigint").alias("n_tags"), F.md5(F.array_join("tags", "|")).alias("tags_md5")
    )


def contextual_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.raw_catalog(spark, sf_dir).select(
        "order_key", F.array_join(flag_tags(B.FLAG_COLUMNS), ",").alias("tags")
    )


def similar_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    similar = B.raw_catalog(spark, sf_dir).select(
        "order_key", F.posexplode(similar_list(similar_items(F.col("Similar Songs")))).alias("item_no", "item")
    )
    return similar.select("order_key", F.col("item_no").cast("bigint").alias("item_no"), "item.*")


def key_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.raw_catalog(spark, sf_dir).select(
        "order_key", _text("Key", "key_name"), F.coalesce(key_number(F.col("Key")), F.lit(-1)).alias("key_no")
    )


def audio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = B.raw_catalog(spark, sf_dir)
    return raw.select("order_key", F.explode(feature_map(raw.columns)).alias("feature", "value"))


QUERIES = {
    "catalog_json_scan": catalog_json_scan,
    "catalog_raw_lines": catalog_raw_lines,
    "catalog_file_index": catalog_file_index,
    "catalog_clean": catalog_clean,
    "catalog_quarantine": catalog_quarantine,
    "catalog_union": catalog_union,
    "catalog_track_index": catalog_track_index,
    "catalog_chunk_no": catalog_chunk_no,
    "catalog_head_sample": catalog_head_sample,
    "catalog_sample": catalog_sample,
    "catalog_stats": catalog_stats,
    "genre_distribution": genre_distribution,
    "emotion_distribution": emotion_distribution,
    "dim_index": dim_index,
    "track_id_hash": track_id_hash,
    "tag_split": tag_split,
    "contextual_tags": contextual_tags,
    "similar_tracks": similar_tracks,
    "key_parse": key_parse,
    "audio_features": audio_features,
}

_KEYS = "[" + ", ".join(f"'{name}'" for name in B.KEY_NAMES) + "]"
_RAW = f"""
raw AS (
  SELECT p_partkey AS order_key,
    CASE WHEN p_partkey % 50 = 7 THEN NULL WHEN p_partkey % 3 = 0 THEN ' ' || upper(p_brand) || chr(9)
         ELSE p_brand END AS artist,
    p_name AS song,
    CASE p_size % 4 WHEN 0 THEN 'Happy' WHEN 1 THEN 'sad' WHEN 2 THEN 'Calm' END AS emotion,
    CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_type END AS genre,
    CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 97 = 5 THEN 'fast'
         ELSE CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) END AS tempo,
    CASE WHEN p_partkey % 10 = 9 THEN NULL ELSE ({_KEYS})[p_size % 24 + 1] END AS key_name,
    CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 101 = 3 THEN 'loud'
         ELSE '-' || p_size || '.5' END AS loudness,
    CASE WHEN p_partkey % 19 = 4 THEN 'x' ELSE CAST(p_size AS VARCHAR) END AS energy,
    CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE CAST(p_size + 10 AS VARCHAR) END AS danceability,
    CASE p_partkey % 5 WHEN 0 THEN NULL
      WHEN 1 THEN '[{{"track_id": "' || p_name || '", "similarity": 0.85}}, {{"other": 1}}, "'
                  || split_part(p_name, ' ', 1) || '"]'
      WHEN 2 THEN '["' || p_name || '", "' || p_type || '", " ' || split_part(p_name, ' ', 1) || '", "w"]'
      WHEN 3 THEN p_name ELSE '[]' END AS similar_songs,
    p_size, p_name, p_type
  FROM part)"""
_KEY_NO = """
CASE WHEN key_name IS NULL THEN NULL ELSE
  CASE upper(key_name[1:1]) || CASE WHEN key_name[2:2] IN ('#', 'b') THEN key_name[2:2] ELSE '' END
    WHEN 'C' THEN 0 WHEN 'C#' THEN 1 WHEN 'D' THEN 2 WHEN 'Eb' THEN 3 WHEN 'E' THEN 4 WHEN 'F' THEN 5 WHEN 'F#' THEN 6
    WHEN 'Gb' THEN 6 WHEN 'G' THEN 7 WHEN 'Ab' THEN 8 WHEN 'A' THEN 9 WHEN 'Bb' THEN 10 WHEN 'B' THEN 11 ELSE 0 END
  + CASE WHEN lower(key_name) LIKE '%min%' THEN 12 ELSE 0 END END"""
_CLEAN = f"""
{_RAW},
parsed AS (
  SELECT order_key, {sql_track_id("artist", "song")} AS track_id, {strip("artist")} AS artist,
    {strip("song")} AS song_title, coalesce(lower(emotion), 'neutral') AS emotion,
    coalesce(lower(genre), 'unknown') AS genre, coalesce(TRY_CAST(tempo AS DOUBLE), 120.0) AS tempo,
    CAST(coalesce({_KEY_NO}, 0) AS INTEGER) AS key,
    coalesce(TRY_CAST(loudness AS DOUBLE), -10.0) AS loudness,
    order_key % 5 IN (1, 2, 3) AS has_similar,
    CASE WHEN artist IS NULL OR song IS NULL THEN 'missing name' WHEN tempo = 'fast' THEN 'bad tempo'
         WHEN loudness = 'loud' THEN 'bad loudness' END AS reject_reason
  FROM raw),
clean AS (SELECT * FROM parsed WHERE reject_reason IS NULL)"""
_CHUNKED = f"""
{_CLEAN},
numbered AS (SELECT *, row_number() OVER (ORDER BY order_key) - 1 AS row_no FROM clean),
chunked AS (
  SELECT *, row_no // {CHUNK} + 1 AS chunk_no,
    'tracks_chunk_' || lpad(CAST(row_no // {CHUNK} + 1 AS VARCHAR), 4, '0') || '.json' AS chunk_file FROM numbered)"""


def _sql_ids(dim: str) -> str:
    return f"""
SELECT '{dim}' AS dim, {dim} AS value, row_number() OVER (ORDER BY min(order_key)) - 1 AS id FROM clean GROUP BY {dim}"""


ORACLES = {
    "catalog_json_scan": f"""
WITH {_RAW}
SELECT order_key, coalesce(artist, '') AS artist, song, coalesce(emotion, '') AS emotion, coalesce(genre, '') AS genre,
  coalesce(tempo, '') AS tempo, coalesce(key_name, '') AS key_name, coalesce(loudness, '') AS loudness,
  coalesce(similar_songs, '') AS similar_songs FROM raw""",
    "catalog_raw_lines": f"""
SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS line_no,
  CASE WHEN p_partkey % {BROKEN} = 3 THEN '' ELSE p_name END AS song,
  CASE WHEN p_partkey % {BROKEN} = 3 THEN '{{"song": broken ' || p_partkey ELSE '' END AS line FROM part""",
    "catalog_file_index": f"""
WITH {_CLEAN},
whole AS (SELECT * FROM clean WHERE order_key % {BROKEN} <> 3),
chunked AS (
  SELECT *, 'tracks_chunk_' || lpad(CAST((row_number() OVER (ORDER BY order_key) - 1) // {CHUNK} + 1 AS VARCHAR), 4, '0')
    || '.json' AS chunk_file FROM whole)
SELECT track_id, artist, song_title, genre, emotion, chunk_file FROM chunked
QUALIFY row_number() OVER (PARTITION BY track_id ORDER BY order_key DESC) = 1""",
    "catalog_clean": f"""
WITH {_CLEAN}
SELECT order_key, track_id, artist, song_title, emotion, genre, tempo, key, loudness FROM clean""",
    "catalog_quarantine": f"""
WITH {_CLEAN} SELECT order_key, reject_reason FROM parsed WHERE reject_reason IS NOT NULL""",
    "catalog_union": f"WITH {_CLEAN} SELECT order_key, track_id, genre FROM clean",
    "catalog_track_index": f"""
WITH {_CHUNKED}
SELECT track_id, artist, song_title, genre, emotion, chunk_file FROM chunked
QUALIFY row_number() OVER (PARTITION BY track_id ORDER BY order_key DESC) = 1""",
    "catalog_chunk_no": f"WITH {_CHUNKED} SELECT order_key, row_no, chunk_no, chunk_file FROM chunked",
    "catalog_head_sample": f"""
WITH {_CLEAN} SELECT order_key, track_id FROM clean ORDER BY order_key LIMIT {catalogs.SAMPLE_SIZE}""",
    "catalog_sample": f"""
WITH {_CHUNKED},
drawn AS (
  SELECT order_key, chunk_no, md5(order_key || '#{SEED}') AS ticket,
    row_number() OVER (PARTITION BY chunk_no ORDER BY md5(order_key || '#{SEED}'), order_key) AS n FROM chunked)
SELECT order_key, chunk_no FROM drawn
WHERE n <= {SAMPLE_MAX} // (SELECT count(DISTINCT chunk_no) FROM chunked) + 1
ORDER BY ticket, order_key LIMIT {SAMPLE_MAX}""",
    "catalog_stats": f"""
WITH {_CLEAN}
SELECT 'total_tracks' AS metric, '' AS key, count(*) AS value FROM clean
UNION ALL SELECT 'distinct_tracks', '', count(DISTINCT track_id) FROM clean
UNION ALL SELECT 'unique_artists', '', count(DISTINCT artist) FROM clean
UNION ALL SELECT 'tracks_with_similar', '', count(*) FILTER (has_similar) FROM clean
UNION ALL SELECT 'genre_distribution', genre, count(*) FROM clean GROUP BY genre
UNION ALL SELECT 'emotion_distribution', emotion, count(*) FROM clean GROUP BY emotion""",
    "genre_distribution": f"WITH {_CLEAN} SELECT genre, count(*) AS tracks FROM clean GROUP BY genre",
    "emotion_distribution": f"WITH {_CLEAN} SELECT emotion, count(*) AS tracks FROM clean GROUP BY emotion",
    "dim_index": f"WITH {_CLEAN} {_sql_ids('genre')} UNION ALL {_sql_ids('emotion')}",
    "track_id_hash": f"SELECT doc_id, {sql_track_id('source', 'text')} AS track_id FROM documents",
    "tag_split": f"""
WITH split AS (
  SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '[,;|]'),
    lambda t: lower(regexp_replace(t, '^[{SPACE}]+|[{SPACE}]+$', '', 'g'))), lambda t: t <> '') AS tags FROM documents)
SELECT doc_id, CAST(len(tags) AS BIGINT) AS n_tags, md5(array_to_string(tags, '|')) AS tags_md5 FROM split""",
    "contextual_tags": """
SELECT p_partkey AS order_key, array_to_string(list_filter([
  CASE WHEN p_size % 2 = 0 THEN 'party' END,
  CASE WHEN p_size % 3 = 0 THEN 'work/study' END,
  CASE WHEN p_size % 5 = 0 THEN 'morning_routine' END], lambda t: t IS NOT NULL), ',') AS tags FROM part""",
    "similar_tracks": f"""
WITH {_RAW},
items AS (
  SELECT order_key, 0 AS item_no, p_name AS name, 0.85 AS similarity FROM raw WHERE order_key % 5 = 1
  UNION ALL SELECT order_key, 1, split_part(p_name, ' ', 1), 0.8 FROM raw WHERE order_key % 5 = 1
  UNION ALL SELECT order_key, 0, p_name, 0.8 FROM raw WHERE order_key % 5 IN (2, 3)
  UNION ALL SELECT order_key, 1, p_type, 0.8 FROM raw WHERE order_key % 5 = 2
  UNION ALL SELECT order_key, 2, split_part(p_name, ' ', 1), 0.8 FROM raw WHERE order_key % 5 = 2)
SELECT order_key, CAST(item_no AS BIGINT) AS item_no, {sql_track_id("'unknown'", "name")} AS track_id,
  CAST(similarity AS DOUBLE) AS similarity FROM items""",
    "key_parse": f"""
WITH {_RAW}
SELECT order_key, coalesce(key_name, '') AS key_name, CAST(coalesce({_KEY_NO}, -1) AS INTEGER) AS key_no FROM raw""",
    "audio_features": f"""
WITH {_RAW}
SELECT order_key, 'tempo' AS feature, TRY_CAST(tempo AS DOUBLE) AS value FROM raw
  WHERE TRY_CAST(tempo AS DOUBLE) IS NOT NULL
UNION ALL SELECT order_key, 'loudness_db', TRY_CAST(loudness AS DOUBLE) FROM raw
  WHERE TRY_CAST(loudness AS DOUBLE) IS NOT NULL
UNION ALL SELECT order_key, 'energy', TRY_CAST(energy AS DOUBLE) FROM raw WHERE TRY_CAST(energy AS DOUBLE) IS NOT NULL
UNION ALL SELECT order_key, 'danceability', TRY_CAST(danceability AS DOUBLE) FROM raw
  WHERE TRY_CAST(danceability AS DOUBLE) IS NOT NULL
UNION ALL SELECT order_key, 'key', CAST({_KEY_NO} AS DOUBLE) FROM raw WHERE key_name IS NOT NULL""",
}
