"""Musical keys, audio features and similar-track lists of a raw catalog row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sessionflow.functions.text import UNKNOWN_ARTIST, strip, track_id

# Pitch class of each key name; an unlisted spelling counts as 0; minor keys are 12 higher.
PITCH_CLASS = {
    "C": 0, "C#": 1, "Db": 1, "D": 2, "D#": 3, "Eb": 3, "E": 4, "F": 5, "F#": 6, "Gb": 6, "G": 7, "G#": 8, "Ab": 8,
    "A": 9, "A#": 10, "Bb": 10, "B": 11,
}
MINOR_OFFSET = 12

# Raw columns that become audio features, next to the key; most similar tracks kept; weight of a bare name.
FEATURE_COLUMNS = ("Tempo", "Loudness (db)", "Energy", "Danceability")
MAX_SIMILAR = 3
NAMED_SIMILARITY = 0.8


def key_number(text: Column) -> Column:
    """0..11 for a major key, 12..23 for a minor one, null when the text names no key."""
    name = strip(text)
    letter = F.upper(F.regexp_extract(name, "^([A-Ga-g])", 1))
    accidental = F.regexp_extract(name, "^[A-Ga-g]([#b])", 1)
    mode = F.lower(F.regexp_extract(name, "(?i)(maj|min)", 1))
    pitches = F.create_map(*[F.lit(x) for pair in PITCH_CLASS.items() for x in pair])
    pitch = F.coalesce(F.try_element_at(pitches, F.concat(letter, accidental)), F.lit(0))
    return F.when(letter != "", pitch + F.when(mode == "min", MINOR_OFFSET).otherwise(0))


def feature_name(column: str) -> str:
    """``Loudness (db)`` -> ``loudness_db``."""
    return column.lower().replace(" ", "_").replace("(", "").replace(")", "")


def audio_features(columns: list[str]) -> Column:
    """map<string, double> of the features whose raw text is a number, and of the key if it is given."""
    entries = [
        F.struct(F.lit(feature_name(c)).alias("k"), F.col(f"`{c}`").try_cast("double").alias("v"))
        for c in FEATURE_COLUMNS
        if c in columns
    ]
    if "Key" in columns:
        key = F.when(F.col("Key").isNotNull(), F.coalesce(key_number(F.col("Key")), F.lit(0)))
        entries.append(F.struct(F.lit("key").alias("k"), key.cast("double").alias("v")))
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e["v"].isNotNull()))


def similar_items(text: Column) -> Column:
    """array<struct<name, similarity>> of the first items of a similar-songs text; null for a broken JSON list.

    The text is a JSON list of names and of {track_id, similarity} objects, or one plain name. Items of any other kind
    are left out; an object whose similarity is no number stays, with a null similarity.
    """
    is_list = F.coalesce(F.startswith(text, F.lit("[")), F.lit(False))
    values = F.try_variant_get(F.try_parse_json(F.when(is_list, text)), "$", "array<variant>")

    def item(value: Column) -> Column:
        is_name = F.schema_of_variant(value) == "STRING"
        name = F.try_variant_get(value, "$.track_id", "string")
        has_similarity = F.try_variant_get(value, "$.similarity", "variant").isNotNull()
        named = F.struct(
            F.try_variant_get(value, "$", "string").alias("name"), F.lit(NAMED_SIMILARITY).alias("similarity")
        )
        pair = F.struct(name.alias("name"), F.try_variant_get(value, "$.similarity", "double").alias("similarity"))
        return F.when(is_name, named).when(name.isNotNull() & has_similarity, pair)

    listed = F.array_compact(F.transform(F.slice(values, 1, MAX_SIMILAR), item))
    plain = F.when(
        strip(text) != "", F.array(F.struct(text.alias("name"), F.lit(NAMED_SIMILARITY).alias("similarity")))
    )
    none = F.array().cast("array<struct<name:string,similarity:double>>")
    return F.when(is_list, listed).otherwise(F.coalesce(plain, none))


def similar_tracks(items: Column) -> Column:
    """array<struct<track_id, similarity>> of the items of ``similar_items``."""
    return F.transform(
        items,
        lambda i: F.struct(
            track_id(F.lit(UNKNOWN_ARTIST), i["name"]).alias("track_id"), i["similarity"].alias("similarity")
        ),
    )


def similar_is_bad(items: Column) -> Column:
    """True for a broken JSON list, or when an object has no numeric similarity."""
    return items.isNull() | F.exists(items, lambda i: i["similarity"].isNull())
