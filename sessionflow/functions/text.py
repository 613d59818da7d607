"""Text normalisation, track ids and tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space, and everything that is no letter, digit, underscore, white space or hyphen.
WHITE_SPACE = r"\s\x0B\x1C-\x1F\x85\p{Z}"
NOT_WORD = rf"[^\p{{L}}\p{{N}}_{WHITE_SPACE}-]"
UNKNOWN_ARTIST = "unknown"
TAG_SEPARATORS = "[,;|]"
FLAG_PREFIX = "Good for "


def strip(text: Column) -> Column:
    """Remove all leading and trailing white space, not only blanks."""
    return F.regexp_replace(text, f"^[{WHITE_SPACE}]+|[{WHITE_SPACE}]+$", "")


def _name_part(text: Column) -> Column:
    return F.regexp_replace(strip(F.lower(text)), NOT_WORD, "")


def track_id(artist: Column, title: Column) -> Column:
    """Stable id of a track: equal for names that differ only in case, punctuation or outer white space."""
    digest = F.md5(F.concat(_name_part(artist), F.lit("||"), _name_part(title)))
    return F.concat(F.lit("track_"), F.substring(digest, 1, 12))


def clean_tags(tags: Column) -> Column:
    """Tags stripped and lower-cased; null and blank ones dropped; null gives an empty array."""
    cleaned = F.transform(tags, lambda t: F.lower(strip(t)))
    return F.coalesce(F.filter(cleaned, lambda t: t.isNotNull() & (t != "")), F.array().cast("array<string>"))


def split_tags(text: Column) -> Column:
    """Tags of a text such as ``Party, work|STUDY``."""
    return clean_tags(F.split(text, TAG_SEPARATORS))


def flag_tag(column: str) -> str:
    """Tag of a flag column: ``Good for Work/Study`` -> ``work/study``."""
    return column.removeprefix(FLAG_PREFIX).lower().replace(" ", "_")


def flag_columns(columns: list[str]) -> list[str]:
    return [c for c in columns if c.startswith(FLAG_PREFIX.rstrip())]


def flag_tags(columns: list[str]) -> Column:
    """Tags of the flag columns that are set. Flags are text; null, zero and unreadable flags are off."""
    tags = [
        F.when(F.col(f"`{c}`").try_cast("double") != 0, F.lit(flag_tag(c))) for c in columns
    ]
    return F.array_compact(F.array(*tags)) if tags else F.array().cast("array<string>")
