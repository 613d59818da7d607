"""Seeded draws: the same key and seed always give the same number, on any cluster."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(seed: str, *keys: Column) -> Column:
    """md5 hex of the keys and the seed."""
    return F.md5(F.concat_ws("#", *[k.cast("string") for k in keys], F.lit(seed)))


def draw(seed: str, *keys: Column) -> Column:
    """A 60-bit non-negative integer, even over its range."""
    return F.conv(F.substring(digest(seed, *keys), 1, 15), 16, 10).cast("bigint")
