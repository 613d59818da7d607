"""Event time text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: ISO time; the fraction of a second may be absent.
ISO_READ = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"
ISO_WRITE = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def parse_iso(text: Column) -> Column:
    """Timestamp of an ISO text with 0 to 6 fraction digits; null for anything else."""
    return F.try_to_timestamp(text, F.lit(ISO_READ))


def format_iso(time: Column) -> Column:
    return F.date_format(time, ISO_WRITE)
