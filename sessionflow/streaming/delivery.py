"""Events of a topic that delivers them at least once: each passes once."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sessionflow.streaming.sessions import DELAY


def each_once(events: DataFrame, key: str = "event_id", delay: str = DELAY) -> DataFrame:
    """The events of a stream without repeated deliveries of one ``key``.

    A key is remembered until the watermark has passed its event by ``delay``; a delivery after that is late by itself and is
    dropped as such. So each event passes once, however often and however late it comes again, and state holds the keys of
    the last two delays only. Events are spread by key, which repeats a few times at most.
    """
    return events.withWatermark("event_time", delay).dropDuplicatesWithinWatermark([key])
