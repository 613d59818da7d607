"""Two streams joined: closed session windows with the recommendations made for their session."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionflow.streaming.sessions import DELAY

#: A recommendation belongs to a session window from the window's begin until this long after its end.
LINGER = "1 hour"


def windows_with_offers(windows: DataFrame, offers: DataFrame, span: str, linger: str = LINGER, delay: str = DELAY) -> DataFrame:
    """Closed windows, left outer joined with ``offers`` (user_id, session_id, made_at, recommended_track, rec_strategy).

    ``windows`` is a watermarked stream of session windows of length ``span`` (see ``session_stream``). Both sides wait in
    state: a window until the watermark has passed its end and ``linger``, when it is given out alone if nothing matched; an
    offer until no open window can hold its time. So state follows the bounds, not the history, and a window that nothing
    matches comes out once, with nulls. The watermark is that of the slower stream.
    """
    rest = [c for c in windows.columns if c != "window"]
    bounds = [F.col("window.start").alias("_start"), F.col("window.end").alias("_end")]  # one column may carry a watermark
    left = windows.select(F.window_time("window").alias("closed_at"), *bounds, *rest)
    right = offers.filter(F.col("made_at").isNotNull()).withWatermark("made_at", delay).select(
        F.col("user_id").alias("for_user"), F.col("session_id").alias("for_session"), "made_at", "recommended_track", "rec_strategy"
    )
    in_time = (F.col("made_at") > F.col("closed_at") - F.expr(f"INTERVAL {span}")) & (F.col("made_at") <= F.col("closed_at") + F.expr(f"INTERVAL {linger}"))
    same = (F.col("user_id") == F.col("for_user")) & (F.col("session_id") == F.col("for_session"))
    window = F.struct(F.col("_start").alias("start"), F.col("_end").alias("end")).alias("window")
    return left.join(right, same & in_time, "left_outer").select(window, *rest, "made_at", "recommended_track", "rec_strategy")
