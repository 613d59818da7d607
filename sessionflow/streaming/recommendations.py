"""Recommendations on a stream: per micro-batch, or from all plays stored so far."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sessionflow.operators.recommend import DEFAULT_TOP_N, enrich_sessions, generate_recommendations
from sessionflow.operators.skew import policy_for
from sessionflow.storage import hand_off
from sessionflow.streaming import sinks


def recommend_batch(plays: DataFrame, batch_id: int, folder: str, top_n: int = DEFAULT_TOP_N) -> DataFrame:
    """Store the recommendations of one micro-batch, and return them as stored.

    The plan reads the batch several times, so it goes on from the plays written to the shared folder.
    """
    kept = hand_off(plays, "batch-plays")
    return sinks.write_and_reread(generate_recommendations(kept, top_n=top_n, skew=policy_for(kept)), batch_id, folder)


def start_recommendations(
    plays: DataFrame, folder: str, checkpoint: str, top_n: int = DEFAULT_TOP_N, trigger: dict | None = None
) -> StreamingQuery:
    """Recommendations whose model is each micro-batch's own plays."""
    return sinks.start(
        plays,
        lambda batch, batch_id: recommend_batch(batch, batch_id, folder, top_n),
        checkpoint,
        trigger=trigger,
    )


def enriched_sessions(sessions: DataFrame, recommendation_log: DataFrame) -> DataFrame:
    """Stored session windows with the newest stored recommendation of their session."""
    return enrich_sessions(sessions, sinks.latest_rows(recommendation_log, ["user_id", "session_id"]))


def run_play_log(plays: DataFrame, folder: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Store the plays of a stream; a model over all of them is then ``recommend_from_log``."""
    return sinks.run_to_table(plays, folder, checkpoint, trigger=trigger)


def recommend_from_log(
    spark: SparkSession, folder: str, schema: T.StructType, top_n: int = DEFAULT_TOP_N
) -> DataFrame:
    """Recommendations from every play stored so far."""
    plays = sinks.read_batches(spark, folder, schema).drop("batch_id")
    return generate_recommendations(plays, top_n=top_n, skew=policy_for(plays))
