"""The streaming job: messages in; session windows, recommendations, rejected messages and counts out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sessionflow.operators.recommend import DEFAULT_TOP_N, enrich_sessions
from sessionflow.sources import events as E
from sessionflow.streaming import documents, metrics, recommendations, sessions, sinks

# Fixed value: trigger of the main queries.
EVERY = {"processingTime": "20 seconds"}


@dataclass(frozen=True)
class Job:
    """The running queries of one job and where they write."""

    folder: str
    sessions: StreamingQuery
    recommendations: StreamingQuery
    quarantine: StreamingQuery

    @property
    def queries(self) -> tuple[StreamingQuery, ...]:
        return (self.sessions, self.recommendations, self.quarantine)

    def await_end(self) -> None:
        """Wait until all queries end. If one fails, the others are stopped and the failure raised."""
        try:
            while any(query.isActive for query in self.queries):
                for query in self.queries:
                    query.awaitTermination(1)
            for query in self.queries:
                query.awaitTermination()
        finally:
            self.stop()

    def stop(self) -> None:
        """Stop all queries; the checkpoints let the next start repeat an unfinished batch and go on from there."""
        for query in self.queries:
            query.stop()

    def finish(self) -> None:
        """Finish the input seen so far, then stop: for sources that stand still, since a busy topic never ends."""
        for query in self.queries:
            query.processAllAvailable()
        self.stop()


def start_job(
    messages: DataFrame,
    folder: str,
    window: str = sessions.WINDOW,
    delay: str = sessions.DELAY,
    top_n: int = DEFAULT_TOP_N,
    trigger: dict | None = None,
) -> Job:
    """Start the session, recommendation and quarantine queries over a stream of messages.

    Tables below ``folder``: session_lists (track lists in slices), sessions (final windows), recommendations,
    quarantine (messages that are unreadable or have no readable time, with their text), event_counts (a row per
    batch) and event_samples (three decoded messages per batch). Each has a folder per micro-batch. Besides there are two document stores, upserted by key: session_documents
    (a document per user, session and window) and recommendation_documents (the newest per user and session); read them with
    ``session_documents`` and ``recommendation_documents``.
    """
    everything = E.with_event_time(E.decode(messages))
    decoded = E.valid_events(E.decode(messages))
    trigger = trigger or EVERY

    def store_sessions(pieces: DataFrame, batch_id: int) -> None:
        stored = sinks.write_and_reread(pieces, batch_id, f"{folder}/session_lists")
        final = sinks.write_and_reread(sessions.sessions_of_pieces(stored), batch_id, f"{folder}/sessions")
        documents.upsert(final, batch_id, f"{folder}/session_documents")

    def store_recommendations(batch: DataFrame, batch_id: int) -> None:
        made = recommendations.recommend_batch(batch, batch_id, f"{folder}/recommendations", top_n)
        documents.upsert(made, batch_id, f"{folder}/recommendation_documents")

    def store_rejected(batch: DataFrame, batch_id: int) -> None:
        rejected = F.col(E.CORRUPT).isNotNull() | F.col("event_time").isNull()
        sinks.write_batch(metrics.sample_events(batch, "event_id"), batch_id, f"{folder}/event_samples")
        counts = metrics.message_counts()
        metrics.write_counted(batch, batch_id, f"{folder}/quarantine", counts, f"{folder}/event_counts", rejected)

    windows = sessions.session_piece_stream(E.plays_of(decoded), window, delay)
    return Job(
        folder,
        sinks.start(windows, store_sessions, f"{folder}/checkpoints/sessions", trigger=trigger),
        sinks.start(E.plays_of(decoded), store_recommendations, f"{folder}/checkpoints/recommendations", trigger=trigger),
        sinks.start(everything, store_rejected, f"{folder}/checkpoints/quarantine", trigger=trigger),
    )


def session_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The final session windows that the job below ``folder`` has stored, one document per user, session and window."""
    schema = spark.read.parquet(f"{folder}/sessions").drop("batch_id").schema
    return documents.read_documents(spark, f"{folder}/session_documents", schema, sessions.KEYS)


def recommendation_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The newest recommendation of every user and session."""
    schema = spark.read.parquet(f"{folder}/recommendations").drop("batch_id").schema
    return documents.read_documents(spark, f"{folder}/recommendation_documents", schema, ("user_id", "session_id"))


def job_enriched_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """The job's session windows with the track recommended for their session."""
    return enrich_sessions(session_documents(spark, folder), recommendation_documents(spark, folder))
