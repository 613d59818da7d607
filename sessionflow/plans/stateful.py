"""Queries on stateful streams: the tables arrive in slices of time, and the query is restarted before each of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionflow.operators import sessions as S
from sessionflow.operators.recommend import generate_recommendations
from sessionflow.plans.events import GAP_SECONDS
from sessionflow.plans.sessions import KEYS, WIDE_WINDOW, WINDOWS, window_bounds
from sessionflow.plans.sql import EVENTS, PLAYS, TRACKS, model, next_track
from sessionflow.sources import bindings as B
from sessionflow.sources import events as E
from sessionflow.storage import hand_off, new_folder
from sessionflow.streaming import delivery, documents, gap_sessions, metrics, offers, pair_model, sessions, sinks

DELAY_US = 60_000_000
LINGER_SECONDS = 3600
SLICES = 4
#: Users of whose sessions no recommendation arrives.
WITHOUT_OFFERS = 3
SAMPLE_SEED = "sample"
#: State lies in four partitions a core, or in so many where there are few cores.
LEAST_PARTITIONS = 32
ROW_GROUP = 4 << 20


def _slices(df: DataFrame, time: str = "event_time", like: DataFrame | None = None) -> Iterator[DataFrame]:
    """The rows in slices of equal time, the earliest first; ``like`` has the times to divide."""
    us = F.unix_micros(time)
    span = (like or df).agg(F.min(F.unix_micros("event_time")).alias("low"), F.max(F.unix_micros("event_time")).alias("high")).first()
    width = ((span.high or 0) - (span.low or 0)) // SLICES + 1
    for i in range(SLICES):
        yield df.filter(F.floor((us - (span.low or 0)) / width) == i)


def _stream(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.readStream.schema(like.schema).parquet(path)


def _arrive(df: DataFrame, folder: str, run: Callable[[DataFrame], None]) -> None:
    """Slice after slice of ``df`` arrives in a folder; each time ``run`` starts the query anew on a stream of it."""
    for part in _slices(df):
        part.write.mode("append").parquet(f"{folder}/in")
        run(_stream(df.sparkSession, f"{folder}/in", df))


def stream_session_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session numbers of all events in closed sessions; the sessions come from a stream."""
    folder, events = new_folder(spark, "gap-sessions"), B.events(spark, sf_dir)
    closed = lambda stream: gap_sessions.gap_session_stream(stream, gap_seconds=GAP_SECONDS)
    _arrive(events, folder, lambda stream: sinks.run_to_table(closed(stream), f"{folder}/out", f"{folder}/checkpoint"))
    stored = sinks.read_batches(spark, f"{folder}/out", closed(_stream(spark, f"{folder}/in", events)).schema)
    assigned = S.assign_from_sessions(events, stored, "user_id", GAP_SECONDS, B.skew_of(spark, sf_dir, "events"))
    return assigned.select("event_id", "user_id", "session_no", "session_start_us")


def stream_gap_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The closed sessions themselves: events, bounds, first and last track."""
    folder, events = new_folder(spark, "gap-tables"), B.events(spark, sf_dir)
    closed = lambda stream: gap_sessions.gap_session_stream(stream, gap_seconds=GAP_SECONDS)
    _arrive(events, folder, lambda stream: sinks.run_to_table(closed(stream), f"{folder}/out", f"{folder}/checkpoint"))
    stored = sinks.read_batches(spark, f"{folder}/out", closed(_stream(spark, f"{folder}/in", events)).schema)
    return stored.select("user_id", "events", "first_us", "last_us", "first_track", "last_track")


def stream_pair_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pair counts kept by a stateful stream, folded into a base halfway: the model of all plays."""
    folder, plays = new_folder(spark, "pair-model"), B.plays(spark, sf_dir)
    partitions = min(int(spark.conf.get(pair_model.PARTITIONS)), max(LEAST_PARTITIONS, 4 * spark.sparkContext.defaultParallelism))
    for i, part in enumerate(_slices(plays)):
        # small row groups: a slice of a table in order of time lies in few files, which all cores are to read
        part.write.mode("append").option("parquet.block.size", ROW_GROUP).parquet(f"{folder}/in")
        pair_model.run_pair_model(_stream(spark, f"{folder}/in", plays), folder, partitions=partitions)
        if i == SLICES // 2:
            pair_model.fold_model(spark, folder)
    return pair_model.pair_model(spark, folder)


def stream_events_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every slice is delivered again together with the next one; each event passes once."""
    folder, events, before = new_folder(spark, "once"), B.events(spark, sf_dir), None
    for part in _slices(events):
        both = part if before is None else part.unionByName(before)
        both.write.mode("append").parquet(f"{folder}/in")
        sinks.run_to_table(delivery.each_once(_stream(spark, f"{folder}/in", events)), f"{folder}/out", f"{folder}/checkpoint")
        before = part
    return sinks.read_batches(spark, f"{folder}/out", events.schema).select("event_id", "user_id", "track_id", "event_type")


def _offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recommendations of the sessions of most users, made at the session's last play."""
    plays = B.plays(spark, sf_dir)
    chosen = F.col("next_track_recommendation")
    picks = generate_recommendations(plays, KEYS, B.EVENT_ORDER, skew=B.skew_of(spark, sf_dir, "events"))
    made = plays.groupBy(*KEYS).agg(F.max("event_time").alias("made_at"))
    picks = picks.select(*KEYS, chosen["track"].alias("recommended_track"), chosen["strategy"].alias("rec_strategy"))
    return picks.join(made, list(KEYS)).filter(F.col("user_id") % WITHOUT_OFFERS != 0)


def stream_window_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session windows joined with a stream of recommendations; windows are complete once the watermark passed their bound."""
    folder = new_folder(spark, "offers")
    plays = B.plays(spark, sf_dir)
    made = hand_off(_offers(spark, sf_dir), "offers-made")

    def joined() -> DataFrame:
        enriched = E.enrich_stream(_stream(spark, f"{folder}/plays", plays), B.tracks(spark, sf_dir))
        windows = sessions.session_stream(enriched, window=WIDE_WINDOW)
        return offers.windows_with_offers(windows, _stream(spark, f"{folder}/offers", made), WIDE_WINDOW)

    for played, offered in zip(_slices(plays), _slices(made, "made_at", plays), strict=True):
        played.write.mode("append").parquet(f"{folder}/plays")
        offered.write.mode("append").parquet(f"{folder}/offers")
        sinks.run_to_table(joined(), f"{folder}/out", f"{folder}/checkpoint")
    seen = plays.agg(F.max(F.unix_micros("event_time")).alias("us")).first().us or 0
    offered = made.agg(F.max(F.unix_micros("made_at")).alias("us")).first().us or 0
    passed = (min(seen, offered) - 2 * DELAY_US) // 1_000_000 - LINGER_SECONDS
    done = sinks.read_batches(spark, f"{folder}/out", joined().schema).filter(F.unix_seconds("window.end") <= passed)
    return done.select(*window_bounds(), *KEYS, "track_count", "last_track", "recommended_track", "rec_strategy")


def stream_session_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest closed window of every session, upserted by session into a document store, compacted on the way."""
    folder, plays = new_folder(spark, "documents"), B.plays(spark, sf_dir)
    columns = ("window", *KEYS, "track_count", "first_artist", "last_track")

    def windows(stream: DataFrame) -> DataFrame:
        return sessions.session_stream(E.enrich_stream(stream, B.tracks(spark, sf_dir)), window=WIDE_WINDOW).select(*columns)

    schema = windows(_stream(spark, sf_dir, plays)).schema
    for i, part in enumerate(_slices(plays)):
        part.write.mode("append").parquet(f"{folder}/in")
        query = documents.start_documents(windows(_stream(spark, f"{folder}/in", plays)), f"{folder}/store", f"{folder}/checkpoint", sinks.WAIT)
        query.awaitTermination()
        if i == SLICES // 2:
            documents.compact(spark, f"{folder}/store", schema, KEYS)
    return documents.read_documents(spark, f"{folder}/store", schema, KEYS).select(*window_bounds(), *columns[1:])


def stream_batch_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sample events of every micro-batch, stored twice as after a failure."""
    folder, events, number = new_folder(spark, "samples"), B.events(spark, sf_dir), iter(range(SLICES))

    def run(stream: DataFrame) -> None:
        part = next(number)

        def store(batch: DataFrame, batch_id: int) -> None:
            for _ in range(2):
                chosen = metrics.sample_events(batch, "event_id", SAMPLE_SEED).select("event_id", "user_id", "event_type")
                sinks.write_batch(chosen.withColumn("slice", F.lit(part).cast("bigint")), batch_id, f"{folder}/out")

        sinks.start(stream, store, f"{folder}/checkpoint", trigger=sinks.WAIT).awaitTermination()

    _arrive(events, folder, run)
    return spark.read.parquet(f"{folder}/out").select("slice", "event_id", "user_id", "event_type")


def stream_distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users, tracks and sessions by sketches stored per micro-batch, each stored twice, beside the exact counts."""
    folder, plays = new_folder(spark, "distincts"), B.plays(spark, sf_dir)
    columns = ["user_id", "track_id", "session_id"]

    def store(batch: DataFrame, batch_id: int) -> None:
        for _ in range(2):
            metrics.write_distincts(batch, batch_id, f"{folder}/out", columns)

    _arrive(plays, folder, lambda stream: sinks.start(stream, store, f"{folder}/checkpoint", trigger=sinks.WAIT).awaitTermination())
    estimates = metrics.distinct_counts(spark, f"{folder}/out", columns).unpivot([], columns, "what", "estimate")
    exact = plays.agg(*[F.count_distinct(c).alias(c) for c in columns]).unpivot([], columns, "what", "exact")
    error = 3 * 1.04 / 2 ** (metrics.SKETCH_BITS / 2)
    close = F.abs(F.col("estimate") - F.col("exact")) <= F.col("exact") * error + 1
    return estimates.join(exact, "what").select("what", "exact", close.alias("within_error"))


QUERIES = {
    "stream_batch_samples": stream_batch_samples,
    "stream_distinct_counts": stream_distinct_counts,
    "stream_session_assign": stream_session_assign,
    "stream_gap_sessions": stream_gap_sessions,
    "stream_pair_model": stream_pair_model,
    "stream_events_once": stream_events_once,
    "stream_window_offers": stream_window_offers,
    "stream_session_documents": stream_session_documents,
}

_NUMBERED = f"""
marked AS (
  SELECT *, CASE WHEN us - lag(us) OVER w > {GAP_SECONDS}000000 OR lag(us) OVER w IS NULL THEN 1 ELSE 0 END AS is_new
  FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)),
numbered AS (
  SELECT *, CAST(sum(is_new) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT)
    AS session_no FROM marked),
gaps AS (
  SELECT user_id, session_no, count(*) AS events, min(us) AS first_us, max(us) AS last_us,
    arg_min(track_id, (us, event_id)) AS first_track, arg_max(track_id, (us, event_id)) AS last_track
  FROM numbered GROUP BY user_id, session_no
  HAVING max(us) + {GAP_SECONDS}000001 <= (SELECT max(us) // 1000 * 1000 - {DELAY_US} FROM ev))"""

ORACLES = {
    "stream_batch_samples": f"""
WITH {EVENTS},
bounds AS (SELECT min(us) AS low, (max(us) - min(us)) // {SLICES} + 1 AS width FROM ev),
sliced AS (SELECT ev.*, (us - low) // width AS slice FROM ev CROSS JOIN bounds)
SELECT slice, event_id, user_id, event_type FROM sliced
QUALIFY row_number() OVER (PARTITION BY slice ORDER BY md5(event_id || '#{SAMPLE_SEED}'), event_id) <= 3""",
    "stream_distinct_counts": f"""
WITH {PLAYS}
SELECT 'user_id' AS what, count(DISTINCT user_id) AS exact, true AS within_error FROM plays
UNION ALL SELECT 'track_id', count(DISTINCT track_id), true FROM plays
UNION ALL SELECT 'session_id', count(DISTINCT session_id), true FROM plays""",
    "stream_session_assign": f"""
WITH {EVENTS}, {_NUMBERED}
SELECT event_id, user_id, session_no, first_us AS session_start_us FROM numbered JOIN gaps USING (user_id, session_no)""",
    "stream_gap_sessions": f"""
WITH {EVENTS}, {_NUMBERED}
SELECT user_id, events, first_us, last_us, first_track, last_track FROM gaps""",
    "stream_pair_model": f"""
WITH {PLAYS}, {model("plays", "user_id, session_id", "us, event_id")}
SELECT last_track, track_id, pair_count FROM pairs""",
    "stream_events_once": f"WITH {EVENTS} SELECT event_id, user_id, track_id, event_type FROM ev",
    "stream_window_offers": f"""
WITH {PLAYS}, {TRACKS}, {WINDOWS}, {model("plays", "user_id, session_id", "us, event_id")},
{next_track("edges", "cooccurrence", "s.user_id, s.session_id")},
made AS (
  SELECT r.user_id, r.session_id, next_track, strategy, m.us
  FROM recs r JOIN (SELECT user_id, session_id, max(us) AS us FROM plays GROUP BY ALL) m USING (user_id, session_id)
  WHERE r.user_id % {WITHOUT_OFFERS} <> 0)
SELECT window_start, window_end, w.user_id, w.session_id, w.track_count, w.last_track,
  m.next_track AS recommended_track, m.strategy AS rec_strategy
FROM windows w LEFT JOIN made m ON m.user_id = w.user_id AND m.session_id = w.session_id
  AND m.us >= window_start * 1000000 AND m.us < (window_end + {LINGER_SECONDS}) * 1000000
WHERE window_end <= (least((SELECT max(us) FROM plays), (SELECT max(us) FROM made)) - {2 * DELAY_US}) // 1000000 - {LINGER_SECONDS}""",
    "stream_session_documents": f"""
WITH {PLAYS}, {TRACKS}, {WINDOWS}
SELECT window_start, window_end, user_id, session_id, track_count, first_artist, last_track FROM windows
WHERE window_end * 1000000 <= (SELECT max(us) - {DELAY_US} FROM plays)
QUALIFY row_number() OVER (PARTITION BY user_id, session_id ORDER BY window_start DESC) = 1""",
}
