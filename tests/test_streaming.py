"""Watermarks, late rows, restarts, replays and metrics on file streams."""

import time

from pyspark.sql import functions as F

from sessionflow.operators.recommend import generate_recommendations
from sessionflow.sources import events as E
from sessionflow.streaming import metrics, recommendations, sessions, sinks
from sessionflow.streaming.job import start_job

EVENT = "event_id bigint, user_id string, session_id string, track_id string, artist string, t double, event_type string"


def add_file(spark, folder, rows):
    """Append one file of plays (event_id, seconds)."""
    data = [(i, "u", "s", f"t{i}", f"a{i}", float(t), "play") for i, t in rows]
    spark.createDataFrame(data, EVENT).coalesce(1).write.mode("append").parquet(folder)


def play_stream(spark, folder):
    stream = spark.readStream.schema(spark.read.parquet(folder).schema).option("maxFilesPerTrigger", 1).parquet(folder)
    return stream.withColumn("event_time", F.timestamp_seconds("t"))


def window_counts(spark, path):
    rows = spark.read.parquet(path).collect()
    return sorted((int(r["window"]["start"].timestamp()), r["track_count"]) for r in rows)


def test_late_rows_are_dropped_and_a_restart_repeats_nothing(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    arrivals = [[(1, 10), (2, 110)], [(3, 150)], [(4, 60)], [(5, 300)], [(6, 310)], [(7, 30)]]
    dropped = 0
    for rows in arrivals:  # every file is a run of its own, from the same checkpoint
        add_file(spark, folder, rows)
        query = sinks.run_to_table(sessions.session_stream(play_stream(spark, folder)), out, checkpoint)
        dropped += metrics.dropped_late_rows(query)
    assert window_counts(spark, out) == [(0, 3), (120, 1)]
    assert dropped == 1


def test_update_mode_keeps_the_newest_row_per_window(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    for rows in ([(1, 10)], [(2, 20), (3, 130)], [(4, 30)]):
        add_file(spark, folder, rows)
        stream = sessions.session_stream(play_stream(spark, folder))
        sinks.run_to_table(stream, out, checkpoint, mode="update")
    log = sinks.read_batches(spark, out, stream.schema)
    assert log.count() > 2
    latest = sinks.latest_rows(log, sessions.KEYS).collect()
    assert sorted((r["track_count"], r["last_track"]) for r in latest) == [(1, "t3"), (3, "t4")]


def test_track_list_slices_equal_the_window_aggregate(spark, tmp_path):
    folder = str(tmp_path / "in")
    add_file(spark, folder, [(i, i * 7) for i in range(100)])
    pieces_out, out = str(tmp_path / "pieces"), str(tmp_path / "out")
    sinks.run_to_table(sessions.session_piece_stream(play_stream(spark, folder)), pieces_out, str(tmp_path / "c1"))
    sinks.run_to_table(sessions.session_stream(play_stream(spark, folder)), out, str(tmp_path / "c2"))
    pieces = spark.read.parquet(pieces_out).drop("batch_id")
    columns = [*sessions.KEYS, "track_count", "first_artist", "last_track", "has_multiple_tracks"]
    together = sessions.sessions_of_pieces(pieces).select(columns).collect()
    assert sorted(map(tuple, together)) == sorted(map(tuple, spark.read.parquet(out).select(columns).collect()))
    lists = pieces.orderBy("slice_no").collect()
    assert [t for r in lists for t in r["tracks"]] == [f"t{i}" for i in range(len([t for r in lists for t in r["tracks"]]))]


def test_recommendations_per_batch_survive_a_replay(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    add_file(spark, folder, [(1, 10), (2, 20), (3, 30)])
    batch = spark.read.parquet(folder).withColumn("event_time", F.timestamp_seconds("t"))
    for _ in range(2):
        recommendations.recommend_batch(batch, 0, out)
    got = spark.read.parquet(out)
    assert got.count() == 1
    assert got.first()["next_track_recommendation"]["track"] == "t1"
    assert recommendations.enriched_sessions(
        batch.groupBy("user_id", "session_id").count(), got
    ).first()["recommended_track"] == "t1"


def test_play_log_model_uses_all_batches(spark, tmp_path):
    folder, log, checkpoint = (str(tmp_path / n) for n in ("in", "log", "checkpoint"))
    for rows in ([(1, 10)], [(2, 20)], [(3, 30)]):
        add_file(spark, folder, rows)
        recommendations.run_play_log(play_stream(spark, folder), log, checkpoint, sinks.WAIT)
    schema = play_stream(spark, folder).schema
    got = recommendations.recommend_from_log(spark, log, schema).first()["next_track_recommendation"]
    whole = spark.read.parquet(folder).withColumn("event_time", F.timestamp_seconds("t"))
    want = generate_recommendations(whole, skew=None).first()["next_track_recommendation"]
    assert got == want


def test_every_batch_leaves_its_counts(spark, tmp_path):
    folder, out, counts = (str(tmp_path / n) for n in ("in", "out", "counts"))
    for i in range(12):
        add_file(spark, folder, [(2 * i, 10), (2 * i + 1, 20)])

    def store(batch, batch_id):
        for _ in range(2):  # a replay changes nothing
            metrics.write_counted(batch, batch_id, out, metrics.event_counts(), counts, F.col("t") > 10)

    sinks.start(play_stream(spark, folder), store, str(tmp_path / "checkpoint"), trigger=sinks.WAIT).awaitTermination()
    rows = spark.read.parquet(counts).collect()
    assert [(r["events"], r["plays"], r["skips"]) for r in rows] == [(2, 2, 0)] * 12
    assert spark.read.parquet(out).count() == 12


def test_every_progress_report_is_stored(spark, tmp_path):
    """More batches than Spark keeps reports of; late rows and state are in them."""
    folder, out, reports = (str(tmp_path / n) for n in ("in", "out", "reports"))
    add_file(spark, folder, [(1, 1000)])
    listener = metrics.StoreProgress(reports)
    spark.streams.addListener(listener)
    try:
        sinks.run_to_table(sessions.session_stream(play_stream(spark, folder)), out, str(tmp_path / "checkpoint"))
        for t in (5000, 10):  # the second is late
            add_file(spark, folder, [(t, t)])
            sinks.run_to_table(sessions.session_stream(play_stream(spark, folder)), out, str(tmp_path / "checkpoint"))
        rates = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 3).load()
        query = sinks.start(rates, lambda batch, batch_id: batch.foreach(lambda row: None), str(tmp_path / "rates"), trigger={"processingTime": "0 seconds"})
        while (query.lastProgress or {"batchId": 0})["batchId"] < 120:
            query.awaitTermination(1)
        query.stop()
    finally:
        for _ in range(60):  # reports reach listeners by a queue
            if len(list((tmp_path / "reports").glob("*.json"))) >= 125:
                break
            time.sleep(1)
        spark.streams.removeListener(listener)
    rows = metrics.read_progress(spark, reports).collect()
    rated = {r["batch"]: r["rows"] for r in rows if r["query_id"] == str(query.id)}
    assert set(range(120)) <= set(rated) and {rated[i] for i in range(120)} == {3}
    others = [r for r in rows if r["query_id"] != str(query.id)]
    assert sum(r["late_rows"] for r in others) == 1 and max(r["state_rows"] for r in others) >= 1


def test_samples_of_a_batch_are_the_same_in_any_order(spark):
    rows = spark.range(500).select(F.col("id").alias("event_id"))
    ids = [sorted(r["event_id"] for r in metrics.sample_events(rows.repartition(n), "event_id").collect()) for n in (1, 7)]
    assert ids[0] == ids[1] and len(ids[0]) == 3
    assert metrics.sample_events(rows.limit(2), "event_id").count() == 2


def test_table_stream_reads_a_file_and_a_folder(spark, tmp_path):
    folder = str(tmp_path / "table")
    add_file(spark, folder, [(1, 10), (2, 20)])
    schema = spark.read.parquet(folder).schema
    single = next((tmp_path / "table").glob("*.parquet"))
    for i, path in enumerate((folder, str(single))):
        stream = E.table_stream(spark, path, schema)
        out = str(tmp_path / f"out{i}")
        sinks.run_to_table(stream, out, str(tmp_path / f"c{i}"))
        assert spark.read.parquet(out).count() == 2


def test_messages_as_a_file_stream(spark, tmp_path):
    folder, out = str(tmp_path / "topic"), str(tmp_path / "out")
    events = spark.createDataFrame([("u", "a", 1.5)], "user_id string, track_id string, t double")
    E.publish(E.to_event_record(events.withColumn("event_time", F.timestamp_seconds("t"))), "parquet", folder)
    stream = E.decode(E.message_stream(spark, "parquet", folder))
    sinks.run_to_table(stream, out, str(tmp_path / "checkpoint"))
    assert spark.read.parquet(out).first()["timestamp"] == "1970-01-01T00:00:01.500000"


def test_the_job_from_messages_to_tables(spark, tmp_path):
    topic, folder = str(tmp_path / "topic"), str(tmp_path / "job")

    def send(rows):
        columns = "user_id string, session_id string, track_id string, artist string, event_type string, t double"
        events = spark.createDataFrame(rows, columns).withColumn("event_time", F.timestamp_seconds("t"))
        E.publish(E.to_event_record(events), "parquet", topic)

    send([("u", "s", "a", "A", "play", 10.0), ("u", "s", "b", "B", "skip", 20.0), ("u", "s", "c", "C", "play", 30.5)])
    bad = [('{"user_id": ', ), ('{"user_id": "u", "event_type": "play", "timestamp": "yesterday"}',)]
    texts = spark.createDataFrame(bad, "value string").select(F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary"))
    texts.write.mode("append").parquet(topic)
    job = start_job(E.message_stream(spark, "parquet", topic), folder, trigger=sinks.WAIT)
    job.await_end()
    counts = spark.read.parquet(f"{folder}/event_counts").agg(*[F.sum(c) for c in ("messages", "corrupt", "bad_time", "plays", "skips")])
    assert tuple(counts.first()) == (5, 1, 1, 3, 1)
    rejected = spark.read.parquet(f"{folder}/quarantine").collect()
    assert sorted((r[E.CORRUPT] or "", r["timestamp"] or "") for r in rejected) == [("", "yesterday"), ('{"user_id": ', "")]
    send([("v", "x", "d", "D", "play", 400.0)])  # moves the watermark past the first window
    start_job(E.message_stream(spark, "parquet", topic), folder, trigger=sinks.WAIT).await_end()
    stored = spark.read.parquet(f"{folder}/sessions").collect()
    assert [(r["session_id"], r["track_count"], r["first_artist"], r["last_track"]) for r in stored] == [("s", 2, "A", "c")]
    lists = spark.read.parquet(f"{folder}/session_lists").orderBy("slice_no").collect()
    assert [t for r in lists for t in r["tracks"]] == ["a", "c"]
    picks = {
        r["session_id"]: r["next_track_recommendation"]["track"]
        for r in spark.read.parquet(f"{folder}/recommendations").collect()
    }
    assert picks == {"s": "a", "x": "d"}
