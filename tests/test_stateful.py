"""Stateful streams: gap sessions, the kept pair model, deliveries, two-stream joins, the document store; late and repeated
arrivals, restarts, replays from an older checkpoint."""

import random
import shutil
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from sessionflow.operators.edges import cooccurrence_counts
from sessionflow.operators.sessions import assign_from_sessions, assign_sessions
from sessionflow.streaming import delivery, documents, gap_sessions, offers, pair_model, sessions, sinks

PLAY = "event_id bigint, user_id string, session_id string, track_id bigint, t double"
KEYS = ("user_id", "session_id")


def arrive(spark, folder, rows, schema=PLAY):
    spark.createDataFrame(rows, schema).withColumn("event_time", F.timestamp_seconds("t")).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(spark.read.parquet(folder).schema).parquet(folder)


def test_gap_sessions_merge_late_events_and_close_behind_the_watermark(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    play = lambda i, t, user="u": (i, user, None, i, t if t is None else float(t))
    arrivals = [
        [play(1, 0), play(2, 100), play(3, 300), play(4, None), play(5, 10, None)],  # 300 is too far from 100; the watermark is 240
        [play(6, 250), play(7, 200.000001, "v")],  # exactly the gap after 100, and bridges to 300
        [play(8, 1000), play(9, 1160, "v")],  # closes the first; the watermark goes to 1100
        [play(10, 50)],  # late: dropped
        [play(11, 3000, "w")],
    ]
    for rows in arrivals:
        stream = gap_sessions.gap_session_stream(arrive(spark, folder, rows), gap_seconds=150)
        sinks.run_to_table(stream, out, checkpoint)
    got = sorted(tuple(r) for r in spark.read.parquet(out).select("user_id", "events", "first_us", "last_us", "first_track", "last_track").collect())
    assert got == [
        ("u", 1, 1000_000_000, 1000_000_000, 8, 8),
        ("u", 4, 0, 300_000_000, 1, 3),
        ("v", 1, 200_000_001, 200_000_001, 7, 7),
        ("v", 1, 1160_000_000, 1160_000_000, 9, 9),
    ]


def test_events_find_their_stored_session(spark):
    draw = random.Random(3)
    rows = [(i, f"u{draw.randint(0, 3)}", None, i, float(draw.randint(-900, 4000))) for i in range(300)]
    events = spark.createDataFrame(rows, PLAY).withColumn("event_time", F.timestamp_seconds("t"))
    want = assign_sessions(events, "user_id", 60, None)
    stored = want.groupBy("user_id", "session_no").agg(F.min(F.unix_micros("event_time")).alias("first_us"), F.max(F.unix_micros("event_time")).alias("last_us")).drop("session_no")
    columns = ("event_id", "user_id", "session_no", "session_start_us")
    got = assign_from_sessions(events, stored, "user_id", 60, None).select(*columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*columns).collect()))


@pytest.fixture(scope="module")
def plays():
    """Plays of a few sessions in arrivals out of order, with repeated tracks, plays without a track, and single plays."""
    draw = random.Random(5)
    rows = [(i, f"u{i % 3}", f"s{draw.randint(0, 4)}", None if draw.random() < 0.05 else draw.randint(1, 6), float(draw.randint(1, 50))) for i in range(220)]
    rows += [(900, "single", "s", 1, 5.0), (901, "twice", "s", 1, 5.0), (902, "twice", "s", 1, 5.0)]
    return [rows[:80], rows[80:81], rows[81:150], rows[150:]]


def model_rows(df):
    return sorted(tuple(r) for r in df.select("last_track", "track_id", "pair_count").collect())


def test_the_kept_model_equals_the_model_of_all_plays(spark, tmp_path, plays):
    folder, model, copy = (str(tmp_path / n) for n in ("in", "model", "copy"))
    for i, rows in enumerate(plays):
        stream = arrive(spark, folder, rows)
        if i == 2:
            shutil.copytree(f"{model}/checkpoint", copy)
        pair_model.run_pair_model(stream, model)
        if i == 2:  # the same batch again from the state before it, as after a failure before the commit
            shutil.rmtree(f"{model}/checkpoint")
            shutil.copytree(copy, f"{model}/checkpoint")
            pair_model.run_pair_model(stream, model)
        seen = spark.read.parquet(folder)
        assert model_rows(pair_model.pair_model(spark, model)) == model_rows(cooccurrence_counts(seen, KEYS, ("event_time", "event_id"), None))
        if i in (1, 2):
            for _ in range(2):
                pair_model.fold_model(spark, model)
    assert spark.read.parquet(f"{model}/folds").count() == 2


def test_a_session_is_forgotten_after_its_time(spark, tmp_path):
    folder, model = str(tmp_path / "in"), str(tmp_path / "model")
    play = lambda i, track, t, s="s": (i, "u", s, track, float(t))
    arrivals = [[play(1, 1, 1), play(2, 2, 10)], [play(3, 3, 500, "other")], [play(4, 4, 900, "other")], [play(5, 5, 901, "s")]]
    for rows in arrivals:
        pair_model.run_pair_model(arrive(spark, folder, rows), model, keep_seconds=100)
    # session s began anew at 901, so its track 5 has no pairs; the watermark had not passed "other" when it went on
    assert model_rows(pair_model.pair_model(spark, model)) == [(2, 1, 1), (4, 3, 1)]


def test_a_session_that_goes_on_puts_its_timer_off(spark, tmp_path):
    folder, model = str(tmp_path / "in"), str(tmp_path / "model")
    play = lambda i, track, t, s="s": (i, "u", s, track, float(t))
    arrivals = [
        [play(1, 1, 1)],
        [play(2, 2, 400)],
        [play(3, 9, 700, "other")],  # the watermark of 640 has passed 501, when s would go but for its play at 400
        [play(4, 3, 701)],
        [play(5, 9, 1500, "other")],  # passes 1201
        [play(6, 4, 1501)],  # begins anew
    ]
    for rows in arrivals:
        pair_model.run_pair_model(arrive(spark, folder, rows), model, keep_seconds=500)
    assert model_rows(pair_model.pair_model(spark, model)) == [(3, 1, 1), (3, 2, 1)]


def test_a_session_costs_one_read_and_one_write_of_state_per_batch():
    calls, stored = [], {}

    class Value:
        def get(self):
            calls.append("get")
            return stored.get("value")

        def update(self, value):
            calls.append("update")
            stored["value"] = value

    class Handle:
        def getValueState(self, name, schema):
            return Value()

        def registerTimer(self, at):
            calls.append("timer")

    processor = pair_model.SessionPairs(100)
    processor.init(Handle())
    first = list(processor.handleInputRows(("u", "s"), iter([("u", "s", None, i, i, i, 1) for i in range(50)]), None))
    assert calls == ["get", "update", "timer"]
    assert sorted(tuple(r) for r in first) == [(49, i, 1) for i in range(49)]
    calls.clear()
    again = list(processor.handleInputRows(("u", "s"), iter([("u", "s", None, 60, 60, 7, 2)]), None))
    assert calls == ["get", "update"]
    counted = {}
    for last, track, n in [*first, *again]:
        counted[last, track] = counted.get((last, track), 0) + n
    assert {k: n for k, n in counted.items() if n} == {(7, i): 1 for i in range(50) if i != 7}


class Kept:
    """State of one key, and a count of the calls to it."""

    def __init__(self):
        self.calls, self.value, self.timers = [], None, set()

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls.append("get")
        return self.value

    def update(self, value):
        self.calls.append("update")
        self.value = value

    def clear(self):
        self.calls.append("clear")
        self.value = None

    def registerTimer(self, at):
        self.calls.append("timer")
        self.timers.add(at)

    def expire(self, processor, now):
        for at in sorted(t for t in self.timers if t <= now):
            watermark, expired = SimpleNamespace(getCurrentWatermarkInMs=lambda: now), SimpleNamespace(getExpiryTimeInMs=lambda at=at: at)
            assert list(processor.handleExpiredTimer((3,), watermark, expired)) == []
            self.timers.discard(at)


def test_the_sessions_of_a_bucket_share_calls_to_state_and_are_forgotten_each_in_its_time():
    kept = Kept()
    processor = pair_model.SessionPairs(100)
    processor.init(kept)

    def play(session, i, track, second):
        return ("u", session, None, second * 1_000_000, i, track, 1)

    def arrive(*rows):
        kept.calls.clear()
        return sorted(tuple(r) for r in processor.handleInputRows((3,), iter(rows), None))

    found = arrive(*[play(f"s{i}", 3 * i + k, 10 * i + k, 1000 + i) for k in range(3) for i in range(40)])
    assert found == [(10 * i + 2, 10 * i + k, 1) for i in range(40) for k in range(2)]
    assert kept.calls == ["get", "update", "timer"] and kept.timers == {1_100_000}
    # s0 goes on, another session is due before all others
    assert arrive(play("s0", 500, 2, 1050), play("early", 501, 7, 990), play("early", 502, 8, 980), play(None, 503, 9, 1050)) == [(7, 8, 1)]
    assert kept.calls == ["get", "update", "timer"] and kept.timers == {1_090_000, 1_100_000}
    kept.expire(processor, 1_095_000)  # early goes
    kept.expire(processor, 1_119_500)  # s1 to s19 go, s0 is due at 1150
    assert kept.timers == {1_120_000}
    assert arrive(play("early", 600, 1, 1110), play("s19", 601, 1, 1110), play("s20", 602, 1, 1110), play("s0", 603, 1, 1110)) == sorted(
        [(202, 200, -1), (202, 201, -1), (1, 200, 1), (1, 201, 1), (1, 202, 1)] + [(2, 0, -1), (2, 1, -1), (1, 0, 1), (1, 2, 2)]
    )
    assert kept.calls == ["get", "update"]
    kept.expire(processor, 2_000_000)
    assert kept.value is None and not kept.timers


def test_state_has_a_row_per_bucket_and_the_partitions_it_was_given(spark, tmp_path, plays, monkeypatch):
    monkeypatch.setattr(pair_model, "BUCKETS", 5)
    folder, model = str(tmp_path / "in"), str(tmp_path / "model")
    before = spark.conf.get(pair_model.PARTITIONS)
    for rows in plays:
        query = pair_model.run_pair_model(arrive(spark, folder, rows), model, partitions=2)
        assert query.lastProgress.stateOperators[0].numRowsTotal <= 5
    assert model_rows(pair_model.pair_model(spark, model)) == model_rows(cooccurrence_counts(spark.read.parquet(folder), KEYS, ("event_time", "event_id"), None))
    assert sorted(p.name for p in (tmp_path / "model/checkpoint/state/0").iterdir() if p.name.isdigit()) == ["0", "1"]
    assert spark.conf.get(pair_model.PARTITIONS) == before


def test_each_event_passes_once(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    play = lambda i, t: (i, "u", "s", i, float(t + 1000))
    arrivals = [[play(1, 0), play(1, 0), play(2, 50)], [play(1, 0), play(2, 50), play(3, 70)], [play(4, 500), play(3, 70)], [play(4, 500), play(2, 50), play(5, 470)], [play(5, 470)]]
    for rows in arrivals:
        sinks.run_to_table(delivery.each_once(arrive(spark, folder, rows)), out, checkpoint)
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == [1, 2, 3, 4, 5]


OFFER = "user_id string, session_id string, t double, recommended_track bigint, rec_strategy string"


def test_windows_wait_for_offers_within_their_time(spark, tmp_path):
    folder, made, out, checkpoint = (str(tmp_path / n) for n in ("in", "made", "out", "checkpoint"))
    play = lambda i, s, t: (i, "u", s, i, float(t))
    offer = lambda s, t, track: ("u", s, t if t is None else float(t), track, "x")
    arrivals = [
        ([play(1, "a", 10), play(2, "b", 20), play(3, "c", 30)], [offer("a", 15, 71)]),
        ([play(4, "d", 400)], [offer("b", 170, 72), offer("x", 100, 73), offer("a", None, 74)]),  # b within an hour's third
        ([play(5, "d", 900)], [offer("c", 800, 75)]),  # too late for c
        ([play(6, "e", 2000)], [offer("e", 2000, 76)]),
        ([play(7, "f", 4000)], [offer("f", 4000, 77)]),
    ]
    for played, offered in arrivals:
        stream = arrive(spark, folder, played).withColumn("artist", F.lit("A"))
        recs = arrive(spark, made, offered, OFFER).withColumnRenamed("event_time", "made_at")
        joined = offers.windows_with_offers(sessions.session_stream(stream), recs, sessions.WINDOW, "2 minutes")
        sinks.run_to_table(joined, out, checkpoint)
    got = sorted((r.session_id, r.window.start, r.recommended_track or 0) for r in spark.read.parquet(out).collect())
    assert [(s, track) for s, _, track in got] == [("a", 71), ("b", 72), ("c", 0), ("d", 0), ("d", 0), ("e", 76)]


def document_rows(spark, store, schema, keys):
    return sorted(tuple(r) for r in documents.read_documents(spark, store, schema, keys).collect())


def test_a_replayed_batch_leaves_each_document_once(spark, tmp_path):
    folder, store, checkpoint, copy = (str(tmp_path / n) for n in ("in", "store", "checkpoint", "copy"))
    shape = "user_id string, session_id string, track_id bigint, event_id bigint"
    schema = spark.createDataFrame([], shape).schema
    assert document_rows(spark, store, schema, KEYS) == []
    play = lambda i, s, track: (i, "u", s, track, float(i))
    arrivals = [[play(1, "a", 1), play(2, "b", 2)], [play(3, "a", 3)], [play(4, "c", 4), play(5, None, 5)]]
    want = [[("u", "a", 1, 1), ("u", "b", 2, 2)], [("u", "a", 3, 3), ("u", "b", 2, 2)], None]
    for i, rows in enumerate(arrivals):
        stream = arrive(spark, folder, rows).select(*schema.names)
        if i:
            shutil.copytree(checkpoint, f"{copy}{i}")
        documents.start_documents(stream, store, checkpoint, sinks.WAIT).awaitTermination()
        if i:  # killed between the store's commit and the query's: the batch comes again
            documents.start_documents(stream, store, f"{copy}{i}", sinks.WAIT).awaitTermination()
        if want[i]:
            assert document_rows(spark, store, schema, KEYS) == want[i]
        if i == 1:
            documents.compact(spark, store, schema, KEYS)
            assert document_rows(spark, store, schema, KEYS) == want[i]
    found = documents.read_documents(spark, store, schema, KEYS)
    assert sorted(((r.session_id or ""), r.track_id) for r in found.collect()) == [("", 5), ("a", 3), ("b", 2), ("c", 4)]


def test_files_of_killed_tasks_are_never_read(spark, tmp_path):
    store = documents._Store(str(tmp_path / "store"))
    frame = spark.createDataFrame([("u", 1)], "user_id string, track_id bigint")
    documents.upsert(frame, 0, store.path)
    left = store.write(iter(frame.withColumn("track_id", F.lit(9).cast("bigint")).toArrow().to_batches()))  # no commit follows
    assert left.rows == 1 and (tmp_path / "store" / "data" / left.name).exists()
    again = store.write(iter(frame.withColumn("track_id", F.lit(8).cast("bigint")).toArrow().to_batches()))
    store.commit([again, None], "batch-0", 0, -1)  # the batch is there already: its files go
    assert not (tmp_path / "store" / "data" / again.name).exists()
    assert document_rows(spark, store.path, frame.schema, ["user_id"]) == [("u", 1)]
    for _ in range(2):
        documents.upsert(spark.createDataFrame([("u", 2), ("v", 3)], frame.schema), 1, store.path)
    assert document_rows(spark, store.path, frame.schema, ["user_id"]) == [("u", 2), ("v", 3)]
    documents.upsert(frame.limit(0), 2, store.path)
    assert len(document_rows(spark, store.path, frame.schema, ["user_id"])) == 2
