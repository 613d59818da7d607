"""Decode, time parse, play filter, publishing, session assignment."""

import json

import pytest
from pyspark.sql import functions as F

from sessionflow.operators import sessions as S
from sessionflow.operators.skew import SkewPolicy
from sessionflow.sources import events as E

GOOD = {"user_id": "u1", "track_id": "a", "session_id": "s1", "timestamp": "2024-01-01T00:00:00.123456", "event_type": "play"}
LINES = [
    json.dumps(GOOD),
    json.dumps({**GOOD, "timestamp": "2024-01-01T00:00:00"}),
    json.dumps({**GOOD, "timestamp": "2024-01-01T00:00:00.12"}),
    json.dumps({**GOOD, "timestamp": "junk"}),
    json.dumps({**GOOD, "event_type": "skip"}),
    "{bad",
    json.dumps({**GOOD, "x": 1}),
    json.dumps({**GOOD, "user_id": 5}),
]


@pytest.fixture(scope="module")
def messages(spark):
    df = spark.createDataFrame([(str(i), line) for i, line in enumerate(LINES)], "key string, value string")
    return df.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value")).cache()


def test_decode_filter_and_quarantine(messages):
    decoded = E.decode(messages)
    assert E.corrupt_messages(decoded).count() == 1
    plays = E.plays_of(E.valid_events(decoded)).select("user_id", F.unix_micros("event_time").alias("us")).collect()
    base = 1704067200000000
    assert sorted((r["user_id"], r["us"] - base) for r in plays) == [
        ("5", 123456),
        ("u1", 0),
        ("u1", 120000),
        ("u1", 123456),
        ("u1", 123456),
    ]


def test_published_messages_decode_to_the_same_events(spark, messages, tmp_path):
    events = E.plays_of(E.valid_events(E.decode(messages)))
    folder = str(tmp_path / "topic")
    E.publish(E.to_event_record(events), sink="parquet", path=folder)
    stored = spark.read.parquet(folder)
    assert {bytes(r["key"]).decode() for r in stored.collect()} == {"5", "u1"}
    again = E.plays_of(E.valid_events(E.decode(stored)))
    columns = ["user_id", "track_id", "session_id", "event_time", "event_type"]
    assert sorted(map(tuple, again.select(columns).collect())) == sorted(map(tuple, events.select(columns).collect()))


def test_unknown_track_keeps_the_event(spark):
    events = spark.createDataFrame([(1, "a"), (2, "zz"), (3, None)], "event_id int, track_id string")
    tracks = spark.createDataFrame([("a", "A", "T", "pop", "sad")], "track_id string, artist string, song_title string, genre string, emotion string")
    for skew in (None, SkewPolicy(share=4, min_rows=1)):
        got = {r["event_id"]: r["artist"] for r in E.enrich(events, tracks, skew).collect()}
        assert got == {1: "A", 2: None, 3: None}


@pytest.mark.parametrize("gap", [1, 60, 3600])
def test_session_assignment_in_both_forms(spark, gap):
    events = spark.range(600).select(
        "id",
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 11).alias("user_id"),
        F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(20000)) - 5000).alias("event_time"),
    )
    columns = ["id", "session_no", "session_start_us"]
    plain = sorted(map(tuple, S.assign_sessions(events, gap_seconds=gap, skew=None).select(columns).collect()))
    split = sorted(map(tuple, S.assign_sessions(events, gap_seconds=gap, skew=SkewPolicy(4, 1)).select(columns).collect()))
    assert plain == split
    last: dict = {}
    number: dict = {}
    want = []
    for r in sorted(events.collect(), key=lambda r: (r["user_id"], r["event_time"])):
        user, time = r["user_id"], r["event_time"].timestamp()
        if user not in last or time - last[user] > gap:
            number[user] = number.get(user, 0) + 1
        last[user] = time
        want.append((r["id"], number[user]))
    assert sorted(want) == [(a, b) for a, b, _ in plain]


def test_window_sessions_and_recent_tracks(spark):
    plays = spark.createDataFrame(
        [(1, "u", "s", "a", "X", 10), (2, "u", "s", "b", "Y", 110), (3, "u", "s", "c", "Z", 150)],
        "event_id int, user_id string, session_id string, track_id string, artist string, t int",
    ).withColumn("event_time", F.timestamp_seconds("t"))
    got = S.window_sessions(plays).orderBy("window").collect()
    assert [(r["track_count"], r["first_artist"], r["last_track"], r["has_multiple_tracks"]) for r in got] == [
        (2, "X", "b", True),
        (1, "Z", "c", False),
    ]
    recent = {r["event_id"]: r["recent_tracks"] for r in S.recent_tracks(plays, "user_id", ["event_time"], 2).collect()}
    assert recent == {1: [], 2: ["a"], 3: ["a", "b"]}
    assert S.last_n_tracks(plays, "user_id", ["event_time"], 2).first()["recent_tracks"] == ["b", "c"]
