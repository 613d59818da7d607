"""Candidates against brute force, weighted draws, play classes."""

import itertools

import pytest
from pyspark.sql import functions as F

from sessionflow.operators import candidates as K
from sessionflow.operators import lengths as L
from sessionflow.operators import profiles as P
from sessionflow.operators.skew import SkewPolicy

POLICIES = [None, SkewPolicy(share=4, min_rows=1)]
PROFILE = "user_id string, preferred_genres array<string>, preferred_emotions array<string>, recent_tracks array<string>"
SMALL = [("t1", "pop", "happy"), ("t2", "rock", "sad"), ("t3", "pop", "sad"), ("t4", "jazz", "calm")]


def brute(tracks, genres, emotions, recent):
    """Candidates in rank order: preferred genres first, then the emotions by genre and track."""
    preferred = [t for g in genres for t in sorted(x for x in tracks if x[1] == g)]
    preferred += [
        t for e in emotions for t in sorted((x for x in tracks if x[2] == e and x[1] not in genres), key=lambda x: (x[1], x[0]))
    ]
    preferred = preferred or sorted(tracks, key=lambda x: (x[1], x[0]))
    available = [t[0] for t in preferred if t[0] not in recent]
    return available or [t[0] for t in preferred]


def listed(spark, profiles, tracks, skew):
    """Every user's candidates, found one rank at a time."""
    profile_df = spark.createDataFrame(profiles, PROFILE)
    track_df = spark.createDataFrame(tracks, "track_id string, genre string, emotion string")
    positions = K.track_positions(track_df, skew)
    available = K.exclude_recent(K.candidate_segments(profile_df, track_df, skew), positions, skew)
    ranks = available.withColumn("r", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_available") - 1)))
    found = {}
    for row in sorted(K.candidate_at(ranks, positions, "r").collect(), key=lambda x: (x["user_id"], x["r"])):
        found.setdefault(row["user_id"], []).append(row["track_id"])
    return found


@pytest.mark.parametrize("skew", POLICIES)
def test_small_candidates(spark, skew):
    profiles = [
        ("u1", ["pop"], ["sad"], ["t1", "t3"]),
        ("u2", ["zzz"], ["zzz"], ["t4"]),
        ("u3", ["pop"], ["sad"], ["t1", "t2", "t3"]),
    ]
    got = listed(spark, profiles, SMALL, skew)
    assert got["u1"] == ["t2"]
    assert set(got["u2"]) == {"t1", "t2", "t3"}
    assert set(got["u3"]) == {"t1", "t2", "t3"}


@pytest.mark.parametrize("skew", POLICIES)
def test_candidates_equal_brute_force(spark, skew):
    genres, emotions = ["g1", "g2", "g3"], ["e1", "e2", "e3"]
    tracks = [
        (f"t{i:02d}", genres[i * 7 % 3], emotions[(i * i + i // 4) % 3]) for i in range(40)
    ]
    profiles = []
    for n, (a, b, e) in enumerate(itertools.product([*genres, "none"], genres, [*emotions, "none"])):
        recent = [f"t{(n * 5 + j * 3) % 40:02d}" for j in range(n % 6)]
        profiles.append((f"u{n:02d}", [a, b], [e], recent))
    profiles.append(("all", ["none"], [], ["t01", "t02"]))
    got = listed(spark, profiles, tracks, skew)
    for user, liked, moods, recent in profiles:
        assert got[user] == brute(tracks, list(dict.fromkeys(liked)), moods, recent), user


def test_pick_is_stable_and_available(spark):
    profiles = spark.createDataFrame([("u1", ["pop"], ["sad"], ["t1", "t3"]), ("u2", ["jazz"], [], [])], PROFILE)
    tracks = spark.createDataFrame(SMALL, "track_id string, genre string, emotion string")
    got = {r["user_id"]: r["track_id"] for r in K.pick_candidate(profiles, tracks, "s", None).collect()}
    assert got == {"u1": "t2", "u2": "t4"}


def test_weighted_pick_follows_the_weights(spark):
    weights = spark.createDataFrame([("a", 1), ("b", 7), ("c", 0), ("d", 2)], "value string, weight int")
    users = spark.range(3000).withColumnRenamed("id", "user_id")
    got = P.weighted_pick(users, weights, "value", "weight", "s", 2)
    counts = {r["value"]: r["count"] for r in got.groupBy("value").count().collect()}
    assert sum(counts.values()) == 6000 and "c" not in counts
    assert counts["b"] == pytest.approx(4200, abs=200) and counts["d"] == pytest.approx(1200, abs=150)


@pytest.mark.parametrize(
    "duration,typical,outcome", [(126, 180, "play"), (125, 180, "play"), (30, 180, "skip"), (60, 180, "partial"), (10, 10, "play")]
)
def test_classify_play(spark, duration, typical, outcome):
    got = spark.range(1).select(P.classify_play(F.lit(duration), F.lit(typical)).alias("x")).first()["x"]
    assert got == outcome


def test_engagement_defaults_and_totals(spark):
    events = spark.createDataFrame(
        [("u1", "pop", "play", 100), ("u1", "pop", "skip", 10), ("u2", "rock", "skip", 5), ("u2", "rock", "signup", 1)],
        "user_id string, genre string, event_type string, duration_played int",
    )
    got = {(r["scope"], r["key"]): (r["events"], r["skip_rate"], r["average_play_duration"]) for r in P.engagement_stats(events).collect()}
    assert got[("all", "")] == (3, 2 / 3, 100.0)
    assert got[("genre", "rock")] == (1, 1.0, 180.0)
    assert got[("user", "u1")] == (2, 0.5, 100.0)
    assert P.engagement_stats(events.filter("false")).count() <= 1
    assert events.select(P.skip_rate(events.filter("false")).alias("x")).first()["x"] == 0.2


def test_plays_without_genre_are_no_taste(spark):
    rows = [(1, t, g, e, "play") for t, g, e in ((1, None, None), (2, None, None), (3, None, None), (4, "pop", None), (5, "rock", None))]
    rows += [(2, 1, None, None, "play")]
    plays = spark.createDataFrame(rows, "user_id int, track_id int, genre string, emotion string, event_type string")
    found = lambda dim, n: {r[0]: r[1] for r in P.preferences(plays, "user_id", dim, n).collect()}
    assert found("genre", 2) == {1: ["pop", "rock"], 2: []}
    assert found("emotion", 1) == {1: [], 2: []}


def test_weighted_sample_draws_without_replacement_by_weight(spark):
    weights = spark.createDataFrame([("x", 1.0), ("y", 2.0), ("z", 5.0), ("none", 0.0), ("null", None), (None, 3.0)], "v string, w double")
    many = spark.range(6000).select(F.col("id").alias("u")).join(weights)
    got = P.weighted_sample(many, "u", "v", "w", "s", 2)
    rows = got.collect()
    assert len(rows) == 12000 and {r["v"] for r in rows} == {"x", "y", "z"}
    first = {v: sum(r["v"] == v and r["pick_no"] == 1 for r in rows) / 6000 for v in "xyz"}
    assert all(abs(first[v] - w / 8) < 0.03 for v, w in (("x", 1), ("y", 2), ("z", 5)))
    second = sum(r["v"] == "y" and r["pick_no"] == 2 for r in rows) / 6000  # after x: 2/7, after z: 2/3
    assert abs(second - (1 / 8 * 2 / 7 + 5 / 8 * 2 / 3)) < 0.03
    assert {tuple(r) for r in P.weighted_sample(many.repartition(7), "u", "v", "w", "s", 2).collect()} == {tuple(r) for r in rows}
    assert P.weighted_sample(many, "u", "v", "w", "s", 9).count() == 18000


def test_typical_lengths_stay_within_the_rank_error_and_fall_back(spark):
    plays = spark.range(30_000).select(F.lit(1).cast("bigint").alias("track_id"), F.pmod(F.xxhash64("id"), F.lit(10_007)).cast("int").alias("duration_played"))
    few = spark.createDataFrame([(2, 10), (2, 20), (3, 7), (3, 8), (3, 9), (4, None)], "track_id bigint, duration_played int")
    tracks = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, "c"), (5, None), (6, "b")], "track_id bigint, genre string")
    parts = [L.length_sketches(plays.filter(F.pmod("duration_played", F.lit(3)) == i)) for i in range(3)] + [L.length_sketches(few)]
    united = L.merge_sketches(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]), "track_id")
    typical = {r["track_id"]: r["typical"] for r in L.typical_lengths(united, tracks, skew=None).collect()}
    rank = plays.filter(F.col("duration_played") <= typical[1]).count() / 30_000
    assert abs(rank - 0.5) < 0.005
    assert (typical[2], typical[3], typical[4], typical[5], typical[6]) == (9, 8, 180, 180, 9)
