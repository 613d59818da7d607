"""The hand-worked recommendation fixture, its fallbacks, and properties of the edge tables."""

import pytest
from pyspark.sql import functions as F

from sessionflow.operators import edges as G
from sessionflow.operators import popularity as P
from sessionflow.operators import recommend as R
from sessionflow.operators.sessions import last_tracks, track_lists
from sessionflow.operators.skew import SkewPolicy

KEYS = ["user_id", "session_id"]
ORDER = ["ord"]
ROWS = [
    ("u1", "s1", "a", 1), ("u1", "s1", "b", 2), ("u1", "s1", "a", 3), ("u1", "s1", "c", 4),
    ("u2", "s2", "b", 1), ("u2", "s2", "c", 2), ("u3", "s3", "d", 1), ("u4", "s4", "c", 1),
]
POLICIES = [None, SkewPolicy(share=4, min_rows=1)]


@pytest.fixture(scope="module")
def plays(spark):
    return spark.createDataFrame(ROWS, "user_id string, session_id string, track_id string, ord int").cache()


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def next_tracks(recommendations):
    chosen = "next_track_recommendation"
    return {
        r["session_id"]: (r[chosen]["track"], r[chosen]["strategy"], r[chosen]["weight"])
        for r in recommendations.collect()
    }


def test_popularity(plays):
    counts = P.play_counts(plays)
    assert rows(P.popularity_topn(counts, 2)) == [("a", 0.25), ("c", 0.375)]
    assert sum(r["popularity_weight"] for r in P.popularity_weights(counts).collect()) == pytest.approx(1.0)


@pytest.mark.parametrize("skew", POLICIES)
def test_cooccurrence(plays, skew):
    counts = G.cooccurrence_counts(plays, KEYS, ORDER, skew)
    assert rows(counts) == [("c", "a", 2), ("c", "b", 2)]
    assert rows(G.edge_topn(counts, 2, "w")) == [("c", "a", 0.5, 1), ("c", "b", 0.5, 2)]
    assert rows(G.edge_weights(counts, "w", skew)) == [("c", "a", 0.5), ("c", "b", 0.5)]


@pytest.mark.parametrize("skew", POLICIES)
def test_transitions(plays, skew):
    counts = G.transition_counts(plays, KEYS, ORDER, skew)
    assert rows(counts) == [("a", "b", 1), ("a", "c", 1), ("b", "a", 1), ("b", "c", 1)]
    assert {r["w"] for r in G.edge_weights(counts, "w", skew).collect()} == {0.5}


@pytest.mark.parametrize("skew", POLICIES)
def test_recommendations(plays, skew):
    got = R.generate_recommendations(plays, KEYS, ORDER, 2, skew)
    assert next_tracks(got) == {
        "s1": ("a", "cooccurrence", 0.5),
        "s2": ("a", "cooccurrence", 0.5),
        "s3": ("c", "popularity", 0.375),
        "s4": ("a", "cooccurrence", 0.5),
    }
    lists = {r["session_id"]: r["recommendations"] for r in got.collect()}
    assert [(x["track"], x["weight"]) for x in lists["s1"]["cooccurrence"]] == [("a", 0.5), ("b", 0.5)]
    assert lists["s3"]["cooccurrence"] == []
    assert [(x["track"], x["weight"]) for x in lists["s3"]["popularity"]] == [("c", 0.375), ("a", 0.25)]
    stats = R.recommendation_stats(got, last_tracks(plays, KEYS, ORDER)).first()
    assert tuple(stats) == (4, 1, 3, 100.0)


def test_only_single_track_sessions_fall_back(plays):
    got = R.generate_recommendations(plays.filter("session_id in ('s3', 's4')"), KEYS, ORDER, 2, None)
    assert next_tracks(got) == {"s3": ("c", "popularity", 0.5), "s4": ("c", "popularity", 0.5)}


@pytest.mark.parametrize("skew", POLICIES)
def test_no_plays_give_no_recommendations(plays, skew):
    none = plays.filter("false")
    got = R.generate_recommendations(none, KEYS, ORDER, 2, skew)
    assert got.count() == 0
    assert got.columns[-1] == "timestamp"
    stats = R.recommendation_stats(got, last_tracks(none, KEYS, ORDER)).first()
    assert tuple(stats) == (0, 0, 0, 0.0)


def test_samples(plays):
    got = R.sample_recommendations(R.generate_recommendations(plays, KEYS, ORDER, 2, None), KEYS, 2).collect()
    assert [(r["session_id"], r["popularity_tracks"], r["cooccurrence_tracks"]) for r in got] == [
        ("s1", 2, 2),
        ("s2", 2, 2),
    ]


def test_two_sessions_of_a_user_do_not_mix(plays):
    two = plays.withColumn("user_id", F.lit("u"))
    picks = R.generate_recommendations(two, KEYS, ORDER, 2, None)
    sessions = two.select(*KEYS).distinct()
    assert R.enrich_sessions(sessions, picks, KEYS, None).count() == 4


@pytest.mark.parametrize("skew", POLICIES)
def test_track_lists_are_cut_not_capped(plays, skew):
    got = rows(track_lists(plays, KEYS, ORDER, 2, skew).select("session_id", "piece_no", "tracks"))
    assert got[:2] == [("s1", 0, ["a", "b"]), ("s1", 1, ["a", "c"])]
    assert sum(len(r[2]) for r in got) == len(ROWS)


def test_edges_have_no_self_pairs_and_dense_ranks(spark):
    plays = spark.range(900).select(
        (F.col("id") % 90).alias("user_id"),
        (F.col("id") % 90).alias("session_id"),
        F.pmod(F.xxhash64("id"), F.lit(12)).alias("track_id"),
        F.col("id").alias("ord"),
    )
    counts = G.cooccurrence_counts(plays, KEYS, ORDER, None)
    assert counts.filter("last_track = track_id").count() == 0
    totals = G.edge_weights(counts, "w", None).groupBy("last_track").agg(F.sum("w").alias("t")).collect()
    assert all(r["t"] == pytest.approx(1.0) for r in totals)
    ranks = G.edge_topn(counts, 3, "w").groupBy("last_track").agg(F.sort_array(F.collect_list("rank")).alias("r"))
    assert all(r["r"] == list(range(1, len(r["r"]) + 1)) for r in ranks.collect())
