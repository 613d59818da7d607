"""Per-row functions and the catalog job on the hand-worked cases."""

import hashlib

import pytest
from pyspark.sql import functions as F

from sessionflow.functions import music, text
from sessionflow.operators import catalog as C
from sessionflow.sources import catalogs


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column.alias("x")).first()["x"]


def hashed(artist, title):
    return "track_" + hashlib.md5(f"{artist}||{title}".encode()).hexdigest()[:12]


def test_track_id(spark):
    make = text.track_id(F.col("a"), F.col("t"))
    assert one(spark, make, a=" Beyoncé ", t="Halo!") == hashed("beyoncé", "halo")
    assert one(spark, make, a="\tBEYONCÉ\n", t="halo") == hashed("beyoncé", "halo")
    assert one(spark, make, a="a-b_c", t="東京 2!") == hashed("a-b_c", "東京 2")


def test_tags(spark):
    assert one(spark, text.split_tags(F.col("t")), t="Party, ;work|STUDY") == ["party", "work", "study"]
    assert one(spark, text.split_tags(F.col("t")), t=None) == []
    cleaned = text.clean_tags(F.array(F.lit(" A "), F.lit(None), F.lit(" "), F.lit("b")))
    assert one(spark, cleaned, t="") == ["a", "b"]


def test_flag_tags(spark):
    df = spark.createDataFrame(
        [("1", "0", None, "x")],
        "`Good for Work/Study` string, `Good for Party` string, `Good for Driving` string, other string",
    )
    flags = text.flag_columns(df.columns)
    assert len(flags) == 3
    assert df.select(text.flag_tags(flags).alias("x")).first()["x"] == ["work/study"]


@pytest.mark.parametrize(
    "name,number",
    [("C Maj", 0), ("D min", 14), ("F# min", 18), ("Bb Maj", 10), ("Eb min", 15), ("B Maj", 11), ("b MIN", 23),
     (None, None), ("?", None)],
)
def test_key_number(spark, name, number):
    assert one(spark, music.key_number(F.col("k")), k=name) == number


def test_audio_features(spark):
    df = spark.createDataFrame(
        [("120", "x", "-6.5", None)], "Tempo string, Energy string, `Loudness (db)` string, Key string"
    )
    got = df.select(music.audio_features(df.columns).alias("x")).first()["x"]
    assert got == {"tempo": 120.0, "loudness_db": -6.5}


@pytest.mark.parametrize(
    "value,expected",
    [
        ('[{"track_id":"t","similarity":0.85},{"other":1}]', [("t", 0.85)]),
        ('["x","y","z","w"]', [("x", 0.8), ("y", 0.8), ("z", 0.8)]),
        ('[{"track_id":5,"similarity":"0.5"}, 7, " q "]', [("5", 0.5), ("q", 0.8)]),
        ("plain name", [("plain name", 0.8)]),
        (None, []),
        ("[]", []),
        ("", []),
    ],
)
def test_similar_tracks(spark, value, expected):
    got = one(spark, music.similar_tracks(music.similar_items(F.col("s"))), s=value)
    assert [(r["track_id"], r["similarity"]) for r in got] == [(hashed("unknown", n), w) for n, w in expected]


RAW = (
    "order_key bigint, `Artist(s)` string, song string, emotion string, Genre string, Tempo string, Key string, "
    "`Loudness (db)` string, Energy string, Danceability string, `Similar Songs` string, `Good for Party` string"
)


@pytest.fixture(scope="module")
def raw(spark):
    def line(key, artist="A", song="S", emotion=None, genre=None, tempo=None, tone=None, loud=None, similar=None):
        return (key, artist, song, emotion, genre, tempo, tone, loud, "5", "6", similar, "1")

    lines = [
        line(1, "First", "Song", "Happy", "POP"),
        line(2, "Other", "Tune", genre="rock", tempo="99.5", tone="D min", loud="-3", similar='["x"]'),
        line(3, None),
        line(4, tempo="fast"),
        line(5, " first ", "SONG!", "sad", "Jazz"),
        line(6, loud="loud"),
        line(7, similar="[broken"),
        line(8, similar='[{"track_id": "t", "similarity": "near"}]'),
    ]
    return spark.createDataFrame(lines, RAW).cache()


def test_clean_and_quarantine(raw):
    parsed = C.parse_catalog(raw)
    clean = {r["order_key"]: r for r in C.clean_tracks(parsed).collect()}
    assert set(clean) == {1, 2, 5}
    first, second = clean[1], clean[2]
    assert (first["emotion"], first["genre"], first["tempo"], first["key"], first["loudness"]) == (
        "happy", "pop", 120.0, 0, -10.0,
    )
    assert (second["emotion"], second["tempo"], second["key"], second["loudness"]) == ("neutral", 99.5, 14, -3.0)
    assert second["contextual_tags"] == ["party"]
    reasons = {r["order_key"]: r["reject_reason"] for r in C.quarantined(parsed).collect()}
    assert reasons == {
        3: "missing name",
        4: "bad tempo",
        6: "bad loudness",
        7: "bad similar songs",
        8: "bad similar songs",
    }


def test_missing_required_column_fails_before_any_job(raw):
    with pytest.raises(ValueError, match="song_title"):
        C.parse_catalog(raw.drop("song"))


def test_prepare_catalog_writes_all_tables(spark, raw, tmp_path):
    folder = str(tmp_path / "catalog")
    stats = {(r["metric"], r["key"]): r["value"] for r in catalogs.prepare_catalog(raw, folder, 2, 2).collect()}
    assert stats[("total_tracks", "")] == 3
    assert stats[("distinct_tracks", "")] == 2
    assert stats[("tracks_with_similar", "")] == 1
    assert stats[("genre_distribution", "pop")] == 1
    index = {r["track_id"]: r for r in spark.read.parquet(f"{folder}/index").collect()}
    assert index[hashed("first", "song")]["genre"] == "jazz"  # the later row wins
    assert index[hashed("first", "song")]["chunk_file"] == "tracks_chunk_0002.json"
    dims = {(r["dim"], r["value"]): r["id"] for r in catalogs.read_dimensions(spark, folder).collect()}
    assert dims[("genre", "pop")] == 0 and dims[("genre", "rock")] == 1 and dims[("genre", "jazz")] == 2
    assert spark.read.parquet(f"{folder}/quarantine").count() == 5
    assert spark.read.json(f"{folder}/sample").count() == 2
    for name in {r["chunk_file"] for r in index.values()}:  # every name opens, and its chunk holds the tracks
        chunk = catalogs.read_chunk(spark, folder, name)
        ids = [r["track_id"] for r in chunk.collect()]
        assert 1 <= len(ids) <= 2
        assert {t for t, r in index.items() if r["chunk_file"] == name} <= set(ids)


def test_even_sample_takes_the_quota_of_each_chunk(spark):
    tracks = spark.range(1000).select(F.col("id").alias("order_key"), F.floor(F.col("id") / 100).alias("chunk_no"))
    got = C.even_sample(tracks, 95, "s")
    assert got.count() == 95
    per_chunk = [r["count"] for r in got.groupBy("chunk_no").count().collect()]
    assert max(per_chunk) <= 10 and len(per_chunk) == 10
    again = {r["order_key"] for r in C.even_sample(tracks.repartition(7), 95, "s").collect()}
    assert {r["order_key"] for r in got.collect()} == again


def test_raw_files_are_numbered_by_line_and_keep_broken_ones(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    line = lambda i: '{"Artist(s)": "A%d", "song": "s%d", "Genre": "g%d"}' % (i, i, i % 3)
    files = {"b.json": [line(i) for i in range(500, 900)], "a.json": [line(i) for i in range(500)], "c.json": ["", "not json", line(900), "[1]", '"text"', line(901), ""]}
    for name, lines in files.items():
        (folder / name).write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")  # many splits, and small files packed together
    try:
        got = {r["order_key"]: r for r in catalogs.read_raw_lines(spark, str(folder), []).collect()}
        stats = catalogs.prepare_catalog_files(spark, str(folder), str(tmp_path / "catalog"), [], 100, 5)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [got[i]["song"] for i in range(900)] == [f"s{i}" for i in range(900)]
    assert (got[902]["song"], got[905]["song"]) == ("s900", "s901")
    assert {i: got[i][C.CORRUPT] for i in (901, 903, 904)} == {901: "not json", 903: "[1]", 904: '"text"'}
    assert set(range(900, 907)) - set(got) == {900, 906}  # blank lines
    assert {(r["metric"], r["key"]): r["value"] for r in stats.collect()}[("total_tracks", "")] == 902
    kept = catalogs.read_quarantine(spark, str(tmp_path / "catalog"))
    assert sorted((r["order_key"], r["reject_reason"], r["line"]) for r in kept.collect()) == [(901, "malformed line", "not json"), (903, "malformed line", "[1]"), (904, "malformed line", '"text"')]
    index = {r["track_id"]: r["chunk_file"] for r in catalogs.read_index(spark, str(tmp_path / "catalog")).collect()}
    assert index[hashed("a250", "s250")] == "tracks_chunk_0003.json" and index[hashed("a901", "s901")] == "tracks_chunk_0010.json"
    chunk = catalogs.read_chunk(spark, str(tmp_path / "catalog"), "tracks_chunk_0003.json")
    assert sorted(r["order_key"] for r in chunk.collect()) == list(range(200, 300))
