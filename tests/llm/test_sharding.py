"""Sharding: exact sizes, the law of the draws against exact fractions, uniform places, odd rows."""

from collections import Counter
from fractions import Fraction
from math import comb

import pytest
from cases import documents, no_documents, odd_documents
from conftest import SF_DIR
from pyspark.sql import functions as F

from sessionflow.llm import sharding
from sessionflow.llm.queries import op13_sharding


def expected_draw(size, marked, drawn, u):
    """Inverts the exact distribution function, from the mode up and then from the mode down."""
    low, high = max(0, drawn + marked - size), min(drawn, marked)
    mode = max(low, min(high, (drawn + 1) * (marked + 1) // (size + 2)))
    passed = Fraction(0)
    for x in [*range(mode, high + 1), *range(mode - 1, low - 1, -1)]:
        passed += Fraction(comb(marked, x) * comb(size - marked, drawn - x), comb(size, drawn))
        if Fraction(u) < passed:
            return x
    return None


def test_draws_follow_the_exact_law(spark):
    shapes = [(0, 0, 0), (1, 1, 1), (5, 0, 3), (5, 5, 3), (10, 3, 10), (10, 3, 0), (40, 13, 17), (400, 20, 380), (3000, 1500, 900)]
    rows = [(*s, (i + 0.37) / 101) for s in shapes for i in range(101)]
    frame = spark.createDataFrame(rows, "size bigint, marked bigint, drawn bigint, u double")
    draw = sharding.hypergeometric(F.col("size"), F.col("marked"), F.col("drawn"), F.col("u"))
    for r in frame.withColumn("x", draw).collect():
        assert r.x == expected_draw(r["size"], r.marked, r.drawn, r.u), r


def test_draws_of_very_many_rows_keep_their_mean_and_width(spark):
    size, marked, drawn = 10**10, 10**10 // 24, 5 * 10**9
    frame = spark.range(200).withColumn("u", (F.col("id") + 0.5) / 200)
    big = [F.lit(v).cast("bigint") for v in (size, marked, drawn)]
    found = [r.x for r in frame.select(sharding.hypergeometric(*big, F.col("u")).alias("x")).collect()]
    width = (drawn / size * marked * (1 - marked / size) * (1 - drawn / size)) ** 0.5
    mean = drawn / size * marked
    assert abs(sum(found) / len(found) - mean) < width / 20
    assert abs((sum((x - mean) ** 2 for x in found) / len(found)) ** 0.5 / width - 1) < 0.05


@pytest.mark.parametrize("n_blocks, depth", [(1, 1), (16, 1), (40, 2)])
def test_a_matrix_has_the_margins_asked_for(spark, n_blocks, depth):
    sizes = {3 * i % (1 << 4 * depth): 5 + 7 * i % 11 for i in range(n_blocks)}
    total = sum(sizes.values())
    quotas = [total // 5 + (i < total % 5) for i in range(5)]
    blocks = spark.createDataFrame(list(sizes.items()), "node bigint, n bigint")
    found = {r.node: r.quotas for r in sharding.communication_matrix(blocks, quotas, depth, 3).collect()}
    assert {k: sum(v) for k, v in found.items()} == sizes
    assert [sum(v[i] for v in found.values()) for i in range(5)] == quotas
    assert min(min(v) for v in found.values()) >= 0


@pytest.mark.parametrize("make", [lambda s: documents(s, SF_DIR), odd_documents, no_documents], ids=["small", "odd", "empty"])
def test_every_row_has_one_place(spark, make, monkeypatch):
    monkeypatch.setattr(sharding, "GROUP_ROWS", 3)
    docs = make(spark).repartition(5)
    found = sharding.shuffle_into_shards(docs, 7, seed=1).select("row.*", "shard", "slot").collect()
    whole = [r.asDict() for r in docs.collect()]
    assert Counter(str(sorted(r.items(), key=str)) for r in whole) == Counter(str(sorted({k: v for k, v in r.asDict().items() if k not in ("shard", "slot")}.items(), key=str)) for r in found)
    places = {}
    for r in found:
        places.setdefault(r.shard, []).append(r.slot)
    sizes = [len(places.get(s, ())) for s in range(7)]
    assert all(sorted(v) == list(range(len(v))) for v in places.values())
    assert sum(sizes) == len(whole) and max(sizes) - min(sizes) <= 1


def test_places_are_uniform_also_for_equal_rows(spark):
    """Of 120 rows 80 are equal: shards and places get their share of them, with the spread of a uniform shuffle."""
    docs = spark.createDataFrame([(min(i, 40), "x") for i in range(120)], "doc_id bigint, text string").repartition(3)
    runs, counts, slots = 8, [], []
    for seed in range(runs):
        equal = sharding.shuffle_into_shards(docs, 3, seed).filter("row.doc_id = 40").select("shard", "slot").collect()
        counts.append([sum(r.shard == s for r in equal) for s in range(3)])
        slots += [r.slot for r in equal]
    one = (80 / 3 * 2 / 3 * 40 / 119) ** 0.5
    for s in range(3):
        assert abs(sum(c[s] for c in counts) - runs * 80 / 3) < 4 * one * runs**0.5
        assert len({c[s] for c in counts}) > 1
    assert abs(sum(slots) / len(slots) - 19.5) < 4 * 11.6 / len(slots) ** 0.5


def test_the_query_returns_sizes_digests_and_written_shards(spark, tmp_path):
    import zlib

    found = {r.doc_id: r for r in op13_sharding(spark, SF_DIR).collect()}
    for r in documents(spark, SF_DIR).collect():
        raw = (r.text or "").encode()
        assert (found[r.doc_id]["size"], found[r.doc_id].text_crc32) == (len(raw) + 8, zlib.crc32(raw))
        assert (found[r.doc_id].law, found[r.doc_id].grown_shard) == ("rows", None)
    shuffled = sharding.shuffle_into_shards(documents(spark, SF_DIR).select("doc_id"), 4)
    folder = sharding.write_shards(shuffled, str(tmp_path / "shards"))
    assert spark.read.parquet(folder).groupBy("shard").count().count() == 4
