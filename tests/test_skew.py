"""The skew-proof operators must equal their plain forms, with hot keys forced and without."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sessionflow.operators.prefix import number_rows, running_sum
from sessionflow.operators.skew import (
    hot_keys_together,
    SkewPolicy,
    hot_keys,
    lookup_join,
    policy_for,
    with_last,
    with_position,
    with_previous,
)

POLICIES = [None, SkewPolicy(), SkewPolicy(share=4, min_rows=1), SkewPolicy(share=64, min_rows=1)]


@pytest.fixture(scope="module")
def rows(spark):
    """2 000 rows, two thirds of them on key 0; some null keys."""
    df = spark.range(2000).select(
        F.when(F.col("id") % 3 < 2, 0).when(F.col("id") % 30 == 2, None).otherwise(F.col("id") % 17).alias("k"),
        F.pmod(F.xxhash64("id"), F.lit(500)).alias("t"),
        F.col("id"),
    )
    return df.cache()


def as_set(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_hot_keys_are_bounded(rows):
    policy = SkewPolicy(share=8, min_rows=1)
    hot = hot_keys(rows, ["k"], policy, ["t", "id"]).table.collect()
    assert 1 <= len(hot) <= 10
    assert sum(r["_slices"] for r in hot) <= 20
    assert all(len(r["_bounds"]) < max(r["_slices"], 2) for r in hot)
    assert hot_keys(rows, ["id"], policy).table is None


def test_small_inputs_are_searched_as_well(rows):
    assert policy_for(rows).rows == rows.count()
    assert policy_for(rows, skew=SkewPolicy(min_rows=10)).rows == 2000


def test_a_sample_finds_the_hot_keys(spark):
    many = spark.range(400_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    hot = hot_keys(many, ["k"], SkewPolicy(share=64, min_rows=5000)).table.collect()
    assert [(r["k"], 18 <= r["_slices"] <= 26) for r in hot] == [(-1, True)]


@pytest.mark.parametrize("policy", POLICIES)
def test_with_last(rows, policy):
    whole = Window.partitionBy("k")
    want = rows.withColumn("last", F.max_by("id", F.struct("t", "id")).over(whole))
    got = with_last(rows, ["k"], ["t", "id"], "id", "last", policy)
    assert as_set(got, "k", "id", "last") == as_set(want, "k", "id", "last")


@pytest.mark.parametrize("policy", POLICIES)
@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join(spark, rows, policy, how):
    attrs = spark.range(12).select(F.col("id").alias("k"), (F.col("id") * 10).alias("a"))
    got = lookup_join(rows, attrs, ["k"], how, skew=policy)
    assert as_set(got, "k", "t", "id", "a") == as_set(rows.join(attrs, "k", how), "k", "t", "id", "a")


@pytest.mark.parametrize("policy", POLICIES)
def test_with_position(rows, policy):
    order = Window.partitionBy("k").orderBy("t", "id")
    want = rows.filter("k is not null").withColumn("pos", F.row_number().over(order).cast("long") - 1)
    got = with_position(rows.filter("k is not null"), ["k"], ["t", "id"], skew=policy)
    assert as_set(got, "id", "pos") == as_set(want, "id", "pos")


@pytest.mark.parametrize("policy", POLICIES)
@pytest.mark.parametrize("n", [1, 5])
def test_with_previous(rows, policy, n):
    order = Window.partitionBy("k").orderBy("t", "id").rowsBetween(-n, -1)
    known = rows.filter("k is not null")
    want = known.withColumn("prev", F.collect_list("id").over(order))
    got = with_previous(known, ["k"], ["t", "id"], "id", n, "prev", skew=policy)
    assert as_set(got, "id", "prev") == as_set(want, "id", "prev")


def test_number_rows(rows):
    got = number_rows(rows, ["id"], "no")
    assert got.filter(F.col("no") != F.col("id")).count() == 0


@pytest.mark.parametrize("far", [10**12, 5 * 10**4])
def test_row_numbers_of_uneven_keys_come_from_even_ranges(spark, monkeypatch, far):
    """Clustered keys and one far from them: the ranges grow with the rows, and none holds many more than the others."""
    from sessionflow.operators import prefix

    handed = []
    monkeypatch.setattr(prefix, "hand_off", lambda df, name, f=prefix.hand_off: handed.append(f(df, name)) or handed[-1])
    keys = spark.range(100_000).select(F.col("id").alias("k")).filter(F.col("k") != far).union(spark.range(1).select(F.lit(far).alias("k")))
    got = number_rows(keys, ["k"], "no", range_rows=2_000)
    order = got.orderBy("k").collect()
    assert [r["no"] for r in order] == list(range(len(order)))
    sizes = [r["count"] for r in handed[0].groupBy("_range").count().collect()]
    assert len(sizes) > 40 and max(sizes) < 6_000


def test_running_sum_in_digest_order(spark):
    df = spark.range(300).select(F.col("id"), F.md5(F.col("id").cast("string")).alias("h"))
    got = running_sum(df, F.col("id"), ["h"], "before").collect()
    total = 0
    for row in sorted(got, key=lambda r: r["h"]):
        assert row["before"] == total
        total += row["id"]


def test_ranges_of_a_hot_key_are_even(spark):
    """A key with all rows is cut into about 100 ranges, none much longer than the others."""
    from sessionflow.operators.skew import _with_parts

    df = spark.range(100_000).select(F.lit(1).alias("k"), F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("t"))
    policy = SkewPolicy(share=100, min_rows=1000)
    parts = _with_parts(df, hot_keys(df, ["k"], policy, ["t"]), ["t"])
    sizes = parts.groupBy("_part").agg(F.count("*").alias("n"), F.min("t").alias("lo"), F.max("t").alias("hi"))
    sizes = sorted(sizes.collect(), key=lambda r: r["_part"])
    assert len(sizes) > 80
    assert max(r["n"] for r in sizes) < 2000
    assert all(a["hi"] < b["lo"] for a, b in zip(sizes, sizes[1:]))


def test_hot_keys_of_several_sets_in_one_search(spark):
    df = spark.range(4000).select(
        F.when(F.col("id") < 1500, F.lit(None)).otherwise(F.col("id") % 900).alias("a"), (F.col("id") % 3).cast("string").alias("b"), (F.col("id") % 2000).alias("c")
    )
    policy = SkewPolicy(share=10, min_rows=1)
    sets = [["a"], ["a", "b"], ["b"], ["c"]]
    rows = lambda hot: set() if hot.table is None else {tuple(r) for r in hot.table.collect()}
    together = hot_keys_together(df, sets, policy)
    assert [rows(h) for h in together] == [rows(hot_keys(df, keys, policy)) for keys in sets]
    assert [len(rows(h)) for h in together] == [1, 3, 3, 0]
