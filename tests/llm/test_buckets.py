"""What tasks send to the buckets of tokens and of sample points."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from sessionflow.llm import components, ngram_join, set_join, suffix_dedup
from sessionflow.llm.words import shingle_sets


def _letters(seed, n_texts, n_words):
    rng = random.Random(seed)
    return [" ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(n_words)) for _ in range(n_texts)]


def test_buckets_of_sample_points_are_equally_full():
    """Sample points are those of least hashes, so their own hashes are small."""
    docs = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(50), pa.int64()), "text": pa.array(_letters(1, 50, 1000))})
    sizes = [0] * 16
    for b in suffix_dedup._points(100, 16)(iter([docs])):
        if (bucket := b.column("bucket")[0].as_py()) >= 0:
            sizes[bucket] += len(b.column("many")[0].as_py())
    assert sum(sizes) > 5000 and max(sizes) < 1.3 * sum(sizes) / 16


def test_points_of_a_frequent_gram_go_to_several_groups():
    common, groups = _letters(2, 1, 300)[0], set()
    for task in range(20):
        docs = pa.RecordBatch.from_pydict({"doc_id": pa.array([2 * task, 2 * task + 1], pa.int64()), "text": pa.array([common, common])})
        groups |= {b.column("bucket")[0].as_py() for b in suffix_dedup._points(100, 1000)(iter([docs])) if b.column("bucket")[0].as_py() < 0}
    assert len(groups) > 10


def test_lean_entries_are_sent_without_bitmaps_in_equally_full_buckets():
    class Ranks:
        value = np.zeros(1 << set_join.COUNTER_BITS, np.uint16)

    docs = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(200), pa.int64()), "text": pa.array(_letters(3, 200, 400))})
    entries, sent, sizes = 0, 0, [0] * 16
    for b in set_join._sent(shingle_sets, Ranks, set_join.Similarity(3, 4), 16, True, 1)(iter([docs])):
        n = len(b.column("many")[0].as_py())
        entries, sent = entries + n, sent + b.nbytes
        sizes[b.column("bucket")[0].as_py()] += n
    assert entries > 10_000 and sent < 30 * entries
    assert max(sizes) < 1.3 * entries / 16


def test_shared_points_come_in_a_row_per_document_whatever_the_buckets(spark, monkeypatch):
    """Rows per bucket and document would grow with both."""
    counts, hand_off = {}, suffix_dedup.hand_off

    def counted(df, name):
        out = hand_off(df, name)
        counts[name] = (out.count(), out.agg({"n": "sum"}).first()[0]) if "n" in out.columns else out.count()
        return out

    monkeypatch.setattr(suffix_dedup, "hand_off", counted)
    monkeypatch.setattr(suffix_dedup, "BUCKET_POINTS", 50)
    texts = _letters(4, 20, 300)
    docs = spark.createDataFrame([(i, texts[i % 20]) for i in range(40)], "doc_id bigint, text string")
    suffix_dedup.repeated_spans(docs).count()
    rows, points = counts["suffix-points"]
    assert rows == 40 and points > 1000


def test_buckets_of_points_give_rows_by_slices_not_by_documents():
    passage = _letters(5, 1, 200)[0]
    docs = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(300), pa.int64()), "text": pa.array([f"{t} {passage}" for t in _letters(6, 300, 20)])})
    groups = {}
    for b in suffix_dedup._points(100, 16)(iter([docs])):
        groups.setdefault(b.column("bucket")[0].as_py(), []).append(b)
    shared = [b for k, parts in groups.items() for b in suffix_dedup._shared(4)((pa.scalar(k),), iter(parts))]
    assert sum(len(b) for b in shared) <= 4 * len(groups)
    by_slice = {}
    for b in shared:
        for i in range(len(b)):
            by_slice.setdefault(b.column("slice")[i].as_py(), []).append(b.slice(i, 1))
    places = [row for k, parts in by_slice.items() for b in suffix_dedup._gathered((pa.scalar(k),), iter(parts)) for row in b.to_pylist()]
    assert sorted(r["doc_id"] for r in places) == list(range(300)) and all(r["n"] * 4 == len(r["places"]) for r in places)


def test_sketches_differ_in_no_more_bits_than_sets_in_tokens():
    rng = np.random.default_rng(7)
    for n, m, both in ((5, 6, 5), (100, 120, 90), (64, 65, 64), (1000, 900, 10), (3000, 2500, 2400), (1, 500, 0)):
        tokens = rng.integers(0, 1 << 63, n + m, dtype=np.uint64) * np.uint64(2)
        x, y = np.sort(tokens[:n]), np.sort(np.concatenate([tokens[:both], tokens[n : n + m - both]]))
        sets = set_join.Sets(np.arange(2), np.zeros(2, np.int64), np.concatenate([x, y]), np.array([0, n, n + m]))
        a, b = (np.frombuffer(s, np.uint8) for s in set_join.sketches_of(sets))
        assert n <= 8 * len(a) <= max(2 * n, 64) and set_join.sketches_differ(a, a) == 0
        assert set_join.sketches_differ(a, b) == set_join.sketches_differ(b, a) <= n + m - 2 * both


def test_whole_sets_are_fetched_only_for_pairs_whose_sketches_are_alike(spark, monkeypatch):
    """Pairs share a rare passage and differ in the rest, which is common: they meet, but their sets stay where they are."""
    counts = {}

    def counted(hand_off):
        def run(df, name):
            out = hand_off(df, name)
            counts[name] = out.count()
            return out

        return run

    monkeypatch.setattr(set_join, "hand_off", counted(set_join.hand_off))
    monkeypatch.setattr(ngram_join, "hand_off", counted(ngram_join.hand_off))
    passages, (left, right) = _letters(8, 20, 60), _letters(9, 2, 140)
    texts = [f"{p} {rest}" for p in passages for rest in (left, right)]
    near = texts[6].split()
    texts.append(" ".join([*near[:30], "other", *near[31:]]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs).collect()}
    assert found == {i: i for i in range(40)} | {40: 6}
    assert counts["ngram-tried"] >= 20 and sum(v for k, v in counts.items() if k.endswith("-pairs")) <= 3


def test_links_form_stars_with_few_shuffles(spark):
    """Chains, circles, repeated links and a hub: the least key of each component, and no shuffle beyond five a round."""
    draw = np.random.default_rng(4)
    links = [(i, i + 1) for i in range(100, 140)] + [(200, 201), (201, 202), (202, 200), (200, 201)] + [(999, 300 + i) for i in range(50)]
    links += [tuple(map(int, draw.integers(1000, 1150, 2))) for _ in range(100)]
    least = {k: k for link in links for k in link if link[0] != link[1]}
    for _ in least:
        for a, b in links:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    df = spark.createDataFrame(links, "a bigint, b bigint")
    assert {(r.key, r.root) for r in components.components(df).collect()} == set(least.items())
    assert {(r.key, r.root) for r in components.stars(df).collect()} == {(k, r) for k, r in least.items() if k != r}
    edges = spark.createDataFrame([(b, a) for a, b in links if a < b], "u bigint, v bigint")
    plan = components._round(edges)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 8  # parts that are used again stand there again


def test_a_few_pairs_are_checked_in_few_tasks(spark):
    """Pairs lie over all partitions of a shuffle; tasks are as many as cores, or more where rows are large."""
    rows, cores = spark.range(500).repartition(64), spark.sparkContext.defaultParallelism
    assert set_join.in_few_tasks(rows, 500, 16).rdd.getNumPartitions() == cores < 64
    assert set_join.in_few_tasks(rows, 500, set_join.TASK_BYTES // 10).rdd.getNumPartitions() == 50
    assert sorted(r.id for r in set_join.in_few_tasks(rows, 500, 16).collect()) == list(range(500))
