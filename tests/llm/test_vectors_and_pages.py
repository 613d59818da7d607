"""Vector searches against all pairs, archives of pages, and what the subpackage leaves alone."""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from compare import connect, differences
from conftest import SF_DIR

from sessionflow.llm import vectors
from sessionflow.llm.ann import nearest
from sessionflow.llm.queries import ORACLES, QUERIES
from sessionflow.llm.topk import exact_top_k
from sessionflow.llm.warc import member, read_pages, read_records, read_warc, record, register, write_pages

EMBEDDINGS = "vec_id bigint, embedding array<float>, label int, row int, v int, block int"


def odd_vectors(spark):
    draw = np.random.default_rng(5)
    good = [(i, [float(x) for x in draw.standard_normal(6)], 1) for i in range(120)]
    same = [(200 + i, [0.5] * 6, None) for i in range(130)]
    bad = [(300, None, 1), (400, [1.0, None], 1), (500, [float("nan")] * 6, 1), (600, [float("inf")] * 6, 1), (700, [0.0] * 6, 1), (800, [], 1), (None, [1.0] * 6, 1), (1000, [2.0], 1)]
    rows = [*good, *same, *bad, good[7], good[7]]
    return spark.createDataFrame([(*r, 1, 1, 1) for r in rows], EMBEDDINGS)


def usable_rows(df, zero):
    rows = [(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()]
    rows = [(i, v) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    width = max((len(v) for _, v in rows), default=0)
    return [(i, np.array([*v, *[0.0] * (width - len(v))])) for i, v in rows if zero or any(v)]


def expected(rows, k, every):
    out = []
    for i, q in rows:
        if i % every == 0:
            scores = sorted((-float(v @ q), j) for j, v in rows if j != i)[:k]
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores, 1)]
    return out


@pytest.mark.parametrize("block", [8192, 40])
def test_exact_top_k(spark, block, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", block)
    monkeypatch.setattr(vectors, "BLOCK_QUERIES", 2)
    df = odd_vectors(spark)
    rows = [(i, np.floor(256 * v)) for i, v in usable_rows(df, True)]
    assert Counter(map(tuple, exact_top_k(df).collect())) == Counter(expected(rows, 5, 50))
    assert exact_top_k(df.limit(0)).collect() == []
    few = df.filter("vec_id IN (0, 1, 2)")
    assert [(r["rank"], r.query_id) for r in exact_top_k(few).orderBy("rank").collect()] == [(1, 0), (2, 0)]


def test_top_k_equals_sql(spark):
    assert differences(QUERIES["op8_top_k"](spark, SF_DIR), connect(SF_DIR), ORACLES["op8_top_k"]) == ""


def test_nearest_recall_and_scores(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = usable_rows(df, False)
    by_id = dict(rows)
    found = nearest(df).collect()
    exact = {(q, j) for q, _, j, _ in expected(rows, 20, 20)}
    assert len(found) == len(exact)
    assert len({(r.query_id, r.vec_id) for r in found} & exact) / len(exact) >= 0.9
    assert all(abs(r.score - by_id[r.query_id] @ by_id[r.vec_id]) < 1e-9 for r in found)


def test_nearest_of_odd_vectors(spark):
    df = odd_vectors(spark)
    found = nearest(df).collect()
    allowed = {i for i, _ in usable_rows(df, False)}
    assert {r.vec_id for r in found} <= allowed and 700 not in {r.query_id for r in found}
    ranks = Counter(r.query_id for r in found)
    assert set(ranks) == {i for i in allowed if i % 20 == 0} and set(ranks.values()) == {20}
    assert nearest(df.limit(0)).collect() == []
    assert len(nearest(df.filter("vec_id < 3")).collect()) == 2


# -- archives ----------------------------------------------------------------------------------------------------------


def odd_pages(spark):
    texts = ["", "same", None, "é" * 50_000, "<html>\r\n\r\nWARC/1.1\r\n"]
    rows = [(10_000 + i, f"http://x/{i}\r\nX: 1" if i else None, texts[i % 5], i) for i in range(25)]
    return spark.createDataFrame([*rows, (None, "u", "same", 1), (10_021, "u", "same", 1), rows[3], rows[3]], "page_id bigint, url string, html string, payload int")


def expected_pages(df):
    rows = [(r.page_id, (r.html or "").encode()) for r in df.select("page_id", "html").collect()]
    newest = {}
    for i, raw in rows:
        newest[raw] = max((x for x in (i, newest.get(raw)) if x is not None), default=None)
    sha = lambda raw: base64.b32encode(hashlib.sha1(raw).digest()).decode()
    return Counter((i, len(raw), sha(raw), *(("response", None) if i == newest[raw] else ("revisit", newest[raw]))) for i, raw in rows)


@pytest.mark.parametrize("table", ["small", "odd", "empty"])
def test_pages_round_trip(spark, table):
    df = spark.read.parquet(f"{SF_DIR}/pages.parquet") if table == "small" else odd_pages(spark)
    df = df.limit(0) if table == "empty" else df
    assert Counter(map(tuple, read_pages(spark, write_pages(df)).collect())) == expected_pages(df)


def test_filters_and_payloads_of_the_source(spark):
    folder = write_pages(odd_pages(spark))
    register(spark)
    load = lambda **o: spark.read.format("warc").options(path=folder, **o).load()
    assert load().filter("record_type = 'revisit'").count() == sum(n for k, n in expected_pages(odd_pages(spark)).items() if k[3] == "revisit")
    assert load(payload="false").filter("payload IS NOT NULL").count() == 0
    assert load().filter("payload_digest IN ('none', 'other')").count() == 0
    assert load(partitionBytes="1").rdd.getNumPartitions() >= load().rdd.getNumPartitions()


def test_frames_with_filters_can_be_used_again(spark):
    folder = write_pages(odd_pages(spark))
    every = read_warc(spark, folder)
    n = every.count()
    parts = [every.filter(F.col("record_type") == t) for t in ("response", "revisit")]
    assert sum(p.count() for p in parts) == n == every.count() == parts[0].union(parts[1]).count()
    chosen = [read_warc(spark, folder, {"record_type": [t]}) for t in ("response", "revisit")]
    assert [c.count() for c in chosen] == [p.count() for p in parts]
    assert read_warc(spark, folder, {"refers_to": []}).count() == chosen[1].count()
    pushed = spark.read.format("warc").options(path=folder, pushFilters="true").load().filter("record_type = 'response'")
    assert pushed.count() == parts[0].count()


@pytest.mark.parametrize("split", [1, 2, 5])
def test_members_of_several_records(split):
    """Gzip archives in one stream and in members of several records, with payloads that are wanted or not."""
    noise = np.random.default_rng(2)
    payloads = [noise.bytes(n) for n in (0, 10, 200_000, 5, 70_000)]
    records = [record({"record_type": "metadata" if k % 2 else "resource", "record_id": f"<urn:{k}>", "content_type": "text/plain"}, p) for k, p in enumerate(payloads)]
    raw = b"".join(gzip.compress(b"".join(records[i : i + split])) for i in range(0, len(records), split))
    for kinds in ({"resource"}, {"metadata"}, {"resource", "metadata"}):
        rows = list(read_records(Counted(raw), True, lambda row: row["record_type"] in kinds, True, True))
        want = [(f"urn:{k}", p) for k, p in enumerate(payloads) if ("metadata" if k % 2 else "resource") in kinds]
        assert [(r["record_id"], r["payload"]) for r in rows] == want
    with pytest.raises(ValueError):
        list(read_records(Counted(raw[:-30]), True, lambda row: True, True, True))


class Counted:
    """A file that counts the bytes read from it."""

    def __init__(self, raw):
        self.file, self.n = pa.BufferReader(raw), 0

    def size(self):
        return self.file.size()

    def read_at(self, n, at):
        got = self.file.read_at(n, at)
        self.n += len(got)
        return got


def test_unwanted_payloads_are_passed_over():
    noise = np.random.default_rng(1).bytes(3_000_000)
    records = [record({"record_type": t, "record_id": f"<urn:{k}>", "content_type": "text/plain"}, noise) for k, t in enumerate(("resource", "metadata", "resource"))]
    wanted = lambda row: row["record_type"] == "metadata"
    ours, other, plain = b"".join(map(member, records)), b"".join(gzip.compress(r) for r in records), b"".join(records)
    for raw, packed, skips in ((ours, True, True), (other, True, False), (plain, False, True)):
        source = Counted(raw)
        rows = list(read_records(source, packed, wanted, True, True))
        assert [(r["record_id"], r["payload"]) for r in rows] == [("urn:1", noise)]
        assert (source.n < 2 * len(noise)) == skips


def test_a_cut_archive_is_an_error():
    raw = member(record({"record_type": "resource", "record_id": "<urn:1>"}, b"x" * 1000))
    with pytest.raises(ValueError):
        list(read_records(Counted(raw[:-30]), True, lambda row: True, True, True))


def test_nothing_else_imports_the_subpackage():
    package = Path(vectors.__file__).parents[1]
    for path in package.rglob("*.py"):
        if "llm" not in path.parts:
            assert "sessionflow.llm" not in path.read_text(), path
