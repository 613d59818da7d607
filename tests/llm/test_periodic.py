"""Periodic runs against brute force over all lags."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from cases import documents, no_documents, odd_documents, words
from conftest import SF_DIR

from sessionflow.llm import periodic
from sessionflow.llm.queries import op11_periodic_runs, with_periods


def smallest_period(w):
    return next(q for q in range(1, len(w) + 1) if all(w[i] == w[i - q] for i in range(q, len(w))))


def expected_runs(w, least=6, powers=4):
    """All maximal stretches of each lag; of these the ones whose smallest period is the lag."""
    found = []
    for q in range(1, len(w) // powers + 1):
        i = q
        while i < len(w):
            if w[i] != w[i - q]:
                i += 1
                continue
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            length = j - i + q
            if length >= max(least, powers * q) and smallest_period(w[i - q : j]) == q:
                found.append((i - q, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def expected_row(doc_id, text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    runs = expected_runs(w)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    digest = lambda b: hashlib.sha256(b).hexdigest()
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    collapsed = b" ".join(x for i, x in enumerate(w) if i not in dropped)
    return (doc_id, len(runs), *top, digest("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()), digest(collapsed))


def planted(doc_id, text):
    if doc_id is None or text is None or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return text
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return ""
    n, g = len(w), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return " ".join(w[i] if i < a else w[a + (i - a) % p] for i in range(n))


def random_text(seed):
    draw = random.Random(seed)
    out = []
    while len(out) < draw.randint(0, 160):
        root = [draw.choice("ab") for _ in range(draw.choice([1, 1, 2, 3, 4, 5, 7, 8, 9, 16, 17]))]
        part = root * draw.randint(1, 9)
        out += part[: draw.randint(1, len(part))]
    return out


@pytest.mark.parametrize("least, powers", [(6, 4), (1, 3), (9, 5)])
def test_runs_of_two_letter_texts(least, powers):
    texts = [random_text(i) for i in range(300)] + [[], ["a"], list("aaaaaa"), list("ab" * 40), list("aab" * 30 + "aab" * 9 + "b" + "aab" * 30)]
    ids = np.array([ord(c) for t in texts for c in t], np.int64)
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    found = [tuple(r) for r in periodic.find_runs(ids, starts, least, powers).tolist()]
    assert found == [(s + int(starts[i]), n, q) for i, t in enumerate(texts) for s, n, q in expected_runs(t, least, powers)]


def test_words_lie_between_ascii_white_space_only():
    every = "".join(map(chr, range(256))) + " x y　 \x1cz\x85 "
    flat, starts = periodic.split_words(pa.array([every, None, "", " \n", "a\tb", " c "]))
    expected = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in (every, "", "", " \n", "a\tb", " c ")]
    assert [flat.to_pylist()[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)] == expected


@pytest.mark.parametrize("make", [lambda s: documents(s, SF_DIR), odd_documents, no_documents], ids=["small", "odd", "empty"])
def test_collapsed_texts(spark, make, monkeypatch):
    docs = make(spark)
    expected = sorted(expected_row(r.doc_id, planted(r.doc_id, r.text))[1:] for r in docs.select("doc_id", "text").collect() if not r.text or len(r.text) < 40_000)
    found = periodic.collapse_runs(with_periods(docs))
    digests = lambda r: (hashlib.sha256("".join(f"{x.start},{x.length},{x.period}\n" for x in r.runs).encode()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest())
    got = sorted(digests(r) for r in found.collect())
    assert set(e[-2:] for e in expected) <= set(got) and len(got) == docs.count()


def test_the_query_equals_brute_force(spark):
    found = {r.doc_id: tuple(r) for r in op11_periodic_runs(spark, SF_DIR).collect()}
    rows = [(r.doc_id, r.text) for r in documents(spark, SF_DIR).collect()]
    assert len(found) == len(rows)
    assert sum(v[1] for v in found.values()) > 5
    for doc_id, text in rows:
        if len(text or "") < 30_000:
            assert found[doc_id] == expected_row(doc_id, planted(doc_id, text))


def test_one_word_repeated_very_often_and_a_long_period(spark):
    tail = words(5, 20_000).split()
    texts = [" ".join(["a"] * 300_000), " ".join(tail * 5), "x " * 99_999 + "y " + "x " * 99_999]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.row.doc_id: r for r in periodic.collapse_runs(docs).collect()}
    runs = {i: [tuple(x) for x in r.runs] for i, r in found.items()}
    assert runs[0] == [(0, 300_000, 1)] and found[0].text == "a"
    assert runs[1] == [(0, 100_000, 20_000)] and found[1].text == " ".join(tail)
    assert runs[2] == [(0, 99_999, 1), (100_000, 99_999, 1)] and found[2].text == "x y x"
