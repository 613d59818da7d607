"""Alignment of two tokenizers against the libraries and a plain merge per text."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from cases import documents, no_documents, odd_documents
from conftest import SF_DIR
from tokenizers import Tokenizer

from sessionflow.llm import align as module
from sessionflow.llm.queries import op12_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(libraries, text):
    """(ids, bytes) of both, or nothing where one does not give the text back."""
    a, b = libraries
    letters = {v: k for k, v in a.get_vocab().items()}
    code = module.byte_letters()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(code[c] for c in letters[i]) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return [], [], [], []
    return ids_a, bytes_a, ids_b, bytes_b


def plain_groups(libraries, text):
    ids_a, bytes_a, ids_b, bytes_b = tokens(libraries, text or "")
    ends_a, ends_b = (np.cumsum([len(x) for x in y]).tolist() for y in (bytes_a, bytes_b))
    both, groups, a, b = sorted(set(ends_a) & set(ends_b)), [], 0, 0
    for end in both:
        x, y = ends_a.index(end) + 1, ends_b.index(end) + 1
        groups.append((ids_a[a:x], ids_b[b:y]))
        a, b = x, y
    return groups


def expected(libraries, rows):
    all_groups = [plain_groups(libraries, t) for _, t in rows]
    pairs = [Counter((x, y) for a, b in groups for x in a for y in b) for groups in all_groups]
    counts = Counter(p for linked in pairs for p in linked)
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for (doc_id, _), groups, linked in zip(rows, all_groups, pairs, strict=True):
        spelled = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        n_best = sum(t for p, t in linked.items() if counts[p] == best[p[0]])
        total = sum(t * counts[p] for p, t in linked.items())
        numbers = (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(linked.values()), n_best, total)
        out.append((doc_id, *numbers, hashlib.sha256(spelled.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


ODD = [
    "a  b\n\n\tc <s> </s> <unk> <|endoftext|> <0x41>",
    "trailing space ",
    " leading",
    "▁ literal ▁ signs",
    "==============-----------########" * 20,
    "日本語のテキスト и кириллица 🙂🙃 é ﬁ ½ Ａ",
    "\x00\x01 nul ﻿  \x85",
    "QWxhZGRpbjpvcGVuIHNlc2FtZQ" * 30,
    "x" * 3000,
    "9" * 777 + " " * 55 + "z",
]


@pytest.mark.parametrize("lane, large", [(256, 1 << 16), (3, 4)])
@pytest.mark.parametrize("make", [lambda s: documents(s, SF_DIR).limit(60), odd_documents, no_documents], ids=["small", "odd", "empty"])
def test_align_equals_the_libraries(spark, make, lane, large, libraries, monkeypatch):
    monkeypatch.setattr(module, "LANE", lane)
    docs = make(spark)
    short = docs.filter("text IS NULL OR length(text) < 20000")
    rows = [(r.doc_id, r.text) for r in short.select("doc_id", "text").collect()]
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    found = module.align(short, A, B).select("row.doc_id", *names).collect()
    assert sorted((tuple(r) for r in found), key=str) == expected(libraries, rows)


def test_odd_texts_and_counts_over_many_chunks(spark, libraries):
    rows = list(enumerate([*ODD, *ODD[:3], None, "", "the end", "the end of the end"]))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    found = module.align(docs, A, B).drop("row").collect()
    names = ("row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    found = module.align(docs, A, B).select(*names).collect()
    assert sorted((tuple(r) for r in found), key=str) == expected(libraries, rows)


def test_chunks_of_one_row_lanes_of_one_token_and_large_groups(libraries, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(module, "LANE", 1)
    a, b = module.byte_level(A), module.pieces(B)
    texts = [*ODD, "plain words here"]
    for first, data, offsets in module._chunks(pa.array(texts)):
        found = module.align_chunk(a, b, data, offsets)
        for large in (1, 1 << 16):
            monkeypatch.setattr(module, "LARGE_GROUP", large)
            group, keys, times = module.links(found.groups, found.ids_a, found.ids_b)
            row = np.searchsorted(found.at_group, group, "right") - 1
            got = Counter()
            for r, k, t in zip(row.tolist(), keys.tolist(), times.tolist(), strict=True):
                got[r, k >> 32, k & 0xFFFFFFFF] += t
            want = Counter((i, x, y) for i, text in enumerate(texts[first : first + len(offsets) - 1]) for p, q in plain_groups(libraries, text) for x in p for y in q)
            assert got == want


def test_token_groups(spark, libraries):
    rows = list(enumerate([*ODD, None, ""]))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for r in module.token_groups(docs, A, B).collect():
        groups, a, b = [], 0, 0
        for x, y in zip(r.cuts_a, r.cuts_b, strict=True):
            groups.append((r.ids_a[a:x], r.ids_b[b:y]))
            a, b = x, y
        assert groups == plain_groups(libraries, rows[r.row.doc_id][1])


def test_the_query_covers_every_document(spark):
    found = op12_alignment(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in found) == sorted(r.doc_id for r in documents(spark, SF_DIR).collect())
    assert all(r.n_links >= r.n_groups and r.n_best <= r.n_links for r in found)


def test_a_task_needs_little_memory_for_many_texts(monkeypatch):
    """What numpy holds at once does not follow the bytes of a batch of rows."""
    import tracemalloc
    from types import SimpleNamespace

    monkeypatch.setattr(module, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    draw = np.random.default_rng(3)
    known = np.array(["the", "of", "tokens", "alignment", "Merging", "a", "space,", "zwölf", "17", "boundaries."])
    texts = [" ".join(known[draw.integers(0, len(known), 400)]) for _ in range(2600)]
    rows = pa.RecordBatch.from_pydict({"row": pa.array([{"doc_id": i} for i in range(len(texts))]), "text": texts})
    module.byte_level(A), module.pieces(B)
    tracemalloc.start()
    n = sum(len(b.column("rows")[0]) for b in module._blocks(A, B, "")(iter([rows])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == len(texts) and sum(map(len, texts)) > 5 << 20
    assert peak < 200 << 20
