"""Tokenizing, token files and packing against the libraries and exact round trips."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from cases import documents, no_documents, odd_documents
from conftest import SF_DIR
from public_tokenizers import PATTERN

from sessionflow.llm import bpe, packing, token_files, tokens
from sessionflow.llm.bpe import BytePairEncoder, encode_decode
from sessionflow.llm.packing import pack_documents, plan
from sessionflow.llm.queries import vocabulary
from sessionflow.llm.token_files import Reader, Writer, pack, read_token_files, unpack, write_token_files
from sessionflow.llm.tokens import library_encoder, tokenizer

RANKS, WORDS = vocabulary("byte_bpe_multi_50k.tiktoken"), vocabulary("byte_bpe_50k.json")
TABLES = {"small": lambda spark: documents(spark, SF_DIR), "odd": odd_documents, "empty": no_documents}


def rows_of(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    draw = random.Random(3)
    letters = list("ab'stre lld0 1.,!\n\t\xa0 é×ß中\x1c\x85“🙂 　")
    return ["".join(draw.choice(letters) for _ in range(draw.randint(0, 60))) for _ in range(5000)]


def test_bpe_equals_the_library_on_odd_texts():
    texts = [*odd_texts(), "a" * 3000, "ab" * 2000, " " * 1000, "".join(random.Random(1).choice("abcdefg") for _ in range(8000))]
    encoder, library = BytePairEncoder(RANKS, PATTERN), reference()
    for text, ids in zip(texts, encoder.rows(pa.array(texts)), strict=True):
        assert ids.tolist() == library.encode_ordinary(text)
        assert encoder.ranks.decode(ids) == text.encode()


def test_library_encoder_equals_whole_texts():
    texts, library = odd_texts(), tokenizer(WORDS)
    whole = library.encode_batch_fast(texts, add_special_tokens=False)
    for ids, e in zip(library_encoder(WORDS).rows(pa.array(texts)), whole, strict=True):
        assert ids.tolist() == e.ids


def test_strings_of_added_tokens_equal_the_unchanged_library():
    from tokenizers import Tokenizer

    library, end = Tokenizer.from_file(WORDS), "<|endoftext|>"
    draw = random.Random(5)
    parts = [end, end[:7], end[7:], "it's", " ", "  ", "\n", "x", "9", "<|", "é", "中", "<"]
    texts = [end, f" {end} ", f"a{end}b", f"{end}{end}", end[:7], end[7:], *("".join(draw.choice(parts) for _ in range(draw.randint(0, 12))) for _ in range(3000))]
    assert library.token_to_id(end) in library.encode(f"a{end}b", add_special_tokens=False).ids
    for text, ids in zip(texts, library_encoder(WORDS).rows(pa.array(texts)), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_forgetting_pieces_changes_nothing(monkeypatch):
    """The tasks of op3, op4 and op9 where a worker starts anew before almost every chunk."""
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    monkeypatch.setattr(tokens, "CHUNK", 200)
    monkeypatch.setattr(bpe, "_encoders", {})
    monkeypatch.setattr(tokens, "_encoders", {})
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    texts = odd_texts()[:300]
    docs = [pa.RecordBatch.from_pydict({"doc_id": pa.array(range(300), pa.int64()), "text": texts})]
    found = [r for b in bpe._codes(RANKS, PATTERN, False)(iter(docs)) for r in b.to_pylist()]
    library = reference()
    assert [(np.frombuffer(r["ids"], "<u4").tolist(), r["decoded"].decode()) for r in found] == [(library.encode_ordinary(t), t) for t in texts]
    whole = [e.ids for e in tokenizer(WORDS).encode_batch_fast(texts, add_special_tokens=False)]
    cuts = SimpleNamespace(value=np.zeros(0, np.int64))
    found = [r["ids"] for b in token_files._encode(WORDS, 0, 16, cuts)(iter(docs)) for r in b.to_pylist()]
    assert [np.frombuffer(x, "<u2").tolist() for x in found] == [[*ids, 0] for ids in whole]
    pieces = [r for b in packing._packed(WORDS, 1, 2048, 256)(iter(docs)) for r in b.to_pylist()]
    assert sum(p["length"] for p in pieces) == sum(len(ids) + 1 for ids in whole)
    for p in pieces:
        ids = np.array([*whole[p["doc_id"]], 1], "<u4")[p["start"] : p["start"] + p["length"]]
        assert p["ids_crc32"] == zlib.crc32(ids.tobytes())


@pytest.mark.parametrize("table", TABLES)
def test_encode_decode(spark, table):
    df, library = TABLES[table](spark), reference()
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    expected = []
    for i, t in rows_of(df):
        ids = np.array(library.encode_ordinary(t), "<u4")
        expected.append((i, len(ids), sha(ids.tobytes()), sha(t.encode())))
    assert Counter(map(tuple, encode_decode(df, RANKS, PATTERN, digests=True).collect())) == Counter(expected)
    assert sorted(bytes(r.decoded) for r in encode_decode(df, RANKS, PATTERN).collect()) == sorted(t.encode() for _, t in rows_of(df))


@pytest.mark.parametrize("bits", [1, 7, 13, 16, 17, 31, 32])
def test_bit_packing_round_trip(tmp_path, bits):
    draw = np.random.default_rng(bits)
    docs = [draw.integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32) for n in (0, 1, 9, 1000, 3)]
    assert all((unpack(pack(d, bits), len(d), bits) == d).all() for d in docs)
    with pa.OSFile(str(tmp_path / "x.tids"), "wb") as out:
        writer = Writer(out, bits, block_ids=64)
        for i, d in enumerate(docs):
            writer.add(None if i == 1 else i, d)
        writer.close()
    with pa.OSFile(str(tmp_path / "x.tids")) as source:
        reader = Reader(source)
        for i in (3, 0, 4, 2, 1):  # random access
            assert (reader.ids(i) == docs[i]).all()
        assert reader.has_id.tolist() == [True, False, True, True, True]


@pytest.mark.parametrize("table", TABLES)
def test_token_files(spark, table):
    df, library = TABLES[table](spark), tokenizer(WORDS)
    ids = [(i, np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4")) for i, t in rows_of(df)]
    found = read_token_files(*write_token_files(df, WORDS)).orderBy("start").collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == Counter((i, len(x), zlib.crc32(x.tobytes())) for i, x in ids)
    assert [r.start for r in found] == (np.cumsum([0, *[r.n_tokens for r in found]])[:-1]).tolist()
    order = [-1 if r.doc_id is None else r.doc_id for r in found]
    assert order == sorted(order)


def check_plan(tokens, prompts, pieces, capacity, segments, loss):
    by_item, by_sequence = defaultdict(list), defaultdict(list)
    for i, start, length, sequence, offset in pieces:
        by_item[i].append((start, length))
        by_sequence[sequence].append((offset, length, i, start))
    for i, n in enumerate(tokens):
        at = 0
        for start, length in sorted(by_item[i]):
            assert start == at and length > 0
            at += length
        assert at == n
    for parts in by_sequence.values():
        at = 0
        for offset, length, _, _ in sorted(parts):
            assert offset == at
            at += length
        assert at == capacity or at & (at - 1) == 0
        assert at <= capacity and len(parts) <= segments
        assert sum(n - min(max(prompts[i] - s, 0), n) for _, n, i, s in parts) <= loss


@pytest.mark.parametrize("limits", [(2048, 256, 2048), (64, 3, 40), (7, 2, 5), (100, 1, 100), (1, 1, 1)])
def test_packing_keeps_all_limits(limits):
    draw = random.Random(limits[0])
    for _ in range(25):
        tokens = [draw.choice([0, 1, 3, 50, 300]) for _ in range(draw.randint(0, 40))]
        prompts = [draw.randint(0, n) for n in tokens]
        check_plan(tokens, prompts, list(plan(tokens, prompts, *limits)), *limits)


@pytest.mark.parametrize("table", TABLES)
def test_pack_documents(spark, table):
    df, library = TABLES[table](spark), tokenizer(WORDS)
    pieces = pack_documents(df, WORDS).collect()
    crcs = Counter()
    for i, t in rows_of(df):
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 1], "<u4")
        crcs[i, len(ids)] += 1
        mine = [p for p in pieces if p.doc_id == i and p.doc_tokens == len(ids)]
        assert any(p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes()) for p in mine)
    total = Counter()
    for p in pieces:
        total[p.doc_id, p.doc_tokens] += p.length
    assert total == Counter({k: k[1] * n for k, n in crcs.items()})
    parts = defaultdict(list)
    for p in pieces:
        parts[p.sequence_id].append((p.offset, p.length))
    for rows in parts.values():
        size = sum(n for _, n in rows)
        assert size == 2048 or (size < 2048 and size & (size - 1) == 0)
        assert [o for o, _ in sorted(rows)] == np.cumsum([0, *[n for _, n in sorted(rows)]])[:-1].tolist()


@pytest.mark.parametrize("table", ["odd", "conversations"])
def test_pack_documents_keeps_the_loss_limit(spark, table):
    """Instruction data: the first tokens of a document are its prompt, which bears no loss."""
    if table == "odd":
        df = odd_documents(spark).selectExpr("doc_id", "text", "if(doc_id % 4 = 0, NULL, doc_id * 7 - 20) AS asked")
    else:
        turns = spark.read.parquet(f"{SF_DIR}/conversations.parquet").filter("text IS NOT NULL")
        df = turns.selectExpr("conv_id * 1000 + turn AS doc_id", "text", "if(role = 'user', 1000000, turn % 5) AS asked")
    library, capacity, segments, loss = tokenizer(WORDS), 64, 3, 20
    pieces = pack_documents(df, WORDS, capacity=capacity, segments=segments, prompt="asked", loss=loss).collect()
    expected = Counter()
    for r in df.collect():
        n = len(library.encode(r.text or "", add_special_tokens=False).ids) + 1
        expected[r.doc_id, n] += np.array([n, n - min(max(r.asked or 0, 0), n)])
    total, parts = Counter(), defaultdict(list)
    for p in pieces:
        total[p.doc_id, p.doc_tokens] += np.array([p.length, p.loss_tokens])
        parts[p.sequence_id].append(p)
    assert {k: v.tolist() for k, v in total.items()} == {k: v.tolist() for k, v in expected.items()}
    for rows in parts.values():
        size = sum(p.length for p in rows)
        assert size == capacity or (size < capacity and size & (size - 1) == 0)
        assert len(rows) <= segments and sum(p.loss_tokens for p in rows) <= loss
    unlimited = pack_documents(df, WORDS, capacity=capacity, segments=segments).groupBy("sequence_id").sum("length")
    assert unlimited.filter(f"`sum(length)` > {loss}").count() > 0


def test_cutting_texts_needs_little_memory(monkeypatch):
    """What numpy holds at once while a batch of many texts is encoded."""
    import tracemalloc

    monkeypatch.setattr(tokens, "_encoders", {})
    draw = random.Random(6)
    texts = pa.array([" ".join(draw.choices(["the", "of", "tokens", "packing", "a", "17", "sequence."], k=400)) for _ in range(3000)])
    encoder = library_encoder(WORDS)
    tracemalloc.start()
    n = sum(1 for _ in encoder.rows(texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == len(texts) and peak < 64 << 20
