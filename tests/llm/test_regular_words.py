"""Words of two letters that polynomial hashes modulo a power of two cannot tell apart (Thue-Morse words and complements)."""

import hashlib

import numpy as np
import pytest
import tiktoken
from tokenizers import Tokenizer

from sessionflow.llm.bpe import encode_decode
from sessionflow.llm.line_dedup import dedup_lines
from sessionflow.llm.ngram_join import near_duplicates
from sessionflow.llm.packing import pack_documents
from sessionflow.llm.queries import vocabulary
from sessionflow.llm.token_files import read_token_files, write_token_files


def thue_morse(n, letters):
    return "".join(letters[i.bit_count() % 2] for i in range(n))


@pytest.fixture(scope="module")
def texts():
    return [thue_morse(n, letters) for n in (1024, 2048, 4096) for letters in ("ab", "ba")]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def test_byte_pairs(docs, texts):
    import base64

    from public_tokenizers import PATTERN

    path = vocabulary("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = {r.doc_id: r for r in encode_decode(docs, path, PATTERN).collect()}
    for i, text in enumerate(texts):
        assert np.frombuffer(found[i].ids, "<u4").tolist() == library.encode_ordinary(text)
        assert found[i].decoded.decode() == text


def test_token_files_and_packing(docs, texts):
    import zlib

    path = vocabulary("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    ids = [library.encode(t, add_special_tokens=False).ids for t in texts]
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    found = {r.doc_id: r.ids_crc32 for r in read_token_files(*write_token_files(docs, path, end_id=0)).collect()}
    assert found == {i: crc([*x, 0]) for i, x in enumerate(ids)}
    for p in pack_documents(docs, path, end_id=1).collect():
        assert p.ids_crc32 == crc([*ids[p.doc_id], 1][p.start : p.start + p.length])


def test_documents_and_lines_of_such_words_stay_apart(docs, texts):
    assert {r.doc_id: r.component_id for r in near_duplicates(docs).collect()} == {i: i for i in range(len(texts))}
    for r in dedup_lines(docs).collect():
        assert r.n_removed == 0 and r.sha256 == hashlib.sha256(texts[r.row.doc_id].encode()).hexdigest()
