"""Byte-level BPE in numpy: encoding by rank files and decoding.

The words of a task that are not yet known are merged together: words of similar length form a padded matrix, and in
every round each row merges its leftmost pair of least rank. Ranks of pairs come from an open-addressing hash table in
two arrays. Rows without a pair leave the matrix, and the matrix narrows with its longest row.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sessionflow.llm.frames import batch
from sessionflow.llm.set_join import ddl
from sessionflow.llm.tokens import Encoder

#: Pieces of more bytes are merged with a heap: their number of rounds would be their length.
MATRIX_BYTES = 256
_NONE = np.int64(1 << 40)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Ranks:
    """A rank file: tokens by rank, and which two tokens merge into which."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.tokens = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        by_rank = sorted((r, t) for t, r in self.tokens.items())
        self.bytes = np.frombuffer(b"".join(t for _, t in by_rank), np.uint8)
        lengths = np.zeros(by_rank[-1][0] + 1, np.int64)
        lengths[[r for r, _ in by_rank]] = [len(t) for _, t in by_rank]
        self.lengths = lengths
        self.starts = np.cumsum(lengths) - lengths
        self.single = np.array([self.tokens[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in self.tokens.items():
            for cut in range(1, len(token)):
                a, b = self.tokens.get(token[:cut]), self.tokens.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self._fill(np.array(list(pairs), np.uint64), np.array(list(pairs.values()), np.int64))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _FACTOR) >> self.shift).astype(np.int64)

    def _fill(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        size = max(4, 4 * len(keys) - 1).bit_length()
        self.shift, self.mask = np.uint64(64 - size), (1 << size) - 1
        self.keys = np.full(1 << size, np.iinfo(np.uint64).max, np.uint64)
        self.ranks = np.full(1 << size, _NONE, np.int64)
        slots = self._slot(keys)
        while len(keys):
            free = self.keys[slots] == np.iinfo(np.uint64).max
            _, first = np.unique(np.where(free, slots, -1 - np.arange(len(slots))), return_index=True)
            won = np.zeros(len(slots), bool)
            won[first] = True
            won &= free
            self.keys[slots[won]], self.ranks[slots[won]] = keys[won], ranks[won]
            keys, ranks, slots = keys[~won], ranks[~won], (slots[~won] + 1) & self.mask

    def of_pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids; _NONE where they do not merge or one is padding (-1)."""
        out = np.full(a.shape, _NONE, np.int64)
        at = np.flatnonzero((a >= 0) & (b >= 0))
        keys = (a.reshape(-1)[at].astype(np.uint64) << np.uint64(32)) | b.reshape(-1)[at].astype(np.uint64)
        slots, flat = self._slot(keys), out.reshape(-1)
        while len(at):
            there = self.keys[slots]
            hit = there == keys
            flat[at[hit]] = self.ranks[slots[hit]]
            on = ~hit & (there != np.iinfo(np.uint64).max)
            at, keys, slots = at[on], keys[on], (slots[on] + 1) & self.mask
        return out

    def merge_words(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word after all merges."""
        out: list = [None] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lengths, kind="stable")
        short = order[lengths[order] <= MATRIX_BYTES]
        for k in order[len(short) :]:
            out[k] = self._merge_long(words[k])
        bucket = np.ceil(np.log2(np.maximum(lengths[short], 1)) * 2)  # two buckets per doubling
        for rows in np.split(short, np.flatnonzero(np.diff(bucket)) + 1):
            if len(rows):
                self._merge_matrix(rows, words, lengths, out)
        return out

    def _merge_matrix(self, rows: np.ndarray, words: list[bytes], lengths: np.ndarray, out: list) -> None:
        width = int(lengths[rows].max())
        ids = np.full((len(rows), width), -1, np.int64)
        inside = np.arange(width) < lengths[rows][:, None]
        ids[inside] = self.single[np.frombuffer(b"".join(words[k] for k in rows), np.uint8)]
        size = lengths[rows].copy()
        ranks = self.of_pairs(ids[:, :-1], ids[:, 1:])
        while True:
            done = ranks.min(axis=1) >= _NONE if ranks.shape[1] else np.ones(len(rows), bool)
            if done.any():
                for r in np.flatnonzero(done).tolist():
                    out[rows[r]] = ids[r, : size[r]]
                rows, ids, ranks, size = rows[~done], ids[~done], ranks[~done], size[~done]
                if not len(rows):
                    return
                width = int(size.max())
                ids, ranks = ids[:, :width], ranks[:, : width - 1]
            every = np.arange(len(rows))
            at = ranks.argmin(axis=1)  # the leftmost of equal ranks
            merged = ranks[every, at]
            # close the gap that the right half of the pair leaves
            columns = np.arange(width)
            ids = np.take_along_axis(ids, np.minimum(columns + (columns > at[:, None]), width - 1), axis=1)
            ids[every, at] = merged
            size -= 1
            ids[every, size] = -1
            columns = np.arange(width - 1)
            ranks = np.take_along_axis(ranks, np.minimum(columns + (columns > at[:, None]), width - 2), axis=1)
            ranks[every, size - 1] = _NONE
            right = np.where(at + 1 < width, ids[every, np.minimum(at + 1, width - 1)], -1)
            ranks[every, np.minimum(at, width - 2)] = np.where(at < width - 1, self.of_pairs(merged, right), _NONE)
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self.of_pairs(ids[left, at[left] - 1], merged[left])

    def _merge_long(self, word: bytes) -> np.ndarray:
        """The same merges for a long word, by a heap of (rank, place) over linked neighbours."""
        ids = self.single[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n

        def rank(i: int) -> int:
            j = after[i]
            return int(self.of_pairs(np.array([ids[i]]), np.array([ids[j]]))[0]) if j < n else int(_NONE)

        start = self.of_pairs(np.array(ids[:-1]), np.array(ids[1:]))
        heap = [(int(r), i) for i, r in enumerate(start) if r < _NONE]
        heapq.heapify(heap)
        now = start.tolist() + [int(_NONE)]
        while heap:
            r, i = heapq.heappop(heap)
            if not alive[i] or now[i] != r:
                continue
            j = after[i]
            ids[i], alive[j], after[i] = r, False, after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (i, before[i]):
                if k >= 0:
                    now[k] = rank(k)
                    if now[k] < _NONE:
                        heapq.heappush(heap, (now[k], k))
        return np.array([x for x, a in zip(ids, alive, strict=True) if a])

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens one after another."""
        ids = ids.astype(np.int64)
        lengths = self.lengths[ids]
        upto = np.cumsum(lengths) - lengths
        return self.bytes[np.repeat(self.starts[ids] - upto, lengths) + np.arange(int(lengths.sum()))].tobytes()


class BytePairEncoder(Encoder):
    """Encodes texts by a rank file; the pattern cuts each distinct piece once."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.ranks, self.pattern = Ranks(path), regex.compile(pattern)
        super().__init__(self._pieces)

    def _pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        words = [[w.encode() for w in self.pattern.findall(p.decode())] for p in pieces]
        distinct = list({w for ws in words for w in ws})
        whole = {w: self.ranks.tokens.get(w) for w in distinct}
        unknown = [w for w in distinct if whole[w] is None]
        ids = dict(zip(unknown, self.ranks.merge_words(unknown), strict=True))
        ids |= {w: np.array([r]) for w, r in whole.items() if r is not None}
        return [np.concatenate([ids[w] for w in ws]) if ws else np.zeros(0, np.int64) for ws in words]


_encoders: dict[tuple[str, str], BytePairEncoder] = {}


def bpe_encoder(path: str, pattern: str) -> BytePairEncoder:
    """One encoder per worker process, vocabulary and pattern."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = BytePairEncoder(path, pattern)
    return _encoders[path, pattern]


CODES = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])
DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def _codes(path: str, pattern: str, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe_encoder(path, pattern)
        sha = lambda raw: hashlib.sha256(raw).hexdigest()
        for b in batches:
            ids = [x.astype("<u4") for x in encoder.rows(b.column("text"))]
            if digests:
                decoded = [sha(encoder.ranks.decode(x)) for x in ids]
                yield batch(DIGESTS, doc_id=b.column("doc_id"), n_tokens=[len(x) for x in ids], ids_sha256=[sha(x.tobytes()) for x in ids], decoded_sha256=decoded)
            else:
                yield batch(CODES, doc_id=b.column("doc_id"), ids=[x.tobytes() for x in ids], decoded=[encoder.ranks.decode(x) for x in ids])

    return run


def encode_decode(docs: DataFrame, path: str, pattern: str, digests: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): its ids as little-endian uint32 and the bytes decoded from them, or with
    ``digests`` their number and the SHA-256 of both.

    Null or empty text has no ids. Long texts and words are encoded whole. Repeated rows and null ids stay as they are;
    other columns are ignored. No shuffle: each task encodes what it reads.
    """
    return docs.select("doc_id", "text").mapInArrow(_codes(path, pattern, digests), ddl(DIGESTS if digests else CODES))
