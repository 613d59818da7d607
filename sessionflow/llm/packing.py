"""Packing of documents into training sequences: vector bin packing under limits on tokens, segments and loss tokens.

A document longer than a sequence gives whole sequences of its own. The rests are packed by the dot-product heuristic:
the next piece is the one whose needs (tokens, one segment, loss tokens, as shares of the limits) have the largest inner
product with what the sequence has left. When nothing fits whole, a piece is cut to fill the gap. What is left at the
end of a group goes into sequences whose lengths are powers of two, which need no padding.

Each task packs what it has read, a bounded group at a time; nothing is shuffled, and no group depends on another.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionflow.llm.frames import batch, give_back
from sessionflow.llm.set_join import ddl
from sessionflow.llm.tokens import library_encoder

SEQUENCE_TOKENS, SEQUENCE_SEGMENTS = 2048, 256
#: Documents whose rests are packed together; bounds a task's memory.
GROUP = 2048
PIECES = pa.schema([(c, pa.int64()) for c in ("item", "start", "length", "sequence", "offset")])
PACKED = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])
#: With prompts also the loss-bearing tokens of each piece.
PACKED_LOSS = PACKED.append(pa.field("loss_tokens", pa.int64()))


def _loss(start: int, length: int, prompt: int) -> int:
    """Loss-bearing tokens of a piece: those after the first ``prompt`` tokens of its document."""
    return length - min(max(prompt - start, 0), length)


def _first_longest(tokens: int, prompt: int, start: int, most_tokens: int, most_loss: int) -> int:
    """Length of the longest piece from ``start`` within both limits."""
    return min(tokens - start, most_tokens, max(prompt - start, 0) + most_loss)


def plan(tokens, prompts=None, capacity: int = SEQUENCE_TOKENS, segments: int = SEQUENCE_SEGMENTS, loss: int | None = None):
    """Yields (item, start, length, sequence, offset): every token of every item in one piece, sequences numbered from 0.

    ``prompts``: how many first tokens of each item bear no loss (default 0). ``loss``: the most loss-bearing tokens of
    a sequence (default: as many as tokens). Items without tokens give no piece.
    """
    loss = capacity if loss is None else loss
    if capacity < 1 or segments < 1 or loss < 1:
        raise ValueError("limits must be positive")
    tokens = [int(t) for t in tokens]
    prompts = [min(int(p), t) for p, t in zip(prompts, tokens, strict=True)] if prompts is not None else [0] * len(tokens)
    sequence, at = 0, [0] * len(tokens)
    for i, n in enumerate(tokens):
        while n - at[i] >= capacity and _loss(at[i], capacity, prompts[i]) <= loss:
            yield i, at[i], capacity, sequence, 0
            at[i] += capacity
            sequence += 1
    left = np.array([n - a for n, a in zip(tokens, at, strict=True)], np.int64)
    need_loss = np.array([_loss(a, n - a, p) for n, a, p in zip(tokens, at, prompts, strict=True)], np.int64)
    order = np.argsort(-left, kind="stable")
    order = order[left[order] > 0]
    scale = np.array([1 / capacity, 1 / segments, 1 / loss])
    rest = [int(i) for i in order]  # by tokens left, most first
    need = np.stack([left[order], np.ones(len(order), np.int64), need_loss[order]], axis=1).astype(float)
    open_ = np.ones(len(rest), bool)

    def take(k: int, length: int) -> tuple[int, int, int]:
        i = rest[k]
        piece = (i, at[i], length)
        at[i] += length
        need[k, 0] = tokens[i] - at[i]
        need[k, 2] = _loss(at[i], tokens[i] - at[i], prompts[i])
        open_[k] = need[k, 0] > 0
        return piece

    n_open = int(open_.sum())
    while n_open:
        room, pieces = np.array([capacity, segments, loss], float), []
        while room[0] > 0 and room[1] > 0 and n_open:
            k = -1
            # the last segment has to fill the gap: only an exact fit or a cut does
            fits = open_ & (need <= room).all(axis=1) & ((need[:, 0] == room[0]) if room[1] == 1 else True)
            if fits.any():
                k = int(np.argmax(np.where(fits, need @ (scale * scale * room), -1.0)))
                length = int(need[k, 0])
            else:
                k = int(np.argmax(np.where(open_, need[:, 0], -1.0)))
                i = rest[k]
                length = _first_longest(tokens[i], prompts[i], at[i], int(room[0]), int(room[2]))
                if not length:
                    break  # the loss limit is reached
            start = at[rest[k]]
            pieces.append(take(k, length))
            room -= (length, 1, _loss(start, length, prompts[rest[k]]))
            n_open -= not open_[k]
        for sequence_length in _whole(sum(p[2] for p in pieces), capacity):
            offset = 0
            while offset < sequence_length:
                i, start, length = pieces.pop(0)
                used = min(length, sequence_length - offset)
                yield i, start, used, sequence, offset
                offset += used
                if used < length:
                    pieces.insert(0, (i, start + used, length - used))
            sequence += 1


def _whole(total: int, capacity: int) -> list[int]:
    """Lengths that need no padding: the whole capacity, or else powers of two, largest first."""
    if total == capacity:
        return [total]
    return [1 << k for k in range(total.bit_length() - 1, -1, -1) if total >> k & 1]


def _packed(path: str, end_id: int, capacity: int, segments: int, loss: int | None = None, with_prompts: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = library_encoder(path), np.array([end_id], "<u4")
        base, used, ids, held, prompts = TaskContext.get().partitionId() << 33, 0, [], [], []

        def packed():
            nonlocal used
            rows = list(plan([len(x) for x in held], prompts, capacity, segments, loss))
            pieces = np.array(rows, np.int64).reshape(-1, 5).T
            crcs = [zlib.crc32(held[i][s : s + n]) for i, s, n, _, _ in rows]
            columns = {"loss_tokens": [_loss(s, n, prompts[i]) for i, s, n, _, _ in rows]} if with_prompts else {}
            out = batch(PACKED_LOSS if with_prompts else PACKED, doc_id=[ids[i] for i in pieces[0]], start=pieces[1], length=pieces[2], ids_crc32=crcs, doc_tokens=[len(held[i]) for i in pieces[0]], sequence_id=pieces[3] + (base + used), offset=pieces[4], **columns)
            used += int(pieces[3].max()) + 1 if len(rows) else 0
            return out

        for b in batches:
            first = b.column("prompt").to_pylist() if with_prompts else [0] * b.num_rows
            for doc_id, p, x in zip(b.column("doc_id").to_pylist(), first, encoder.rows(b.column("text")), strict=True):
                ids.append(doc_id)
                prompts.append(max(p or 0, 0))
                held.append(np.concatenate([x, end]).astype("<u4"))
                if len(held) == GROUP:
                    yield packed()
                    ids, held, prompts = [], [], []
        if held:
            yield packed()
        ids, held, prompts = [], [], []
        give_back()

    return run


def pack_documents(
    docs: DataFrame, path: str, end_id: int = 1, capacity: int = SEQUENCE_TOKENS, segments: int = SEQUENCE_SEGMENTS, prompt: str | None = None, loss: int | None = None
) -> DataFrame:
    """Packs the ids of ``docs`` (doc_id, text), each document ended by ``end_id``, into sequences.

    Returns a row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. ``prompt`` names a column
    of ``docs`` that says how many first tokens of a document bear no loss (null or negative: none; more than it has:
    all), and adds loss_tokens, those of the piece that do; without it all tokens bear loss. ``loss`` is the most
    loss-bearing tokens of a sequence (default: as many as tokens).
    Null or empty text is the end id alone. Repeated rows and rows without a doc_id are packed like any other; sequence
    ids are unique, not gapless. Other columns are ignored. A task that runs again gives the same pieces and ids.
    """
    if min(capacity, segments, capacity if loss is None else loss) < 1:
        raise ValueError("limits must be positive")
    prompts = [] if prompt is None else [F.col(prompt).cast("bigint").alias("prompt")]
    run = _packed(path, end_id, capacity, segments, loss, bool(prompts))
    return docs.select("doc_id", "text", *prompts).mapInArrow(run, ddl(PACKED_LOSS if prompts else PACKED))
