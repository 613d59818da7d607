"""Alignment of two tokenizers: where the tokens of A and B end together, and which ids stand for the same text.

All texts of a chunk are merged in lockstep: one state vector holds a pointer into A's and into B's token ends for every
text, and each step moves, in all texts at once, the pointer whose token ends first, or both where they end together. There
a cut is made, and the links of the group between it and the cut before are given out. Texts that are done leave the vector.
Long texts take several places in it, from ends that A and B share.

How many documents hold a pair of ids linked is counted over the whole corpus. A chunk is stored with the distinct pairs it
holds, so that a pair is sent once per chunk and not once per document, both for counting and for bringing counts back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionflow.llm.frames import from_planes, give_back, hand_off, planes
from sessionflow.llm.tokens import Encoder, library_encoder, tokenizer
from sessionflow.llm.words import buffers, chunks

#: Bytes of text aligned at once, for which a task needs some hundred times as much; a longer text is aligned alone.
CHUNK = 1 << 20
#: Distinct pieces that each of the two encoders of a worker remembers.
REMEMBERED = 300_000
#: Tokens of A after which a text goes on in another place of the state vector.
LANE = 256
#: Pairs of a group from which on its ids are counted before they are paired.
LARGE_GROUP = 1 << 16
#: Bits of a pair's key that hold B's id.
B_BITS = 32

_SPACE = 32
_encoders: dict[str, Encoder] = {}


class Vocabulary:
    """The bytes of all tokens."""

    def __init__(self, tokens: list[bytes]):
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.names = [str(i) for i in range(len(tokens))]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        lengths = self.lengths[ids]
        upto = np.cumsum(lengths) - lengths
        return self.bytes[np.repeat(self.starts[ids] - upto, lengths) + np.arange(int(lengths.sum()))]


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_level(path: str) -> tuple[Encoder, Vocabulary]:
    """Tokenizer A: a byte-level vocabulary of the tokenizers library; strings of special tokens are ordinary text."""
    letters = byte_letters()
    loaded = tokenizer(path)
    tokens = [b""] * loaded.get_vocab_size()
    for name, i in loaded.get_vocab().items():
        tokens[i] = bytes(letters[c] for c in name) if all(c in letters for c in name) else b""
    return library_encoder(path, special=False, remembered=REMEMBERED), Vocabulary(tokens)


def _words_with_space(data: np.ndarray, offsets: np.ndarray, _) -> np.ndarray:
    """Where white space follows other text, and where rows begin."""
    begins = np.zeros(len(data), bool)
    begins[1:] = (data[1:] == _SPACE) & (data[:-1] != _SPACE)
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(begins)


def _rows_only(data: np.ndarray, offsets: np.ndarray, _) -> np.ndarray:
    return np.unique(offsets[:-1][np.diff(offsets) > 0])


def pieces(path: str) -> tuple[Encoder, Vocabulary]:
    """Tokenizer B: a piece model of the sentencepiece library that puts a space before a text.

    Where no piece holds a space after other text, no merge crosses such a place, and the words of a text are encoded one by
    one; otherwise whole texts are.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    tokens = [bytes([int(n[3:5], 16)]) if model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
    apart = all("▁" not in n.lstrip("▁") for n in names)
    if path not in _encoders:
        lone = [model.piece_to_id("▁")]  # of a space at the end; the library gives nothing for an empty text

        def encode(parts: list[bytes]) -> list[list[int]]:
            found = model.encode([p[1:].decode() for p in parts], num_threads=1)
            return [ids if len(p) > 1 else lone for p, ids in zip(parts, found, strict=True)]

        _encoders[path] = Encoder(encode, starts_of=_words_with_space if apart else _rows_only, remembered=REMEMBERED)
    return _encoders[path], Vocabulary(tokens)


def _whole(vocabulary: Vocabulary, ids: np.ndarray, at: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows whose tokens' bytes are those of the text."""
    cum = np.concatenate([[0], np.cumsum(vocabulary.lengths[ids])])
    sizes = np.diff(offsets)
    whole = cum[at[1:]] - cum[at[:-1]] == sizes
    held = ids[np.repeat(whole, np.diff(at))]
    text = data if whole.all() else data[np.repeat(whole, sizes)]
    rows = np.flatnonzero(whole)
    wrong = np.flatnonzero(vocabulary.decode(held) != text)
    whole[rows[np.searchsorted(np.cumsum(sizes[whole]), wrong, "right")]] = False
    return whole


def lanes(ends_a: np.ndarray, ends_b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, lane: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first A token, first B token, A token after the last) of the places in the state vector.

    Rows have tokens ``at_a[i]:at_a[i + 1]``; ends ascend over all rows. A long row is divided after about every ``lane``
    tokens of A, at the next end that B has as well.
    """
    lane = lane or LANE
    sizes = np.diff(at_a)
    more = np.maximum(sizes - 1, 0) // lane
    row = np.repeat(np.arange(len(sizes)), more)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(more) - more, more)
    spot = at_a[row] + (nth + 1) * lane - 1
    limit = np.minimum(spot + lane, at_a[row + 1] - 1)
    shared = []
    while len(spot):
        b = np.searchsorted(ends_b, ends_a[spot])
        meets = ends_b[b] == ends_a[spot]
        shared.append(np.stack([spot[meets] + 1, b[meets] + 1]))
        on = ~meets & (spot + 1 < limit)
        spot, limit = spot[on] + 1, limit[on]
    some = sizes > 0
    first = np.concatenate([np.stack([at_a[:-1][some], at_b[:-1][some]]), *shared], axis=1)
    first = first[:, np.argsort(first[0], kind="stable")]
    return first[0], first[1], np.append(first[0], at_a[-1])[1:]


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray, end_a: np.ndarray) -> np.ndarray:
    """The groups as columns (first A token, tokens of A, first B token, tokens of B), in the order in which they close."""
    state = np.stack([first_a, first_b, first_a, first_b, end_a])  # pointers, where the group began, where the text ends
    closed = []
    while state.shape[1]:
        a, b = state[0], state[1]
        x, y = ends_a[a], ends_b[b]
        a += x <= y
        b += y <= x
        cut = np.flatnonzero(x == y)
        if len(cut):
            now = state[:, cut]
            closed.append(np.stack([now[2], now[0] - now[2], now[3], now[1] - now[3]]))
            state[2:4, cut] = now[:2]
            if (now[0] == now[4]).any():
                state = state[:, state[0] < state[4]]
    return np.concatenate(closed, axis=1) if closed else np.zeros((4, 0), np.int64)


def links(groups: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, key, times): the linked pairs of ids of every group; key holds A's id above B's."""
    _, n_a, _, n_b = groups
    large = n_a * n_b >= LARGE_GROUP
    which = np.flatnonzero(~large)
    first_a, n_a, first_b, n_b = groups[:, which]
    pairs = n_a * n_b
    inside = np.arange(int(pairs.sum())) - np.repeat(np.cumsum(pairs) - pairs, pairs)
    wide = np.repeat(n_b, pairs)
    a = ids_a[np.repeat(first_a, pairs) + inside // wide]
    b = ids_b[np.repeat(first_b, pairs) + inside % wide]
    out = [(np.repeat(which, pairs), a.astype(np.int64) << B_BITS | b, np.ones(len(a), np.int64))]
    for g in np.flatnonzero(large).tolist():
        first_a, n_a, first_b, n_b = groups[:, g].tolist()
        a, times_a = np.unique(ids_a[first_a : first_a + n_a], return_counts=True)
        b, times_b = np.unique(ids_b[first_b : first_b + n_b], return_counts=True)
        keys = (a.astype(np.int64)[:, None] << B_BITS | b.astype(np.int64)).ravel()
        out.append((np.full(len(keys), g), keys, np.outer(times_a, times_b).ravel()))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


@dataclass
class Aligned:
    """The tokens and groups of a chunk; rows without tokens have none of either. Groups are in the order of the text."""

    ids_a: np.ndarray
    at_a: np.ndarray
    ids_b: np.ndarray
    at_b: np.ndarray
    groups: np.ndarray
    at_group: np.ndarray


def _only(whole: np.ndarray, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(at)
    return ids[np.repeat(whole, sizes)], np.concatenate([[0], np.cumsum(np.where(whole, sizes, 0))])


def align_chunk(a: tuple[Encoder, Vocabulary], b: tuple[Encoder, Vocabulary], data: np.ndarray, offsets: np.ndarray) -> Aligned:
    """Aligns the rows of a chunk of texts that begin with the space put before them; a row of the space alone is empty."""
    found = [encoder.chunk(data, offsets) for encoder, _ in (a, b)]
    whole = np.diff(offsets) > 1
    for (_, vocabulary), (ids, at) in zip((a, b), found, strict=True):
        whole &= _whole(vocabulary, ids, at, data, offsets)
    (ids_a, at_a), (ids_b, at_b) = (_only(whole, *x) for x in found)
    ends_a, ends_b = np.cumsum(a[1].lengths[ids_a]), np.cumsum(b[1].lengths[ids_b])
    groups = lockstep(ends_a, ends_b, *lanes(ends_a, ends_b, at_a, at_b))
    groups = groups[:, np.argsort(groups[0], kind="stable")]
    return Aligned(ids_a, at_a, ids_b, at_b, groups, np.searchsorted(groups[0], at_a))


def _chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    wide = pc.cast(column.fill_null(""), pa.large_string())
    return chunks(pc.binary_join_element_wise(pa.scalar("", pa.large_string()), wide, pa.scalar(" ", pa.large_string())), CHUNK)


def _spelled(found: Aligned, names: pa.Array, n_a: int, n_b: int) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of every row; ``names`` holds ,id and ;id of A, then ,id and |id of B."""
    first_a, size_a, first_b, size_b = found.groups
    size = size_a + size_b
    start = np.cumsum(size) - size
    order = np.empty(int(size.sum()), np.int32)
    place_a = np.arange(len(found.ids_a)) + np.repeat(start - first_a, size_a)
    place_b = np.arange(len(found.ids_b)) + np.repeat(start + size_a - first_b, size_b)
    order[place_a], order[place_b] = found.ids_a, found.ids_b.astype(np.int64) + 2 * n_a
    order[start] += n_a
    order[start + size_a] += n_b
    rows = np.append(start, len(order))[found.at_group]
    data, offsets = buffers(names.take(pa.array(order)))
    bounds = offsets[rows]
    return [data[a + 1 : b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


BLOCK = [("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64())]


def _blocks(path_a: str, path_b: str, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level(path_a), pieces(path_b)
        spelling = [f"{mark}{i}".encode() for v, marks in ((a[1], ",;"), (b[1], ",|")) for mark in marks for i in v.names]
        names = pa.array(spelling, pa.large_binary())
        block = TaskContext.get().partitionId() << 33
        for rows in batches:
            for first, data, offsets in _chunks(rows.column("text")):
                found = align_chunk(a, b, data, offsets)
                group, keys, times = links(found.groups, found.ids_a, found.ids_b)
                distinct, which = np.unique(keys, return_inverse=True)
                row = np.searchsorted(found.at_group, group, "right") - 1
                pairs, again = np.unique(row * max(len(distinct), 1) + which, return_inverse=True)
                row, which = np.divmod(pairs, max(len(distinct), 1))
                sums = np.bincount(again, times, len(pairs)).astype(np.int64)
                n = len(offsets) - 1
                digests = [hashlib.sha256(x).hexdigest() if x else "" for x in _spelled(found, names, len(a[1].names), len(b[1].names))]
                counts = [np.diff(found.at_a), np.diff(found.at_b), np.diff(found.at_group), np.bincount(row, sums, n).astype(np.int64)]
                lists = [[c] for c in counts]
                packed = [planes(distinct, "i8"), planes(np.bincount(which, minlength=len(distinct)), "i4"), planes(row, "i4"), planes(which, "i4"), planes(sums, "i8")]
                part = rows.column("row").slice(first, n)
                held = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), part)
                arrays = [pa.array([block], pa.int64()), held, *[pa.array([x[0]], pa.list_(pa.int64())) for x in lists], pa.array([digests], pa.list_(pa.string()))]
                arrays += [pa.array([x], pa.binary()) for x in packed]
                yield pa.RecordBatch.from_arrays(arrays, names=["block", "rows", *[c for c, _ in BLOCK], "groups_sha256", "keys", "held_by", "pair_row", "pair_key", "pair_times"])
                block += 1
                del found, group, keys, times, distinct, which, row, pairs, again, sums, digests, arrays, packed
                give_back()

    return run


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, key_no, key, held_by) of the distinct pairs of each block."""
    for b in batches:
        for block, keys, held in zip(b.column("block").to_pylist(), b.column("keys").to_pylist(), b.column("held_by").to_pylist(), strict=True):
            keys = from_planes(keys, "i8")
            columns = [np.full(len(keys), block), np.arange(len(keys), dtype=np.int32), keys, from_planes(held, "i4").astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["block", "key_no", "key", "held_by"])


def _summed(blocks: pa.Table, asked: pa.Table) -> pa.Table:
    """The results of the rows of one block, whose pairs have got their counts."""
    block = blocks.combine_chunks()
    counts, best = np.zeros(asked.num_rows, np.int64), np.zeros(asked.num_rows, np.int64)
    at = asked.column("key_no").to_numpy()
    counts[at], best[at] = asked.column("n").to_numpy(), asked.column("top").to_numpy()
    row, key, times = (from_planes(block.column(c)[0].as_py(), k) for c, k in (("pair_row", "i4"), ("pair_key", "i4"), ("pair_times", "i8")))
    rows = block.column("rows").chunk(0).flatten()
    n = len(rows)
    totals = [np.zeros(n, np.int64) for _ in range(2)]
    for total, values in zip(totals, (best, counts), strict=True):
        np.add.at(total, row, values[key] * times)
    columns = [rows, *[block.column(c).chunk(0).flatten() for c, _ in BLOCK], *[pa.array(t) for t in totals], block.column("groups_sha256").chunk(0).flatten()]
    return pa.table(columns, names=["row", *[c for c, _ in BLOCK], "n_best", "count_sum", "groups_sha256"])


def _packed(docs: DataFrame) -> tuple[DataFrame, str]:
    packed = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("row"), "text")
    return packed, packed.schema["row"].dataType.simpleString()


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The aligned chunks of ``docs``, written to the shared folder: rows, their counts, and the pairs they hold linked."""
    packed, kind = _packed(docs)
    numbers = ", ".join(f"{c} array<bigint>" for c, _ in BLOCK)
    schema = f"block bigint, rows array<{kind}>, {numbers}, groups_sha256 array<string>, keys binary, held_by binary, pair_row binary, pair_key binary, pair_times binary"
    return hand_off(packed.mapInArrow(_blocks(path_a, path_b, kind), schema), "align-blocks")


def link_counts(blocks: DataFrame) -> DataFrame:
    """(key, n, top): in how many documents each pair of ids is linked, and 1 where no pair of its A id is in more, else 0."""
    asked = blocks.select("block", "keys", "held_by").mapInArrow(_asked, "block bigint, key_no int, key bigint, held_by bigint")
    counts = hand_off(asked.groupBy("key").agg(F.sum("held_by").alias("n")), "align-counts")
    id_a = F.shiftright("key", B_BITS)
    best = counts.groupBy(id_a.alias("id_a")).agg(F.max("n").alias("most"))
    joined = counts.withColumn("id_a", id_a).join(F.broadcast(best), "id_a")  # at most a row per id of A's vocabulary
    return joined.select("key", "n", (F.col("n") == F.col("most")).cast("bigint").alias("top"))


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(row, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row of ``docs``; row holds its columns other
    than text.

    A is a byte-level vocabulary of the tokenizers library and encodes a space and the text, B a piece model of the
    sentencepiece library and puts the space there itself. Places where tokens of both end cut them into groups; all pairs of
    an A and a B token of one group are links. A pair of ids counts as often as there are rows that hold it linked; n_best
    are the links whose count is the highest of their A id (ties included), count_sum adds up the counts of all links.
    groups_sha256 is the digest of the ids by group, written as ``a1,a2|b1;a3|b2,b3``.

    Null and empty texts, and texts that one of the tokenizers does not give back byte by byte, have no tokens: zeros and an
    empty groups_sha256. Repeated rows and ids count as rows of their own; other columns are carried along. Whole texts are
    aligned, however long.
    """
    _, kind = _packed(docs)
    blocks = aligned_blocks(docs, path_a, path_b)
    asked = blocks.select("block", "keys", "held_by").mapInArrow(_asked, "block bigint, key_no int, key bigint, held_by bigint")
    told = asked.select("block", "key_no", "key").join(link_counts(blocks), "key").select("block", "key_no", "n", "top")
    numbers = ", ".join(f"{c} bigint" for c in [*[c for c, _ in BLOCK], "n_best", "count_sum"])
    held = blocks.drop("keys", "held_by")
    return held.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_summed, f"row {kind}, {numbers}, groups_sha256 string")


def _tokens(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level(path_a), pieces(path_b)
        for rows in batches:
            for first, data, offsets in _chunks(rows.column("text")):
                found = align_chunk(a, b, data, offsets)
                n = len(offsets) - 1
                cuts = [np.cumsum(found.groups[k]) for k in (1, 3)]
                cuts = [c - np.repeat(at[:-1], np.diff(found.at_group)) for c, at in zip(cuts, (found.at_a, found.at_b), strict=True)]
                columns = [(found.ids_a, found.at_a), (found.ids_b, found.at_b), *[(c, found.at_group) for c in cuts]]
                arrays = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(v, pa.int32())) for v, at in columns]
                yield pa.RecordBatch.from_arrays([rows.column("row").slice(first, n), *arrays], names=["row", "ids_a", "ids_b", "cuts_a", "cuts_b"])

    return run


def token_groups(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(row, ids_a, ids_b, cuts_a, cuts_b) per row of ``docs``: the ids of both, and after how many of each every group ends.

    Rows and odd texts as in ``align``.
    """
    packed, kind = _packed(docs)
    return packed.mapInArrow(_tokens(path_a, path_b), f"row {kind}, ids_a array<int>, ids_b array<int>, cuts_a array<int>, cuts_b array<int>")
