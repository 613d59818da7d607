"""Words, shingles and lines of whole text columns as 64-bit hashes, computed on Arrow buffers with numpy.

Words are hashed eight bytes at a time, all words of a chunk at once, so that no Python object is made per word. Polynomial
prefix sums give the hash of any span of bytes at once, but modulo a power of two they collide on regular texts: they only
choose where to look. Pieces that must not be mistaken for one another are told apart by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

from sessionflow.llm.frames import give_back

#: Bytes of text handled at once; a single longer text is handled alone.
CHUNK_BYTES = 1 << 20
#: Words per shingle.
SHINGLE = 5

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLOCK = 1 << 16


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n - 1, base, np.uint64))])


_LOW, _LOW_INVERSE = _powers(_BASE, _BLOCK), _powers(_INVERSE, _BLOCK)
_STEP, _STEP_INVERSE = pow(_BASE, _BLOCK, 1 << 64), pow(_INVERSE, _BLOCK, 1 << 64)
_random = np.random.default_rng(20240611)
BYTES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: A-Z read as a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] = LOWER[97:123]
#: space, and \x09 to \x0D
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Words of more bytes are hashed one by one.
LONG_WORD = 256
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_SHINGLE_FACTORS = _random.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit value over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Sums of BYTES[byte] * base^position before every position."""
    n = len(data)
    out = np.empty(n + 1, np.uint64)
    out[0] = 0
    values = BYTES[data]
    factor = 1
    for start in range(0, n, _BLOCK):
        part = values[start : start + _BLOCK]
        part *= _LOW[: len(part)] * np.uint64(factor)
        factor = factor * _STEP % (1 << 64)
    np.cumsum(values, out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each span of bytes, the same wherever the span stands."""
    high = _powers(_STEP_INVERSE, len(prefix) // _BLOCK + 1)
    return mix((prefix[ends] - prefix[starts]) * _LOW_INVERSE[starts % _BLOCK] * high[starts // _BLOCK] + (ends - starts).astype(np.uint64))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins; null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of pieces of whole rows with about ``size`` bytes."""
    data, offsets = buffers(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last
    give_back()


def _word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a chunk; a word never crosses a row."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][np.diff(offsets) > 0]
    begins[edges] = inside[edges]
    ends = np.zeros(len(data) + 1, bool)
    ends[1:] = inside
    ends[1:-1] &= ~inside[1:]
    edges = offsets[1:][np.diff(offsets) > 0]
    ends[edges] = inside[edges - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends)


def short_keys(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Spans of up to seven bytes as numbers: their bytes, and their size above them."""
    word = np.ndarray((len(data) + 1,), np.uint64, np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    sizes = sizes.astype(np.uint64)
    inside = (np.uint64(1) << (sizes * np.uint64(8))) - np.uint64(1)
    return (word[starts] & inside) | (sizes << np.uint64(56))


def distinct_spans(data: np.ndarray, bounds: np.ndarray, keep: np.ndarray | None = None) -> tuple[list[bytes], np.ndarray]:
    """The distinct spans of ``data`` between neighbouring bounds, and which of them each span is; of those in ``keep``."""
    kind, width = (pa.binary(), np.int32) if len(data) < 1 << 31 else (pa.large_binary(), np.int64)
    parts = [None, pa.py_buffer(np.ascontiguousarray(bounds, width)), pa.py_buffer(np.ascontiguousarray(data))]
    spans = pa.Array.from_buffers(kind, len(bounds) - 1, parts)
    found = (spans if keep is None else spans.filter(pa.array(keep))).dictionary_encode()
    return found.dictionary.to_numpy(zero_copy_only=False).tolist(), np.asarray(found.indices).astype(np.int64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hashes of the lower-cased words of a chunk, which stand at ``starts`` to ``ends``.

    Eight bytes at a time are mixed into the hash so far, which begins with the size; words of very many bytes go one by one.
    """
    lowered = np.concatenate([LOWER[data], np.zeros(8, np.uint8)])
    word = np.ndarray((len(data) + 1,), np.uint64, lowered, strides=(1,))
    sizes = ends - starts
    out = mix(sizes.astype(np.uint64) + np.uint64(_BASE))
    which, at, left = np.flatnonzero(sizes <= LONG_WORD), starts, sizes
    at, left = at[which], left[which]
    while len(which):
        out[which] = mix(out[which] ^ (word[at] & _FIRST_BYTES[np.minimum(left, 8)]))
        on = left > 8
        which, at, left = which[on], at[on] + 8, left[on] - 8
    for i in np.flatnonzero(sizes > LONG_WORD).tolist():
        out[i] = xxhash.xxh3_64_intdigest(lowered[starts[i] : ends[i]].tobytes())
    return out


@dataclass
class Sets:
    """Sets of 64-bit tokens one after another: set i is flat[starts[i]:starts[i + 1]], distinct and ascending."""

    row: np.ndarray
    unit: np.ndarray
    flat: np.ndarray
    starts: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.starts)

    def keys(self) -> np.ndarray:
        """One 64-bit key per set; equal sets have equal keys."""
        sums = np.zeros(len(self.flat) + 1, np.uint64)
        np.cumsum(mix(self.flat + np.uint64(0x632BE59BD9B4E019)), out=sums[1:])
        return mix(sums[self.starts[1:]] - sums[self.starts[:-1]] + self.sizes.astype(np.uint64)).view(np.int64)


def _distinct(tokens: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorts the tokens of each set and drops repetitions."""
    bounds = starts.tolist()
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        tokens[a:b].sort()
    keep = np.ones(len(tokens), bool)
    keep[1:] = tokens[1:] != tokens[:-1]
    keep[starts[:-1][np.diff(starts) > 0]] = True
    kept = np.zeros(len(tokens) + 1, np.int64)
    np.cumsum(keep, out=kept[1:])
    return tokens[keep], kept[starts]


def shingle_sets(column: pa.Array) -> Iterator[Sets]:
    """Per row the distinct shingles of five lower-cased words; shorter texts give one shingle of all their words."""
    for first, data, offsets in chunks(column):
        starts, ends = _word_spans(data, offsets)
        words = word_hashes(data, starts, ends)
        n_rows = len(offsets) - 1
        row = np.searchsorted(offsets, starts, "right") - 1
        per_row = np.bincount(row, minlength=n_rows)
        word_starts = np.concatenate([[0], np.cumsum(per_row)])
        sizes = np.where(per_row >= SHINGLE, per_row - SHINGLE + 1, (per_row > 0).astype(np.int64))
        set_starts = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(set_starts[-1]) - np.repeat(set_starts[:-1] - word_starts[:-1], sizes)
        length = np.repeat(np.minimum(per_row, SHINGLE), sizes)
        padded = np.concatenate([words, np.zeros(SHINGLE, np.uint64)])
        tokens = length.astype(np.uint64)
        for i in range(SHINGLE):
            tokens = tokens + np.where(i < length, padded[at + i] * _SHINGLE_FACTORS[i], np.uint64(0))
        tokens, set_starts = _distinct(mix(tokens), set_starts)
        yield Sets(np.arange(first, first + n_rows), np.zeros(n_rows, np.int64), tokens, set_starts)


def line_sets(column: pa.Array) -> Iterator[Sets]:
    """Per line (text between line feeds) with a word, the distinct lower-cased words; ``unit`` is the line's number."""
    for first, data, offsets in chunks(column):
        starts, ends = _word_spans(data, offsets)
        tokens = word_hashes(data, starts, ends)
        feeds = np.flatnonzero(data == 10)
        row = np.searchsorted(offsets, starts, "right") - 1
        line = np.searchsorted(feeds, starts) - np.searchsorted(feeds, offsets[:-1])[row]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (line[1:] != line[:-1])
        at = np.flatnonzero(new)
        tokens, set_starts = _distinct(tokens, np.concatenate([at, [len(tokens)]]))
        yield Sets(row[at] + first, line[at], tokens, set_starts)
