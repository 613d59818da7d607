"""Token ids of whole text columns through the tokenizers library, which sees each distinct word of a task once.

The pattern of the byte-level vocabularies never joins text across certain borders (a word and the white space after it,
letters and digits, letters and punctuation away from apostrophes). Texts are cut there with numpy, the library encodes
the distinct pieces, and their ids are put together again. Where a border is not certain, no cut is made. Strings of added
tokens (<|endoftext|>) are pieces of their own, for the library takes them out of a text before all else.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa

from sessionflow.llm.words import chunks, distinct_spans, short_keys

#: Distinct pieces whose ids a worker remembers; then it starts anew.
REMEMBERED = 1_000_000
#: Bytes of text cut at once; a task needs some 25 times as much for it.
CHUNK = 3 << 19
#: Pieces of up to so many bytes are told apart as numbers.
SHORT = 7

_WHITE, _LETTER, _DIGIT, _OTHER, _APOSTROPHE, _UNKNOWN = range(6)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _WHITE
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[48:58] = _DIGIT
_CLASS[39] = _APOSTROPHE
_CLASS[128:] = _UNKNOWN


def piece_starts(data: np.ndarray, offsets: np.ndarray, added: re.Pattern | None = None) -> np.ndarray:
    """Where the pieces of a chunk begin. No match of the pattern crosses such a place; what ``added`` finds is whole."""
    kind = _CLASS[data]
    after = np.flatnonzero(data[:-1] == 0xC3) + 1  # U+00C0 to U+00FF: letters but for the signs of product and quotient
    letters = after[(data[after] != 0x97) & (data[after] != 0xB7)]
    kind[letters] = kind[letters - 1] = _LETTER
    begins = np.zeros(len(data), bool)
    before, now = kind[:-1], kind[1:]
    plain = (before >= _LETTER) & (before <= _OTHER)
    begins[1:] = plain & (now >= _LETTER) & (now <= _OTHER) & (before != now)
    begins[1:] |= (now == _WHITE) & (plain | (before == _APOSTROPHE))
    # white space after another character: the only white space beyond ASCII begins with bytes C2, E1, E2 or E3
    at = np.flatnonzero((now == _WHITE) & (before == _UNKNOWN)) + 1
    lead = lambda k: np.where(at >= k, data[np.maximum(at - k, 0)], 0)
    sure = ((lead(2) >= 0xC3) & (lead(2) <= 0xDF)) | ((lead(3) >= 0xE4) & (lead(3) <= 0xEF)) | ((lead(4) >= 0xF0) & (lead(4) <= 0xF4))
    begins[at[sure]] = True
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    if added and added.search(raw := data.tobytes()):
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            for found in added.finditer(raw, a, b):  # within one row
                begins[found.start() : found.end()] = False
                begins[found.start()] = True
                begins[found.end() : found.end() + 1] = True
    return np.flatnonzero(begins)


@dataclass
class Encoder:
    """Encodes chunks; ``encode`` gives the ids of many pieces, and is asked once per distinct piece, told by its bytes.

    ``starts_of`` says where the pieces of a chunk begin (by default ``piece_starts``); ``added`` finds the strings that are
    tokens before all else. More than ``remembered`` pieces are forgotten (by default ``REMEMBERED``).
    """

    encode: Callable[[list[bytes]], list]
    added: re.Pattern | None = None
    starts_of: Callable[[np.ndarray, np.ndarray, re.Pattern | None], np.ndarray] = piece_starts
    remembered: int | None = None
    known: dict[bytes, int] = field(default_factory=dict)
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    places: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    starts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint32))

    def _forget(self) -> None:
        self.known, self.keys, self.places = {}, np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.starts, self.counts, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _learn(self, pieces: list[bytes]) -> np.ndarray:
        """Encodes new pieces; returns their places among all that are known."""
        new = self.encode(pieces)
        counts = np.fromiter(map(len, new), np.int64, len(new))
        flat = np.fromiter(chain.from_iterable(new), np.uint32, int(counts.sum()))
        first = len(self.counts)
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.ids = np.concatenate([self.ids, flat])
        return np.arange(first, first + len(pieces))

    def _short(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The place of each short piece; ``keys`` ascend."""
        keys, one, which = np.unique(short_keys(data, starts, sizes), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        held = at < len(self.keys)
        held[held] = self.keys[at[held]] == keys[held]
        if not held.all():
            a, n = starts[one[~held]].tolist(), sizes[one[~held]].tolist()
            places = self._learn([data[x : x + size].tobytes() for x, size in zip(a, n, strict=True)])
            self.keys, self.places = np.insert(self.keys, at[~held], keys[~held]), np.insert(self.places, at[~held], places)
            at = np.searchsorted(self.keys, keys)
        return self.places[at][which]

    def _long(self, data: np.ndarray, bounds: np.ndarray, long: np.ndarray) -> np.ndarray:
        """The place of each longer piece."""
        distinct, which = distinct_spans(data, bounds, long)
        if new := [p for p in distinct if p not in self.known]:
            self.known.update(zip(new, self._learn(new).tolist(), strict=True))
        return np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))[which]

    def chunk(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows of a chunk, and where each row's ids begin."""
        n = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
        begins = self.starts_of(data, offsets, self.added)
        bounds = np.append(begins, len(data))
        sizes = np.diff(bounds)
        if len(self.counts) > (REMEMBERED if self.remembered is None else self.remembered):
            self._forget()
        long = sizes > SHORT
        place = np.empty(len(begins), np.int64)
        place[~long] = self._short(data, begins[~long], sizes[~long])
        if long.any():
            place[long] = self._long(data, bounds, long)
        del bounds, sizes, long
        counts = self.counts[place]
        upto = np.concatenate([[0], np.cumsum(counts)])
        at = np.repeat(self.starts[place] - upto[:-1], counts)
        del place, counts
        at += np.arange(upto[-1])
        return self.ids[at], upto[np.searchsorted(begins, offsets)]

    def rows(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of every row in order."""
        for _, data, offsets in chunks(column, CHUNK):
            ids, at = self.chunk(data, offsets)
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                yield ids[a:b]


def tokenizer(path: str):
    """The vocabulary in a task, as the library reads it."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def added_strings(loaded) -> re.Pattern | None:
    """Finds the strings of added tokens in UTF-8; of several at one place the longest."""
    tokens = loaded.get_added_tokens_decoder().values()
    if odd := [t.content for t in tokens if t.lstrip or t.rstrip or t.single_word or (t.normalized and loaded.normalizer)]:
        raise ValueError(f"added tokens that take more than their own string are not supported: {odd}")
    strings = sorted({t.content.encode() for t in tokens if t.content}, key=len, reverse=True)
    return re.compile(b"|".join(map(re.escape, strings))) if strings else None


def vocabulary_size(path: str) -> int:
    return tokenizer(path).get_vocab_size()


_encoders: dict[tuple[str, bool], Encoder] = {}


def library_encoder(path: str, special: bool = True, remembered: int | None = None) -> Encoder:
    """One encoder per worker process and vocabulary; it keeps what it has learnt for the next task.

    Strings of special tokens in a text are those tokens, or ordinary text where ``special`` is false.
    """
    if (path, special) not in _encoders:
        loaded = tokenizer(path)
        loaded.encode_special_tokens = not special
        encode = lambda pieces: [e.ids for e in loaded.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)]
        _encoders[path, special] = Encoder(encode, added_strings(loaded) if special else None, remembered=remembered)
    return _encoders[path, special]
