"""Periodic runs of words: an online sparse dynamic program over the diagonals (lags) of a text against itself.

Words are read from first to last. A word that also stands some lag earlier adds one to the match length of that lag, and a
lag that it does not add to has ended: if its matches make a run, the run is given out at once.

Of the earlier occurrences of a word only those can belong to a run that agree with it in the words before as well. In a run
of smallest period q, the k words up to any of its words (k the least power of two from q on) stand last exactly q words
earlier; the other way round, where the last earlier place of k words is q words back (k/2 < q <= k), no shorter period
fits. So one earlier occurrence for each power of two is enough, a frequent word or a text that repeats one word costs no
more than any other, and a lag that has ended has the smallest period of its run. Which words agree in k words is found for
a batch of texts at once, from pairs of names for k/2 words; what occurs once in its text leaves, so that beyond a few
words only repetitions are left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionflow.llm.frames import give_back
from sessionflow.llm.words import buffers

#: Words of a run, and how often it repeats its period, at least.
LEAST_WORDS, LEAST_POWERS = 6, 4
#: Bytes of text handled at once; a longer text is handled alone.
CHUNK = 4 << 20

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def split_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts one after another, and where each text's words begin; words lie between ASCII white space."""
    lists = pc.ascii_split_whitespace(column.fill_null(""))
    flat, offsets = lists.values, np.asarray(lists.offsets).astype(np.int64)
    full = np.asarray(pc.binary_length(flat)) > 0
    kept = np.concatenate([[0], np.cumsum(full)])
    return flat.filter(pa.array(full)), kept[offsets]


def _earlier(names: np.ndarray, at: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names of ascending values, lag of the last place of the same name in the same text or 0, whether there is another).

    ``at`` ascends; so the places of a name in one text stand side by side once sorted by name.
    """
    order = np.argsort(names, kind="stable")
    sorted_names, where = names[order], at[order]
    new = np.ones(len(order), bool)
    new[1:] = sorted_names[1:] != sorted_names[:-1]
    named = np.empty(len(order), np.int64)
    named[order] = np.cumsum(new) - 1
    same = ~new
    same[1:] &= text[where[1:]] == text[where[:-1]]
    lag, again = np.zeros(len(order), np.int64), np.zeros(len(order), bool)
    lag[order[1:]] = np.where(same[1:], where[1:] - where[:-1], 0)
    again[order] = same | np.append(same[1:], False)
    return named, lag, again


def lags_of_words(ids: np.ndarray, starts: np.ndarray, powers: int = LEAST_POWERS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(at, lag, k): places whose last k words stand last ``lag`` words earlier in the same text, by place and lag.

    ``ids`` number the words of all texts, which begin at ``starts``. k is the least power of two from the lag on. Lags
    that do not fit ``powers`` times into their text are left out.
    """
    sizes = np.diff(starts)
    text = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.arange(len(ids)) - starts[:-1][text]
    longest = int(sizes.max(initial=0)) // powers
    found = []
    if longest >= 1:
        at = 1 + np.flatnonzero((ids[1:] == ids[:-1]) & (text[1:] == text[:-1]))
        found.append((at, np.ones(len(at), np.int64), np.ones(len(at), np.int64)))
    names, at, k = ids.astype(np.int64), np.arange(len(ids)), 1
    alive = np.ones(len(ids), bool)
    while k < longest and len(at):
        spot = np.full(len(ids), -1, np.int64)
        spot[at] = np.arange(len(at))
        ends = at[inside[at] >= 2 * k - 1]
        ends = ends[alive[ends] & alive[ends - k]]
        if not len(ends):
            break
        pair = names[spot[ends - k]] * (int(names.max()) + 1) + names[spot[ends]]
        k *= 2
        names, lag, again = _earlier(pair, ends, text)
        use = (lag > k // 2) & (lag <= k) & (lag * powers <= sizes[text[ends]])
        found.append((ends[use], lag[use], np.full(int(use.sum()), k)))
        at, names = ends[again], names[again]
        alive = np.zeros(len(ids), bool)
        alive[at] = True
    if not found:
        return (np.zeros(0, np.int64),) * 3
    at, lag, k = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((lag, at))
    return at[order], lag[order], k[order]


def runs_of_lags(at: list[int], lags: list[int], ks: list[int], least: int = LEAST_WORDS, powers: int = LEAST_POWERS) -> Iterator[tuple[int, int, int]]:
    """(start, length, period) of the runs of ``lags_of_words``, each as it ends: match lengths of the active lags by place.

    The texts of a batch may follow one another: no lag is active at a text's first word.
    """
    active: dict[int, tuple[int, int]] = {}

    def ended(lag: int) -> Iterator[tuple[int, int, int]]:
        last, matches = active.pop(lag)
        if matches + lag >= max(least, powers * lag):
            yield last - matches - lag + 1, matches + lag, lag

    now = -1
    for place, lag, k in zip(at, lags, ks, strict=True):
        if place != now:
            now = place
            for old in [x for x, (last, _) in active.items() if last < place - 1]:
                yield from ended(old)
        active[lag] = (place, active[lag][1] + 1 if lag in active else k)
    for old in list(active):
        yield from ended(old)


def find_runs(ids: np.ndarray, starts: np.ndarray, least: int = LEAST_WORDS, powers: int = LEAST_POWERS) -> np.ndarray:
    """A row (start, length, period) per run of all texts, start counted over all words, by start and then period."""
    events = lags_of_words(ids, starts, powers)
    runs = np.array(list(runs_of_lags(*[e.tolist() for e in events], least, powers)), np.int64).reshape(-1, 3)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _collapsed(least: int, powers: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, offsets = buffers(b.column("text"))
            first = 0
            while first < b.num_rows:
                last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK, "right")) - 1)
                part = b.slice(first, last - first)
                words, starts = split_words(part.column("text"))
                ids = np.asarray(words.dictionary_encode().indices)
                runs = find_runs(ids, starts, least, powers)
                depth = np.zeros(len(ids) + 1, np.int64)
                np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
                np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
                keep = np.cumsum(depth)[:-1] == 0
                kept = np.concatenate([[0], np.cumsum(keep)])[starts]
                left = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept, pa.int32()), words.filter(pa.array(keep))), " ")
                text = np.searchsorted(starts, runs[:, 0], "right") - 1
                columns = [runs[:, 0] - starts[text], runs[:, 1], runs[:, 2]]
                values = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(RUN))
                found = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(starts))), pa.int32()), values)
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(np.diff(starts), pa.int64()), found, left], names=["row", "n_words", "runs", "text"])
                first = last
                del part, words, ids, runs, left, found, values
            give_back()

    return run


def collapse_runs(docs: DataFrame, least: int = LEAST_WORDS, powers: int = LEAST_POWERS) -> DataFrame:
    """(row, n_words, runs, text) per row of ``docs``; row holds its columns other than text.

    A run is a stretch of consecutive words of smallest period q, with at least ``least`` words and ``powers`` times q, that
    no word beside it extends with period q. runs lists (start, length, period), start being a word's number from 0, by
    start and then period. Of each run the first q words stay; text is the words that no run drops, joined by one space.

    Null, empty and wordless texts have no words, no runs and empty text. Every row stands for itself: repeated rows and ids,
    rows without an id and other columns make no difference. A text is never cut; it is handled in one task, in memory and
    time proportional to its words, but for a logarithm. ``powers`` must be 3 at least.
    """
    if powers < 3 or least < 1:
        raise ValueError("powers must be at least 3 and least at least 1")
    packed = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("row"), "text")
    kind = packed.schema["row"].dataType.simpleString()
    return packed.mapInArrow(_collapsed(least, powers), f"row {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, text string")
