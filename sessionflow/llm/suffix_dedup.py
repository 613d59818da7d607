"""Suffix-array dedup: removes bytes of repeated passages, by a distributed merge sort of text suffixes.

A passage counts from ``length`` bytes. Suffixes are taken at sample points: in each window of ``length`` bytes the place
of its least gram hash (a gram is about a third of a window). Equal windows have their sample point at the same place,
so comparing what stands around sample points finds every repeated window, with a few suffixes per hundred bytes.

1. ``_points`` and ``_shared``: grams of sample points go to buckets, and points whose gram occurs once are dropped. A
   task sends each gram once and marks it if it has more of them, so a frequent gram doesn't fill a bucket. A bucket
   gives a row per slice of the documents, and ``_gathered`` makes of a slice a row per document.
2. ``_runs``: each remaining suffix, followed by what stands before it, is sorted within the task; of equal ones the
   first goes on and the others are known to repeat. Runs are cut at common borders and sent front-coded: each suffix as
   the length of the prefix it has in common with the one before, and the rest.
3. ``merge_runs``: a loser tree merges the runs of a range. It keeps for each loser how far it agrees with the winner,
   so a prefix that is known to agree is never compared again, and it gives the common prefix of all neighbours.
4. ``_resolve``: from those, suffixes that agree far enough after their points, and by the same method before them, are
   the same window; all but the first of each window repeat. Windows that may go on beyond a border are settled by a
   grouping over all ranges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionflow.llm.frames import batch, from_planes, give_back, hand_off, partitions, planes, rows_of
from sessionflow.llm.set_join import bucket_of, ddl, group_apart, keyed
from sessionflow.llm.words import chunks, prefix_hashes, span_hashes

LENGTH = 100
#: Points a task gathers before it sends them; suffixes in a run; points of a bucket and suffixes of a range on average.
FLUSH_POINTS, RUN_SUFFIXES, BUCKET_POINTS, RANGE_SUFFIXES = 1 << 19, 1 << 16, 250_000, 50_000
#: Points of a slice of the documents at most on average, of which the shared ones come together.
SLICE_POINTS = 1 << 21
#: Bytes of text whose sample points are found at once; it takes some hundred bytes of memory for each.
POINT_BYTES = 1 << 18
#: Documents, and suffixes of each, in the sample from which the borders of the ranges are taken.
SAMPLE_DOCS, SAMPLE_SUFFIXES = 2000, 20

#: Bits of a gram's hash that are sent. Grams that collide only bring suffixes that turn out to differ.
GRAM_BITS = np.uint64((1 << 64) - (1 << 16))

POINTS = pa.schema([("bucket", pa.int64()), ("gram", pa.binary()), ("doc", pa.binary()), ("pos", pa.binary()), ("many", pa.binary())])
SHARED = pa.schema([("slice", pa.int64()), ("doc", pa.binary()), ("pos", pa.binary())])
PLACES = pa.schema([("doc_id", pa.int64()), ("places", pa.binary()), ("n", pa.int64())])
RUNS = pa.schema(
    [("range", pa.int64()), *[(c, pa.binary()) for c in ("common", "rest", "doc", "text_key", "at")], ("doc_id", pa.int64()), ("key", pa.int64()), ("spans", pa.binary())]
)
FOUND = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("spans", pa.binary()), ("window", pa.binary()), ("start", pa.int64())])


def gram_length(length: int) -> int:
    return max(2, length * 32 // 100)


def sample_points(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, point, first window, last window, gram hash) of a chunk: the windows whose least gram is at the point."""
    gram = gram_length(length)
    per_row = np.maximum(np.diff(offsets) - length + 1, 0)
    total = int(per_row.sum())
    if not total:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64))
    at = np.arange(len(data) - gram + 1)
    hashes = span_hashes(prefix_hashes(data), at, at + gram)
    least = (hashes >> np.uint64(32) << np.uint64(32)) | at.astype(np.uint64)  # equal grams: the leftmost
    width, done = length - gram + 1, 1
    while done * 2 <= width:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    if done < width:
        least = np.minimum(least[: len(least) - (width - done)], least[width - done :])
    windows = np.arange(total) + np.repeat(offsets[:-1] - (np.cumsum(per_row) - per_row), per_row)
    point = (least[windows] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    row = np.repeat(np.arange(len(per_row)), per_row)
    new = np.flatnonzero(np.concatenate([[True], (point[1:] != point[:-1]) | (row[1:] != row[:-1])]))
    last = np.append(new[1:], total) - 1
    return row[new], point[new], windows[new], windows[last], hashes[point[new]]


# -- grams that occur more than once -----------------------------------------------------------------------------------


def _send(parts: list[tuple], n_buckets: int) -> Iterator[pa.RecordBatch]:
    gram, doc, pos = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.argsort(gram, kind="stable")
    gram, doc, pos = gram[order], doc[order], pos[order]
    first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
    count = np.diff(np.append(first, len(gram)))
    row = lambda k, at, many: batch(POINTS, bucket=[k], gram=[planes(gram[at], "u8")], doc=[planes(doc[at], "i8")], pos=[planes(pos[at], "u4")], many=[planes(many, "u1")])
    known = np.flatnonzero(np.repeat(count > 1, count))
    if len(known):
        yield row(group_apart(doc[known], n_buckets), known, np.zeros(len(known)))
    bucket = bucket_of(gram[first], n_buckets)  # by another hash: those of sample points are the least of many
    order = np.argsort(bucket, kind="stable")
    first, count, bucket = first[order], count[order], bucket[order]
    for part in np.split(np.arange(len(first)), np.flatnonzero(np.diff(bucket)) + 1):
        yield row(int(bucket[part[0]]), first[part], count[part] > 1)


def _points(length: int, n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for b in batches:
            ids = b.column("doc_id").to_numpy()
            for first, data, offsets in chunks(b.column("text"), POINT_BYTES):
                row, point, _, _, gram = sample_points(data, offsets, length)
                if len(row):
                    parts.append((gram & GRAM_BITS, ids[first + row], (point - offsets[row]).astype(np.uint32)))
                    held += len(row)
                if held >= FLUSH_POINTS:
                    yield from _send(parts, n_buckets)
                    parts, held = [], 0
        if parts:
            yield from _send(parts, n_buckets)
        del parts
        give_back()

    return run


def _by_slice(parts: list[tuple[np.ndarray, np.ndarray]], n_slices: int) -> pa.RecordBatch:
    """Points as a row per slice of the documents: their number doesn't depend on that of the documents."""
    doc, pos = (np.concatenate(c) for c in zip(*parts, strict=True))
    part = bucket_of(doc.view(np.uint64), n_slices)
    order = np.lexsort((pos, doc, part))
    doc, pos, part = doc[order], pos[order], part[order]
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
    at = list(zip(first.tolist(), [*first[1:].tolist(), len(part)], strict=False))
    return batch(SHARED, slice=part[first], doc=[planes(doc[a:z], "i8") for a, z in at], pos=[planes(pos[a:z], "u4") for a, z in at])


def _shared(n_slices: int):
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, known, held = [], [], 0
        for b in batches:
            for g, d, p, m in rows_of(b, "gram", "doc", "pos", "many"):
                part = tuple(from_planes(raw, kind) for raw, kind in ((g, "u8"), (d, "i8"), (p, "u4"), (m, "u1")))
                if key[0].as_py() >= 0:
                    parts.append(part)
                    continue
                known.append(part[1:3])
                held += len(part[1])
                if held >= FLUSH_POINTS:
                    yield _by_slice(known, n_slices)
                    known, held = [], 0
        if known:
            yield _by_slice(known, n_slices)
        if parts:
            gram, doc, pos, many = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.argsort(gram, kind="stable")
            gram, doc, pos, many = gram[order], doc[order], pos[order], many[order]
            first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
            count = np.diff(np.append(first, len(gram)))
            shared = np.repeat((count > 1) | (np.maximum.reduceat(many, first) > 0), count) & (many == 0)
            found = _by_slice([(doc[shared], pos[shared])], n_slices)
            del parts, gram, doc, pos, many, order, shared
            give_back()
            yield found

    return run


def _gathered(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shared points of a slice's documents, each in one row."""
    parts = [(from_planes(d, "i8"), from_planes(p, "u4")) for b in batches for d, p in rows_of(b, "doc", "pos")]
    doc, pos = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.argsort(doc, kind="stable")
    doc, pos = doc[order], pos[order]
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    places = [p.tobytes() for p in np.split(pos, first[1:])]
    yield batch(PLACES, doc_id=doc[first], places=places, n=[len(p) // 4 for p in places])
    del parts, doc, pos, order, places
    give_back()


# -- sorted runs -------------------------------------------------------------------------------------------------------


def _suffixes(b: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(suffix, doc_id, text_key, point) per chunk of a batch (doc_id, text_key, text, places).

    A suffix is a row of bytes: what follows its point up to ``length``, what stands before it read backwards, and the
    distances from its last and first window to the point. Bytes outside its windows are zero.
    """
    gram = gram_length(length)
    width = length - gram
    ids, keys = b.column("doc_id").to_numpy(), b.column("text_key").to_numpy()
    places = b.column("places")
    for start, data, offsets in chunks(b.column("text"), POINT_BYTES):
        row, point, first, last, _ = sample_points(data, offsets, length)
        if not len(row):
            continue
        some = [np.frombuffer(x, np.uint32).astype(np.int64) + int(offsets[i]) for i, x in enumerate(places.slice(start, len(offsets) - 1).to_pylist())]
        known = np.zeros(len(data) + 1, bool)
        at = np.concatenate(some)
        known[at[at < len(data)]] = True
        keep = np.flatnonzero(known[point])
        if not len(keep):
            continue
        row, point, near, most = row[keep], point[keep], point[keep] - last[keep], point[keep] - first[keep]
        ahead = np.arange(length)
        right = np.where(ahead < (length - near)[:, None], data[np.minimum(point[:, None] + ahead, len(data) - 1)], 0)
        behind = np.arange(1, width + 1)
        left = np.where(behind <= most[:, None], data[np.maximum(point[:, None] - behind, 0)], 0)
        ends = np.stack([near, most], axis=1)
        out = np.ascontiguousarray(np.concatenate([right, left, ends], axis=1).astype(np.uint8))
        yield out, ids[start + row], keys[start + row], point - offsets[row]


def _strings(rows: np.ndarray) -> np.ndarray:
    """Rows of bytes as strings of fixed length that sort like them."""
    return np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").reshape(-1)


def common_prefixes(rows: np.ndarray) -> np.ndarray:
    """How many bytes each row has in common with the one before it; 0 for the first."""
    out = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        same = rows[1:] == rows[:-1]
        out[1:] = np.where(same.all(axis=1), rows.shape[1], same.argmin(axis=1))
    return out


def _spans(start: np.ndarray, end: np.ndarray) -> bytes:
    return np.stack([start, end], axis=1).astype(np.int64).tobytes()


def _known(doc: np.ndarray, key: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[list, list, list]:
    """Spans by document."""
    order = np.lexsort((key, doc))
    doc, key, start, end = doc[order], key[order], start[order], end[order]
    first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])]))
    at = np.split(np.arange(len(doc)), first[1:])
    return doc[first].tolist(), key[first].tolist(), [_spans(start[i], end[i]) for i in at]


def _run(parts: list[tuple], borders: np.ndarray, length: int) -> Iterator[pa.RecordBatch]:
    rows, doc, key, at = (np.concatenate(c) for c in zip(*parts, strict=True))
    parts.clear()
    order = np.lexsort((at, doc))
    order = order[np.argsort(_strings(rows[order]), kind="stable")]
    rows, doc, key, at = rows[order], doc[order], key[order], at[order]
    common = common_prefixes(rows)
    head = np.maximum.accumulate(np.where(common < rows.shape[1], np.arange(len(rows)), 0))
    repeats = (doc != doc[head]) | (at != at[head])  # equal to an earlier one, which goes on
    none = {c: [None] for c in RUNS.names}
    if repeats.any():
        near, most = (rows[repeats][:, c].astype(np.int64) for c in (-2, -1))
        docs, keys, spans = _known(doc[repeats], key[repeats], at[repeats] - most, at[repeats] - near + length)
        n = len(docs)
        yield batch(RUNS, **{c: [None] * n for c in RUNS.names} | {"range": [-1 - d % 64 for d in docs], "doc_id": docs, "key": keys, "spans": spans})
    rows, doc, key, at = rows[~repeats], doc[~repeats], key[~repeats], at[~repeats]
    where = np.searchsorted(borders, _strings(rows), "right")
    for part in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(where)) + 1):
        common = common_prefixes(rows[part])
        rest = rows[part][np.arange(rows.shape[1]) >= common[:, None]]
        yield batch(RUNS, **none | {"range": [int(where[part[0]])], "common": [common.astype("u2").tobytes()], "rest": [pa.compress(rest.tobytes(), "zstd", asbytes=True)], "doc": [planes(doc[part], "i8")], "text_key": [planes(key[part], "i8")], "at": [planes(at[part], "i8")]})


def _runs(length: int, borders: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for b in batches:
            for part in _suffixes(b, length):
                parts.append(part)
                held += len(part[0])
                if held >= RUN_SUFFIXES:
                    yield from _run(parts, borders.value, length)
                    parts, held = [], 0
        if parts:
            yield from _run(parts, borders.value, length)
        del parts
        give_back()

    return run


def _sampled(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                rows = [r for part in _suffixes(b.slice(i, 1), length) for r in part[0]]
                step = max(1, -(-len(rows) // SAMPLE_SUFFIXES))
                out = [r.tobytes() for r in rows[::step]]
                yield pa.RecordBatch.from_pydict({"suffix": pa.array(out, pa.binary())})

    return run


# -- merging -----------------------------------------------------------------------------------------------------------


def decode_run(common: np.ndarray, rest: bytes, size: int) -> list[bytes]:
    """The suffixes of a front-coded run."""
    out, last, at = [], b"", 0
    for n in common.tolist():
        end = at + size - n
        last = last[:n] + rest[at:end]
        out.append(last)
        at = end
    return out


def merge_runs(runs: list[list[bytes]], commons: list[list[int]], size: int) -> tuple[list[tuple[int, int]], list[int]]:
    """Merges sorted runs with a loser tree that knows common prefixes.

    ``commons``: of each suffix, how many bytes it shares with the one before it in its run. Returns (run, place) in
    order, and how many bytes each shares with the one before it in the result.
    """
    n = len(runs)
    leaves = 1 << max(0, n - 1).bit_length()
    ends = [len(r) for r in runs]
    heads = [r[0] if r else None for r in runs] + [None] * (leaves - n)
    place = [0] * n
    losers, agree = [0] * leaves, [0] * leaves

    def play(a: int, b: int, known: int) -> tuple[int, int, int]:
        """(winner, loser, bytes they share); both agree on the first ``known`` bytes. An ended run loses."""
        x, y = heads[a], heads[b]
        if y is None:
            return a, b, 0
        if x is None:
            return b, a, 0
        if x == y:
            return (a, b, size) if a < b else (b, a, size)
        k = known
        while x[k] == y[k]:
            k += 1
        return (a, b, k) if x[k] < y[k] else (b, a, k)

    winners = [0] * leaves + list(range(leaves))
    for node in range(leaves - 1, 0, -1):
        winners[node], losers[node], agree[node] = play(winners[2 * node], winners[2 * node + 1], 0)
    champion, shares = winners[1], 0
    order: list[tuple[int, int]] = []
    common: list[int] = []
    while heads[champion] is not None:
        order.append((champion, place[champion]))
        common.append(shares)
        # the next of the same run; what it shares with the suffix just given is known
        run = champion
        place[run] += 1
        k = place[run]
        if k < ends[run]:
            heads[run], shares = runs[run][k], commons[run][k]
        else:
            heads[run], shares = None, -1
        node = (leaves + run) >> 1
        while node:
            held = agree[node]
            if shares < held:  # the loser shares more with the last winner, so it comes first
                losers[node], champion, agree[node], shares = champion, losers[node], shares, held
            elif shares == held and shares >= 0:
                winner, loser, agreed = play(champion, losers[node], shares)
                champion, losers[node], agree[node] = winner, loser, agreed if heads[loser] is not None else -1
                if heads[winner] is None:
                    shares = -1
            node >>= 1
    return order, common


def _prefix_with(rows: np.ndarray, border: np.ndarray | None) -> np.ndarray:
    """How many bytes each row has in common with a border."""
    if border is None:
        return np.full(len(rows), -1)
    same = rows == border
    return np.where(same.all(axis=1), rows.shape[1], same.argmin(axis=1))


def _resolve(rows: np.ndarray, common: np.ndarray, doc: np.ndarray, key: np.ndarray, at: np.ndarray, length: int, beyond: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Spans of the windows that repeat an earlier one here; the first of each window that may occur beyond a border."""
    width = length - gram_length(length)
    near, most = rows[:, -2].astype(np.int64), rows[:, -1].astype(np.int64)
    reach = np.maximum(common, np.append(common[1:], 0))
    mine = np.flatnonzero((reach >= length - most) | (beyond >= length - most))
    if not len(mine):
        return
    mine = mine[np.lexsort((at[mine], doc[mine]))]  # earlier places first
    left = rows[:, length : length + width]
    by_left = np.argsort(_strings(left), kind="stable") if width else np.arange(len(rows))
    common_left = common_prefixes(left[by_left]) if width else common * 0
    left_class = np.empty(len(rows), np.int64)
    repeats = np.zeros((len(rows), width + 2), bool)
    ask_row, ask_back = [], []
    for back in range(width + 1):
        some = mine[(near[mine] <= back) & (back <= most[mine])]
        if not len(some):
            continue
        left_class[by_left] = np.cumsum(common_left < back) if back else 0
        window = np.cumsum(common < length - back)[some] * (len(rows) + 1) + left_class[some]
        _, first, which = np.unique(window, return_index=True, return_inverse=True)
        head = some[first[which]]
        again = (doc[some] != doc[head]) | (at[some] != at[head])
        repeats[some[again], back] = True
        out = some[(head == some) & (beyond[some] >= length - back)]
        ask_row.append(out)
        ask_back.append(np.full(len(out), back))
    # runs of neighbouring windows that repeat
    edge = np.diff(repeats.astype(np.int8), axis=1, prepend=0)
    row, low = np.nonzero(edge == 1)
    _, high = np.nonzero(edge == -1)
    if len(row):
        docs, keys, spans = _known(doc[row], key[row], at[row] - (high - 1), at[row] - low + length)
        none = [None] * len(docs)
        yield batch(FOUND, doc_id=docs, text_key=keys, spans=spans, window=none, start=none)
    ask_row, ask_back = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (ask_row, ask_back))
    for part in np.split(np.arange(len(ask_row)), range(10_000, len(ask_row), 10_000)):
        if len(part):
            windows = [hashlib.md5(bytes([b]) + rows[r, : length - b].tobytes() + rows[r, length : length + b].tobytes()).digest() for r, b in zip(ask_row[part].tolist(), ask_back[part].tolist(), strict=True)]
            yield batch(FOUND, doc_id=doc[ask_row[part]], text_key=key[ask_row[part]], spans=[None] * len(part), window=windows, start=at[ask_row[part]] - ask_back[part])


def _merged(length: int, borders: Broadcast):
    size = 2 * length - gram_length(length) + 2

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = key[0].as_py()
        runs, commons, columns = [], [], ([], [], [])
        for b in batches:
            if k < 0:
                none = [None] * len(b)
                yield batch(FOUND, doc_id=b.column("doc_id"), text_key=b.column("key"), spans=b.column("spans"), window=none, start=none)
                continue
            for common, rest, *ids in zip(*(b.column(c).to_pylist() for c in ("common", "rest", "doc", "text_key", "at")), strict=True):
                common = np.frombuffer(common, "u2")
                rest = pa.decompress(rest, int(size * len(common) - common.sum(dtype=np.int64)), "zstd", asbytes=True)
                runs.append(decode_run(common, rest, size))
                commons.append(common.tolist())
                for column, raw in zip(columns, ids, strict=True):
                    column.append(from_planes(raw, "i8"))
        if k < 0 or not runs:
            return
        order, common = merge_runs(runs, commons, size)
        first = np.cumsum([0] + [len(r) for r in runs])
        place = np.array([first[r] + i for r, i in order])
        rows = np.frombuffer(b"".join([runs[r][i] for r, i in order]), np.uint8).reshape(-1, size)
        del runs
        doc, text_key, at = (np.concatenate(c)[place] for c in columns)
        all_borders = borders.value
        border = lambda i: np.frombuffer(all_borders[i].ljust(size, b"\0"), np.uint8) if 0 <= i < len(all_borders) else None
        beyond = np.maximum(_prefix_with(rows, border(k - 1)), _prefix_with(rows, border(k)))
        yield from _resolve(rows, np.array(common), doc, text_key, at, length, beyond)
        del rows, doc, text_key, at, place, order, common, commons, columns
        give_back()

    return run


def _single_spans(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([FOUND.field("doc_id"), FOUND.field("text_key"), FOUND.field("spans")])
        for b in batches:
            spans = [_spans(np.array([s]), np.array([s + length])) for s in b.column("start").to_pylist()]
            yield batch(schema, doc_id=b.column("doc_id"), text_key=b.column("text_key"), spans=spans)

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, text_key, spans): byte spans of repeated windows, as pairs of 64-bit start and end; spans may overlap."""
    if not 4 <= length <= 250:
        raise ValueError("length must be from 4 to 250 bytes")
    spark = docs.sparkSession
    texts = keyed(docs)
    n_points = (texts.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0) * 2 // (length - gram_length(length) + 2)
    n_buckets = max(partitions(spark), n_points // BUCKET_POINTS)
    sent = texts.select("doc_id", "text").mapInArrow(_points(length, n_buckets), ddl(POINTS))
    n_slices = max(partitions(spark), n_points // SLICE_POINTS)
    shared = sent.groupBy("bucket").applyInArrow(_shared(n_slices), ddl(SHARED))
    shared = hand_off(shared.groupBy("slice").applyInArrow(_gathered, ddl(PLACES)), "suffix-points")
    n_shared = shared.agg(F.sum("n").alias("n")).first().n or 0
    places = shared.select("doc_id", "places")

    sample = shared.select("doc_id").orderBy(F.xxhash64("doc_id")).limit(SAMPLE_DOCS)
    sample = spark.createDataFrame(sample.collect(), "doc_id bigint")  # at most SAMPLE_DOCS ids
    few = texts.join(F.broadcast(places.join(F.broadcast(sample), "doc_id")), "doc_id")
    suffixes = sorted(bytes(r.suffix) for r in few.select("doc_id", "text_key", "text", "places").mapInArrow(_sampled(length), "suffix binary").collect())
    n_ranges = max(partitions(spark), n_shared // RANGE_SUFFIXES)
    borders = sorted({suffixes[len(suffixes) * i // n_ranges] for i in range(1, n_ranges)} if suffixes else set())
    size = 2 * length - gram_length(length) + 2
    borders = spark.sparkContext.broadcast(np.array(borders, f"S{size}"))  # one suffix per range

    with_places = texts.join(places, "doc_id").select("doc_id", "text_key", "text", "places")
    runs = with_places.mapInArrow(_runs(length, borders), ddl(RUNS))
    found = hand_off(runs.groupBy("range").applyInArrow(_merged(length, borders), ddl(FOUND)), "suffix-spans")
    # windows at borders: all but the first of each, over all ranges
    asked = found.filter("window IS NOT NULL").select("doc_id", "text_key", "window", "start")
    first = asked.groupBy("window").agg(F.min(F.struct("doc_id", "start")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    again = asked.join(first.select("window", "first"), "window").filter(F.struct("doc_id", "start") != F.col("first"))
    settled = again.select("doc_id", "text_key", "start").mapInArrow(_single_spans(length), "doc_id bigint, text_key bigint, spans binary")
    return found.filter("spans IS NOT NULL").select("doc_id", "text_key", "spans").unionByName(settled)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = {"text": [], "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
        for text, spans in zip(b.column("text").to_pylist(), b.column("spans").to_pylist(), strict=True):
            raw = (text or "").encode()
            kept, n_spans = raw, 0
            if spans:
                pairs = np.frombuffer(b"".join(spans), np.int64).reshape(-1, 2)
                depth = np.zeros(len(raw) + 1, np.int64)
                np.add.at(depth, pairs[:, 0], 1)
                np.add.at(depth, pairs[:, 1], -1)
                gone = np.cumsum(depth)[:-1] > 0
                n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                text = kept.decode("utf-8", "ignore")
            for name, value in zip(out, (text, len(raw), len(raw) - len(kept), n_spans, hashlib.sha256(kept).hexdigest()), strict=True):
                out[name].append(value)
        arrays = [b.column("row"), pa.array(out["text"], pa.string()), *[pa.array(out[c], pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")], pa.array(out["kept_sha256"], pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, names=["row", *out])
        del out, arrays
        give_back()


def dedup_passages(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(row, text, n_bytes, n_removed, n_spans, kept_sha256) per row of ``docs``; row holds its columns other than text.

    A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a document of smaller doc_id, or
    in the same one before. Strings are taken from the input, and may overlap. text is what is left, without characters
    of which only a part is left; kept_sha256 is the digest of the bytes left, n_spans counts maximal removed runs.

    Null text is empty for the counts and stays null. Rows without a doc_id are not compared and stay whole. Of rows that
    repeat a doc_id neither is earlier at the same place. Texts shorter than ``length`` have no window.
    """
    spans = repeated_spans(docs, length).groupBy("doc_id", "text_key").agg(F.collect_list("spans").alias("spans"))
    spans = spans.select(F.col("doc_id").alias("span_id"), F.col("text_key").alias("span_key"), "spans")
    packed = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("row"), "text", F.xxhash64("text").alias("text_key"))
    joined = packed.join(spans, (F.col("row.doc_id") == F.col("span_id")) & (F.col("text_key") == F.col("span_key")), "left")
    kind = packed.schema["row"].dataType.simpleString()
    return joined.select("row", "text", "spans").mapInArrow(_kept, f"row {kind}, text string, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
