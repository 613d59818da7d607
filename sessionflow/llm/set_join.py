"""Set-similarity join on Spark: rare-first prefixes, length, positional, bitmap and suffix filters, one check per pair.

Units (documents or lines) with equal sets form one class, named by a 64-bit key, so copies never meet as pairs.

1. ``read_units`` reads the texts once: a row per unit, and counts of all tokens in a table of 2^20 hashed counters. The
   table has a fixed size; it ranks every token by how many units hold it, tokens in one counter by their hash.
2. ``shared_postings`` puts the prefix of each class in that order into buckets of tokens. Tokens of one class are
   dropped, tokens of few classes (up to a limit) give pairs at once, and the entries of others are kept as rows. Of a
   token with more entries than the limit a task sends one, marked, to the bucket and the others past the buckets, so a
   frequent token never fills a bucket.
3. For frequent tokens ``pairs_with_leader`` pairs every class with one class of the token only, and ``pairs_between``
   joins two sets of entries on the token. All pairs pass the filters on size, positions and bitmaps.
4. ``alike`` compares sketches of the sets, bitmaps as long as each set asks for, and ``verify`` brings the sets of the
   pairs that pass together and counts their overlap.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sessionflow.llm.frames import batch, from_planes, give_back, hand_off, partitions, planes, rows_of
from sessionflow.llm.words import Sets, mix

SetsOf = Callable[[pa.Array], Iterator[Sets]]

COUNTER_BITS = 20
SEGMENTS = 64
#: Entries a task gathers before it sends them, and entries a bucket gets on average at most.
FLUSH_ENTRIES = 1 << 18
BUCKET_ENTRIES = 200_000
#: Ids and keys of wanted sets that are sent to every executor at most, some 10 MB; more are joined by a shuffle.
BROADCAST_KEYS = 400_000
#: Bytes of pairs with their sets or sketches that a task gets at most, where tasks are made fewer.
TASK_BYTES = 1 << 24
_LOW = np.uint64((1 << 48) - 1)

UNITS = pa.schema(
    [("doc_id", pa.int64()), ("text_key", pa.int64()), ("unit", pa.int64()), ("key", pa.int64()), ("n", pa.int64()),
     ("segment", pa.int32()), ("counts", pa.binary())]
)
#: A bitmap of 256 bits in four columns.
SIGNATURE = ("sig0", "sig1", "sig2", "sig3")
#: One of 1024 bits, for sets as large as those of whole texts.
WIDE_SIGNATURE = tuple(f"sig{i}" for i in range(16))
TYPES = {"token": "u8", "key": "i8", "n": "u4", "pos": "u4", **{c: "i8" for c in SIGNATURE}, "doc": "i8", "many": "u1"}
#: What lean entries lack.
WITHOUT = (*SIGNATURE, "doc")
POSTINGS = pa.schema([(c, pa.int64()) for c in TYPES if c != "many"])


def ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "bigint", pa.int32(): "int", pa.binary(): "binary", pa.string(): "string", pa.bool_(): "boolean", pa.float64(): "double"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


@dataclass(frozen=True)
class Similarity:
    """Jaccard similarity of at least num / den."""

    num: int
    den: int

    @property
    def least_with_others(self) -> int:
        """The least size of a set to which another than an equal one can be similar: one with a token more."""
        return -(-self.num // (self.den - self.num)) if self.num < self.den else 1

    def prefix(self, n: np.ndarray) -> np.ndarray:
        """How many of the rarest tokens must hold one that a similar set has in its own prefix."""
        return n - (self.num * n + self.den - 1) // self.den + 1

    def overlap(self, a, b):
        """The least overlap of similar sets of these sizes."""
        both = self.num + self.den
        return (self.num * (a + b) + both - 1) // both

    def sizes(self, x: str, y: str) -> Column:
        """Length filter on two entries."""
        n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
        return self.den * F.least(n, m) >= self.num * F.greatest(n, m)

    def from_first(self, x: str, y: str) -> Column:
        """Whether two entries can be at the first token that similar sets share: all others lie behind it in both."""
        both = self.num + self.den
        need = F.expr(f"({self.num} * ({x}.n + {y}.n) + {both - 1}) div {both}")
        return F.least(*[F.col(f"{side}.n") - F.col(f"{side}.pos") for side in (x, y)]) >= need

    def allows(self, x: str, y: str, signature: tuple[str, ...] = SIGNATURE) -> Column:
        """Length, positional and bitmap filter on two entries of one token."""
        c = lambda side, name: F.col(f"{side}.{name}")
        total = c(x, "n") + c(y, "n")
        both = self.num + self.den
        need = F.expr(f"({self.num} * ({x}.n + {y}.n) + {both - 1}) div {both}")
        most = F.least(c(x, "pos"), c(y, "pos")) + 1 + F.least(c(x, "n") - c(x, "pos"), c(y, "n") - c(y, "pos"))
        differ = sum((F.bit_count(c(x, s).bitwiseXOR(c(y, s))) for s in signature), F.lit(0))
        return (
            self.sizes(x, y)
            & (most >= need)
            & (differ <= total - 2 * need)
        )


def _signatures(sets: Sets, signature: tuple[str, ...] = SIGNATURE) -> dict[str, np.ndarray]:
    """A bitmap per set in which each token flips a bit; sets that differ in d tokens differ in at most d bits."""
    filled = np.flatnonzero(sets.sizes > 0)
    bits, word = np.uint64(1) << (sets.flat & np.uint64(63)), (sets.flat >> np.uint64(6)) % np.uint64(len(signature))
    out = {}
    for i, c in enumerate(signature):
        column = np.zeros(len(sets.row), np.uint64)
        if len(filled):
            column[filled] = np.bitwise_xor.reduceat(np.where(word == i, bits, np.uint64(0)), sets.starts[filled])
        out[c] = column.view(np.int64)
    return out


def sketches_of(sets: Sets) -> list[bytes]:
    """A bitmap per set in which each token flips a bit, of as many bits as the set has tokens or up to twice as many."""
    bits = np.left_shift(np.int64(1), np.ceil(np.log2(np.maximum(sets.sizes, 64))).astype(np.int64))
    ends = np.cumsum(bits)
    at = np.repeat(ends - bits, sets.sizes) + (sets.flat & np.repeat(bits - 1, sets.sizes).astype(np.uint64)).astype(np.int64)
    flips = np.bincount(at, minlength=int(bits.sum())) & 1
    raw = np.packbits(flips.astype(np.uint8), bitorder="little").tobytes()
    return [raw[(z - n) // 8 : z // 8] for n, z in zip(bits.tolist(), ends.tolist(), strict=True)]


def sketches_differ(x: np.ndarray, y: np.ndarray) -> int:
    """In how many bits two sketches differ; sets differ in as many tokens at least. The longer one is folded."""
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def counted_units(sets_of: SetsOf, signature: tuple[str, ...] = (), sketched: bool = False) -> Callable:
    schema = units_schema(signature, sketched)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNTER_BITS, np.uint32)
        for b in batches:
            ids, text_keys = b.column("doc_id").to_numpy(), b.column("text_key").to_numpy()
            for sets in sets_of(b.column("text")):
                counts += np.bincount((sets.flat >> np.uint64(64 - COUNTER_BITS)).view(np.int64), minlength=len(counts)).astype(np.uint32)
                none = [None] * len(sets.row)
                bits = _signatures(sets, signature) | ({"sketch": sketches_of(sets)} if sketched else {})
                yield batch(schema, doc_id=ids[sets.row], text_key=text_keys[sets.row], unit=sets.unit, key=sets.keys(), n=sets.sizes, segment=none, counts=none, **bits)
        if counts.any():
            none = [None] * SEGMENTS
            parts = [zlib.compress(p.tobytes(), 1) for p in np.split(counts, SEGMENTS)]
            empty = dict.fromkeys(set(schema.names) - {"segment", "counts"}, none)
            yield batch(schema, segment=range(SEGMENTS), counts=parts, **empty)

    return run


def units_schema(signature: tuple[str, ...] = (), sketched: bool = False) -> pa.Schema:
    return pa.schema([*UNITS, *[pa.field(c, pa.int64()) for c in signature], *([pa.field("sketch", pa.binary())] if sketched else [])])


def _sum_counts(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((1 << COUNTER_BITS) // SEGMENTS, np.uint64)
    for b in batches:
        for part in b.column("counts"):
            total += np.frombuffer(zlib.decompress(part.as_buffer()), np.uint32)
    yield pa.RecordBatch.from_pydict({"segment": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, text_key) of the rows with an id; the text's hash tells apart rows that share an id."""
    return docs.filter("doc_id IS NOT NULL").select("doc_id", "text", F.xxhash64("text").alias("text_key"))


def read_units(docs: DataFrame, sets_of: SetsOf, name: str, signature: tuple[str, ...] = (), sketched: bool = False) -> tuple[DataFrame, np.ndarray, int]:
    """(doc_id, text_key, unit, key, n, the bitmap and sketch asked for) per unit, the rank of each counter by rarity, and the
    number of tokens."""
    rows = hand_off(docs.mapInArrow(counted_units(sets_of, signature, sketched), ddl(units_schema(signature, sketched))), f"{name}-units")
    summed = rows.filter("segment IS NOT NULL").select("segment", "counts").groupBy("segment").applyInArrow(_sum_counts, "segment int, counts binary")
    counts = np.zeros((SEGMENTS, (1 << COUNTER_BITS) // SEGMENTS), np.uint64)
    for segment, part in summed.collect():  # 2^20 numbers whatever the input
        counts[segment] = np.frombuffer(part, np.uint64)
    counts = counts.reshape(-1)
    ranks = np.minimum(np.log2(counts + 1.0) * 1024, 65535).astype(np.uint16)
    return rows.filter("segment IS NULL").drop("segment", "counts"), ranks, int(counts.sum())


def _prefixes(sets: Sets, ids: np.ndarray, ranks: np.ndarray, similarity: Similarity, lean: bool) -> dict[str, np.ndarray]:
    """Entries of the prefixes, each class once. The top 16 bits of a token are its rank, the others its hash."""
    keys = sets.keys()
    by_doc = np.argsort(ids[sets.row], kind="stable")
    _, first = np.unique(keys[by_doc], return_index=True)
    first = by_doc[first]  # of the smallest doc_id
    first = first[sets.sizes[first] > 0]
    tokens = (ranks[sets.flat >> np.uint64(64 - COUNTER_BITS)].astype(np.uint64) << np.uint64(48)) | (sets.flat & _LOW)
    starts, sizes = sets.starts[first], sets.sizes[first]
    for a, n in zip(starts.tolist(), sizes.tolist(), strict=True):
        tokens[a : a + n].sort()
    taken = similarity.prefix(sizes)
    pos = np.arange(taken.sum()) - np.repeat(np.cumsum(taken) - taken, taken)
    rep = lambda values: np.repeat(values, taken)
    return {
        "token": tokens[rep(starts) + pos],
        "key": rep(keys[first]),
        "n": rep(sizes).astype(np.uint32),
        "pos": pos.astype(np.uint32),
        **({} if lean else {c: rep(v[first]) for c, v in _signatures(sets).items()} | {"doc": rep(ids[sets.row[first]])}),
    }


def _join(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}


def _by_token(entries: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Entries by token with each class once, in its smallest doc_id, the first entry of each token, and the number of each
    token's entries."""
    order = np.lexsort([entries[c] for c in ("doc", "key", "token") if c in entries])
    entries = {c: v[order] for c, v in entries.items()}
    token, key = entries["token"], entries["key"]
    keep = np.ones(len(token), bool)
    keep[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
    if "many" in entries:  # the mark of any copy counts
        at = np.cumsum(keep) - 1
        marks = np.zeros(at[-1] + 1, np.uint8)
        np.maximum.at(marks, at, entries["many"])
    entries = {c: v[keep] for c, v in entries.items()}
    if "many" in entries:
        entries["many"] = marks
    token = entries["token"]
    first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    return entries, first, np.diff(np.append(first, len(token)))


def packed_schema(lean: bool) -> pa.Schema:
    return pa.schema([("bucket", pa.int64()), *[(c, pa.binary()) for c in TYPES if not (lean and c in WITHOUT)]])


def _packed(bucket: int, entries: dict[str, np.ndarray]) -> pa.RecordBatch:
    return batch(packed_schema("doc" not in entries), bucket=[bucket], **{c: [planes(v, TYPES[c])] for c, v in entries.items()})


def bucket_of(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    """The bucket of each hash, all equally full even where only small hashes come, as least ones or those of prefixes are."""
    return ((mix(hashes) >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)


def group_apart(ids: np.ndarray, n_buckets: int) -> int:
    """One of as many groups as there are buckets, numbered from -1 down, for what passes the buckets.

    It depends on all ids that are sent: a frequent token, which many tasks send, doesn't bring them to one group.
    """
    return -1 - int(mix(ids.view(np.uint64)).sum(dtype=np.uint64) % np.uint64(n_buckets))


def _pack(parts: list[dict[str, np.ndarray]], n_buckets: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Entries by bucket; of a token with more than ``limit`` of them the first alone, marked, and the others apart."""
    entries, first, count = _by_token(_join(parts))
    many = count > limit
    entries["many"] = np.zeros(len(entries["token"]), np.uint8)
    known = {c: v[np.repeat(many, count)] for c, v in entries.items()}
    if len(known["token"]):
        yield _packed(group_apart(known["key"] + known["pos"], n_buckets), known)
    entries["many"][first] = many
    stay = ~np.repeat(many, count)
    stay[first] = True
    heads = {c: v[stay] for c, v in entries.items()}
    bucket = bucket_of(heads["token"] & _LOW, n_buckets)
    order = np.argsort(bucket, kind="stable")
    heads, bucket = {c: v[order] for c, v in heads.items()}, bucket[order]
    for part in np.split(np.arange(len(bucket)), np.flatnonzero(np.diff(bucket)) + 1):
        yield _packed(int(bucket[part[0]]), {c: v[part] for c, v in heads.items()})


def _sent(sets_of: SetsOf, ranks: Broadcast, similarity: Similarity, n_buckets: int, lean: bool, limit: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for b in batches:
            ids = b.column("doc_id").to_numpy()
            for sets in sets_of(b.column("text")):
                entries = _prefixes(sets, ids, ranks.value, similarity, lean)
                if len(entries["token"]):
                    parts.append(entries)
                    held += len(entries["token"])
                if held >= FLUSH_ENTRIES:
                    yield from _pack(parts, n_buckets, limit)
                    parts, held = [], 0
        if parts:
            yield from _pack(parts, n_buckets, limit)
        del parts
        give_back()

    return run


def _postings(entries: dict[str, np.ndarray]) -> pa.RecordBatch:
    zero = np.zeros(0 if "doc" in entries else len(entries["token"]), np.int64)
    column = lambda v: v.view(np.int64) if v.dtype == np.uint64 else v.astype(np.int64)
    return batch(POSTINGS, **{c: column(entries.get(c, zero)) for c in POSTINGS.names})


def _met(entries: dict[str, np.ndarray], count: np.ndarray, similarity: Similarity) -> np.ndarray:
    """Distinct pairs of classes that share a token here and pass the length, positional and bitmap filters: rows of the
    class whose smallest doc_id is smaller, the other class, and that doc_id; of one doc_id, both orders.

    ``count``: entries of each token, which follow each other. One step per distance between two entries of a token.
    """
    n, pos, key, doc = entries["n"].astype(np.int64), entries["pos"].astype(np.int64), entries["key"], entries["doc"]
    left = np.repeat(np.cumsum(count), count) - np.arange(len(key)) - 1  # entries of the token after this one
    x, step, found = np.flatnonzero(left > 0), 1, []
    while len(x):
        y = x + step
        need = similarity.overlap(n[x], n[y])
        ok = similarity.den * np.minimum(n[x], n[y]) >= similarity.num * np.maximum(n[x], n[y])
        ok &= np.minimum(pos[x], pos[y]) + 1 + np.minimum(n[x] - pos[x], n[y] - pos[y]) >= need
        met, other, most = x[ok], y[ok], (n[x] + n[y] - 2 * need)[ok]
        differ = sum(np.bitwise_count((entries[c][met] ^ entries[c][other]).view(np.uint64)).astype(np.int64) for c in SIGNATURE)
        met, other = met[differ <= most], other[differ <= most]
        both = doc[other] == doc[met]
        swap = doc[other] < doc[met]
        met, other, again = np.where(swap, other, met), np.where(swap, met, other), (other[both], met[both])
        met, other = np.concatenate([met, again[0]]), np.concatenate([other, again[1]])
        found.append(np.stack([key[met], key[other], doc[met]], axis=1))
        step += 1
        x = x[left[x] >= step]
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)


def _shared(similarity: Similarity, limit: int, lean: bool) -> Callable:
    kinds = {c: TYPES[c] for c in packed_schema(lean).names[1:]}

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for b in batches:
            for raw in rows_of(b, *kinds):
                entries = {c: from_planes(x, kinds[c]) for c, x in zip(kinds, raw, strict=True)}
                if key[0].as_py() < 0:
                    yield _postings(entries)
                else:
                    parts.append(entries)
        if not parts:
            return
        entries, first, count = _by_token(_join(parts))
        marked = np.maximum.reduceat(entries["many"], first) > 0
        frequent = marked | (count > limit)
        keep = np.repeat(frequent, count) & (entries["many"] == 0)
        yield _postings({c: v[keep] for c, v in entries.items()})
        few = ~frequent & (count > 1)
        some = {c: v[np.repeat(few, count)] for c, v in entries.items()}
        zero = np.zeros(len(some["token"]), np.int64)
        pairs = _met(dict.fromkeys(WITHOUT, zero) | some, count[few], similarity)
        none = np.zeros(len(pairs), np.int64)
        del entries, parts, some
        give_back()
        yield batch(POSTINGS, token=pairs[:, 0], key=pairs[:, 1], n=none, pos=none - 1, doc=pairs[:, 2], **{c: none for c in SIGNATURE})

    return run


def shared_postings(docs: DataFrame, sets_of: SetsOf, ranks: np.ndarray, n_tokens: int, similarity: Similarity, name: str, lean: bool, limit: int) -> tuple[DataFrame, DataFrame]:
    """(token, key, n, pos, bitmap, doc): prefix entries whose token more than ``limit`` classes have; and (a, b, doc):
    the pairs of classes that may be similar by a token of fewer, a having the smaller smallest doc_id; where both have the
    same, the pair is there in both orders. ``lean``: entries without bitmap and doc, and pairs in any order. A class may
    have several entries of one token, with the smallest doc_id that a task has seen."""
    spark = docs.sparkSession
    share = 1 - similarity.num / similarity.den
    n_buckets = max(partitions(spark), int(n_tokens * share) // BUCKET_ENTRIES)
    sent = docs.mapInArrow(_sent(sets_of, spark.sparkContext.broadcast(ranks), similarity, n_buckets, lean, limit), ddl(packed_schema(lean)))
    found = hand_off(sent.groupBy("bucket").applyInArrow(_shared(similarity, limit, lean), ddl(POSTINGS)), f"{name}-postings")
    return found.filter("pos >= 0"), found.filter("pos < 0").select(F.col("token").alias("a"), F.col("key").alias("b"), "doc")


def once_each(postings: DataFrame) -> DataFrame:
    """The postings with each class once per token, in its smallest doc_id: copies of a class come from many tasks."""
    return postings.groupBy("token", "key", "n", "pos", *SIGNATURE).agg(F.min("doc").alias("doc"))


def ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def pairs_with_leader(postings: DataFrame, similarity: Similarity) -> DataFrame:
    """Distinct (a, b): every class with the first class of each of its tokens."""
    leader = postings.groupBy("token").agg(F.min(F.struct("doc", "key", "n", "pos", *SIGNATURE)).alias("l")).select("token", "l.*")
    x, y = postings.alias("x"), leader.alias("y")
    met = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.key") != F.col("y.key")) & similarity.allows("x", "y"))
    return met.select(*ordered(F.col("x.key"), F.col("y.key"))).distinct()


def pairs_between(left: DataFrame, right: DataFrame, similarity: Similarity, also: Column, signature: tuple[str, ...] = SIGNATURE) -> DataFrame:
    """Distinct (a, b): classes of ``left`` and ``right`` that share a token, where ``also`` holds for entries x and y."""
    x, y = left.alias("x"), right.alias("y")
    met = x.join(y, (F.col("x.token") == F.col("y.token")) & also & similarity.allows("x", "y", signature))
    return met.select(*ordered(F.col("x.key"), F.col("y.key"))).distinct()


SETS = pa.schema([("key", pa.int64()), ("tokens", pa.binary())])


def _wanted_sets(sets_of: SetsOf) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            wanted = b.column("wanted")
            bounds = np.append(wanted.offsets.to_numpy(), 0)[: len(wanted) + 1]
            flat = wanted.values.to_numpy()
            for sets in sets_of(b.column("text")):
                keys = sets.keys()
                found = np.zeros(len(keys), bool)
                for row in np.unique(sets.row):
                    a, z = np.searchsorted(sets.row, row, "left"), np.searchsorted(sets.row, row, "right")
                    found[a:z] = np.isin(keys[a:z], flat[bounds[row] : bounds[row + 1]])
                at = np.flatnonzero(found)
                _, once = np.unique(np.stack([sets.row[at], keys[at]]), axis=1, return_index=True)
                at = at[once]
                if len(at):
                    yield batch(SETS, key=keys[at], tokens=[sets.flat[sets.starts[i] : sets.starts[i + 1]].tobytes() for i in at])

    return run


def suffix_allows(x: np.ndarray, y: np.ndarray, need: int, depth: int = 3) -> bool:
    """Suffix filter: halves one set at its middle token and the other at the same place; the parts bound the overlap."""

    def most(x: np.ndarray, y: np.ndarray, depth: int) -> int:
        if not depth or len(x) < 16 or len(y) < 16:
            return min(len(x), len(y))
        middle = len(x) // 2
        at = int(np.searchsorted(y, x[middle]))
        return most(x[:middle], y[:at], depth - 1) + most(x[middle:], y[at:], depth - 1)

    return most(x, y, depth) >= need


def _overlaps(similarity: Similarity) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("x"), b.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                need = similarity.overlap(len(x), len(y))
                ok = suffix_allows(x, y, need)
                if ok:
                    at = np.searchsorted(y, x)
                    ok = int((y[np.minimum(at, len(y) - 1)] == x).sum()) >= need
                keep.append(ok)
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def first_places(units: DataFrame) -> DataFrame:
    """(key, doc_id, unit, n): the first place of each class, and its size."""
    first = F.min(F.struct("doc_id", "unit")).alias("first")
    return units.filter("n > 0").groupBy("key").agg(first, F.max("n").alias("n")).select("key", "first.*", "n")


def tallied(rows: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """The rows, and their number once they were written."""
    seen = Observation()
    return rows.observe(seen, F.count(F.lit(1)).alias("n")), lambda: seen.get["n"]


def in_few_tasks(rows: DataFrame, n_rows: int, most_bytes: int) -> DataFrame:
    """The rows, of which none has more bytes, in no more tasks than cores unless those got over ``TASK_BYTES``: a few
    pairs lie scattered over all partitions of a shuffle, and each would start a Python worker for some."""
    return rows.coalesce(max(rows.sparkSession.sparkContext.defaultParallelism, -(-n_rows * most_bytes // TASK_BYTES)))


def _alike(similarity: Similarity) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, m = (b.column(c).to_numpy() for c in ("n", "m"))
            most = n + m - 2 * similarity.overlap(n, m)
            keep = similarity.den * np.minimum(n, m) >= similarity.num * np.maximum(n, m)
            for i in np.flatnonzero(keep).tolist():
                x, y = (np.frombuffer(b.column(c)[i].as_buffer(), np.uint8) for c in ("x", "y"))
                keep[i] = sketches_differ(x, y) <= most[i]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def alike(pairs: DataFrame, n_pairs: int, sketches: DataFrame, largest: int, similarity: Similarity) -> DataFrame:
    """The pairs (a, b) that may be similar by the ``sketches`` (key, n, sketch), which are far smaller than the sets.
    ``largest``: the greatest n."""
    with_b = pairs.join(sketches.select(F.col("key").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("y")), "b")
    both = with_b.join(sketches.select(F.col("key").alias("a"), "n", F.col("sketch").alias("x")), "a")
    both = in_few_tasks(both.select("a", "b", "n", "m", "x", "y"), n_pairs, 32 + 2 * max(8, largest // 4))
    return both.mapInArrow(_alike(similarity), "a bigint, b bigint")


def verify(pairs: DataFrame, units: DataFrame, docs: DataFrame, sets_of: SetsOf, similarity: Similarity, name: str) -> DataFrame:
    """The pairs (a, b) whose sets are similar, each checked once on the whole sets."""
    pairs, n_pairs = tallied(pairs)
    pairs = hand_off(pairs, f"{name}-pairs")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    places = first_places(units.join(needed, "key", "left_semi"))
    wanted = hand_off(places.groupBy("doc_id").agg(F.collect_list("key").alias("wanted"), F.max("n").alias("n")), f"{name}-wanted")
    size = wanted.agg(F.count("*").alias("n"), F.sum(F.size("wanted")).alias("keys"), F.max("n").alias("largest")).first()
    wanted = wanted.drop("n")
    if size.n + (size.keys or 0) <= BROADCAST_KEYS:  # few enough for every executor: the texts stay where they are
        wanted = F.broadcast(wanted)
    sets = docs.select("doc_id", "text").join(wanted, "doc_id").select("text", "wanted").mapInArrow(_wanted_sets(sets_of), ddl(SETS))
    sets = hand_off(sets, f"{name}-sets")
    with_b = pairs.join(sets.select(F.col("key").alias("b"), F.col("tokens").alias("y")), "b")
    both = with_b.join(sets.select(F.col("key").alias("a"), F.col("tokens").alias("x")), "a")
    both = in_few_tasks(both.select("a", "b", "x", "y"), n_pairs(), 16 + 16 * (size.largest or 0))
    return hand_off(both.mapInArrow(_overlaps(similarity), "a bigint, b bigint").distinct(), f"{name}-links")
