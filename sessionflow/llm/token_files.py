"""Token-id files: every id in the fewest bits the vocabulary needs, in blocks that are read alone.

Layout, little-endian: ``TIDS``, version, bits per id, ids per block (4 x uint32); then the blocks, each padded to whole
bytes; then the index: the byte offset of every block (uint64), and per document its id (int64), whether it has one
(uint8) and where its ids begin (uint64, one more at the end); then the numbers of blocks and documents (2 x uint64).
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sessionflow.llm.frames import batch, hand_off, new_folder, partitions
from sessionflow.llm.set_join import ddl
from sessionflow.llm.tokens import library_encoder, vocabulary_size

MAGIC, VERSION, BLOCK_IDS = b"TIDS", 1, 1 << 16
#: Bytes of text per file on average.
FILE_BYTES = 64 << 20


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` one after another in ``bits`` bits each, lowest bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = (ids[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(spread.astype(np.uint8).reshape(-1), bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return (flat.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


class Writer:
    """Appends documents to one file; holds one block."""

    def __init__(self, out, bits: int, block_ids: int = BLOCK_IDS):
        self.out, self.bits, self.block_ids = out, bits, block_ids
        self.at = out.write(MAGIC + np.array([VERSION, bits, block_ids], "<u4").tobytes()) or 16
        self.blocks, self.docs, self.has_id, self.starts, self.held, self.n_held = [], [], [], [0], [], 0

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        raw = pack(ids[:n], self.bits)
        self.out.write(raw)
        self.blocks.append(self.at)
        self.at += len(raw)
        self.held, self.n_held = [ids[n:]], len(ids) - n

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id or 0)
        self.has_id.append(doc_id is not None)
        self.starts.append(self.starts[-1] + len(ids))
        self.held.append(ids)
        self.n_held += len(ids)
        while self.n_held >= self.block_ids:
            self._flush(self.block_ids)

    def close(self) -> None:
        if self.n_held:
            self._flush(self.n_held)
        for values, kind in ((self.blocks, "<u8"), (self.docs, "<i8"), (self.has_id, "u1"), (self.starts, "<u8"), ([len(self.blocks), len(self.docs)], "<u8")):
            self.out.write(np.array(values, kind).tobytes())


class Reader:
    """Reads the index of a file, then any document's ids or all of them, block by block."""

    def __init__(self, source):
        self.source = source
        head = source.read_at(16, 0)
        if head[:4] != MAGIC:
            raise ValueError("not a token-id file")
        _, self.bits, self.block_ids = np.frombuffer(head, "<u4", 3, 4).tolist()
        size = source.size()
        n_blocks, n_docs = np.frombuffer(source.read_at(16, size - 16), "<u8").tolist()
        index = source.read_at(size, at := size - 16 - 8 * (n_docs + 1) - 9 * n_docs - 8 * n_blocks)
        self.blocks = np.append(np.frombuffer(index, "<u8", n_blocks), at).astype(np.int64)
        self.docs = np.frombuffer(index, "<i8", n_docs, 8 * n_blocks)
        self.has_id = np.frombuffer(index, "u1", n_docs, 8 * (n_blocks + n_docs)).astype(bool)
        self.starts = np.frombuffer(index, "<u8", n_docs + 1, 8 * (n_blocks + n_docs) + n_docs).astype(np.int64)
        self.kept = (-1, None)

    def _block(self, k: int) -> np.ndarray:
        if self.kept[0] != k:
            raw = self.source.read_at(int(self.blocks[k + 1] - self.blocks[k]), int(self.blocks[k]))
            n = min(self.block_ids, int(self.starts[-1]) - k * self.block_ids)
            self.kept = (k, unpack(raw, n, self.bits))
        return self.kept[1]

    def ids(self, i: int) -> np.ndarray:
        """The ids of the i-th document; reads the blocks that hold it."""
        a, b = int(self.starts[i]), int(self.starts[i + 1])
        parts = []
        while a < b:
            k, at = divmod(a, self.block_ids)
            part = self._block(k)[at : at + b - a]
            parts.append(part)
            a += len(part)
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


ENCODED = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("ids", pa.binary())])
WRITTEN = pa.schema([("part", pa.int64()), ("path", pa.string()), ("n_ids", pa.int64())])
READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _encode(path: str, end_id: int, bits: int, cuts: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = library_encoder(path), np.array([end_id], np.uint32)
        for b in batches:
            # the place of doc_id among the cuts; rows without one belong to the first part
            part = np.where(b.column("doc_id").is_valid(), np.searchsorted(cuts.value, b.column("doc_id").fill_null(0)), 0)
            ids = [pack(np.concatenate([x, end]), 16 if bits <= 16 else 32) for x in encoder.rows(b.column("text"))]
            yield batch(ENCODED, part=part, doc_id=b.column("doc_id"), ids=ids)

    return run


def _write(folder: str, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, base = fs.FileSystem.from_uri(folder)
        width, part, writer, out, path = 16 if bits <= 16 else 32, None, None, None, ""

        def finish():
            writer.close()
            out.close()
            return batch(WRITTEN, part=[part], path=[path], n_ids=[writer.starts[-1]])

        for b in batches:
            for p, doc_id, ids in zip(b.column("part").to_pylist(), b.column("doc_id").to_pylist(), b.column("ids"), strict=True):
                if p != part:
                    if writer:
                        yield finish()
                    part, path = p, f"{base}/{p:06d}-{uuid.uuid4().hex}.tids"
                    out = where.open_output_stream(path)
                    writer = Writer(out, bits)
                writer.add(doc_id, np.frombuffer(ids.as_buffer(), f"<u{width // 8}").astype(np.uint32))
        if writer:
            yield finish()

    return run


def write_token_files(docs: DataFrame, path: str, end_id: int = 0, folder: str | None = None) -> tuple[str, DataFrame]:
    """Encodes ``docs`` (doc_id, text) with the vocabulary file ``path``, ends each document with ``end_id`` and writes
    files of rising doc_id to the shared folder. Returns the folder and (part, path, n_ids) of the written files.

    Null text is empty and gives the end id alone. Rows without a doc_id come first; rows of one doc_id stand in the
    order of their text's hash. A task that is run again writes a new file; only files in the returned table count.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-files")
    uri = folder if "://" in folder else f"file://{folder}"
    where, base = fs.FileSystem.from_uri(uri)
    where.create_dir(base, recursive=True)
    bits = (vocabulary_size(path) - 1).bit_length()
    size = docs.agg(F.sum(F.octet_length("text")).alias("s")).first().s or 0
    n = max(partitions(spark), -(-size // FILE_BYTES))
    steps = [i / n for i in range(1, n)] or [0.5]
    cuts = docs.agg(F.percentile_approx("doc_id", steps, 100 * n).alias("c")).first().c or []
    cuts = spark.sparkContext.broadcast(np.array(sorted(set(cuts)), np.int64))  # one number per file
    encoded = docs.select("doc_id", "text").mapInArrow(_encode(path, end_id, bits, cuts), ddl(ENCODED)).withColumn("order", F.xxhash64("ids"))
    dealt = encoded.repartitionById(len(cuts.value) + 1, F.col("part"))
    ordered = dealt.sortWithinPartitions("part", F.asc_nulls_first("doc_id"), "order").select("part", "doc_id", "ids")
    return folder, hand_off(ordered.mapInArrow(_write(uri, bits), ddl(WRITTEN)), "token-index")


def _read(uri: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, _ = fs.FileSystem.from_uri(uri)
        for b in batches:
            for path, base in zip(b.column("path").to_pylist(), b.column("base").to_pylist(), strict=True):
                with where.open_input_file(path) as source:
                    reader = Reader(source)
                    for first in range(0, len(reader.docs), 8192):
                        rows = range(first, min(first + 8192, len(reader.docs)))
                        crcs = [zlib.crc32(reader.ids(i).astype("<u4").tobytes()) for i in rows]
                        at = slice(rows.start, rows.stop)
                        ids = pa.array(reader.docs[at], pa.int64(), mask=~reader.has_id[at])
                        yield batch(READ, doc_id=ids, start=reader.starts[:-1][at] + base, n_tokens=np.diff(reader.starts)[at], ids_crc32=crcs)

    return run


def read_token_files(folder: str, written: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files; start counts the ids of all before it."""
    uri = folder if "://" in folder else f"file://{folder}"
    # one row per file: the running total is over files, not documents
    before = F.sum("n_ids").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("n_ids")
    files = written.select("part", "path", before.alias("base"))
    n = partitions(written.sparkSession)
    return files.repartitionById(n, F.pmod("part", F.lit(n)).cast("int")).select("path", "base").mapInArrow(_read(uri), ddl(READ))
