"""Line dedup: removes lines whose words are nearly those of an earlier line, by an exact set-similarity join."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionflow.llm.frames import give_back, hand_off
from sessionflow.llm.set_join import Similarity, first_places, keyed, once_each, ordered, pairs_between, pairs_with_leader, read_units, shared_postings, verify
from sessionflow.llm.words import Sets, line_sets

#: Jaccard similarity of the lines' distinct words that makes the later one go.
SIMILARITY = Similarity(9, 10)
#: Distinct words a line needs to be compared at all: every line with a word is.
MIN_WORDS = 1
#: Lines of a token that are compared with each other at once; tokens of more lines are frequent.
FREQUENT = 128


def _lines(min_words: int):
    def sets_of(column: pa.Array) -> Iterator[Sets]:
        for sets in line_sets(column):
            keep = sets.sizes >= min_words
            sizes = sets.sizes[keep]
            flat = sets.flat[np.repeat(keep, sets.sizes)]
            yield Sets(sets.row[keep], sets.unit[keep], flat, np.concatenate([[0], np.cumsum(sizes)]))

    return sets_of


def _later(links: DataFrame, places: DataFrame) -> DataFrame:
    """(key) of the classes that begin after a class linked with them."""
    side = lambda c: places.select(F.col("key").alias(c), F.struct("doc_id", "unit").alias(f"at_{c}"))
    both = links.join(side("a"), "a").join(side("b"), "b").filter("at_a != at_b")
    return both.select(F.when(F.col("at_a") > F.col("at_b"), F.col("a")).otherwise(F.col("b")).alias("key")).distinct()


def repeated_lines(docs: DataFrame, similarity: Similarity = SIMILARITY, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_key, unit): the lines of ``docs`` (doc_id, text) that go, unit being the line's number in its text.

    A line goes if an earlier line, by doc_id and number, has the same set of words or a similar one. All lines of the
    input count as earlier lines, those that go as well. Lines of equal sets are one class. A class meets one
    earlier class first, for each of its frequent tokens and by the others; only where this leaves it in place it meets
    all others that may be similar and begin in an earlier document or the same. Sets so small that only equal ones are similar to them meet no other class.
    """
    texts, sets_of = keyed(docs), _lines(min_words)
    units, ranks, n_tokens = read_units(texts, sets_of, "lines")
    meeting = _lines(max(min_words, similarity.least_with_others))
    postings, met = shared_postings(texts, meeting, ranks, n_tokens, similarity, "lines", lean=False, limit=FREQUENT)
    postings = hand_off(once_each(postings), "lines-entries")
    places = hand_off(first_places(units).drop("n"), "lines-places")
    # of the pairs found in buckets one for each later class at first
    first = met.groupBy("b").agg(F.min_by("a", F.struct("doc", "a")).alias("a")).select(*ordered(F.col("a"), F.col("b")))
    tried = hand_off(first.unionByName(pairs_with_leader(postings, similarity)).distinct(), "lines-tried")
    gone = hand_off(_later(verify(tried, units, texts, sets_of, similarity, "lines"), places), "lines-gone")
    earlier = (F.col("x.key") != F.col("y.key")) & (F.col("y.doc") <= F.col("x.doc"))
    rest = pairs_between(postings.join(gone, "key", "left_anti"), postings, similarity, earlier)
    # and of those in buckets the pairs whose later class is still in place
    still = met.join(gone.withColumnRenamed("key", "b"), "b", "left_anti")
    rest = rest.unionByName(still.select(*ordered(F.col("a"), F.col("b"))))
    rest = rest.distinct().join(tried, ["a", "b"], "left_anti")
    gone = gone.unionByName(_later(verify(rest, units, texts, sets_of, similarity, "lines-rest"), places)).distinct()
    classes = places.select("key", F.col("doc_id").alias("first_doc"), F.col("unit").alias("first_unit"))
    classes = classes.join(gone.withColumn("gone", F.lit(True)), "key", "left")
    later = F.col("gone").isNotNull() | (F.col("doc_id") != F.col("first_doc")) | (F.col("unit") != F.col("first_unit"))
    return units.join(classes, "key").filter(later).select("doc_id", "text_key", "unit")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts, lines, removed = [], [], []
        for text, drop in zip(b.column("text").to_pylist(), b.column("drop").to_pylist(), strict=True):
            parts = text.split("\n") if text else []
            going = set(drop or ())
            lines.append(len(parts))
            removed.append(len(going))
            texts.append("\n".join(p for i, p in enumerate(parts) if i not in going) if going else text)
        columns = [b.column("row"), pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(removed, pa.int64())]
        digests = [hashlib.sha256((t or "").encode()).hexdigest() for t in texts]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(digests)], names=["row", "text", "n_lines", "n_removed", "sha256"])
        del texts, columns, digests
        give_back()


def dedup_lines(docs: DataFrame, similarity: Similarity = SIMILARITY, min_words: int = MIN_WORDS) -> DataFrame:
    """(row, text, n_lines, n_removed, sha256) per row of ``docs``; row holds its columns other than text.

    text is what is left, lines joined by line feeds again; sha256 is its digest in UTF-8. Null text stays null, with no
    lines, as does empty text. Lines with fewer than ``min_words`` distinct words stay. Rows without a doc_id are not
    compared and stay whole. Rows that repeat a doc_id are places of one rank: neither is earlier than the other.
    """
    drop = repeated_lines(docs, similarity, min_words).groupBy("doc_id", "text_key").agg(F.collect_set("unit").alias("drop"))
    drop = drop.select(F.col("doc_id").alias("drop_id"), F.col("text_key").alias("drop_key"), "drop")
    packed = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("row"), "text", F.xxhash64("text").alias("text_key"))
    joined = packed.join(drop, (F.col("row.doc_id") == F.col("drop_id")) & (F.col("text_key") == F.col("drop_key")), "left")
    kind = packed.schema["row"].dataType.simpleString()
    return joined.select("row", "text", "drop").mapInArrow(_cut, f"row {kind}, text string, n_lines bigint, n_removed bigint, sha256 string")
