"""N-gram Jaccard join: near-duplicate documents by the distinct five-word shingles they share."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sessionflow.llm.components import stars
from sessionflow.llm.frames import hand_off
from sessionflow.llm.set_join import SIGNATURE, UNITS, WIDE_SIGNATURE, Similarity, alike, counted_units, ddl, keyed, ordered, pairs_between, pairs_with_leader, read_units, shared_postings, tallied, verify
from sessionflow.llm.words import shingle_sets

#: 100 * intersection >= 75 * union
SIMILARITY = Similarity(3, 4)
#: Members of a component that meet all others at a token, and how often new ones do at most.
HUBS, HUB_ROUNDS = 4, 2
#: Pairs between components for each entry from which on they do, of all tokens and of the token.
PAIRS_PER_ENTRY = 8


def near_duplicates(docs: DataFrame, similarity: Similarity = SIMILARITY) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs`` (doc_id, text): the documents linked by similar sets.

    Equal sets are one class. First every class meets one leader for each shingle of its prefix; what that links forms
    components. Where many pairs are left between components, a few members of a shingle's largest component meet the
    others, once more if that halves the pairs. Then classes of different components that share a prefix shingle meet, so no link between components is
    lost, and a large group of near copies costs a few pairs per member and not all pairs. Every pair is checked once,
    by its sets if sketches of them leave it possible.

    Null, empty or wordless text: n_shingles 0, linked with nothing. Rows without a doc_id keep their row, with
    component_id null, and link with nothing. Repeated rows are copies. Other columns are ignored.
    """
    return _named(docs, similarity).drop("text_key").unionByName(_without_id(docs))


def _named(docs: DataFrame, similarity: Similarity) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id) of the rows with an id; the key tells apart texts of one id."""
    texts = keyed(docs)
    units, ranks, n_tokens = read_units(texts, shingle_sets, "ngram", WIDE_SIGNATURE, sketched=True)
    postings, _ = shared_postings(texts, shingle_sets, ranks, n_tokens, similarity, "ngram", lean=True, limit=1)
    entries = hand_off(merged(postings), "ngram-entries")
    seen = Observation()
    sketches = units.filter("n > 0").select("key", "n", "sketch").dropDuplicates(["key"])
    sketches = hand_off(sketches.observe(seen, F.max("n").alias("largest")), "ngram-sketches")
    largest = seen.get["largest"] or 0
    similar = lambda pairs, n, name: verify(alike(pairs, n, sketches, largest, similarity), units, texts, shingle_sets, similarity, name)
    met, n_met = tallied(pairs_with_leader(entries, similarity))
    tried = hand_off(met, "ngram-tried")
    roots = _linked(similar(tried, n_met(), "ngram"), None)

    placed, before = hand_off(_open(entries, roots), "ngram-open"), None
    for seed in range(HUB_ROUNDS):
        crowded, n_entries, left = _crowded(placed)
        if left <= PAIRS_PER_ENTRY * n_entries or before is not None and 2 * left > before:
            break
        met = pairs_with_hubs(placed.join(crowded, "token", "left_semi"), similarity, seed)
        met, n_met = tallied(met.join(tried, ["a", "b"], "left_anti"))
        new = hand_off(met, "ngram-hubs")
        roots = _linked(similar(new, n_met(), "ngram-hub"), roots)
        tried = tried.unionByName(new)
        placed, before = hand_off(_open(placed, roots), "ngram-open"), left

    # the entries were sent without bitmaps; what is left gets wide ones, or a group's members meet those near it in vain
    bitmaps = units.filter("n > 0").select("key", *WIDE_SIGNATURE).dropDuplicates(["key"])
    placed = hand_off(placed.join(bitmaps, "key"), "ngram-open")
    apart = (F.col("x.root") < F.col("y.root")) & similarity.from_first("x", "y")
    met, n_met = tallied(pairs_between(placed, placed, similarity, apart, WIDE_SIGNATURE).join(tried, ["a", "b"], "left_anti"))
    rest = hand_off(met, "ngram-rest")
    roots = _linked(similar(rest, n_met(), "ngram-rest"), roots)

    classes = units.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("n").alias("n")).join(roots, "key", "left")
    classes = classes.withColumn("root", F.coalesce("root", "key"))
    named = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    names = classes.filter("n > 0").join(named, "root").select("key", "component_id")
    found = units.filter("n > 0").join(names, "key").select("doc_id", "text_key", F.col("n").alias("n_shingles"), "component_id")
    alone = units.filter("n = 0").select("doc_id", "text_key", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return found.unionByName(alone)


def merged(postings: DataFrame) -> DataFrame:
    """The entries (token, key, n, pos, bitmap, doc), each once, of the first of all tokens that the same classes have: near
    copies share most tokens of their prefixes, and would meet at each of them.

    All classes have their tokens in one order, so the first token of some classes is the first for each of them. Classes
    of a token are compared by their number and 128 bits of hash.
    """
    entries = postings.select("token", "key", "n", "pos").distinct()
    classes = [F.bit_xor(F.xxhash64("key", F.lit(i))).alias(f"h{i}") for i in range(2)]
    shared = entries.groupBy("token").agg(F.count("*").alias("c"), *classes, F.min("pos").alias("at")).filter("c > 1")
    first = shared.groupBy("c", "h0", "h1").agg(F.min_by("token", F.struct("at", "token")).alias("token")).select("token")
    none = F.lit(0).cast("bigint")
    return entries.join(first, "token", "left_semi").select("*", *[none.alias(c) for c in SIGNATURE], none.alias("doc"))


def _linked(links: DataFrame, roots: DataFrame | None) -> DataFrame:
    """(key, root) of the classes that are no root themselves: the components of ``links`` and of those before, which come as
    links too, so that stars stay stars."""
    if roots is not None:
        links = links.unionByName(roots.select(F.col("root").alias("a"), F.col("key").alias("b")))
    return stars(links)


def _open(entries: DataFrame, roots: DataFrame) -> DataFrame:
    """(token, key, n, pos, root) of the tokens that classes of several components have."""
    placed = entries.select("token", "key", "n", "pos").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    several = placed.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi")
    return placed.join(several.select("token"), "token", "left_semi")


def _crowded(placed: DataFrame) -> tuple[DataFrame, int, int]:
    """(token) of those with many pairs between components for each entry; the entries and such pairs of all tokens."""
    sizes = placed.groupBy("token", "root").agg(F.count("*").alias("c")).groupBy("token").agg(F.sum("c").alias("c"), F.sum(F.col("c") * F.col("c")).alias("same"))
    sizes = sizes.select("token", "c", F.expr("(c * c - same) div 2").alias("pairs"))
    seen = Observation()
    crowded = sizes.observe(seen, F.sum("c").alias("entries"), F.sum("pairs").alias("pairs")).filter(F.col("pairs") > PAIRS_PER_ENTRY * F.col("c"))
    crowded = hand_off(crowded.select("token"), "ngram-crowded")
    return crowded, seen.get["entries"] or 0, seen.get["pairs"] or 0


def pairs_with_hubs(placed: DataFrame, similarity: Similarity, seed: int) -> DataFrame:
    """Distinct (a, b): a few classes of each token's largest component with the token's classes of other components."""
    drawn = [F.min(F.struct(F.xxhash64("key", F.lit(seed * HUBS + i)).alias("h"), "key", "n", "pos")).alias(f"m{i}") for i in range(HUBS)]
    by_root = placed.groupBy("token", "root").agg(F.count("*").alias("c"), *drawn)
    largest = by_root.groupBy("token").agg(F.max(F.struct("c", "root", *[f"m{i}" for i in range(HUBS)])).alias("l"))
    members = F.array_distinct(F.transform(F.array(*[f"l.m{i}" for i in range(HUBS)]), lambda m: F.struct(m["key"], m["n"], m["pos"])))
    hubs = largest.select("token", F.col("l.root").alias("root"), F.explode(members).alias("m")).select("token", "root", "m.*")
    x, y = placed.alias("x"), hubs.alias("y")
    apart = (F.col("x.token") == F.col("y.token")) & (F.col("x.root") != F.col("y.root"))
    met = x.join(y, apart & similarity.sizes("x", "y") & similarity.from_first("x", "y"))
    return met.select(*ordered(F.col("x.key"), F.col("y.key"))).distinct()


def _without_id(docs: DataFrame) -> DataFrame:
    """Rows without a doc_id: their set is counted, they link with nothing."""
    rows = docs.filter("doc_id IS NULL").select(F.lit(0).cast("bigint").alias("doc_id"), "text", F.lit(0).cast("bigint").alias("text_key"))
    counted = rows.mapInArrow(counted_units(shingle_sets), ddl(UNITS)).filter("segment IS NULL")
    none = F.lit(None).cast("bigint")
    return counted.select(none.alias("doc_id"), F.col("n").alias("n_shingles"), none.alias("component_id"))


def representatives(docs: DataFrame, similarity: Similarity = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stay: of each group its least doc_id, and all rows without words or id.

    A group's rows that repeat the least doc_id all stay. Of rows that share an id but not the text each goes or stays alone.
    """
    found = _named(docs, similarity).filter("doc_id != component_id").select("doc_id", "text_key").distinct()
    going = found.select(F.col("doc_id").alias("_going_id"), F.col("text_key").alias("_going_key"))
    return docs.join(going, (F.col("doc_id") == F.col("_going_id")) & (F.xxhash64("text") == F.col("_going_key")), "left_anti")
