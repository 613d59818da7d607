"""Connected components of a link table, by rounds of large-star and small-star steps on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionflow.llm.frames import hand_off


def _least(edges: DataFrame) -> DataFrame:
    """(of, m): the least parent of each node that has one."""
    return edges.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("m"))


def _round(edges: DataFrame) -> DataFrame:
    """Edges (u, v), all with u > v, after a large-star and a small-star step. No step needs an edge in both directions."""
    # large star: the larger neighbours of a node go to its least neighbour or, if it has no smaller one, stay
    up = edges.join(_least(edges), F.col("v") == F.col("of"), "left").select("u", F.coalesce("m", "v").alias("v"))
    # small star: the parents of a node, and the node, go to its least parent
    tied = up.join(_least(up), F.col("u") == F.col("of"))
    out = tied.select(F.inline(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))))
    return out.filter("u != v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars: nobody has two parents, and no parent has a parent."""
    ends = F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = edges.select(F.inline(ends)).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not nodes.filter("up + down > 1 AND up > 0").take(1)


def stars(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(key, root) of every node with a link but the roots; root is the least key that links reach. ``links`` are read twice.

    Every round is a few joins on narrow rows, written to the shared folder; it ends when all edges lead to the root.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v")
    while True:
        edges = hand_off(_round(edges), "edges")
        if _settled(edges):
            return edges.select(F.col("u").alias("key"), F.col("v").alias("root"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(key, root) of every node with a link; root is the least key that links reach."""
    found = stars(links, a, b)
    return found.unionByName(found.select(F.col("root").alias("key"), "root").distinct())
