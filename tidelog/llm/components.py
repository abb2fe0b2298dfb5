"""Connected components of a graph given as pairs, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import discard, materialise, written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (
        both.where(F.col("v") > F.col("u"))
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    onto = down.join(least, "u")
    return (
        onto.where(F.col("v") != F.col("m"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v")))
        .distinct()
    )


def components(pairs: DataFrame) -> DataFrame:
    """``pairs``: two long columns u and v.  Returns node and comp (the
    smallest node of its component) for every node that isn't that smallest
    one.  Each round is written, so no lineage builds up; a node with many
    neighbours is one key of map-side combined minima."""
    edges, path = written(pairs.where(F.col("u") != F.col("v")).select("u", "v").distinct(), "edges")
    mark = None
    while True:
        last, (edges, path) = path, written(_small_star(_large_star(edges)), "stars")
        discard(pairs.sparkSession, last)
        found = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(found) == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
        mark = tuple(found)


def joined_components(comp: DataFrame, links: DataFrame) -> DataFrame:
    """``comp`` (node, comp), as ``components`` returns it, after more links
    (u, v).  Only the components that the links touch are joined: the links
    are taken between their smallest nodes."""

    def of(links: DataFrame, end: str) -> DataFrame:
        known = comp.select(F.col("node").alias(end), F.col("comp").alias("_c"))
        return links.join(known, end, "left").withColumn(end, F.coalesce("_c", end)).drop("_c")

    merged = components(of(of(links.select("u", "v"), "u"), "v"))
    onto = merged.select(F.col("node").alias("comp"), F.col("comp").alias("_c"))
    moved = comp.join(onto, "comp", "left").select("node", F.coalesce("_c", "comp").alias("comp"))
    return materialise(moved.unionByName(merged), "joined-components")
