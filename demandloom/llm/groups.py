"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.durable import durable


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``; a component is named by its
    smallest node.

    Alternating large-star and small-star (Kiveris et al., 2014): each round moves links
    towards the smallest neighbour known, with one minimum and one join per half. No
    node's neighbours are gathered in one place, and nothing goes through the driver but
    three sums that tell whether a round changed anything. Null ends and self links are
    ignored.
    """
    edges = links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = durable(edges.distinct())
    before = None
    while True:
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
            F.sum(F.xxhash64("b", "a").cast("decimal(38,0)")),
        ).first()
        if now == before or not now[0]:
            break
        before = now
        edges = durable(_small(_large(edges)))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (
        both.join(least, both.a == least.u)
        .where("b > a and b <> m")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these."""
    least = edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    moved = (
        edges.join(least, edges.a == least.u)
        .where("b <> m")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
    )
    return moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()
