"""Connected components of a link table, never gathered in one place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, functions as F

from longreg.sources.tables import stage


def _both_ways(edges: DataFrame) -> DataFrame:
    # Two rows out of one, not a union, which would make everything below it twice.
    return _each(edges, F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))


def _each(rows: DataFrame, *pairs: Column) -> DataFrame:
    """(a, b): the pairs of each row."""
    return rows.select(F.explode(F.array(*pairs)).alias("_p")).select("_p.*")


def _state(edges: DataFrame) -> Row:
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def _to_least(neighbours: DataFrame) -> DataFrame:
    """Adds least, the smallest of a and its neighbours b; the minimum is formed before the shuffle."""
    least = neighbours.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    return neighbours.join(least, "a")


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b); component is its smallest node.

    Alternates the two star operations: every node's larger neighbours are tied to the
    smallest node around it, then its smaller neighbours are. Edges never grow in number, and
    a logarithmic number of rounds leaves stars. Loops and repeated links do no harm; a node
    that only links to itself is not listed.
    """
    edges = stage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = _state(edges)
    while True:
        large = _to_least(_both_ways(edges)).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        small = _to_least(large.where("a <> b").distinct())
        tied = _each(small, F.struct(F.col("b").alias("a"), F.col("least").alias("b")),
                     F.struct("a", F.col("least").alias("b"))).where("a <> b").distinct()
        edges = stage(tied, "links")
        state = _state(edges)
        if state == seen:
            break
        seen = state
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
