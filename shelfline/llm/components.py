"""Connected components of a graph whose edges are a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.session import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b: long); a component is named by its smallest node.

    Alternating large-star and small-star rounds: each node's neighbours are hung on the smallest of them, first the
    larger ones, then the smaller ones, until nothing changes. A round is two aggregates and two joins on the node,
    so a hub with many neighbours is combined before the shuffle and split by adaptive joins; the number of rounds
    grows with the logarithm of a component's size. Nulls and loops are left out; no edges give no rows.
    """
    stars = materialise(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    before = _mark(stars)
    while True:
        stars = materialise(_small_star(_large_star(stars)))
        now = _mark(stars)
        if now == before:
            break
        before = now
    own = stars.select(F.col("b").alias("node")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        own.select("node", F.col("node").alias("component"))
    )


def _mark(edges: DataFrame) -> tuple:
    """A fingerprint of the edge set: two numbers, whatever its size."""
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every node's larger neighbours on the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Written first: a join with an aggregate's own output could not split a hub, one of two shuffles can.
    least = materialise(both.groupBy("a").agg(F.min("b").alias("low")))
    low = F.least("a", "low")
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), low.alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang every node and its smaller neighbours on the smallest of them; edges run from larger to smaller."""
    least = materialise(edges.groupBy("a").agg(F.min("b").alias("low")))
    hung = edges.join(least, "a").where(F.col("b") > F.col("low")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    return hung.unionByName(least.select("a", F.col("low").alias("b"))).distinct()
