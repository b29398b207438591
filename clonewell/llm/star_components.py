"""Problem 3: one group identifier over all chains of pairwise matches, by large-star and small-star."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clonewell.session import stage, unstage


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.sum(F.xxhash64("v", "u", F.lit(7)).cast("decimal(20,0)"))).first())


def _rewire(sides: DataFrame, large: bool) -> DataFrame:
    """``sides`` has (u, v): v is a neighbour of u. Links those neighbours to the least of u and them."""
    least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = sides.join(least, "u")
    if large:
        return joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    both = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return both.unionByName(least.where("u <> m").select("u", F.col("m").alias("v")))


def star_components(pairs: DataFrame, a: Column, b: Column, max_rounds: int = 60) -> DataFrame:
    """``group_id, node`` for every node that a pair links to another one; group_id is the group's least node.

    Each round rewrites the links twice: large-star links every node's larger neighbours to the least
    node it knows, small-star does so with the node itself and its smaller neighbours. Groups become
    stars around their least node after a number of rounds that grows with the logarithm of the
    longest chain (at most its square); a round that changes nothing ends it.

    Scale: a round is three shuffles of distinct links. Least neighbours are map-side aggregates; the
    joins that carry them back have one row per node on one side, so the partitions of a hub with very
    many links are split by adaptive skew handling. Links are staged in the shared folder every
    round, and only a count and two sums per round reach the driver.

    Null ends and links of a node to itself are ignored; repeated and reversed pairs count once; no
    pairs give no rows. Only the two given expressions are read.
    """
    ends = pairs.select(a.alias("_a"), b.alias("_b")).where("_a <> _b")
    links = stage(ends.select(F.greatest("_a", "_b").alias("u"), F.least("_a", "_b").alias("v")).distinct(), "links")
    seen = _fingerprint(links)
    for _ in range(max_rounds):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _rewire(both, large=True).distinct()
        new = stage(_rewire(large, large=False).distinct(), "links")  # u > v in each link, so v are smaller neighbours
        now = _fingerprint(new)
        unstage(links)
        links = new
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"links still changed after {max_rounds} rounds")
    roots = links.select(F.col("v").alias("group_id")).distinct().select("group_id", F.col("group_id").alias("node"))
    return links.select(F.col("v").alias("group_id"), F.col("u").alias("node")).unionByName(roots)
