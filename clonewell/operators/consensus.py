"""Consensus genotypes and barcodes of clusters."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F


def consensus_genotypes(clusters: DataFrame, calls: DataFrame, min_quality: int) -> DataFrame:
    """``cluster, size, geno``: of several reads, the calls whose qualities, less ``min_quality`` for each read without them, are above 0; of one read, those of at least ``min_quality``.

    Calls are joined in order of position, then text; ``=`` stands for none.
    """
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    sums = clusters.select("read_id", "cluster").join(calls, "read_id").groupBy("cluster", "mut").agg(F.count(F.lit(1)).alias("m"), F.sum("q").alias("q"), F.min("pos").alias("pos"))
    both = sums.join(sizes, "cluster")
    kept = both.where(F.when(F.col("size") > 1, F.col("q") - min_quality * (F.col("size") - F.col("m")) > 0).otherwise(F.col("q") >= min_quality))
    # at most one entry per position and change of the amplicon
    texts = kept.groupBy("cluster").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "mut"))), lambda x: x["mut"]), ";").alias("geno"))
    return sizes.join(texts, "cluster", "left").select("cluster", "size", F.coalesce("geno", F.lit("=")).alias("geno"))


def _align(center: str, other: str) -> list[str]:
    """``other`` laid along ``center`` by edit distance: for each base of it, what stands there; inserted bases follow the base before (the first item holds those in front)."""
    n, m = len(center), len(other)
    cost = [list(range(m + 1))]
    for i in range(1, n + 1):
        row = [i]
        for j in range(1, m + 1):
            row.append(min(cost[i - 1][j - 1] + (center[i - 1] != other[j - 1]), cost[i - 1][j] + 1, row[j - 1] + 1))
        cost.append(row)
    out = [""] * (n + 1)
    i, j = n, m
    while i or j:
        if i and j and cost[i][j] == cost[i - 1][j - 1] + (center[i - 1] != other[j - 1]):
            out[i] = other[j - 1] + out[i]
            i, j = i - 1, j - 1
        elif i and cost[i][j] == cost[i - 1][j] + 1:
            out[i] = out[i] or "-"
            i -= 1
        else:
            out[i] = other[j - 1] + out[i]
            j -= 1
    return out


def plurality(barcodes: list[str], counts: list[int]) -> str:
    """Most frequent content at each place of barcodes aligned to the first one; ties to the one seen first, gaps dropped."""
    places = [_align(barcodes[0], b) for b in barcodes]
    out = []
    for k in range(len(barcodes[0]) + 1):
        votes: dict[str, int] = {}
        for p, n in zip(places, counts):
            votes[p[k]] = votes.get(p[k], 0) + n
        out.append(max(votes, key=votes.get))  # dicts keep the order of first sight
    return "".join(x for x in out if x != "-")


def consensus_barcodes(clusters: DataFrame) -> DataFrame:
    """``cluster, consensus``: the most frequent barcode; of two reads that differ the first one's; of other ties, a plurality of their alignment.

    Barcodes are counted before anything is grouped; only clusters with ties (rare, and of few different
    barcodes, since those lie within a small distance) are aligned, one group each.
    """
    counts = clusters.where("barcode IS NOT NULL").groupBy("cluster", "barcode").agg(F.count(F.lit(1)).alias("n"), F.min("read_id").alias("first"))
    per = counts.groupBy("cluster").agg(F.max("n").alias("most"), F.sum("n").alias("size"))
    both = counts.join(per, "cluster")
    top = both.where("n = most").groupBy("cluster", "size").agg(F.count(F.lit(1)).alias("ties"), F.min_by("barcode", "first").alias("barcode"))
    clear = top.where("ties = 1 OR size = 2").select("cluster", F.col("barcode").alias("consensus"))
    tied = both.join(top.where("ties > 1 AND size > 2").select("cluster"), "cluster", "left_semi").select("cluster", "barcode", "n", "first")
    kind = dict(clusters.dtypes)["cluster"]

    def aligned(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("first", kind="stable")
        return pd.DataFrame({"cluster": group["cluster"].iloc[:1], "consensus": [plurality(group["barcode"].tolist(), group["n"].tolist())]})

    return clear.unionByName(tied.groupBy("cluster").applyInPandas(aligned, f"cluster {kind}, consensus string"))
