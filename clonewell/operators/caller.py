"""Counts of library barcodes in short reads: extraction between flanks, nearest match, counts by sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clonewell.functions.seq import between_flanks, reverse_complement
from clonewell.operators.neighbors import nearest


def read_barcodes(reads: DataFrame, up: str, down: str, length: int, slack: int = 3, flip: bool = False) -> DataFrame:
    """``sample, read_id, barcode`` of ``sample, read_id, seq`` (and ``seq2`` of mates): what stands between the flanks, null if nothing does.

    ``flip`` tells that first reads run backwards; then mates run forwards, and else the reverse. If both mates
    have a barcode, they must agree, or there is none.
    """
    first = reverse_complement(F.col("seq")) if flip else F.col("seq")
    one = between_flanks(first, up, down, length, slack)
    if "seq2" not in reads.columns:
        return reads.select("sample", "read_id", one.alias("barcode"))
    second = F.col("seq2") if flip else reverse_complement(F.col("seq2"))
    two = between_flanks(second, up, down, length, slack)
    both = F.when(one.isNull(), two).when(two.isNull() | (one == two), one)
    return reads.select("sample", "read_id", both.alias("barcode"))


def call_reads(barcodes: DataFrame, library: DataFrame, max_errors: int) -> DataFrame:
    """``sample, fate, hit, n``: reads of ``sample, read_id, barcode`` counted by library barcode (``library`` has ``seq``).

    Equal barcodes of a sample are counted first, so the similarity search and its joins see each distinct barcode once.
    Fates: ``failedExtraction``, ``noMatch``, ``ambiguous`` (several library barcodes equally near) and ``hit``.
    """
    counts = barcodes.groupBy("sample", "barcode").agg(F.count(F.lit(1)).alias("n"))
    best = nearest(counts.select(F.col("barcode").alias("seq")), library, max_errors)
    both = counts.join(best, counts["barcode"] == best["seq"], "left")
    fate = F.when(F.col("barcode").isNull(), "failedExtraction").when(F.col("nhits").isNull(), "noMatch").when(F.col("nhits") > 1, "ambiguous").otherwise("hit")
    return both.withColumn("fate", fate).groupBy("sample", "fate", "hit").agg(F.sum("n").alias("n"))
