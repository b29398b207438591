"""Barcode libraries: preclusters, collisions, dominance, filters, merging, conversion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window as W

from clonewell.functions.seq import phred


def precluster_members(reads: DataFrame, barcode: Column, row_id: Column) -> DataFrame:
    """``barcode, cluster_id, row_id, size``: reads of the same exact barcode; cluster_id is the smallest row id.

    Sizes and ids come from a map-side aggregate that is joined back, not from a window or a collected
    list, so a barcode with a third of all reads never lies in one task (the join's skewed partitions
    are split at run time). Null barcodes form no cluster.
    """
    rows = reads.select(barcode.alias("barcode"), row_id.alias("row_id")).where("barcode IS NOT NULL")
    sizes = rows.groupBy("barcode").agg(F.min("row_id").alias("cluster_id"), F.count(F.lit(1)).alias("size"))
    return rows.join(sizes, "barcode").select("barcode", "cluster_id", "row_id", "size")


def precluster_quality(reads: DataFrame, barcode: Column, qual: Column, cap: int = 93) -> DataFrame:
    """``barcode, pos, q, n``: Phred values of a barcode's reads summed by position, held at ``cap``; a single read keeps its values.

    One row per position, by an algebraic aggregate. Null qualities add nothing.
    """
    bases = reads.select(barcode.alias("barcode"), F.posexplode(phred(qual)).alias("i", "q")).where("barcode IS NOT NULL")
    sums = bases.groupBy("barcode", (F.col("i") + 1).alias("pos")).agg(F.sum("q").alias("s"), F.count(F.lit(1)).alias("n"))
    return sums.select("barcode", "pos", F.when(F.col("n") > 1, F.least(F.col("s"), F.lit(cap))).otherwise(F.col("s")).cast("int").alias("q"), "n")


def tag_collisions(df: DataFrame, key: str, out: str = "collision") -> DataFrame:
    """``df`` with ``collision`` in a column where another row has the same key, else an empty text; null keys never collide."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return df.join(counts, key, "left").withColumn(out, F.when(F.col("_n") > 1, "collision").otherwise("")).drop("_n")


def dominant(df: DataFrame, key: str, size: str, min_ratio: float = 2 / 3, min_size: int = 2) -> DataFrame:
    """Rows that hold more than ``min_ratio`` of their key's total size (singletons count in the total) and have ``min_size``."""
    if not 0.5 <= min_ratio < 1:
        raise ValueError("min_ratio lies between 0.5 and 1, else two rows could dominate")
    totals = df.groupBy(key).agg(F.sum(size).alias("_total"))
    return df.join(totals, key).where((F.col(size) / F.col("_total") > min_ratio) & (F.col(size) >= min_size)).drop("_total")


def clean_rows(df: DataFrame, tag: str = "collision", size: str = "size", min_size: int = 2) -> DataFrame:
    """Rows without collision and of at least ``min_size``."""
    return df.where((F.col(tag) == "") & (F.col(size) >= min_size))


def merge_libraries(first: DataFrame, second: DataFrame, key: str = "barcode", geno: str = "geno", size: str = "size") -> DataFrame:
    """Both libraries as one: ``barcode, geno, size, status``.

    A clone of the second library is added to the largest clone of the first with the same barcode and genotype
    (ties to the smaller genotype can't occur, as these are equal; repeated clones of either side are
    first summed up); it is ``conflict`` if the first has the barcode with other genotypes only, else ``new``.
    """
    one, two = (d.groupBy(key, geno).agg(F.sum(size).alias(size)) for d in (first, second))
    both = one.withColumnRenamed(size, "_one").join(two.withColumnRenamed(size, "_two"), [key, geno], "full")
    known = one.select(key).distinct().withColumn("_known", F.lit(True))
    status = F.when(F.col("_one").isNotNull() & F.col("_two").isNotNull(), "merged").when(F.col("_one").isNotNull(), "first").when(F.col("_known"), "conflict").otherwise("new")
    total = (F.coalesce("_one", F.lit(0)) + F.coalesce("_two", F.lit(0))).cast("bigint")
    return both.join(known, key, "left").select(key, geno, total.alias(size), status.alias("status"))


def join_libraries(first: DataFrame, second: DataFrame, keys: Sequence[str], clone: str, size: str = "size") -> DataFrame:
    """Both libraries as one, clone by clone: ``keys..., clone, size, status``; ``keys`` are the barcode and the genotype.

    Clones of the second library, summed up by ``keys``, join the largest clone of the first that has the same (``merged``; ties to the smallest
    ``clone``); that one keeps its name. Those without are added without a name: ``conflict`` if the first library has the barcode with
    other genotypes only, else ``new``. Rows with a null key are left out. Largest clones are map-side aggregates, joined back.
    """
    barcode = keys[0]
    known = lambda d: d.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    one = known(first).groupBy(*keys, clone).agg(F.sum(size).alias(size))
    two = known(second).groupBy(*keys).agg(F.sum(size).alias("_more"))
    largest = one.groupBy(*keys).agg(F.min_by(clone, F.struct(-F.col(size), clone)).alias("_largest"))
    joined = one.join(largest.join(two, keys, "full"), keys, "full").join(one.select(barcode).distinct().withColumn("_known", F.lit(True)), barcode, "left")
    is_largest, more = F.col(clone) == F.col("_largest"), F.coalesce("_more", F.lit(0))
    total = F.when(F.col(clone).isNull(), more).when(is_largest, F.col(size) + more).otherwise(F.col(size)).cast("bigint")
    status = F.when(F.col(clone).isNotNull(), F.when(is_largest & F.col("_more").isNotNull(), "merged").otherwise("first")).when(F.col("_known"), "conflict").otherwise("new")
    return joined.select(*keys, clone, total.alias(size), status.alias("status"))


def join_members(first: DataFrame, second: DataFrame, libraries: DataFrame, keys: Sequence[str], clone: str) -> DataFrame:
    """``keys..., clone, row_id``: the reads of the clones of ``join_libraries``, of both libraries' reads ``keys..., clone (of the first), row_id``."""
    merged = libraries.where("status <> 'first'").select(*keys, F.col(clone).alias("_into"))
    moved = second.join(merged, list(keys)).select(*keys, F.col("_into").alias(clone), "row_id")
    return first.select(*keys, clone, "row_id").unionByName(moved)


def first_columns(df: DataFrame, n: int = 9) -> DataFrame:
    """A library table cut to its first ``n`` columns, as counts expect it."""
    return df.select(*(F.col(f"`{c}`") for c in df.columns[:n]))


def convert_library(df: DataFrame, mode: str, virtual: str = "virtual", up: str = "up") -> DataFrame:
    """``df`` with ``barcode`` as other experiments read it: ``same`` (the virtual one), ``up`` or ``down`` (the virtual one without the up barcode)."""
    if mode not in ("same", "up", "down"):
        raise ValueError(f"unknown mode {mode}")
    barcode = {"same": F.col(virtual), "up": F.col(up), "down": F.substr(F.col(virtual), F.length(up) + 1)}[mode]
    return df.withColumn("barcode", barcode)


def histogram(df: DataFrame, value: Column, cap: int | None = None, fill: bool = False) -> DataFrame:
    """``value, n``; values from ``cap`` up count as ``cap``; with ``fill``, absent values from 1 to ``cap`` have 0."""
    if fill and cap is None:
        raise ValueError("fill needs a cap")
    v = value if cap is None else F.when(value.isNotNull(), F.least(value, F.lit(cap)))
    counts = df.select(v.cast("bigint").alias("value")).where("value IS NOT NULL").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    if not fill:
        return counts
    bins = df.sparkSession.range(1, cap + 1).withColumnRenamed("id", "value")
    return bins.join(counts, "value", "left").select("value", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def first_of(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key by the order given (a window; for keys of bounded size)."""
    return df.withColumn("_k", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_k = 1").drop("_k")
