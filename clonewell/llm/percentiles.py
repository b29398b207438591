"""Problem 2: percentiles per group of very large numeric columns, by cumulative frequencies."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window as W

from clonewell.session import stage


def value_counts(df: DataFrame, keys: dict[str, Column], value: Column, weight: Column | None = None, relative_error: float = 0.0) -> DataFrame:
    """Mergeable summary ``keys..., value, n``: how often each value stands in each group.

    Summaries of different partitions, days or tables combine by ``merge_counts``. With
    ``relative_error`` e > 0, values are first rounded to the nearest of the bounds (1+e)^(2i) / (1+e),
    which moves each by a factor of at most 1+e and bounds the number of distinct values by the
    logarithm of their range; with 0 the values stay, and percentiles are exact.

    Null and NaN values are no part of it; a null key is a group of its own; rows of weight 0 or less
    are ignored.
    """
    v = value.cast("double") if relative_error > 0 else value
    if relative_error > 0:
        step = F.log(F.lit(1.0 + relative_error)) * 2
        v = F.when(v == 0, F.lit(0.0)).otherwise(F.signum(v) * F.exp(F.round(F.log(F.abs(F.nullif(v, F.lit(0.0)))) / step) * step))
    n = F.lit(1) if weight is None else weight
    rows = df.select(*(c.alias(k) for k, c in keys.items()), v.alias("value"), n.cast("bigint").alias("n"))
    if dict(rows.dtypes)["value"] in ("double", "float"):
        rows = rows.where(~F.isnan("value"))
    return rows.where((F.col("value").isNotNull()) & (F.col("n") > 0)).groupBy(*keys, "value").agg(F.sum("n").alias("n"))


def merge_counts(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The summary of several summaries' union, over fewer keys than they had, such as without the day; repeated summaries count as often as they stand."""
    return counts.groupBy(*keys, "value").agg(F.sum("n").alias("n"))


def percentiles(counts: DataFrame, keys: Sequence[str], fractions: Sequence[str | float], partitions: int | None = None) -> DataFrame:
    """``keys..., fraction, value, total`` from a summary: the smallest value whose cumulative count reaches ceil(fraction x total).

    The counts are range-partitioned and sorted by (keys, value); each partition sums up its own
    stretch of a group by a window, and the groups' subtotals of the partitions before are added to
    it. A group of any number of distinct values is spread over as many partitions as its share, and
    the subtotals are at most one row per group and partition. The ranged rows are staged once, so
    that subtotals and running sums see the same partitions even when tasks are run again. A value may stand in several
    rows, as in the union of several days' summaries: running sums go row by row.

    Fractions lie in (0, 1]; they are taken as decimals, so that 0.95 of 20 rows is rank 19. Empty
    input gives no rows. Null keys are groups.
    """
    for f in fractions:
        if not 0 < Decimal(str(f)) <= 1:
            raise ValueError(f"fraction {f} is not in (0, 1]")
    keys = list(keys)
    order = [F.col(k).asc_nulls_first() for k in keys]
    spark = counts.sparkSession
    ranged = counts.repartitionByRange(partitions or int(spark.conf.get("spark.sql.shuffle.partitions")), *order, F.col("value").asc())
    ranged = stage(ranged.select(*keys, "value", "n", F.spark_partition_id().alias("_part")), "ranged")
    before = W.partitionBy(*keys).orderBy("_part")
    offsets = (
        ranged.groupBy(*keys, "_part")
        .agg(F.sum("n").alias("_sub"))
        .select(*keys, "_part", (F.sum("_sub").over(before) - F.col("_sub")).alias("_offset"), F.sum("_sub").over(W.partitionBy(*keys)).alias("total"))
    )
    running = F.sum("n").over(W.partitionBy("_part", *keys).orderBy("value").rowsBetween(W.unboundedPreceding, 0))
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys]
    summed = ranged.withColumn("_run", running).alias("r").join(offsets.alias("o"), [F.col("r._part") == F.col("o._part"), *same])
    upto = F.col("_offset") + F.col("_run")
    targets = F.array(*(F.struct(F.lit(float(f)).alias("fraction"), F.ceil(F.col("total").cast("decimal(20,0)") * F.lit(Decimal(str(f)))).cast("bigint").alias("rank")) for f in fractions))
    hits = F.filter(targets, lambda t: (t["rank"] <= upto) & (t["rank"] > upto - F.col("n")))
    return summed.select(*(F.col(f"r.{k}").alias(k) for k in keys), F.col("value"), F.col("total"), F.explode(hits).alias("t")).select(*keys, F.col("t.fraction").alias("fraction"), "value", "total")
