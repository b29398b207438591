"""Per-key results where a few keys hold most rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clonewell.functions.latest import id_of, recency_key


def aggregate_hot_keys(
    df: DataFrame,
    key: Column,
    row_id: Column,
    time: Column,
    min_rows: int = 1,
    sums: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per key: ``key, n_rows, line_id, first_at, last_at`` and the given sums.

    Every state is algebraic and of fixed width (count, sums, minimum, maximum), so each task folds
    its rows into a hash table that spills when memory is short, and only one partial row per key
    and task is shuffled: a key with a third of all rows costs no more than any other.

    ``line_id`` is the row of the latest ``time`` (null is earliest), ties to the smallest id.
    Rows with a null key or null id are no part of any result; repeated rows count as often as they
    stand; an empty input gives an empty result; columns of the input with other names, also clashing
    ones, are ignored, since only the given expressions are read.
    """
    sums = sums or {}
    rows = df.select(
        key.alias("key"),
        recency_key(time, row_id).alias("_late"),
        time.alias("_time"),
        *(c.alias(f"_s{i}") for i, c in enumerate(sums.values())),
    ).where(F.col("key").isNotNull() & F.col("_late").isNotNull())
    out = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("_late").alias("_late"),
        F.min("_time").alias("first_at"),
        F.max("_time").alias("last_at"),
        *(F.sum(f"_s{i}").alias(n) for i, n in enumerate(sums)),
    )
    return out.where(F.col("n_rows") >= min_rows).select("key", "n_rows", id_of(F.col("_late")).alias("line_id"), "first_at", "last_at", *sums)
