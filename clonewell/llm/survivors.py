"""Problem 1: the best representative of each duplicate group, field by field, by skyline selection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from clonewell.functions.latest import id_of, recency_key

#: Rank of records whose origin has none: behind every registered rank.
NO_RANK = 2**31 - 1

_LAYERS = "array<struct<layer:int,rank:int,late:decimal(38,0),mask:bigint>>"


def surviving_values(
    df: DataFrame,
    keys: dict[str, Column],
    row_id: Column,
    usable: dict[str, Column],
    trust_rank: Column,
    time: Column,
    min_rows: int = 2,
    completeness: str = "set",
) -> DataFrame:
    """Rows ``keys..., field, row_id, layer, n_rows``: for each group and field the record whose value survives.

    A record dominates another if it is no worse in trust (lower rank), recency (later time, then
    smaller id) and completeness (usable in every field in which the other is), and better in one.
    Undominated records are layer 1; without them, the next undominated ones are layer 2, and so on.
    The survivor starts as the first record of layer 1 by the policy (rank, time, id); its gaps are
    filled from the rest of layer 1 in policy order, then from the following layers.

    With ``completeness`` ``set``, the sets of usable fields are compared, not their numbers: so the best usable
    record of a field by the policy is never dominated, and the value of every field is the one the
    policy prefers among all usable values. With ``number``, a record that is trusted more, later and has as many usable fields dominates one
    with others, whose values then fill gaps from the following layers only.

    Scale: within one group, all records of equal rank and equal set of usable fields form a chain
    whose head dominates the rest. Only these heads can give a value, and a hash aggregate finds them
    with map-side combining; a group of any size is left with at most (ranks x 2^fields) heads, and the
    layers are computed on those. No group is gathered in one task. Ranks are meant to be
    few, as those of registered origins are: the heads of one group lie in one row, so a rank that takes a million values needs coarser steps first.

    Null keys: the record belongs to no group. Null rank: behind all ranks. Null time: earliest. Null
    id: the record is ignored. A field without usable value gives no row. Groups of fewer than
    ``min_rows`` records give none. Repeated records count as often as they stand; ties go to the
    smallest id. Only the given expressions are read, so clashing column names don't matter.
    """
    if completeness not in ("set", "number"):
        raise ValueError(f"unknown completeness {completeness}")
    if len(usable) > 16:
        raise ValueError("at most 16 fields: layers are computed over their subsets")
    mask = reduce(lambda a, b: a + b, (F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(usable.values())))
    rows = df.select(
        *(c.alias(k) for k, c in keys.items()),
        mask.cast("bigint").alias("mask"),
        F.coalesce(trust_rank.cast("int"), F.lit(NO_RANK)).alias("rank"),
        recency_key(time, row_id).alias("late"),
    ).where(reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in [*keys, "late"])))
    heads = rows.groupBy(*keys, "rank", "mask").agg(F.count(F.lit(1)).alias("n"), F.min("late").alias("late"))
    groups = (
        heads.groupBy(*keys)
        .agg(F.sum("n").alias("n_rows"), F.sort_array(F.collect_list(F.struct("rank", "late", "mask"))).alias("heads"))
        .where(F.col("n_rows") >= min_rows)
    )

    def dominates(y: Column, x: Column) -> Column:  # y stands before x in policy order, so its rank is no worse
        enough = y["mask"].bitwiseAND(x["mask"]) == x["mask"] if completeness == "set" else F.bit_count(y["mask"]) >= F.bit_count(x["mask"])
        return (y["late"] <= x["late"]) & enough

    def add(done: Column, x: Column) -> Column:
        above = F.array_max(F.transform(F.filter(done, lambda y: dominates(y, x)), lambda y: y["layer"]))
        return F.concat(done, F.array(F.struct((F.coalesce(above, F.lit(0)) + 1).alias("layer"), x["rank"].alias("rank"), x["late"].alias("late"), x["mask"].alias("mask"))))

    single = F.transform("heads", lambda x: F.struct(F.lit(1).alias("layer"), x["rank"].alias("rank"), x["late"].alias("late"), x["mask"].alias("mask")))
    layered = F.sort_array(F.when(F.size("heads") == 1, single.cast(_LAYERS)).otherwise(F.aggregate("heads", F.array().cast(_LAYERS), add)))

    def first_usable(bit: int) -> Column:
        return F.get(F.filter("layers", lambda x: x["mask"].bitwiseAND(F.lit(bit)) != 0), F.lit(0))

    fields = F.array(*(F.struct(F.lit(name).alias("field"), first_usable(1 << i).alias("best")) for i, name in enumerate(usable)))
    return (
        groups.withColumn("layers", layered)
        .select(*keys, "n_rows", F.explode(fields).alias("f"))
        .where(F.col("f.best").isNotNull())
        .select(*keys, F.col("f.field").alias("field"), id_of(F.col("f.best.late")).alias("row_id"), F.col("f.best.layer").alias("layer"), "n_rows")
    )


def surviving_records(df: DataFrame, keys: dict[str, Column], row_id: Column, fields: dict[str, tuple[Column, Column]], trust_rank: Column, time: Column, min_rows: int = 2, completeness: str = "set") -> DataFrame:
    """One built record per group: ``keys..., n_rows`` and each field's surviving value (null where none is usable); ``completeness`` as in ``surviving_values``.

    ``fields`` gives name -> (value, usable). The values are fetched by the ids ``surviving_values``
    names, so wide values don't pass through the aggregation.
    """
    best = surviving_values(df, keys, row_id, {n: u for n, (_, u) in fields.items()}, trust_rank, time, min_rows, completeness)
    values = df.select(row_id.alias("row_id"), *(v.alias(f"_{n}") for n, (v, _) in fields.items()))
    value = reduce(lambda a, n: a.when(F.col("field") == n, F.col(f"_{n}").cast("string")), fields, F.when(F.lit(False), F.lit(None).cast("string")))
    found = best.join(values, "row_id").withColumn("_value", value)
    return found.groupBy(*keys).agg(F.max("n_rows").alias("n_rows"), *(F.max(F.when(F.col("field") == n, F.col("_value"))).alias(n) for n in fields))
