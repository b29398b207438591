"""Problem 4: the most frequent items among very many, by exact refinement of hash prefixes."""

from __future__ import annotations

from decimal import Decimal
from math import ceil

from pyspark.sql import Column, DataFrame, functions as F

from clonewell.session import BROADCAST_ROWS, stage, unstage

#: Bits of the hash by which items are counted in turn; after them the items themselves are.
LEVELS = (10, 20, 32)
#: Bits of the map of kept prefixes (128 KB) and items that are named to raise the bound.
MAP_BITS = 20
NAMED = 10_000


def _prefix(bits: int) -> Column:
    return F.shiftrightunsigned(F.col("_h"), 64 - bits)


def frequent_items(df: DataFrame, item: Column, k: int | None = None, min_share: float | None = None, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """``item, n, share`` of the k most frequent items (ties to the smaller item), or of all items with at least ``min_share`` of the non-null items.

    Rows are counted by the first bits of their item's hash. A prefix' count bounds that of each item
    below it, so prefixes under the current bound are dropped, the rest is counted by more bits, and
    at last by item. The bound is ``ceil(min_share x rows)``; for the k most frequent it is the kth
    largest exact count known so far: the largest prefixes (``NAMED`` at most) name one item each that occurs below
    them, and the next pass counts those along with the longer prefixes. Named items are told apart by
    their 64-bit hashes; should two share one and raise the bound too far, fewer than k items reach it, which is checked,
    and the items are counted again without a bound. So the counts and the choice are exact.

    Scale: every pass reads one column and shuffles partial counts only, whatever k is. Kept prefixes reach the tasks as a
    map of 2^20 bits, by the last 20 bits of the prefix (a prefix that shares them with a kept one passes too, which costs
    counts but no correctness), so there is no join with rows and no limit to their number. Tasks hold at most 2^bits
    states in the first passes; in the later ones, as many as there are items below kept prefixes, and beyond their memory Spark
    writes sorted runs of such states to disk. That is the flat case, in which no prefix can be dropped.

    Null items are ignored; empty input gives no rows; any other column is ignored.
    """
    if (k is None) == (min_share is None):
        raise ValueError("give k or min_share")
    rows = df.select(item.alias("item")).where(F.col("item").isNotNull()).withColumn("_h", F.xxhash64("item"))
    below, names, bound, total, staged = rows, None, 1, None, []
    for bits in levels:
        counts = stage(_count(below, names, bits), "prefixes")
        staged.append(counts)
        if total is None:
            total = counts.agg(F.sum("n")).first()[0] or 0
            if min_share is not None:
                bound = max(1, ceil(total * Decimal(str(min_share))))
        if names is not None:
            known = counts.where("named_n > 0").orderBy(F.desc("named_n")).limit(k).agg(F.count(F.lit(1)), F.min("named_n")).first()
            bound = max(bound, known[1]) if known[0] == k else bound
        kept = counts.where(F.col("n") >= bound)
        below = _keep(rows, kept, bits)
        if k is not None:
            # the item of an arbitrary row, so most likely a frequent one
            names = kept.orderBy(F.desc("n"), "prefix").limit(min(NAMED, BROADCAST_ROWS)).select(F.col("rep").alias("_named"))
    out = stage(_items(below, bound, k), "frequent")
    if k is not None and bound > 1 and out.count() < k:
        unstage(out)
        out = stage(_items(rows, 1, k), "frequent")
    for s in staged:
        unstage(s)
    return out.withColumn("share", F.col("n") / F.lit(max(total or 0, 1)))


def _items(rows: DataFrame, bound: int, k: int | None) -> DataFrame:
    full = rows.groupBy("item").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= bound)
    return full if k is None else full.orderBy(F.desc("n"), "item").limit(k)


def _keep(rows: DataFrame, kept: DataFrame, bits: int) -> DataFrame:
    """The rows whose prefix is kept, told by a map of bits: words of 64, one row of at most 2^14 of them."""
    size = min(bits, MAP_BITS)
    at = lambda p: p.bitwiseAND((1 << size) - 1)
    words = kept.select(at(F.col("prefix")).alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("b"))
    places = rows.sparkSession.range(max(1, (1 << size) // 64)).withColumnRenamed("id", "w").join(words, "w", "left")
    dense = F.array_sort(F.collect_list(F.struct("w", F.coalesce("b", F.lit(0).cast("bigint")).alias("b"))))
    bitmap = places.agg(F.transform(dense, lambda x: x["b"]).alias("_map"))
    p = at(_prefix(bits))
    hit = F.getbit(F.get("_map", F.shiftright(p, 6).cast("int")), p.bitwiseAND(63).cast("int")) == 1
    return rows.crossJoin(F.broadcast(bitmap)).where(hit).select("item", "_h")  # one row


def _count(rows: DataFrame, names: DataFrame | None, bits: int) -> DataFrame:
    """``prefix, n, rep, named_n``: rows by prefix, the hash of an item below it, and the rows of the named item below it."""
    if names is None:
        named, n = rows, F.lit(0).cast("bigint")
    else:
        named, n = rows.join(F.broadcast(names), F.col("_h") == F.col("_named"), "left"), F.count("_named")  # at most NAMED rows
    return named.groupBy(_prefix(bits).alias("prefix")).agg(F.count(F.lit(1)).alias("n"), F.any_value("_h").alias("rep"), n.alias("named_n"))
