"""Counts to frequencies, log ratios, normalised scores and per-variant estimates, in long layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window as W

from clonewell.functions.seq import finite, log_ratio, log_ratio_sd, product_sd
from clonewell.session import small, stage


def frequencies(counts: DataFrame, samples: DataFrame) -> DataFrame:
    """``lib_row, assay, cond, replicate, n, freq`` from ``lib_row, sample, n``; freq is the share in the sample.

    Pairs of row and sample that don't occur stay implicit; ``replicate_stats`` counts them as 0.
    """
    totals = counts.groupBy("sample").agg(F.sum("n").alias("_total"))
    both = stage(totals.join(samples, "sample"), "totals")  # one row per sample
    return counts.join(small(both), "sample").select("lib_row", "assay", "cond", "replicate", "n", (F.col("n") / F.col("_total")).alias("freq"))


def replicate_stats(freqs: DataFrame, samples: DataFrame) -> DataFrame:
    """``lib_row, assay, cond, mean, sd, mean_count`` over the samples of a condition, absent ones as 0.

    The dense grid of rows x samples is never built: mean and standard deviation (of a sample; null for one
    replicate) follow from the sums over the counts present and the number of replicates.
    """
    reps = samples.groupBy("assay", "cond").agg(F.count(F.lit(1)).alias("k"))
    rows = freqs.select("lib_row").distinct()
    sums = freqs.groupBy("lib_row", "assay", "cond").agg(F.sum("freq").alias("s"), F.sum(F.col("freq") * F.col("freq")).alias("ss"), F.sum("n").alias("sn"))
    grid = rows.crossJoin(small(reps))  # one row per condition of the sample sheet
    full = grid.join(sums, ["lib_row", "assay", "cond"], "left").fillna(0, ["s", "ss", "sn"])
    mean, k = F.col("s") / F.col("k"), F.col("k")
    variance = F.greatest((F.col("ss") - k * mean * mean) / F.nullif(k - 1, F.lit(0)), F.lit(0.0))
    return full.select("lib_row", "assay", "cond", mean.alias("mean"), F.when(k > 1, F.sqrt(variance)).alias("sd"), (F.col("sn") / k).alias("mean_count"))


def pseudocount(stats: DataFrame) -> DataFrame:
    """One row ``pseudo``: 10^floor(log10(the second smallest distinct mean)) over all conditions; null if there is none."""
    smallest = stats.select("mean").distinct().orderBy("mean").limit(2)
    second = smallest.agg(F.max("mean").alias("m"), F.count(F.lit(1)).alias("k"))
    return second.select(F.when((F.col("k") == 2) & (F.col("m") > 0), F.pow(F.lit(10.0), F.floor(F.log10(F.when(F.col("m") > 0, F.col("m")))))).alias("pseudo"))


def log_ratios(stats: DataFrame, pseudo: DataFrame, baseline: str = "All") -> DataFrame:
    """``lib_row, assay, cond, lr, sd, allfreq, freq`` of each condition against the baseline of its assay."""
    base = stats.where(F.col("cond") == baseline).select("lib_row", "assay", F.col("mean").alias("m0"), F.col("sd").alias("s0"))
    chosen = stats.where(F.col("cond") != baseline).join(base, ["lib_row", "assay"]).crossJoin(F.broadcast(pseudo))  # one row
    p = F.col("pseudo")
    return chosen.select(
        "lib_row",
        "assay",
        "cond",
        log_ratio(F.col("mean"), F.col("m0"), p).alias("lr"),
        log_ratio_sd(F.col("sd"), F.col("mean"), F.col("s0"), F.col("m0"), p).alias("sd"),
        F.col("m0").alias("allfreq"),
        F.col("mean").alias("freq"),
    )


def exact_medians(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``keys..., median`` of a double column, exact; the mean of the two middle values of an even number.

    Values are counted, range-sorted and summed up per partition; the partitions' subtotals are added, so a group of any
    size is spread over many tasks. Null and NaN values are left out, and groups without others; null keys are groups.
    """
    spark = df.sparkSession
    counts = df.where(finite(F.col(value))).groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    order = [*(F.col(k).asc_nulls_first() for k in keys), F.col("_v").asc()]
    ranged = stage(counts.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).withColumn("_part", F.spark_partition_id()), "ranged")
    whole, before = W.partitionBy(*keys), W.partitionBy(*keys).orderBy("_part")
    subtotals = ranged.groupBy(*keys, "_part").agg(F.sum("_n").alias("_sub"))  # at most one row per group and partition
    offsets = subtotals.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_part").alias("_p"), (F.sum("_sub").over(before) - F.col("_sub")).alias("_before"), F.sum("_sub").over(whole).alias("_total"))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    upto = F.col("_before") + F.sum("_n").over(W.partitionBy("_part", *keys).orderBy("_v").rowsBetween(W.unboundedPreceding, 0))
    run = ranged.join(offsets, [F.col("_part") == F.col("_p"), *same]).withColumn("_upto", upto)
    low, high = F.expr("(_total + 1) div 2"), F.expr("_total div 2 + 1")
    holds = lambda rank: (F.col("_upto") >= rank) & (F.col("_upto") - F.col("_n") < rank)
    return run.where(holds(low) | holds(high)).groupBy(*keys).agg(((F.max(F.when(holds(low), F.col("_v"))) + F.max(F.when(holds(high), F.col("_v")))) / 2).alias("median"))


def wide_enough(stats: DataFrame, bottleneck: float) -> DataFrame:
    """``lib_row, assay`` of rows whose mean count is at least ``bottleneck`` in all conditions of the assay, the baseline too."""
    return stats.groupBy("lib_row", "assay").agg(F.bool_and(F.col("mean_count") >= bottleneck).alias("_wide")).where("_wide").select("lib_row", "assay")


def control_medians(lrs: DataFrame, is_wt: Column, is_null: Column, min_freq: float = 0.0, given: tuple[float | None, float | None] = (None, None)) -> DataFrame:
    """``assay, cond, wt_med, null_med``: exact medians of finite log ratios of the controls above ``min_freq``.

    ``given`` are medians of the wild type and of null rows to take instead. A condition without controls of a kind has null there.
    """
    good = finite(F.col("lr")) & (F.col("allfreq") > min_freq)
    kinds = F.array_compact(F.array(F.when(is_wt & good, "wt"), F.when(is_null & good, "null")))
    controls = lrs.select("assay", "cond", "lr", F.explode(kinds).alias("_kind"))
    medians = exact_medians(controls, ["assay", "cond", "_kind"], "lr")
    wide = medians.groupBy("assay", "cond").agg(*(F.max(F.when(F.col("_kind") == k, F.col("median"))).alias(f"{k}_med") for k in ("wt", "null")))
    out = lrs.select("assay", "cond").distinct().join(small(stage(wide, "medians")), ["assay", "cond"], "left")  # one row per condition
    return out.select("assay", "cond", *(F.lit(float(g)).alias(n) if g is not None else F.col(n) for n, g in zip(("wt_med", "null_med"), given)))


def scores(lrs: DataFrame, medians: DataFrame) -> DataFrame:
    """Log ratios scaled so that the median of null rows is 0 and of wild-type rows 1; null where both are equal."""
    both = lrs.join(small(stage(medians, "medians")), ["assay", "cond"])
    span = F.nullif(F.col("wt_med") - F.col("null_med"), F.lit(0.0))
    return both.select("lib_row", "assay", "cond", ((F.col("lr") - F.col("null_med")) / span).alias("score"), (F.col("sd") / F.abs(span)).alias("sd"), "allfreq", "freq")


def passing(lrs: DataFrame, min_freq: float, bottleneck: float | None = None, strict: bool = False) -> DataFrame:
    """Rows whose baseline frequency is at least ``min_freq`` (above it if ``strict``) and, with ``bottleneck``, whose condition has that frequency."""
    enough = F.col("allfreq") > min_freq if strict else F.col("allfreq") >= min_freq
    return lrs.where(enough if bottleneck is None else enough & (F.col("freq") >= bottleneck))


def joined_estimate(mean: Column, sd: Column, df: Column) -> tuple[Column, Column, Column]:
    """Aggregates (mean, sd, df) of several estimates weighted by 1/sd, all algebraic.

    The joined variance is sum w (sd^2 + mean^2) - joined mean^2. One estimate stays as it is.
    Estimates without sd or with sd 0 are left out, unless there is only one.
    """
    w = F.when(sd > 0, 1 / sd)
    total, n = F.sum(w), F.count(mean)
    m = F.sum(w * mean) / total
    v = F.sum(w * (sd * sd + mean * mean)) / total - m * m
    return F.when(n == 1, F.max(mean)).otherwise(m), F.when(n == 1, F.max(sd)).otherwise(F.sqrt(F.greatest(v, F.lit(0.0)))), F.sum(df)


def variant_estimates(clones: DataFrame, replicates: int) -> DataFrame:
    """``mut`` with estimates from clones ``clone, muts (array), score, sd``: single, multi and inferred.

    ``single`` joins the clones with that mutation only, ``multi`` all clones with it. ``inferred``
    divides a multi-mutant clone's score by the product of the single scores of its other
    mutations, if all of these are known and not 0, and joins those quotients. A column ``k`` tells the
    number of changes of a clone where ``muts`` doesn't list all; such clones give no quotient.
    """
    each = clones.where(finite(F.col("score"))).select("clone", "score", "sd", (F.col("k") if "k" in clones.columns else F.size("muts")).alias("k"), F.explode(F.array_distinct("muts")).alias("mut"))
    df = F.lit(replicates)
    names = ("score", "sd", "df")

    def joined(rows: DataFrame, tag: str) -> DataFrame:
        return rows.groupBy("mut").agg(*(c.alias(f"{n}_{tag}") for n, c in zip(names, joined_estimate(F.col("score"), F.col("sd"), df))))

    single = joined(each.where("k = 1"), "single")
    multi = joined(each, "multi")
    known = single.where((F.col("score_single") != 0) & finite(F.col("score_single"))).select("mut", F.col("score_single").alias("s"), F.col("sd_single").alias("e"))
    listed = clones.where(F.col("k") == F.size("muts")).select("clone") if "k" in clones.columns else None
    several = each.where("k > 1") if listed is None else each.where("k > 1").join(listed, "clone", "left_semi")
    with_single = several.join(known, "mut", "left")
    # of each clone: product and relative variance over all its mutations; the own one is divided out again
    ok = F.col("s").isNotNull()
    per_clone = with_single.groupBy("clone").agg(
        F.sum(F.log(F.abs(F.col("s")))).alias("log_all"),
        F.sum(F.when(F.col("s") < 0, 1).otherwise(0)).alias("neg_all"),
        F.sum(F.pow(F.col("e") / F.col("s"), 2)).alias("rel_all"),
        F.sum(F.when(ok, 0).otherwise(1)).alias("unknown"),
        F.count(F.col("e")).alias("with_sd"),
        F.count(F.lit(1)).alias("m"),
    )
    both = with_single.join(per_clone, "clone").where((F.col("unknown") == 0) | ((F.col("unknown") == 1) & ~ok))
    log_others = F.col("log_all") - F.when(ok, F.log(F.abs(F.col("s")))).otherwise(0.0)
    neg_others = F.col("neg_all") - F.when(F.col("s") < 0, 1).otherwise(0)
    product = F.when(F.col("m") - F.col("unknown") - F.when(ok, 1).otherwise(0) == 0, F.lit(1.0)).otherwise(F.exp(log_others) * F.when(neg_others % 2 == 1, -1.0).otherwise(1.0))
    rel_others = F.greatest(F.coalesce("rel_all", F.lit(0.0)) - F.coalesce(F.pow(F.col("e") / F.col("s"), 2), F.lit(0.0)), F.lit(0.0))
    quotient = F.col("score") / product
    sd = F.abs(quotient) * F.sqrt(F.when(F.col("score") != 0, F.pow(F.col("sd") / F.col("score"), 2)) + rel_others)
    inferred = joined(both.select("mut", quotient.alias("score"), sd.alias("sd")), "infer")
    return multi.join(single, "mut", "full").join(inferred, "mut", "full")


def joint_table(estimates: DataFrame, wild_type: str = "=") -> DataFrame:
    """``mut, score, sd, se, df``: single estimates, else multi ones; the wild type's row is left out."""
    pick = lambda n: F.when(F.col("score_single").isNotNull(), F.col(f"{n}_single")).otherwise(F.col(f"{n}_multi"))
    rows = estimates.where(F.col("mut") != wild_type).select("mut", pick("score").alias("score"), pick("sd").alias("sd"), pick("df").alias("df"))
    return rows.where(F.col("score").isNotNull()).withColumn("se", F.col("sd") / F.sqrt(F.nullif(F.col("df"), F.lit(0))))


__all__ = ["frequencies", "replicate_stats", "pseudocount", "log_ratios", "exact_medians", "wide_enough", "control_medians", "scores", "passing", "joined_estimate", "variant_estimates", "joint_table", "product_sd"]
