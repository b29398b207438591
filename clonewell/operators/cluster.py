"""Clustering of reads into clones: equal barcodes first, then clusters of similar barcodes.

All decisions are relational: reads of a barcode with the same calls are one state, links run between
states, and clusters are connected components. No cluster is gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clonewell.operators.components import components
from clonewell.operators.neighbors import family_neighbors
from clonewell.session import small, stage, unstage


def likely_calls(reads: DataFrame, calls: DataFrame, group: str, min_quality: int) -> DataFrame:
    """``read_id, group, mut, q``: calls seen in more than one read of the group, or with qualities of more than ``min_quality`` in all."""
    own = reads.select("read_id", group).join(calls.select("read_id", "mut", "q"), "read_id")
    sums = own.groupBy(group, "mut").agg(F.count_if(F.col("q") > 0).alias("n"), F.sum("q").alias("s")).where((F.col("n") > 1) | (F.col("s") > min_quality))
    return own.join(sums.select(group, "mut"), [group, "mut"]).where("q > 0")


def variant_matrix(reads: DataFrame, calls: DataFrame, group: str) -> DataFrame:
    """``group, mut, read_id, q``: every call of a group for every read of it, null where the read lacks it; the full outer merge of the reads' calls in long layout."""
    members = reads.select("read_id", group).distinct()
    own = members.join(calls.where("mut IS NOT NULL").groupBy("read_id", "mut").agg(F.max("q").alias("q")), "read_id")
    known = own.select(group, "mut").distinct().join(members, group)
    return known.join(own.select("read_id", "mut", "q"), ["read_id", "mut"], "left").select(group, "mut", "read_id", "q")


def seed_clusters(reads: DataFrame, calls: DataFrame, min_jaccard: float = 0.2, min_matches: int = 1, min_quality: int = 0) -> DataFrame:
    """``read_id, barcode, cluster``: reads of equal barcodes whose calls agree, directly or through others.

    ``reads`` has ``read_id, barcode``, ``calls`` has ``read_id, mut, q``. Two reads are linked if neither has
    a likely call, or if their likely calls have a Jaccard similarity above ``min_jaccard`` and at least
    ``min_matches`` in common. ``cluster`` is the smallest read_id. Reads with null barcodes are left out;
    reads without calls have none; a repeated call of a read counts by its highest quality.

    Reads of a barcode with the same likely calls form one state; only states that share a call are
    compared, so the number of comparisons depends on the distinct states of a barcode, not its reads. States of so few calls that a
    single common one makes them similar (two, at 0.2) are linked to one of them for each call, not to each other; pairs are made only
    where one of the two has more calls.
    """
    known = reads.where("barcode IS NOT NULL AND read_id IS NOT NULL").select("read_id", "barcode").distinct()
    one = calls.where("mut IS NOT NULL").groupBy("read_id", "mut").agg(F.max("q").alias("q"))
    likely = likely_calls(known, one, "barcode", min_quality).groupBy("read_id").agg(F.array_sort(F.collect_set("mut")).alias("muts"))  # the calls of one read
    full = known.join(likely, "read_id", "left").withColumn("muts", F.coalesce("muts", F.array().cast("array<string>")))
    states = full.groupBy("barcode", "muts").agg(F.min("read_id").alias("state"), F.count(F.lit(1)).alias("n"))
    full = stage(full.join(states.select("barcode", "muts", "state"), ["barcode", "muts"]).select("read_id", "barcode", "state", "muts"), "states")
    each = full.where(F.col("read_id") == F.col("state")).select("barcode", "state", F.size("muts").alias("k"), F.explode("muts").alias("mut"))
    most = _always_similar(min_jaccard) if min_matches <= 1 else 0
    few = each.where(F.col("k") <= most)
    stars = few.join(few.groupBy("barcode", "mut").agg(F.min("state").alias("b")), ["barcode", "mut"]).where("state <> b").select(F.col("state").alias("a"), "b")
    a, b = (each.select("barcode", "mut", F.col("state").alias(s), F.col("k").alias(f"k{s}")) for s in ("a", "b"))
    # the side with more calls is a; of two with many, the order of ids decides
    shared = a.where(F.col("ka") > most).join(b, ["barcode", "mut"]).where((F.col("kb") <= most) | (F.col("a") < F.col("b"))).groupBy("a", "b", "ka", "kb").agg(F.count(F.lit(1)).alias("both"))
    union = F.col("ka") + F.col("kb") - F.col("both")
    links = shared.where((F.col("both") / union > min_jaccard) & (F.col("both") >= min_matches)).select("a", "b").unionByName(stars)
    groups = components(links, "a", "b")
    # reads of one state are linked to each other if a read would be to its equal
    alone = (F.size("muts") > 0) & (F.size("muts") < min_matches)
    out = full.join(groups, F.col("state") == F.col("node"), "left")
    return out.select("read_id", "barcode", F.when(alone, F.col("read_id")).otherwise(F.coalesce("component", "state")).alias("cluster"))


def _always_similar(min_jaccard: float) -> int:
    """Up to how many calls two sets may have so that one in common makes their Jaccard similarity exceed ``min_jaccard``."""
    k = 0
    while k < 1_000 and 1 / (2 * (k + 1) - 1) > min_jaccard:
        k += 1
    return k


def merge_clusters(seeds: DataFrame, calls: DataFrame, max_diff: int = 1, min_jaccard: float = 0.2, min_quality: int = 0) -> DataFrame:
    """``read_id, barcode, cluster`` after small clusters have joined larger ones of similar barcodes.

    For each distance d up to ``max_diff``: two clusters with barcodes d apart are joined if their sizes
    differ by a factor of at least 2^d, all their barcodes lie within 2d of each other, and either
    neither has likely calls or the Jaccard similarity of their calls, taken over both clusters' likely calls, is
    above ``min_jaccard``. In a round, each cluster joins the best larger one (nearest, then
    largest, then smallest id), unless that one joins another itself in this round, when it waits for
    the next. Rounds end when nothing joins, as they must, since each join leaves one cluster less. So the result depends neither on the order of rows
    nor on partitions.

    Reads are read at the beginning and at the end. Between, there are counts of each cluster's calls and barcodes, which add up when
    clusters join; after the first round of a distance only clusters that changed are compared again, with each other and with the rest.
    """
    now = stage(seeds.select("read_id", "barcode", "cluster"), "clusters")
    pairs = family_neighbors(now.select(F.col("barcode").alias("seq")).distinct(), max_diff)
    edges = stage(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "dist")), "distances")
    one = calls.where("mut IS NOT NULL").groupBy("read_id", "mut").agg(F.max("q").alias("q"))
    sums = stage(now.select("read_id", "cluster").join(one, "read_id").groupBy("cluster", "mut").agg(F.count_if(F.col("q") > 0).alias("m"), F.coalesce(F.sum("q"), F.lit(0)).alias("q")), "sums")
    members = stage(_members(now.groupBy("cluster", "barcode").agg(F.count(F.lit(1)).alias("n")), sums, min_quality), "members")
    moved = None
    for d in range(1, max_diff + 1):
        alike, changed = None, None
        while True:
            near = _near(members, sums, edges, d, min_jaccard, min_quality, changed)
            fit = _within(near, members, d)
            if alike is not None:
                fit = fit.unionByName(_without(_without(alike, changed, "c1"), changed, "c2"))
            fit = stage(fit, "alike")
            best = fit.groupBy("c1").agg(F.min(F.struct((-F.col("n2")).alias("size"), "c2")).alias("b")).select(F.col("c1").alias("cluster"), F.col("b.c2").alias("into"))
            hooks = stage(best.join(best.select(F.col("cluster").alias("into")), "into", "left_anti").select("cluster", "into"), "hooks")
            for old in (near, alike):
                unstage(old)
            alike = fit
            if not hooks.limit(1).count():
                break
            changed = small(stage(hooks.unionByName(hooks.select(F.col("into").alias("cluster"), "into").distinct()), "changed"))
            told = stage(sums.join(changed, "cluster").groupBy("into", "mut").agg(F.sum("m").alias("m"), F.sum("q").alias("q")).withColumnRenamed("into", "cluster"), "sums")
            codes = members.join(changed, "cluster").groupBy("into", "barcode").agg(F.sum("n").alias("n")).withColumnRenamed("into", "cluster")
            news = [stage(_without(x, changed, "cluster").unionByName(y), name) for x, y, name in ((sums, told, "sums"), (members, _members(codes, told, min_quality), "members"))]
            onward = hooks if moved is None else stage(moved.join(hooks.select(F.col("cluster").alias("into"), F.col("into").alias("next")), "into", "left").select("cluster", F.coalesce("next", "into").alias("into")).unionByName(hooks), "moved")
            for old in (sums, members, told, moved):
                unstage(old)
            sums, members, moved = *news, onward
        unstage(alike)
        unstage(hooks)
    for old in (edges, sums, members):
        unstage(old)
    if moved is not None:
        now = now.join(small(moved), "cluster", "left").select("read_id", "barcode", F.coalesce("into", "cluster").alias("cluster"))
    first = now.groupBy("cluster").agg(F.min("read_id").alias("least"))
    return now.join(first, "cluster").select("read_id", "barcode", F.col("least").alias("cluster"))


def _without(rows: DataFrame, changed: DataFrame, column: str) -> DataFrame:
    return rows.join(changed.select(F.col("cluster").alias(column)), column, "left_anti")


def _likely(m: str, q: str, min_quality: int) -> Column:
    """Whether a call of ``m`` reads, with qualities of ``q`` in all, is a likely one."""
    return (F.col(q) > 0) & ((F.col(m) > 1) | (F.col(q) > min_quality))


def _members(codes: DataFrame, sums: DataFrame, min_quality: int) -> DataFrame:
    """``cluster, barcode, n, size, k, likely``: of each cluster and barcode the reads; of the cluster its reads, barcodes and likely calls."""
    sizes = codes.groupBy("cluster").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("k"))
    likely = sums.where(_likely("m", "q", min_quality)).groupBy("cluster").agg(F.count(F.lit(1)).alias("likely"))
    return codes.join(sizes.join(likely, "cluster", "left"), "cluster").select("cluster", "barcode", "n", "size", "k", F.coalesce("likely", F.lit(0).cast("bigint")).alias("likely"))


def _near(members: DataFrame, sums: DataFrame, edges: DataFrame, d: int, min_jaccard: float, min_quality: int, changed: DataFrame | None) -> DataFrame:
    """``c1, c2, n2, k1, k2``, staged: clusters d apart of which the first, by sizes and calls, may join the second; if some ``changed``, only pairs with one of those."""
    if changed is None:
        return stage(_close(members, members, sums, sums, edges, d, min_jaccard, min_quality), "near")
    own = lambda x: x.join(changed.select("cluster"), "cluster", "left_semi")
    these, theirs, rest = stage(own(members), "changed_members"), stage(own(sums), "changed_sums"), _without(members, changed, "cluster")
    near = _close(these, members, theirs, sums, edges, d, min_jaccard, min_quality).unionByName(_close(rest, these, sums, theirs, edges, d, min_jaccard, min_quality))
    near = stage(near, "near")
    unstage(these)
    unstage(theirs)
    return near


def _close(ones: DataFrame, twos: DataFrame, sums1: DataFrame, sums2: DataFrame, edges: DataFrame, d: int, min_jaccard: float, min_quality: int) -> DataFrame:
    """Pairs for ``_near`` of clusters of ``ones`` and ``twos``.

    The smaller cluster looks for the larger one by a barcode and a call, so clusters of a frequent barcode aren't paired unless
    they have a call in common, or neither has a likely one. Likely calls of both together are those of each, and among the common ones those that are likely in the sum.
    """
    one = ones.select(F.col("cluster").alias("c1"), F.col("barcode").alias("a"), F.col("size").alias("n1"), F.col("k").alias("k1"), F.col("likely").alias("l1"))
    two = twos.where(F.log2("size") >= d).select(F.col("cluster").alias("c2"), F.col("barcode").alias("b"), F.col("size").alias("n2"), F.col("k").alias("k2"), F.col("likely").alias("l2"))
    tops = two.groupBy("b").agg(F.max("n2").alias("top"))
    reach = one.join(edges.where(F.col("dist") <= d).join(tops, "b"), "a").where(F.log2(F.col("top") / F.col("n1")) >= d).groupBy("c1", "n1", "k1", "l1", "b").agg(F.min("dist").alias("dist"))
    fits = (F.col("c1") != F.col("c2")) & (F.log2(F.col("n2") / F.col("n1")) >= d)
    by = ["c1", "c2", "n2", "k1", "k2", "l1", "l2"]
    none = F.lit(None).cast("bigint")
    bare = reach.join(two, "b").where(fits) if min_jaccard < 0 else reach.where("l1 = 0").join(two.where("l2 = 0"), "b").where(fits)
    bare = bare.groupBy(*by).agg(F.min("dist").alias("dist"), none.alias("any"), none.alias("both"))
    m1, m2 = (s.select(F.col("cluster").alias(f"c{i}"), "mut", F.col("m").alias(f"m{i}"), F.col("q").alias(f"q{i}")) for i, s in ((1, sums1), (2, sums2)))
    wanted = two.join(reach.select("b").distinct(), "b", "left_semi").join(m2, "c2")
    shared = reach.join(m1, "c1").join(wanted, ["b", "mut"]).where(fits).groupBy(*by, "mut", "m1", "q1", "m2", "q2").agg(F.min("dist").alias("dist"))
    together = ((F.col("m1") + F.col("m2") > 1) | (F.col("q1") + F.col("q2") > min_quality)) & ((F.col("q1") > 0) | (F.col("q2") > 0))
    single = F.count_if(_likely("m1", "q1", min_quality)) + F.count_if(_likely("m2", "q2", min_quality))
    common = shared.groupBy(*by).agg(F.min("dist").alias("dist"), (F.count_if(together) - single).alias("any"), F.count_if(together & (F.col("q1") > 0) & (F.col("q2") > 0)).alias("both"))
    pairs = bare.unionByName(common).groupBy(*by).agg(F.min("dist").alias("dist"), F.coalesce(F.max("any"), F.lit(0)).alias("any"), F.coalesce(F.max("both"), F.lit(0)).alias("both"))
    union = F.col("l1") + F.col("l2") + F.col("any")
    return pairs.where((F.col("dist") == d) & ((union == 0) | (F.col("both") / F.nullif(union, F.lit(0)) > min_jaccard))).select("c1", "c2", "n2", "k1", "k2")


def _within(near: DataFrame, members: DataFrame, d: int) -> DataFrame:
    """``c1, c2, n2``: those of the pairs whose barcodes all lie within 2d of each other; of two clusters of one barcode each it is known."""
    several = near.where("k1 > 1 OR k2 > 1").select("c1", "c2", "n2")
    barcodes = lambda c, x: members.select(F.col("cluster").alias(c), F.col("barcode").alias(x))
    apart = several.join(barcodes("c1", "a"), "c1").join(barcodes("c2", "b"), "c2").groupBy("c1", "c2", "n2").agg(F.min(F.levenshtein("a", "b", 2 * d)).alias("worst"))
    return near.where("k1 = 1 AND k2 = 1").select("c1", "c2", "n2").unionByName(apart.where("worst >= 0").select("c1", "c2", "n2"))
