"""Connected components of clustering graphs by hooking and shortcutting labels."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, functions as F

from clonewell.session import stage, unstage


def components(edges: DataFrame, a: str, b: str, max_rounds: int | None = None) -> DataFrame:
    """``node, component``: every node of an edge with the smallest node it is linked to, directly or not.

    In each round a node learns the least label among its neighbours; its own label's node takes that label too
    (so whole groups hook onto smaller ones at once, wherever they touch), and then every label is replaced by its
    label's label. The number of rounds grows with the logarithm of the longest path; labels only fall, so rounds end (``max_rounds``
    may bound them, for tests). Labels are staged in the shared folder, and only whether one changed reaches the driver.

    Least labels are map-side aggregates; the joins have one row per node on one side, so partitions of hubs
    and large groups are split by adaptive skew handling. Null ends are ignored; a loop makes its
    node a component; no edges give no rows.
    """
    links = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    links = stage(links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = stage(links.groupBy(F.col("u").alias("node")).agg(F.least("u", F.min("v")).alias("label")), "labels")
    for _ in range(max_rounds) if max_rounds is not None else count():
        near = links.join(labels.select(F.col("node").alias("v"), "label"), "v").groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near"))
        told = stage(labels.join(near, "node").select("node", "label", F.least("label", "near").alias("near")), "near")
        hooks = told.groupBy(F.col("label").alias("node")).agg(F.min("near").alias("hook"))
        hooked = stage(told.join(hooks, "node", "left").select("node", "label", F.least("near", "hook").alias("new")), "hooked")
        jump = hooked.select(F.col("node").alias("new"), F.col("new").alias("jump"))
        new = stage(hooked.join(jump, "new").select("node", F.col("jump").alias("label"), (F.col("jump") != F.col("label")).alias("changed")), "labels")
        changed = new.where("changed").limit(1).count()
        for old in (labels, told, hooked):
            unstage(old)
        labels = new
        if not changed:
            unstage(links)
            return labels.select("node", F.col("label").alias("component"))
    raise RuntimeError(f"labels still changed after {max_rounds} rounds")
