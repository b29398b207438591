"""Survivors, percentiles, match groups and frequent items against brute force, with nulls, ties, repeats and empty tables."""

import math
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from clonewell.llm.frequent import frequent_items
from clonewell.llm.percentiles import merge_counts, percentiles, value_counts
from clonewell.llm.star_components import star_components
from clonewell.llm.survivors import NO_RANK, surviving_records, surviving_values

QUIET = dict(deadline=None, suppress_health_check=list(HealthCheck))
RECORDS = "g bigint, id bigint, a string, b string, rank int, t bigint, movie string, row_id string"


def survivors(df, f=surviving_values, **kw):
    time = F.timestamp_seconds("t")
    if f is surviving_values:
        return f(df, {"g": F.col("g")}, F.col("id"), {"a": F.col("a").isNotNull(), "b": F.col("b").isNotNull()}, F.col("rank"), time, **kw)
    return f(df, {"g": F.col("g")}, F.col("id"), {n: (F.col(n), F.col(n).isNotNull()) for n in "ab"}, F.col("rank"), time, **kw)


def best(records):
    groups, out = defaultdict(list), set()
    for r in records:
        if r[0] is not None and r[1] is not None:
            groups[r[0]].append(r)
    for g, rows in groups.items():
        for k, field in ((2, "a"), (3, "b")):
            usable = [r for r in rows if r[k] is not None]
            if len(rows) > 1 and usable:
                win = min(usable, key=lambda r: (NO_RANK if r[4] is None else r[4], math.inf if r[5] is None else -r[5], r[1]))
                out.add((g, field, win[1]))
    return out


maybe = lambda s: st.one_of(st.none(), s)
record = st.tuples(maybe(st.integers(1, 3)), maybe(st.integers(1, 30)), maybe(st.just("x")), maybe(st.just("y")), maybe(st.integers(1, 3)), maybe(st.integers(0, 3)), st.just("m"), st.just("r"))


@settings(max_examples=15, **QUIET)
@given(st.lists(record, max_size=25))
def test_survivors(spark, records):
    got = {(r.g, r.field, r.row_id) for r in survivors(spark.createDataFrame(records, RECORDS)).collect()}
    assert got == best(records)


def test_survivor_layers_and_records(spark):
    rows = [(1, 1, "a1", None, 1, 5, "", ""), (1, 2, None, "b2", 2, 9, "", ""), (1, 3, "a3", "b3", 3, 1, "", ""), (2, 9, "z", None, None, None, "", "")]
    df = spark.createDataFrame(rows, RECORDS)
    assert sorted((r.field, r.row_id, r.layer, r.n_rows) for r in survivors(df).collect()) == [("a", 1, 1, 3), ("b", 2, 1, 3)]
    assert [tuple(r) for r in survivors(df, surviving_records).collect()] == [(1, 3, "a1", "b2")]
    assert [r.row_id for r in survivors(df, min_rows=1).where("g = 2").collect()] == [9]
    assert survivors(df.limit(0)).collect() == [] and survivors(df.limit(0), surviving_records).collect() == []


def test_gaps_are_filled_from_the_second_layer(spark):
    """By number of usable fields, the newest and most trusted record dominates one that has the other field."""
    rows = [(1, 1, "a1", None, 1, 9, "", ""), (1, 2, None, "b2", 2, 5, "", ""), (1, 3, None, "b3", 3, 7, "", ""), (1, 4, "a4", "b4", 4, 1, "", "")]
    df = spark.createDataFrame(rows, RECORDS)
    got = {r.field: (r.row_id, r.layer) for r in survivors(df, completeness="number").collect()}
    assert got == {"a": (1, 1), "b": (4, 1)}, "the complete record is in the first layer"
    got = {r.field: (r.row_id, r.layer) for r in survivors(df.where("id < 4"), completeness="number").collect()}
    assert got == {"a": (1, 1), "b": (2, 2)}, "the gap is filled from the second"
    assert {r.field: (r.row_id, r.layer) for r in survivors(df.where("id < 4")).collect()} == {"a": (1, 1), "b": (2, 1)}
    assert [tuple(r) for r in survivors(df.where("id < 4"), surviving_records, completeness="number").collect()] == [(1, 3, "a1", "b2")]
    with pytest.raises(ValueError):
        survivors(df, completeness="most")


def test_survivors_of_a_group_with_most_rows(spark):
    df = spark.range(30000).selectExpr("if(id % 3 = 0, -1, id) AS g", "id", "if(id % 7 = 0, 'a', null) AS a", "'b' AS b", "cast(id % 5 as int) AS rank", "id % 1000 AS t")
    got = {(r.g, r.field): r.row_id for r in survivors(df).collect()}
    hot = [i for i in range(0, 30000, 3) if i % 5 == 0]
    late = max(i % 1000 for i in hot)
    assert got[-1, "b"] == min(i for i in hot if i % 1000 == late)
    late = max(i % 1000 for i in hot if i % 7 == 0)
    assert got[-1, "a"] == min(i for i in hot if i % 7 == 0 and i % 1000 == late) and len(got) == 2


def rank_of(values, fraction):
    s = sorted(values)
    return s[max(0, math.ceil(round(fraction * len(s), 9)) - 1)]


def test_percentiles_exact_and_merged_over_days(spark):
    r = random.Random(3)
    rows = [(r.choice(["x", "y", None]), r.randint(1, 4), r.choice([None, float("nan"), *range(-5, 40)]), "n") for _ in range(3000)]
    rows = [(k, d, None if v is None else float(v), n) for k, d, v, n in rows]
    df = spark.createDataFrame(rows, "k string, d int, v double, n string")
    daily = value_counts(df, {"k": F.col("k"), "d": F.col("d")}, F.col("v"))
    whole = merge_counts(daily, ["k"])
    got = {(x.k, x.fraction): (x.value, x.total) for x in percentiles(whole, ["k"], ["0.01", 0.5, 0.95, 1], partitions=7).collect()}
    for key in ("x", "y", None):
        vals = [v for k, _, v, _ in rows if k == key and v is not None and v == v]
        for f in (0.01, 0.5, 0.95, 1.0):
            assert got[key, f] == (rank_of(vals, f), len(vals))


def test_percentiles_of_stored_days_that_were_not_merged(spark, tmp_path):
    r = random.Random(8)
    rows = [(d, r.randint(0, 6)) for d in range(5) for _ in range(200)]
    for d in range(5):  # each day's summary is stored when it comes
        day = spark.createDataFrame([x for x in rows if x[0] == d], "d int, v int")
        value_counts(day, {"g": F.lit("x"), "d": F.col("d")}, F.col("v")).write.parquet(str(tmp_path / f"day={d}"))
    stored = spark.read.parquet(*(str(tmp_path / f"day={d}") for d in range(5)))
    for counts in (stored, merge_counts(stored, ["g"])):
        got = {x.fraction: (x.value, x.total) for x in percentiles(counts, ["g"], [0.1, 0.5, 0.99]).collect()}
        assert got == {f: (rank_of([v for _, v in rows], f), 1000) for f in (0.1, 0.5, 0.99)}
    three = percentiles(stored.where("d < 3"), ["g"], [0.5]).collect()
    assert [(x.value, x.total) for x in three] == [(rank_of([v for d, v in rows if d < 3], 0.5), 600)]


def test_percentile_error_is_bounded(spark):
    df = spark.range(1, 20001).select((F.col("id") * F.col("id")).cast("double").alias("v"))
    counts = value_counts(df, {"g": F.lit(1)}, F.col("v"), relative_error=0.01)
    assert counts.count() < 1100
    for row in percentiles(counts, ["g"], [0.1, 0.5, 0.9]).collect():
        true = math.ceil(row.fraction * 20000) ** 2
        assert true / 1.011 <= row.value <= true * 1.011


def test_percentile_edges(spark):
    df = spark.createDataFrame([(1, 5, 3), (1, 7, 0), (1, 9, 1)], "g int, v int, w int")
    counts = value_counts(df, {"g": F.col("g")}, F.col("v"), F.col("w"))
    assert [(r.value, r.total) for r in percentiles(counts, ["g"], [0.75, 0.76]).orderBy("fraction").collect()] == [(5, 4), (9, 4)]
    assert percentiles(counts.limit(0), ["g"], [0.5]).collect() == []
    with pytest.raises(ValueError):
        percentiles(counts, ["g"], [0])


def groups_of(pairs):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            a, b = sorted((root(a), root(b)))
            up[b] = a
    return {(root(x), x) for x in up}


@settings(max_examples=8, **QUIET)
@given(st.lists(st.tuples(maybe(st.integers(0, 15)), maybe(st.integers(0, 15))), max_size=20))
def test_star_components(spark, pairs):
    df = spark.createDataFrame([(a, b, "u") for a, b in pairs], "x bigint, y bigint, u string")
    assert {(r.group_id, r.node) for r in star_components(df, F.col("x"), F.col("y")).collect()} == groups_of(pairs)


def test_star_components_chain_and_hub(spark):
    chain = [(i, i + 1) for i in range(100, 400)] + [(i + 1, i) for i in range(100, 110)]
    hub = [(5000, i) for i in range(6000, 8000)]
    df = spark.createDataFrame(chain + hub, "x bigint, y bigint")
    got = star_components(df, F.col("x"), F.col("y"))
    assert {(r.group_id, r["count"]) for r in got.groupBy("group_id").count().collect()} == {(100, 301), (5000, 2001)}


def test_frequent_items(spark):
    r = random.Random(1)
    items = [f"v{int(r.paretovariate(0.8))}" for _ in range(8000)]
    df = spark.createDataFrame([(x, 1) for x in items] + [(None, 1)] * 50, "it string, n int")
    count = Counter(items)
    want = sorted(count.items(), key=lambda x: (-x[1], x[0]))
    for levels in ((4, 10, 24), (2,)):
        got = [(x["item"], x["n"]) for x in frequent_items(df, F.col("it"), k=15, levels=levels).collect()]
        assert got == want[:15]
        share = {(x["item"], x["n"]) for x in frequent_items(df, F.col("it"), min_share=0.01, levels=levels).collect()}
        assert share == {(v, n) for v, n in want if n * 100 >= len(items)}


def test_frequent_items_with_too_many_prefixes_to_broadcast(spark, monkeypatch):
    import clonewell.llm.frequent as f

    monkeypatch.setattr(f, "BROADCAST_ROWS", 3)
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 400).cast("string")).alias("item"))
    count = Counter(r[0] for r in df.collect())
    want = sorted(count.items(), key=lambda x: (-x[1], x[0]))[:5]
    assert [(x["item"], x["n"]) for x in frequent_items(df, F.col("item"), k=5, levels=(6, 12)).collect()] == want


@pytest.mark.parametrize("named", [0, 7, 10_000])
def test_frequent_items_of_a_flat_head(spark, monkeypatch, named):
    """All prefixes are kept; nothing depends on how many items are named."""
    import clonewell.llm.frequent as f

    monkeypatch.setattr(f, "NAMED", named)
    df = spark.range(40_000).select((F.col("id") % 2000).cast("string").alias("item")).unionByName(spark.range(5).select(F.lit("7").alias("item")))
    want = sorted(Counter(r[0] for r in df.collect()).items(), key=lambda x: (-x[1], x[0]))[:30]
    assert [(x["item"], x["n"]) for x in frequent_items(df, F.col("item"), k=30, levels=(4, 8, 22)).collect()] == want


def test_no_raw_rows_are_shuffled(spark):
    """Whatever is exchanged, between tasks or to all of them, are aggregates."""
    import clonewell.llm.frequent as f

    rows = spark.range(1000).select((F.col("id") % 9).cast("string").alias("item")).withColumn("_h", F.xxhash64("item"))
    kept = f._count(rows, None, 10).where("n > 100")
    below = f._keep(rows, kept, 10)
    for df in (below, f._count(below, kept.limit(5).select(F.col("rep").alias("_named")), 20), f._items(below, 1, None)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = plan.splitlines()
        shuffles = [k for k, x in enumerate(lines) if "Exchange hashpartitioning" in x or "Exchange SinglePartition" in x]
        assert "SortMergeJoin" not in plan and "SortAggregate" not in plan and shuffles
        assert all("Aggregate" in lines[k + 1] or "Limit" in lines[k + 1] or "Range" in lines[k + 2] for k in shuffles), plan


def test_frequent_items_edges(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("",)], "item string")
    assert [(x["item"], x["n"]) for x in frequent_items(df, F.col("item"), k=2).collect()] == [("", 1), ("a", 1)]
    assert frequent_items(df.limit(0), F.col("item"), k=2).collect() == []
    assert frequent_items(df.where("item IS NULL"), F.col("item"), min_share=0.5).collect() == []
    assert [x["share"] for x in frequent_items(df, F.col("item"), min_share=1 / 3).collect()] == [1 / 3] * 3
    with pytest.raises(ValueError):
        frequent_items(df, F.col("item"))
