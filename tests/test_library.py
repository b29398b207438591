"""Library operators on small tables: hot keys, preclusters, collisions, dominance, merging."""

import pytest
from pyspark.sql import functions as F

from clonewell.operators import library as L
from clonewell.operators.skew import aggregate_hot_keys


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def hot(df, **kw):
    return aggregate_hot_keys(df, F.col("k"), F.col("id"), F.col("t").cast("timestamp"), **kw)


def test_hot_keys(spark):
    data = [("a", 1, "2026-01-01"), ("a", 2, "2026-01-02"), ("a", 3, "2026-01-02"), ("b", 4, None), (None, 5, "2026-01-01"), ("a", 2, "2026-01-02"), ("c", None, "2026-01-01")]
    df = spark.createDataFrame(data, "k string, id bigint, t string").withColumn("n_rows", F.lit("clash")).withColumn("key", F.lit(1))
    assert [(r.key, r.n_rows, r.line_id) for r in hot(df).orderBy("key").collect()] == [("a", 4, 2), ("b", 1, 4)]
    assert [r.key for r in hot(df, min_rows=2).collect()] == ["a"]
    assert hot(df.limit(0)).collect() == []
    assert hot(df, sums={"s": F.col("id")}).where("key = 'a'").first().s == 8


def test_hot_keys_one_key_holds_most(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 10 < 7, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id", F.timestamp_seconds("id").alias("t"))
    out = {r.key: r for r in hot(df).collect()}
    assert out["hot"].n_rows == 14000 and out["hot"].line_id == 19996 and len(out) == 6001


def test_hot_keys_are_combined_before_the_shuffle(spark):
    df = spark.range(10).select(F.lit("x").alias("k"), "id", F.timestamp_seconds("id").alias("t"))
    plan = hot(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan


def test_precluster(spark):
    df = spark.createDataFrame([("AC", "II", 2), ("AC", "]]", 1), ("GG", "5", 3), (None, "I", 4)], "b string, q string, id bigint")
    assert rows(L.precluster_members(df, F.col("b"), F.col("id"))) == [("AC", 1, 1, 2), ("AC", 1, 2, 2), ("GG", 3, 3, 1)]
    assert rows(L.precluster_quality(df, F.col("b"), F.col("q"))) == [("AC", 1, 93, 2), ("AC", 2, 93, 2), ("GG", 1, 20, 1)]


def test_collision_and_clean(spark):
    df = spark.createDataFrame([("x", 5), ("x", 2), ("y", 2), ("z", 1), (None, 9), (None, 8)], "b string, size int")
    tagged = L.tag_collisions(df, "b")
    assert rows(tagged) == sorted([("x", 5, "collision"), ("x", 2, "collision"), ("y", 2, ""), ("z", 1, ""), (None, 9, ""), (None, 8, "")], key=repr)
    assert rows(L.clean_rows(tagged)) == sorted([("y", 2, ""), (None, 9, ""), (None, 8, "")], key=repr)


def test_dominance(spark):
    df = spark.createDataFrame([("a", 5), ("a", 2), ("b", 2), ("b", 1), ("c", 1)], "b string, size int")
    assert rows(L.dominant(df, "b", "size", 0.666)) == [("a", 5), ("b", 2)]
    with pytest.raises(ValueError):
        L.dominant(df, "b", "size", 0.4)


def test_merge(spark):
    one = spark.createDataFrame([("x", "g1", 3), ("y", "g1", 1)], "barcode string, geno string, size int")
    two = spark.createDataFrame([("x", "g1", 2), ("x", "g2", 1), ("z", "g1", 4)], "barcode string, geno string, size int")
    assert rows(L.merge_libraries(one, two)) == [("x", "g1", 5, "merged"), ("x", "g2", 1, "conflict"), ("y", "g1", 1, "first"), ("z", "g1", 4, "new")]


def test_histogram_and_conversion(spark):
    df = spark.createDataFrame([(1,), (1,), (7,), (9,), (None,)], "v int")
    assert rows(L.histogram(df, F.col("v"), cap=5, fill=True)) == [(1, 2), (2, 0), (3, 0), (4, 0), (5, 2)]
    lib = spark.createDataFrame([("AACC", "AA")], "virtual string, up string")
    assert [L.convert_library(lib, m).first().barcode for m in ("same", "up", "down")] == ["AACC", "AA", "CC"]
    with pytest.raises(ValueError):
        L.convert_library(lib, "odd")


def test_join_libraries(spark):
    one = spark.createDataFrame([("x", "g1", "v1", 3), ("x", "g1", "v2", 5), ("x", "g1", "v3", 5), ("y", "g1", "v4", 1), (None, "g1", "v5", 1)], "up string, geno string, virtual string, size bigint")
    two = spark.createDataFrame([("x", "g1", "w1", 2), ("x", "g1", "w2", 4), ("x", "g2", "w3", 1), ("z", "g1", "w4", 7)], "up string, geno string, virtual string, size bigint")
    out = L.join_libraries(one, two, ["up", "geno"], "virtual")
    assert rows(out) == sorted([("x", "g1", "v1", 3, "first"), ("x", "g1", "v2", 11, "merged"), ("x", "g1", "v3", 5, "first"), ("x", "g2", None, 1, "conflict"), ("y", "g1", "v4", 1, "first"), ("z", "g1", None, 7, "new")], key=repr)
    reads = lambda d, mark: d.where("up IS NOT NULL").select("up", "geno", "virtual", F.concat(F.lit(mark), "virtual").alias("row_id"))
    members = L.join_members(reads(one, "a"), reads(two, "b"), out, ["up", "geno"], "virtual")
    assert {r.row_id for r in members.where("virtual = 'v2'").collect()} == {"av2", "bw1", "bw2"} and members.count() == 8
    assert L.join_libraries(one.limit(0), two, ["up", "geno"], "virtual").count() == 3 and L.join_libraries(one, two.limit(0), ["up", "geno"], "virtual").count() == 4
    assert L.first_columns(one, 2).columns == ["up", "geno"]
