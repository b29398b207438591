"""Enrichment on counts whose scores were worked out by hand."""

import pytest
from pyspark.sql import functions as F

from clonewell.operators import enrich as E

COUNTS = {"wt": (100, 80, 60, 50), "stop": (100, 120, 10, 20), "mis": (50, 50, 30, 30), "rare": (150, 150, 0, 0)}
SAMPLES = [("a1", "A", "All", 1), ("a2", "A", "All", 2), ("f1", "A", "F5", 1), ("f2", "A", "F5", 2)]


@pytest.fixture(scope="module")
def lrs(spark):
    samples = spark.createDataFrame(SAMPLES, "sample string, assay string, cond string, replicate int")
    counts = spark.createDataFrame([(r, s[0], n) for r, ns in COUNTS.items() for s, n in zip(SAMPLES, ns) if n], "lib_row string, sample string, n bigint")
    stats = E.replicate_stats(E.frequencies(counts, samples), samples)
    pseudo = E.pseudocount(stats)
    assert abs(pseudo.first().pseudo - 0.1) < 1e-12
    return E.log_ratios(stats, pseudo)


def test_log_ratios_and_scores(spark, lrs):
    got = {r.lib_row: r for r in lrs.collect()}
    for row, lr, sd in (("wt", 0.460731, 0.083001), ("stop", -0.041393, 0.134931), ("mis", 0.505150, 0), ("rare", -0.574031, 0)):
        assert got[row].lr == pytest.approx(lr, abs=1e-6) and got[row].sd == pytest.approx(sd, abs=1e-6)
    medians = E.control_medians(lrs, F.col("lib_row") == "wt", F.col("lib_row") == "stop")
    scores = {r.lib_row: (r.score, r.sd) for r in E.scores(lrs, medians).collect()}
    for row, score, sd in (("wt", 1, 0.165300), ("stop", 0, 0.268722), ("mis", 1.088463, 0), ("rare", -1.060772, 0)):
        assert scores[row] == (pytest.approx(score, abs=1e-6), pytest.approx(sd, abs=1e-6))


def test_filters(lrs):
    assert {r.lib_row for r in E.passing(lrs, 0.125).collect()} == {"wt", "stop", "mis", "rare"}
    assert {r.lib_row for r in E.passing(lrs, 0.125, strict=True).collect()} == {"wt", "stop", "rare"}
    assert {r.lib_row for r in E.passing(lrs, 0.0, bottleneck=0.2).collect()} == {"wt", "mis"}


def test_joined_estimate(spark):
    df = spark.createDataFrame([("x", 1.0, 1.0), ("x", 2.0, 0.5), ("y", 3.0, 0.0), ("z", 1.0, None)], "k string, m double, s double")
    m, s, d = E.joined_estimate(F.col("m"), F.col("s"), F.lit(2))
    got = {r.k: (r.m, r.s, r.d) for r in df.groupBy("k").agg(m.alias("m"), s.alias("s"), d.alias("d")).collect()}
    assert got["x"] == (pytest.approx(1.666667, abs=1e-6), pytest.approx(0.849837, abs=1e-6), 4)
    assert got["y"] == (3.0, 0.0, 2) and got["z"] == (1.0, None, 2)


def test_inferred(spark):
    data = [("ab", ["a", "b"], 0.4, 0.1), ("b", ["b"], 0.8, 0.2), ("ac", ["a", "c"], 0.5, 0.1), ("w", ["="], 1.0, 0.1)]
    est = {r.mut: r for r in E.variant_estimates(spark.createDataFrame(data, "clone string, muts array<string>, score double, sd double"), 2).collect()}
    assert est["a"].score_single is None and est["a"].score_infer == pytest.approx(0.5) and est["a"].sd_infer == pytest.approx(0.176777, abs=1e-6)
    assert est["b"].score_single == 0.8 and est["c"].score_infer is None
    joint = {r.mut: r for r in E.joint_table(spark.createDataFrame([r for r in est.values()], "mut string, score_multi double, sd_multi double, df_multi bigint, score_single double, sd_single double, df_single bigint, score_infer double, sd_infer double, df_infer bigint")).collect()}
    assert "=" not in joint and joint["b"].score == 0.8 and joint["c"].score == 0.5


def test_one_replicate_has_no_sd(spark):
    samples = spark.createDataFrame(SAMPLES[::2], "sample string, assay string, cond string, replicate int")
    counts = spark.createDataFrame([("x", "a1", 5), ("x", "f1", 5)], "lib_row string, sample string, n bigint")
    assert [r.sd for r in E.replicate_stats(E.frequencies(counts, samples), samples).collect()] == [None, None]
    empty = counts.limit(0)
    assert E.replicate_stats(E.frequencies(empty, samples), samples).collect() == []


def test_a_clone_with_a_stop_counts_for_the_stop_only(spark):
    data = [("s", ["W5*"], 2, 0.1, 0.1), ("m", ["A2V"], 1, 0.8, 0.1)]
    clones = spark.createDataFrame(data, "clone string, muts array<string>, k int, score double, sd double")
    est = {r.mut: r for r in E.variant_estimates(clones, 2).collect()}
    assert est["W5*"].score_single is None and est["W5*"].score_multi == 0.1 and est["A2V"].score_multi == 0.8


def test_exact_medians(spark):
    import random
    from statistics import median

    r = random.Random(4)
    rows = [(r.choice(["x", "y", None]), None if r.random() < 0.1 else round(r.gauss(0, 1), 1)) for _ in range(2001)] + [("z", 1.0), ("z", 2.0), ("w", float("nan")), ("w", None)]
    got = {x.k: x["median"] for x in E.exact_medians(spark.createDataFrame(rows, "k string, v double"), ["k"], "v").collect()}
    assert got == {k: pytest.approx(median(v for q, v in rows if q == k and v is not None)) for k in ("x", "y", "z", None)}
    assert E.exact_medians(spark.createDataFrame([], "k string, v double"), ["k"], "v").collect() == []


def test_given_medians_and_bottleneck(spark, lrs):
    medians = E.control_medians(lrs, F.col("lib_row") == "wt", F.col("lib_row") == "none", given=(None, -1.5)).first()
    assert medians.wt_med == pytest.approx(0.460731, abs=1e-6) and medians.null_med == -1.5
    stats = spark.createDataFrame([("a", "A", "All", 5.0), ("a", "A", "F5", 1.0), ("b", "A", "All", 2.0), ("b", "A", "F5", 2.0)], "lib_row string, assay string, cond string, mean_count double")
    assert [r.lib_row for r in E.wide_enough(stats, 2).collect()] == ["b"]
