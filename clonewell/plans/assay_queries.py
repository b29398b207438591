"""Queries of the assay side: counts, frequencies, log ratios, scores, variants and their quality tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window as W

from clonewell.functions import seq as S
from clonewell.operators import enrich as E
from clonewell.plans import base as B
from clonewell.session import small, stage, table

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    """Registers a query, and its SQL if it has one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# Fixed value: the frequency from which on a library row is well measured.
FREQ = 0.0002
#: Digits kept in results that are doubles, so that summation order doesn't show.
ROUND = 9


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, ROUND) for n in names})


def _stats(spark: SparkSession, folder: str) -> DataFrame:
    """Staged, since pseudocount, baseline and conditions each read it."""
    s = B.samples(spark, folder)
    freqs = stage(E.frequencies(B.variant_counts(spark, folder), s), "frequencies")
    return stage(E.replicate_stats(freqs, s), "stats")


def _lrs(spark: SparkSession, folder: str) -> DataFrame:
    stats = _stats(spark, folder)
    return E.log_ratios(stats, E.pseudocount(stats))


_STATS = """, tot AS (SELECT sample, sum(n) AS t FROM vc GROUP BY sample),
 fr AS (SELECT lib_row, assay, cond, replicate, n, n / t::DOUBLE AS freq FROM vc JOIN tot USING (sample) JOIN smp USING (sample)),
 grid AS (SELECT lib_row, sample, assay, cond FROM (SELECT DISTINCT lib_row FROM vc), smp WHERE sample IN (SELECT sample FROM smp)),
 dense AS (SELECT g.lib_row, g.assay, g.cond, coalesce(v.n, 0) AS n, coalesce(v.n / t.t::DOUBLE, 0) AS freq FROM grid g LEFT JOIN vc v ON v.lib_row = g.lib_row AND v.sample = g.sample LEFT JOIN tot t ON t.sample = g.sample),
 st AS (SELECT lib_row, assay, cond, avg(freq) AS mean, stddev_samp(freq) AS sd, avg(n) AS mean_count FROM dense GROUP BY ALL),
 ps AS (SELECT CASE WHEN count(*) = 2 AND max(m) > 0 THEN pow(10.0, floor(log10(max(m)))) END AS pseudo FROM (SELECT DISTINCT mean AS m FROM st ORDER BY m LIMIT 2)),
 lr AS (SELECT a.lib_row, a.assay, a.cond, CASE WHEN a.mean + pseudo > 0 AND b.mean > 0 THEN log10(a.mean + pseudo) - log10(b.mean) END AS lr,
   CASE WHEN a.mean + pseudo > 0 AND b.mean > 0 THEN sqrt(pow(a.sd / (2.302585092994046 * (a.mean + pseudo)), 2) + pow(b.sd / (2.302585092994046 * b.mean), 2)) END AS sd, b.mean AS allfreq, a.mean AS freq
   FROM st a JOIN st b ON b.lib_row = a.lib_row AND b.assay = a.assay AND b.cond = 'All', ps WHERE a.cond <> 'All'),
 med AS (SELECT assay, cond, median(lr) FILTER (WHERE lr IS NOT NULL AND lib_row = '=' AND allfreq > 0) AS wt_med, median(lr) FILTER (WHERE lr IS NOT NULL AND regexp_matches(lib_row, 'del|ins') AND allfreq > 0.0002) AS null_med FROM lr GROUP BY ALL),
 sc AS (SELECT lib_row, assay, cond, (lr - null_med) / nullif(wt_med - null_med, 0) AS score, sd / abs(nullif(wt_med - null_med, 0)) AS sd, allfreq, freq FROM lr JOIN med USING (assay, cond)) """
_V = B.with_tables("vc") + _STATS


@query(B.with_tables("vc") + "SELECT lib_row, sample, n FROM vc")
def sample_counts(spark: SparkSession, folder: str) -> DataFrame:
    return B.variant_counts(spark, folder)


@query(_V + "SELECT lib_row, assay, cond, replicate, n, round(freq, 9) AS freq FROM fr")
def count_frequencies(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(E.frequencies(B.variant_counts(spark, folder), B.samples(spark, folder)), "freq")


@query(_V + "SELECT lib_row, assay, cond, round(mean, 9) AS mean, round(sd, 9) AS sd, round(mean_count, 9) AS mean_count FROM st")
def replicate_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_stats(spark, folder), "mean", "sd", "mean_count")


@query(_V + "SELECT lib_row, assay, cond, round(lr, 6) AS lr, round(sd, 6) AS sd, round(allfreq, 9) AS allfreq, round(freq, 9) AS freq FROM lr")
def log_ratios(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_lrs(spark, folder), "allfreq", "freq").withColumns({n: F.round(n, 6) for n in ("lr", "sd")})


def _scores(spark: SparkSession, folder: str) -> DataFrame:
    lrs = stage(_lrs(spark, folder), "ratios")
    wt, null = F.col("lib_row") == "=", F.col("lib_row").rlike("del|ins") & (F.col("allfreq") > FREQ)
    return E.scores(lrs, E.control_medians(lrs, wt, null))


@query(_V + "SELECT lib_row, assay, cond, round(score, 5) AS score, round(sd, 5) AS sd, round(allfreq, 9) AS allfreq FROM sc")
def enrichment_scores(spark: SparkSession, folder: str) -> DataFrame:
    s = _scores(spark, folder)
    return s.select("lib_row", "assay", "cond", F.round("score", 5).alias("score"), F.round("sd", 5).alias("sd"), F.round("allfreq", 9).alias("allfreq"))


@query(_V + "SELECT assay, cond, round(wt_med, 6) AS wt_med, round(null_med, 6) AS null_med FROM med")
def control_medians(spark: SparkSession, folder: str) -> DataFrame:
    wt, null = F.col("lib_row") == "=", F.col("lib_row").rlike("del|ins") & (F.col("allfreq") > FREQ)
    return E.control_medians(_lrs(spark, folder), wt, null).select("assay", "cond", F.round("wt_med", 6).alias("wt_med"), F.round("null_med", 6).alias("null_med"))


@query(_V + "SELECT lib_row, assay, cond FROM lr WHERE allfreq >= 0.0002 AND freq >= 0.0001")
def frequency_filter(spark: SparkSession, folder: str) -> DataFrame:
    return E.passing(_lrs(spark, folder), FREQ, bottleneck=0.0001).select("lib_row", "assay", "cond")


@query(_V + "SELECT lib_row, assay FROM st GROUP BY ALL HAVING bool_and(mean_count >= 2)")
def bottleneck_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that may be controls: with a mean of two reads at least in every condition of the assay."""
    return E.wide_enough(_stats(spark, folder), 2)


@query(
    _V
    + """, ok AS (SELECT lib_row, assay FROM st GROUP BY ALL HAVING bool_and(mean_count >= 2)), m AS (SELECT assay, cond, median(lr) FILTER (WHERE lr IS NOT NULL AND regexp_matches(lib_row, 'del|ins') AND allfreq > 0) AS null_med FROM lr JOIN ok USING (lib_row, assay) GROUP BY ALL)
    SELECT lib_row, assay, cond, round((lr - null_med) / nullif(0.05 - null_med, 0), 5) AS score FROM lr JOIN m USING (assay, cond)"""
)
def scores_by_given_median(spark: SparkSession, folder: str) -> DataFrame:
    """Scores with a given median of the wild type; null rows are measured where they pass the bottleneck in all conditions."""
    stats = _stats(spark, folder)
    lrs = stage(E.log_ratios(stats, E.pseudocount(stats)), "ratios")
    controls = lrs.join(E.wide_enough(stats, 2), ["lib_row", "assay"], "left_semi")
    medians = E.control_medians(controls, F.lit(False), F.col("lib_row").rlike("del|ins"), given=(0.05, None))
    return E.scores(lrs, medians).select("lib_row", "assay", "cond", F.round("score", 5).alias("score"))


@query(
    _V
    + """SELECT lib_row, assay, CASE WHEN lib_row = '=' THEN 'WT' WHEN regexp_matches(lib_row, 'del|ins') THEN 'fs' ELSE 'sub' END AS class,
    CAST(floor(log10(allfreq) / 0.05) AS BIGINT) AS bin, cond, round(sd / abs(lr), 5) AS cv FROM lr WHERE allfreq > 0 AND lr IS NOT NULL AND sd IS NOT NULL AND abs(lr) > 1e-9"""
)
def frequency_against_cv(spark: SparkSession, folder: str) -> DataFrame:
    r = _lrs(spark, folder).where("allfreq > 0 AND lr IS NOT NULL AND sd IS NOT NULL AND abs(lr) > 1e-9")
    label = F.when(F.col("lib_row") == "=", "WT").when(F.col("lib_row").rlike("del|ins"), "fs").otherwise("sub")
    cv = F.round(F.col("sd") / F.abs("lr"), 5)
    return r.select("lib_row", "assay", label.alias("class"), F.floor(F.log10("allfreq") / 0.05).alias("bin"), "cond", cv.alias("cv"))


@query(_V + "SELECT cond, bin, count(*) AS n FROM (SELECT cond, CAST(floor(log10(mean + pseudo) / 0.05) AS BIGINT) AS bin FROM st, ps) GROUP BY ALL")
def frequency_histogram(spark: SparkSession, folder: str) -> DataFrame:
    stats = _stats(spark, folder)
    with_ps = stats.crossJoin(F.broadcast(E.pseudocount(stats)))  # one row
    return with_ps.groupBy("cond", F.floor(F.log10(F.col("mean") + F.col("pseudo")) / 0.05).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query(
    B.with_tables("vc").replace("vc AS (", "vc AS MATERIALIZED (")
    + """, k AS (SELECT assay, cond, count(*) AS k FROM smp GROUP BY ALL), c AS MATERIALIZED (SELECT lib_row, assay, cond, sum(n) AS n FROM vc JOIN smp USING (sample) GROUP BY ALL), l AS (SELECT DISTINCT lib_row FROM vc)
    SELECT l.lib_row, a.assay, a.cond, round(coalesce(x.n, 0) / a.k::DOUBLE - coalesce(y.n, 0) / b.k::DOUBLE, 9) AS change FROM l CROSS JOIN k a JOIN k b ON b.assay = a.assay AND b.cond = 'All'
    LEFT JOIN c x ON x.lib_row = l.lib_row AND x.assay = a.assay AND x.cond = a.cond LEFT JOIN c y ON y.lib_row = l.lib_row AND y.assay = a.assay AND y.cond = 'All' WHERE a.cond <> 'All'"""
)
def count_change(spark: SparkSession, folder: str) -> DataFrame:
    st = _stats(spark, folder)
    base = st.where("cond = 'All'").select("lib_row", "assay", F.col("mean_count").alias("c0"))
    return st.where("cond <> 'All'").join(base, ["lib_row", "assay"]).select("lib_row", "assay", "cond", F.round(F.col("mean_count") - F.col("c0"), ROUND).alias("change"))


@query(_V + "SELECT x.assay, x.cond, round(corr(x.freq, y.freq), 6) AS r, count(*) AS n FROM (SELECT lib_row, assay, cond, sum(freq) AS freq FROM fr WHERE replicate = 1 GROUP BY ALL) x JOIN (SELECT lib_row, assay, cond, sum(freq) AS freq FROM fr WHERE replicate = 2 GROUP BY ALL) y USING (lib_row, assay, cond) GROUP BY x.assay, x.cond")
def replicate_correlation(spark: SparkSession, folder: str) -> DataFrame:
    f = E.frequencies(B.variant_counts(spark, folder), B.samples(spark, folder))
    one, two = (f.where(F.col("replicate") == k).groupBy("lib_row", "assay", "cond").agg(F.sum("freq").alias(f"f{k}")) for k in (1, 2))
    return one.join(two, ["lib_row", "assay", "cond"]).groupBy("assay", "cond").agg(F.round(F.corr("f1", "f2"), 6).alias("r"), F.count(F.lit(1)).alias("n"))


@query(
    _V
    + """, w AS (SELECT lib_row, score, sd FROM sc WHERE score IS NOT NULL), g AS (SELECT lib_row, count(*) AS n, sum(score / sd) FILTER (WHERE sd > 0) / sum(1 / sd) FILTER (WHERE sd > 0) AS m,
    sum((sd * sd + score * score) / sd) FILTER (WHERE sd > 0) / sum(1 / sd) FILTER (WHERE sd > 0) AS s2, max(score) AS one, max(sd) AS one_sd FROM w GROUP BY lib_row)
    SELECT lib_row, n, round(CASE WHEN n = 1 THEN one ELSE m END, 5) AS score, round(CASE WHEN n = 1 THEN one_sd ELSE sqrt(greatest(s2 - m * m, 0)) END, 4) AS sd FROM g"""
)
def joined_scores(spark: SparkSession, folder: str) -> DataFrame:
    s = _scores(spark, folder).where("score IS NOT NULL")
    m, sd, _ = E.joined_estimate(F.col("score"), F.col("sd"), F.lit(1))
    return s.groupBy("lib_row").agg(F.count(F.lit(1)).alias("n"), F.round(m, 5).alias("score"), F.round(sd, 4).alias("sd"))


def _scored_clones(spark: SparkSession, folder: str) -> DataFrame:
    """Clones (sets of calls) with a score: share of reads in selected samples, and a standard error from the counts."""
    g = B.read_genotypes(spark, folder).withColumn("c", S.calls_of(F.col("geno"))).join(small(B.samples(spark, folder)), F.col("movie") == F.col("sample"))
    muts = F.array_sort(F.array_distinct(F.transform("c", lambda c: c["mut"])))
    rows = g.select(F.when(F.size(muts) == 0, F.array(F.lit("="))).otherwise(muts).alias("muts"), (F.col("cond") != "All").cast("int").alias("sel"))
    n = F.count(F.lit(1))
    by = rows.groupBy("muts").agg(((F.sum("sel") + 0.5) / (n + 1)).alias("score"), F.sqrt(0.25 / (n + 1)).alias("sd"))
    return stage(by.withColumn("clone", F.array_join("muts", ";")), "scored")


_CLONES = """, rr AS (SELECT g.mv, g.hl, cond, coalesce(list_sort(list_distinct(list(c.mut) FILTER (WHERE c.mut IS NOT NULL))), ['=']) AS muts FROM rg g JOIN smp ON sample = g.mv LEFT JOIN cl c ON c.mv = g.mv AND c.hl = g.hl GROUP BY g.mv, g.hl, cond),
 kl AS (SELECT muts, (count(*) FILTER (WHERE cond <> 'All') + 0.5) / (count(*) + 1.0) AS score, sqrt(0.25 / (count(*) + 1.0)) AS sd, array_to_string(muts, ';') AS clone FROM rr GROUP BY muts),
 ea AS (SELECT clone, score::DOUBLE AS score, sd::DOUBLE AS sd, len(muts) AS k, unnest(muts) AS mut FROM kl),
 jn AS (SELECT 'single' AS tag, mut, score, sd FROM ea WHERE k = 1 UNION ALL SELECT 'multi', mut, score, sd FROM ea),
 inf AS (SELECT a.clone, a.mut, any_value(a.score) / product(s.score) AS q, any_value(a.score) AS sc, any_value(a.sd) AS sd, sum(pow(s.sd / s.score, 2)) AS rel FROM ea a JOIN ea b ON b.clone = a.clone AND b.mut <> a.mut LEFT JOIN ea s ON s.mut = b.mut AND s.k = 1 AND s.score <> 0
   WHERE a.k > 1 GROUP BY a.clone, a.mut HAVING count(s.score) = count(*)),
 al AS (SELECT * FROM jn UNION ALL SELECT 'infer', mut, q, abs(q) * sqrt(pow(sd / sc, 2) + rel) FROM inf),
 es AS (SELECT tag, mut, CASE WHEN count(*) = 1 THEN max(score) ELSE sum(score / sd) / sum(1 / sd) END AS score,
   CASE WHEN count(*) = 1 THEN max(sd) ELSE sqrt(greatest(sum((sd * sd + score * score) / sd) / sum(1 / sd) - pow(sum(score / sd) / sum(1 / sd), 2), 0)) END AS sd, count(*) * 2 AS df FROM al GROUP BY tag, mut) """
_VC = B.with_tables("rg", "cl", "smp") + _CLONES


@query(
    _VC
    + "SELECT mut, "
    + ", ".join(f"round(max({c}) FILTER (WHERE tag = '{t}'), {5 if c == 'score' else 4}) AS {c}_{t}" for t in ("single", "multi", "infer") for c in ("score", "sd"))
    + " FROM es GROUP BY mut"
)
def variant_scores(spark: SparkSession, folder: str) -> DataFrame:
    e = E.variant_estimates(_scored_clones(spark, folder), replicates=2)
    return e.select("mut", *(F.round(f"{c}_{t}", 5 if c == "score" else 4).alias(f"{c}_{t}") for t in ("single", "multi", "infer") for c in ("score", "sd")))


@query(
    _VC
    + """SELECT mut, round(coalesce(s.score, m.score), 5) AS score, round(CASE WHEN s.score IS NOT NULL THEN s.sd ELSE m.sd END, 4) AS sd,
    round(CASE WHEN s.score IS NOT NULL THEN s.sd / sqrt(s.df) ELSE m.sd / sqrt(m.df) END, 4) AS se, CAST(coalesce(s.df, m.df) AS BIGINT) AS df
    FROM (SELECT * FROM es WHERE tag = 'multi') m LEFT JOIN (SELECT * FROM es WHERE tag = 'single') s USING (mut) WHERE mut <> '='"""
)
def joint_scores(spark: SparkSession, folder: str) -> DataFrame:
    j = E.joint_table(E.variant_estimates(_scored_clones(spark, folder), replicates=2))
    return j.select("mut", F.round("score", 5).alias("score"), F.round("sd", 4).alias("sd"), F.round("se", 4).alias("se"), F.col("df").cast("bigint").alias("df"))


_BY_DAY = "SELECT CAST(loaded_at AS DATE) AS day, count(*) AS n, count(*) FILTER (WHERE seq IS NULL) AS failed, count(*) FILTER (WHERE seq IS NOT NULL AND NOT good_qual) AS poor, count(*) FILTER (WHERE seq IS NOT NULL AND good_qual) AS kept FROM ln GROUP BY 1"


def _fates(spark: SparkSession, folder: str) -> DataFrame:
    bad = F.col("seq").isNull()
    return B.lines(spark, folder).groupBy(F.to_date("loaded_at").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("failed"), F.count_if(~bad & ~F.col("good_qual")).alias("poor"), F.count_if(~bad & F.col("good_qual")).alias("kept")
    )


@query(B.with_tables("ln") + _BY_DAY)
def read_fates(spark: SparkSession, folder: str) -> DataFrame:
    return _fates(spark, folder)


@query(B.with_tables("ln") + f", f AS ({_BY_DAY}), r AS (SELECT day, CAST(sum(n) OVER (ORDER BY day) AS BIGINT) AS total FROM f) SELECT day, total, total - coalesce(lag(total) OVER (ORDER BY day), 0) AS added FROM r")
def decumulate(spark: SparkSession, folder: str) -> DataFrame:
    # one row per day: the ordered window sees aggregates only
    by_day = W.orderBy("day")
    r = _fates(spark, folder).select("day", F.sum("n").over(by_day.rowsBetween(W.unboundedPreceding, 0)).alias("total"))
    return r.withColumn("added", F.col("total") - F.coalesce(F.lag("total").over(by_day), F.lit(0)))


@query(
    B.with_tables("ln", "smp")
    + """, lib AS (SELECT seq FROM ln WHERE seq IS NOT NULL GROUP BY seq HAVING count(*) >= 20) SELECT sample, count(*) AS total, count(*) FILTER (WHERE ln.seq IS NULL OR lib.seq IS NULL) AS no_match,
    round(count(*) FILTER (WHERE ln.seq IS NULL OR lib.seq IS NULL) / count(*)::DOUBLE, 9) AS frac FROM ln JOIN smp ON sample = mv LEFT JOIN lib ON lib.seq = ln.seq GROUP BY sample"""
)
def no_match_fraction(spark: SparkSession, folder: str) -> DataFrame:
    per = _library_counts(spark, folder)
    out = per.groupBy("sample").agg(F.sum("n").alias("total"), F.coalesce(F.sum(F.when(~F.col("known"), F.col("n"))), F.lit(0)).alias("no_match"))
    return out.withColumn("frac", F.round(F.col("no_match") / F.col("total"), ROUND))


def _library_counts(spark: SparkSession, folder: str) -> DataFrame:
    """``sample, seq, n, known``: reads by sample and sequence, and whether the library holds the sequence (20 lines in all).

    Counts come before the join, so frequent sequences meet it as one row per sample.
    """
    counts = B.lines(spark, folder).groupBy(F.col("movie").alias("sample"), "seq").agg(F.count(F.lit(1)).alias("n"))
    library = counts.where("seq IS NOT NULL").groupBy("seq").agg(F.sum("n").alias("t")).where("t >= 20").select("seq", F.lit(True).alias("known"))
    known = counts.join(library, "seq", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    return known.join(small(B.samples(spark, folder).select("sample")), "sample", "left_semi")


@query(
    B.with_tables("ln", "smp")
    + """, lib AS (SELECT seq FROM ln WHERE seq IS NOT NULL GROUP BY seq HAVING count(*) >= 20), c AS (SELECT seq, cond, count(*) AS n FROM ln JOIN smp ON sample = mv WHERE seq IN (SELECT seq FROM lib) GROUP BY ALL)
    SELECT lib.seq, coalesce(sum(n) FILTER (WHERE cond = 'Acid'), 0)::BIGINT AS acid, coalesce(sum(n) FILTER (WHERE cond = 'All'), 0)::BIGINT AS all_, coalesce(sum(n) FILTER (WHERE cond = 'Heat'), 0)::BIGINT AS heat,
    coalesce(sum(n) FILTER (WHERE cond = 'Salt'), 0)::BIGINT AS salt FROM lib LEFT JOIN c ON c.seq = lib.seq GROUP BY lib.seq"""
)
def counts_pivot(spark: SparkSession, folder: str) -> DataFrame:
    per = B.lines(spark, folder).where("seq IS NOT NULL").groupBy("movie", "seq").agg(F.count(F.lit(1)).alias("n"))
    library = per.groupBy("seq").agg(F.sum("n").alias("t")).where("t >= 20").select("seq")
    conds = small(B.samples(spark, folder).select(F.col("sample").alias("movie"), "cond"))
    wide = per.join(conds, "movie").groupBy("seq").pivot("cond", ["Acid", "All", "Heat", "Salt"]).agg(F.sum("n"))
    out = library.join(wide, "seq", "left").fillna(0)
    return out.select("seq", F.col("Acid").alias("acid"), F.col("All").alias("all_"), F.col("Heat").alias("heat"), F.col("Salt").alias("salt"))


@query(
    B.with_tables("ln")
    + """, s AS (SELECT seq, count(*) AS n FROM ln WHERE seq IS NOT NULL GROUP BY seq), b AS (SELECT n, count(*) AS seqs, CAST(n * count(*) AS BIGINT) AS rows FROM s GROUP BY n)
    SELECT n, seqs, CAST(sum(rows) OVER (ORDER BY n DESC) AS BIGINT) AS covered, round(sum(rows) OVER (ORDER BY n DESC) / sum(rows) OVER (), 9) AS share FROM b"""
)
def cumulative_coverage(spark: SparkSession, folder: str) -> DataFrame:
    # sizes of sequences as a histogram; the window runs over its bins
    s = B.lines(spark, folder).where("seq IS NOT NULL").groupBy("seq").agg(F.count(F.lit(1)).alias("n"))
    b = s.groupBy("n").agg(F.count(F.lit(1)).alias("seqs"))
    run = F.sum(F.col("n") * F.col("seqs")).over(W.orderBy(F.desc("n")).rowsBetween(W.unboundedPreceding, 0))
    return b.select("n", "seqs", run.alias("covered"), F.round(run / F.sum(F.col("n") * F.col("seqs")).over(W.partitionBy()), ROUND).alias("share"))


@query("SELECT assay, sample_name, movie FROM (SELECT lower(trim(assay)) AS assay, sample_name, movie, row_number() OVER (PARTITION BY lower(trim(assay)) ORDER BY started_at, movie) AS k FROM movies WHERE assay IS NOT NULL) WHERE k = 1")
def first_sample_of_assay(spark: SparkSession, folder: str) -> DataFrame:
    from clonewell.operators.library import first_of

    m = table(spark, folder, "movies").where("assay IS NOT NULL").withColumn("assay", F.lower(F.trim("assay")))
    return first_of(m, ["assay"], [F.col("started_at"), F.col("movie")]).select("assay", "sample_name", "movie")
