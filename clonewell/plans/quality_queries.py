"""Quality tables and the smaller operators: fates of barcodes, coverage, subsampling, exact matching, chunk medians."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clonewell.functions import seq as S
from clonewell.operators import enrich as E, library as L, translate as T
from clonewell.plans import assay_queries as A, base as B, clone_queries as K
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


_W = B.with_tables


@query(
    _W("clones")
    + """, t AS (SELECT *, sum(size) OVER (PARTITION BY virtual) AS total, count(*) OVER (PARTITION BY virtual) AS k FROM clones)
    SELECT fate, count(*) AS clones, CAST(sum(size) AS BIGINT) AS reads FROM (SELECT size, CASE WHEN k = 1 THEN 'clean' WHEN size / total > 2 / 3.0::DOUBLE AND size >= 2 THEN 'dominant' ELSE 'compromised' END AS fate FROM t) GROUP BY fate"""
)
def barcode_fates(spark: SparkSession, folder: str) -> DataFrame:
    c = B.clones(spark, folder)
    totals = c.groupBy("virtual").agg(F.sum("size").alias("total"), F.count(F.lit(1)).alias("k"))
    fate = F.when(F.col("k") == 1, "clean").when((F.col("size") / F.col("total") > 2 / 3) & (F.col("size") >= 2), "dominant").otherwise("compromised")
    return c.join(totals, "virtual").groupBy(fate.alias("fate")).agg(F.count(F.lit(1)).alias("clones"), F.sum("size").alias("reads"))


@query(_W("clones") + ", u AS (SELECT up, count(*) AS clones, CAST(least(sum(size), 20) AS BIGINT) AS size FROM clones WHERE up IS NOT NULL GROUP BY up) SELECT size, least(clones, 5) AS clones, count(*) AS barcodes FROM u GROUP BY ALL")
def cluster_size_table(spark: SparkSession, folder: str) -> DataFrame:
    u = B.clones(spark, folder).where("up IS NOT NULL").groupBy("up").agg(F.count(F.lit(1)).alias("c"), F.least(F.sum("size"), F.lit(20)).alias("size"))
    return u.groupBy("size", F.least("c", F.lit(5)).alias("clones")).agg(F.count(F.lit(1)).alias("barcodes"))


@query(_W("clones") + ", t AS (SELECT *, count(*) OVER (PARTITION BY up) AS k FROM clones) SELECT virtual, geno, size, NOT regexp_matches(geno, 'ins|del') AND geno <> '=' AS substitutions_only FROM t WHERE size > 1 AND (up IS NULL OR k = 1)")
def usable_clones(spark: SparkSession, folder: str) -> DataFrame:
    c = L.clean_rows(L.tag_collisions(B.clones(spark, folder), "up", "tag"), "tag")
    return c.select("virtual", "geno", "size", (~F.col("geno").rlike("ins|del") & (F.col("geno") != "=")).alias("substitutions_only"))


@query(
    _W("clones")
    + f""", m AS (SELECT geno, size, CAST(regexp_extract(x, '^(-?\\d+)', 1) AS INTEGER) AS pos FROM (SELECT geno, size, unnest(string_split(geno, ';')) AS x FROM clones WHERE geno <> '=') )
    SELECT CASE WHEN pos BETWEEN 1 AND {B.ORF_LENGTH} THEN 'on' ELSE 'off' END AS target, pos // 300 AS region, count(*) AS calls, CAST(sum(size) AS BIGINT) AS reads FROM m WHERE pos > 0 GROUP BY ALL"""
)
def clone_count_by_region(spark: SparkSession, folder: str) -> DataFrame:
    m = B.clones(spark, folder).where("geno <> '='").select("size", F.explode(F.split("geno", ";")).alias("x")).select("size", F.regexp_extract("x", r"^(-?\d+)", 1).cast("int").alias("pos")).where("pos > 0")
    target = F.when(S.in_frame(F.col("pos"), B.ORF_LENGTH), "on").otherwise("off")
    return m.groupBy(target.alias("target"), F.expr("cast(pos div 300 as int)").alias("region")).agg(F.count(F.lit(1)).alias("calls"), F.sum("size").alias("reads"))


@query(
    _W("ln")
    + """, s AS (SELECT bcid, seq, count(*) AS n FROM ln WHERE seq IS NOT NULL GROUP BY ALL), lib AS (SELECT DISTINCT seq FROM s WHERE bcid = 1 AND n >= 3)
    SELECT lib.seq IS NOT NULL AS matched, s.n = 1 AS singleton, count(*) AS sequences, CAST(sum(s.n) AS BIGINT) AS reads FROM s LEFT JOIN lib ON lib.seq = s.seq WHERE bcid = 2 GROUP BY ALL"""
)
def exact_match_miss(spark: SparkSession, folder: str) -> DataFrame:
    s = B.lines(spark, folder).where("seq IS NOT NULL").groupBy("bcid", "seq").agg(F.count(F.lit(1)).alias("n"))
    library = s.where("bcid = 1 AND n >= 3").select("seq", F.lit(True).alias("known"))
    both = s.where("bcid = 2").join(library, "seq", "left")
    return both.groupBy(F.coalesce("known", F.lit(False)).alias("matched"), (F.col("n") == 1).alias("singleton")).agg(F.count(F.lit(1)).alias("sequences"), F.sum("n").alias("reads"))


@query(
    _W("rg", "cl")
    + """, common AS (SELECT mut FROM cl GROUP BY mut HAVING count(*) * 100 > (SELECT count(*) FROM rg))
    SELECT g.mv AS movie, g.hl AS hole, coalesce(string_agg(c.mut, ';' ORDER BY c.pos, c.mut) FILTER (WHERE c.mut NOT IN (SELECT mut FROM common)), '=') AS geno FROM rg g LEFT JOIN cl c ON c.mv = g.mv AND c.hl = g.hl GROUP BY g.mv, g.hl"""
)
def rebased_genotypes(spark: SparkSession, folder: str) -> DataFrame:
    """Genotypes without calls that more than one read in a hundred has, as errors of the reference would be."""
    reads = B.read_genotypes(spark, folder)
    calls = B.calls(spark, folder)
    total = reads.agg(F.count(F.lit(1)).alias("total"))
    common = calls.groupBy("mut").agg(F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(total)).where("n * 100 > total").select("mut")  # one row; at most a few hundred remain
    kept = calls.join(small(stage(common, "common")), "mut", "left_anti")
    texts = kept.groupBy("movie", "hole").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "mut"))), lambda x: x["mut"]), ";").alias("g"))
    return reads.join(texts, ["movie", "hole"], "left").select("movie", "hole", F.coalesce("g", F.lit("=")).alias("geno"))


@query(_W("cl") + "SELECT mv AS movie, hl AS hole, count(*) AS n, CAST(min(q) AS INTEGER) AS least FROM cl WHERE q >= 20 AND (kind = 'sub' OR q >= 40) GROUP BY mv, hl")
def quality_filtered_calls(spark: SparkSession, folder: str) -> DataFrame:
    c = B.calls(spark, folder).where((F.col("q") >= 20) & ((F.col("kind") == "sub") | (F.col("q") >= 40)))
    return c.groupBy("movie", "hole").agg(F.count(F.lit(1)).alias("n"), F.min("q").alias("least"))


@query("SELECT lower(trim(op)) AS spelling, count(*) AS n, count(DISTINCT refpos) AS positions FROM bcs WHERE op IS NOT NULL GROUP BY 1 ORDER BY n DESC, spelling LIMIT 10")
def top_operations(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "bcs").where("op IS NOT NULL").groupBy(F.lower(F.trim("op")).alias("spelling")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("refpos").alias("positions"))
    return t.orderBy(F.desc("n"), "spelling").limit(10)


@query(
    _W("ln")
    + """, q AS (SELECT line_id // 100 AS chunk, ascii(b) - 33 AS q FROM (SELECT line_id, unnest(string_split(qual, '')) AS b FROM ln WHERE good_qual)),
    c AS (SELECT chunk, q, count(*) AS n FROM q GROUP BY ALL), r AS (SELECT chunk, q, sum(n) OVER (PARTITION BY chunk ORDER BY q) AS upto, sum(n) OVER (PARTITION BY chunk) AS total FROM c)
    SELECT chunk, CAST(min(q) AS INTEGER) AS median FROM r WHERE upto * 2 >= total GROUP BY chunk"""
)
def chunk_medians(spark: SparkSession, folder: str) -> DataFrame:
    """Median Phred value of each hundred lines, as pipelines that read in chunks use it."""
    from pyspark.sql.window import Window as W

    bases = B.lines(spark, folder).where("good_qual").select(F.expr("line_id div 100").alias("chunk"), F.explode(F.split("qual", "")).alias("b"))
    c = bases.groupBy("chunk", (F.ascii("b") - 33).alias("q")).agg(F.count(F.lit(1)).alias("n"))
    whole = W.partitionBy("chunk")
    r = c.select("chunk", "q", F.sum("n").over(whole.orderBy("q")).alias("upto"), F.sum("n").over(whole).alias("total"))
    return r.where("upto * 2 >= total").groupBy("chunk").agg(F.min("q").alias("median"))


@query(
    _W("clones")
    + """, k AS (SELECT virtual, geno, md5(virtual || geno) AS h FROM clones), s AS (SELECT 1 << i AS part FROM (SELECT unnest([0, 1, 2, 3]) AS i)),
    d AS (SELECT part, geno FROM k, s WHERE substr(h, 1, 1) < substr('0123456789abcdefg', CAST(16 // part AS INTEGER) + 1, 1))
    SELECT CAST(part AS INTEGER) AS part, count(*) AS clones, count(DISTINCT x) AS variants FROM (SELECT part, unnest(string_split(geno, ';')) AS x FROM d WHERE geno <> '=') GROUP BY part"""
)
def downsampled_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Calls and variants left when only a half, a quarter or an eighth of the clones is kept; clones are drawn by a hash, so samples are nested and repeatable."""
    h = F.substring(F.md5(F.concat("virtual", "geno")), 1, 1)
    bound = lambda part: "0123456789abcdefg"[16 // part]
    parts = F.array_compact(F.array(*(F.when(h < bound(p), F.lit(p)) for p in (1, 2, 4, 8))))
    drawn = B.clones(spark, folder).where("geno <> '='").select(F.explode(parts).alias("part"), "geno").select("part", F.explode(F.split("geno", ";")).alias("x"))
    return drawn.groupBy("part").agg(F.count(F.lit(1)).alias("clones"), F.count_distinct("x").alias("variants"))


@query(A._V + "SELECT assay, lib_row, " + ", ".join(f"round(max(lr) FILTER (WHERE cond = '{c}'), 6) AS lr_{c.lower()}" for c in ("Acid", "Heat", "Salt")) + ", CASE WHEN lib_row = '=' THEN 'WT' WHEN regexp_matches(lib_row, 'del|ins') THEN 'non' ELSE 'mis' END AS class FROM lr WHERE allfreq >= 0.0002 AND lr IS NOT NULL GROUP BY ALL")
def bin_curves(spark: SparkSession, folder: str) -> DataFrame:
    """Log ratios of well-measured variants with one column per condition, by class, as input of a regression."""
    r = E.passing(A._lrs(spark, folder), A.FREQ).where("lr IS NOT NULL")
    wide = r.groupBy("assay", "lib_row").pivot("cond", ["Acid", "Heat", "Salt"]).agg(F.max("lr"))
    label = F.when(F.col("lib_row") == "=", "WT").when(F.col("lib_row").rlike("del|ins"), "non").otherwise("mis")
    return wide.select("assay", "lib_row", *(F.round(c, 6).alias(f"lr_{c.lower()}") for c in ("Acid", "Heat", "Salt")), label.alias("class"))


@query(K.SQL["codon_changes"].replace("SELECT mv AS movie", "SELECT aa_change, count(*) AS n FROM (SELECT x.aa || aa_pos || y.aa AS aa_change, mv AS movie", 1) + ") WHERE left(aa_change, 1) <> right(aa_change, 1) AND NOT regexp_matches(aa_change, '[*]') GROUP BY aa_change")
def aa_change_tally(spark: SparkSession, folder: str) -> DataFrame:
    """Reads by amino-acid change, without synonymous changes and stops."""
    c = K.codon_changes(spark, folder).where("from_aa <> to_aa AND from_aa <> '*' AND to_aa <> '*'")
    return c.groupBy(F.concat("from_aa", F.col("aa_pos").cast("string"), "to_aa").alias("aa_change")).agg(F.count(F.lit(1)).alias("n"))


@query(
    K.SQL["codon_changes"].replace("SELECT mv AS movie", "SELECT movie, hole, any_value(hgvs_p) AS hgvs_p FROM (SELECT mv AS movie", 1)
    + ") GROUP BY movie, hole HAVING count(*) = 1 AND regexp_full_match(any_value(hgvs_p), 'p\\.[A-Za-z]{3}\\d+([A-Za-z]{3}|=)')"
)
def single_mutants(spark: SparkSession, folder: str) -> DataFrame:
    """Reads whose substitutions change exactly one codon, with that change."""
    c = K.codon_changes(spark, folder).groupBy("movie", "hole").agg(F.count(F.lit(1)).alias("k"), F.any_value("hgvs_p").alias("hgvs_p"))
    return c.where((F.col("k") == 1) & F.col("hgvs_p").rlike(r"^p\.[A-Za-z]{3}\d+([A-Za-z]{3}|=)$")).select("movie", "hole", "hgvs_p")


@query(
    A._V.replace(" fr AS (SELECT lib_row", " frq AS (SELECT lib_row")
    + ", cm AS (SELECT DISTINCT mut AS mv, 0 AS hl, pos, kind, ref, alt, mut FROM cl)"
    + K.blocks_of("cm")
    + ", rg0 AS (SELECT DISTINCT lib_row AS mv, 0 AS hl FROM lr)"
    + K._CLASS.replace("FROM rg LEFT JOIN hg ON hg.mv = rg.mv AND hg.hl = rg.hl", "FROM rg0 rg LEFT JOIN hg ON hg.mv = rg.mv AND hg.hl = rg.hl")
    + "SELECT cond, class, CAST(floor(lr / 0.05) AS BIGINT) AS bin, count(*) AS n FROM lr JOIN vk ON vk.mv = lr.lib_row WHERE allfreq >= 0.0002 AND lr IS NOT NULL AND abs(lr / 0.05 - round(lr / 0.05)) > 1e-6 GROUP BY ALL"
)
def ratios_by_class(spark: SparkSession, folder: str) -> DataFrame:
    """Histogram of the log ratios of well-measured rows by condition and class: wild type, frameshift, stop, synonymous, missense. Ratios on a bin's border are left out."""
    calls = B.calls(spark, folder).select("mut", "pos", "kind", "ref", "alt").distinct()
    meaning = T.translations(calls.withColumn("row", F.col("mut")), K.reading_frame(spark, folder), ["row"]).select("row", T.variant_class(F.col("hgvs_p"), F.col("aa_changes")).alias("class"))
    r = E.passing(A._lrs(spark, folder), A.FREQ).where("lr IS NOT NULL AND abs(lr / 0.05 - round(lr / 0.05)) > 1e-6")
    both = r.join(meaning, F.col("lib_row") == F.col("row"), "left").withColumn("class", F.coalesce("class", F.lit("WT")))
    return both.groupBy("cond", "class", F.floor(F.col("lr") / 0.05).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
