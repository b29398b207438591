"""Queries that match rows: barcode neighbours, nearest library barcodes, set joins, regions, similar genotypes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clonewell.functions import seq as S
from clonewell.functions.reads import hole_of, movie_of
from clonewell.operators import caller as R, neighbors as N
from clonewell.operators.components import components
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


_W = B.with_tables
_DIST = "CASE WHEN dist >= 0 THEN dist ELSE mismatch + indel END"


def _library(spark: SparkSession, folder: str, least: int = 20) -> DataFrame:
    """``seq`` of the sequences with at least ``least`` lines."""
    return B.lines(spark, folder).where("seq IS NOT NULL").groupBy("seq").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("seq")


_LIB = ", lib AS (SELECT seq FROM ln WHERE seq IS NOT NULL GROUP BY seq HAVING count(*) >= 20), d AS (SELECT DISTINCT seq FROM ln WHERE seq IS NOT NULL) "


@query(_W("ln") + _LIB + "SELECT x.seq AS a, y.seq AS b, CAST(levenshtein(x.seq, y.seq) AS INTEGER) AS dist FROM d x JOIN d y ON x.seq < y.seq AND abs(length(x.seq) - length(y.seq)) <= 1 WHERE levenshtein(x.seq, y.seq) <= 1")
def neighbor_join(spark: SparkSession, folder: str) -> DataFrame:
    d = B.lines(spark, folder).select("seq")
    return N.neighbors(d, d, 1, same=True)


@query(
    _W("ln")
    + _LIB
    + """, p AS (SELECT d.seq, lib.seq AS hit, levenshtein(d.seq, lib.seq) AS dist FROM d JOIN lib ON abs(length(d.seq) - length(lib.seq)) <= 2 WHERE levenshtein(d.seq, lib.seq) <= 2),
    b AS (SELECT seq, min(dist) AS diffs FROM p GROUP BY seq) SELECT p.seq, CASE WHEN count(*) = 1 THEN min(hit) END AS hit, CAST(diffs AS INTEGER) AS diffs, count(*) AS nhits FROM p JOIN b ON b.seq = p.seq AND p.dist = b.diffs GROUP BY p.seq, diffs"""
)
def nearest_library_match(spark: SparkSession, folder: str) -> DataFrame:
    return N.nearest(B.lines(spark, folder).select("seq"), _library(spark, folder), 2)


@query(
    _W("ln")
    + _LIB
    + """, p AS (SELECT lib.seq AS a, d.seq AS b, levenshtein(d.seq, lib.seq) AS e, length(d.seq) - length(lib.seq) AS o FROM d JOIN lib ON abs(length(d.seq) - length(lib.seq)) <= 1 AND d.seq <> lib.seq WHERE levenshtein(d.seq, lib.seq) <= 1),
    q AS (SELECT a, b, abs(o) + least(e, hamming(left(a, least(length(a), length(b))::BIGINT), left(b, least(length(a), length(b))::BIGINT)), hamming(right(a, least(length(a), length(b))::BIGINT), right(b, least(length(a), length(b))::BIGINT))) AS dist FROM p)
    SELECT a, b, CAST(dist AS INTEGER) AS dist FROM q WHERE dist <= 1"""
)
def barcode_distances(spark: SparkSession, folder: str) -> DataFrame:
    """Sequences at a distance of 1 from one with at least 20 lines, by the count of alignments: an inner indel is 2 away, one at an end 1."""
    return N.barcode_distances(_library(spark, folder), B.lines(spark, folder).select("seq"), 1)


@query(
    f"SELECT least(query_id, ref_id) AS a, greatest(query_id, ref_id) AS b, min({_DIST}) AS dist, count(*) AS times FROM barcode_matches WHERE query_id <> ref_id AND {_DIST} <= 2 GROUP BY 1, 2"
)
def match_pairs(spark: SparkSession, folder: str) -> DataFrame:
    dist = F.when(F.col("dist") >= 0, F.col("dist")).otherwise(F.col("mismatch") + F.col("indel"))
    m = table(spark, folder, "barcode_matches").where((F.col("query_id") != F.col("ref_id")) & (dist <= 2))
    return m.groupBy(F.least("query_id", "ref_id").alias("a"), F.greatest("query_id", "ref_id").alias("b")).agg(F.min(dist).alias("dist"), F.count(F.lit(1)).alias("times"))


_MV, _HL = (x.replace("read_id", "g.read_id") for x in (B._MV, B._HL))


@query(f"SELECT count(*) AS n, CAST(read_id AS VARCHAR) AS read_id FROM genotypes g WHERE ({_MV}, {_HL}) IN (SELECT mv, hl FROM (SELECT {B._MV} AS mv, {B._HL} AS hl FROM bcs)) GROUP BY read_id")
def reads_with_calls(spark: SparkSession, folder: str) -> DataFrame:
    key = {"m": movie_of(F.col("read_id")), "h": hole_of(F.col("read_id"))}
    known = table(spark, folder, "bcs").select(*(c.alias(k) for k, c in key.items())).distinct()
    kept = table(spark, folder, "genotypes").withColumns(key).join(known, ["m", "h"], "left_semi")
    return kept.groupBy("read_id").agg(F.count(F.lit(1)).alias("n"))


@query(_W("virt", "rg") + "SELECT mv AS movie, hl AS hole FROM virt WHERE NOT EXISTS (SELECT 1 FROM rg WHERE rg.mv = virt.mv AND rg.hl = virt.hl)")
def reads_without_genotype(spark: SparkSession, folder: str) -> DataFrame:
    return B.virtual_barcodes(spark, folder).join(B.read_genotypes(spark, folder), ["movie", "hole"], "left_anti").select("movie", "hole")


@query(_W("bar") + "SELECT coalesce(a.mv, b.mv) AS movie, coalesce(a.hl, b.hl) AS hole, a.seq AS first, b.seq AS second, a.seq IS NOT NULL AND b.seq IS NOT NULL AS paired FROM (SELECT * FROM bar WHERE bcid = 1) a FULL JOIN (SELECT * FROM bar WHERE bcid = 2) b ON a.mv = b.mv AND a.hl = b.hl")
def paired_loci(spark: SparkSession, folder: str) -> DataFrame:
    b = B.barcodes(spark, folder)
    one, two = (b.where(F.col("bcid") == k).select("movie", "hole", F.col("seq").alias(n)) for k, n in ((1, "first"), (2, "second")))
    return one.join(two, ["movie", "hole"], "full").withColumn("paired", F.col("first").isNotNull() & F.col("second").isNotNull())


@query(
    _W("ln")
    + """, a AS (SELECT DISTINCT seq FROM ln WHERE seq IS NOT NULL AND bcid = 1), b AS (SELECT DISTINCT seq FROM ln WHERE seq IS NOT NULL AND bcid = 2)
    SELECT seq, 'both' AS found FROM (SELECT seq FROM a INTERSECT SELECT seq FROM b) UNION ALL SELECT seq, 'first' FROM (SELECT seq FROM a EXCEPT SELECT seq FROM b) UNION ALL SELECT seq, 'second' FROM (SELECT seq FROM b EXCEPT SELECT seq FROM a)"""
)
def locus_sets(spark: SparkSession, folder: str) -> DataFrame:
    # union, intersection and differences of two sets in one aggregate instead of three set operations
    s = B.lines(spark, folder).where("seq IS NOT NULL AND bcid IN (1, 2)").groupBy("seq").agg(F.bool_or(F.col("bcid") == 1).alias("a"), F.bool_or(F.col("bcid") == 2).alias("b"))
    return s.select("seq", F.when(F.col("a") & F.col("b"), "both").when(F.col("a"), "first").otherwise("second").alias("found"))


@query(
    _W("cl")
    + """, r AS (SELECT i AS region, i * 100 + 1 AS from_pos, i * 100 + 150 AS to_pos FROM (SELECT DISTINCT CAST(pos // 100 AS BIGINT) AS i FROM cl WHERE pos > 0))
    SELECT region, count(*) AS n, count(DISTINCT mut) AS variants FROM cl JOIN r ON pos BETWEEN from_pos AND to_pos GROUP BY region"""
)
def region_join(spark: SparkSession, folder: str) -> DataFrame:
    c = B.calls(spark, folder)
    # overlapping regions of 150 positions each 100, as far as there are calls; a position lies in at most two, so the join is on the region's number
    regions = c.where("pos > 0").select(F.expr("pos div 100").alias("region")).distinct()
    bounds = regions.select("region", (F.col("region") * 100 + 1).alias("from_pos"), (F.col("region") * 100 + 150).alias("to_pos"))
    near = c.select("pos", "mut", F.explode(F.array(F.expr("pos div 100"), F.expr("pos div 100") - 1)).alias("region"))
    hit = near.join(bounds, "region").where(F.col("pos").between(F.col("from_pos"), F.col("to_pos")))
    return hit.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("mut").alias("variants"))


@query(
    _W("ln", "rg", "cl")
    + f""", gs AS (SELECT g.mv, g.hl, list(DISTINCT c.mut) FILTER (WHERE c.mut IS NOT NULL) AS muts FROM rg g LEFT JOIN cl c ON c.mv = g.mv AND c.hl = g.hl GROUP BY g.mv, g.hl),
    m AS (SELECT DISTINCT least(query_id, ref_id) AS a, greatest(query_id, ref_id) AS b FROM barcode_matches WHERE query_id <> ref_id AND {_DIST} <= 1),
    j AS (SELECT a, b, coalesce(x.muts, []) AS mx, coalesce(y.muts, []) AS my FROM m JOIN ln p ON p.line_id = a JOIN ln q ON q.line_id = b JOIN gs x ON x.mv = p.mv AND x.hl = p.hl JOIN gs y ON y.mv = q.mv AND y.hl = q.hl)
    SELECT a, b, len(list_intersect(mx, my)) AS common, round(CASE WHEN len(list_distinct(list_concat(mx, my))) = 0 THEN 1.0 ELSE len(list_intersect(mx, my)) / len(list_distinct(list_concat(mx, my)))::DOUBLE END, 9) AS jaccard FROM j"""
)
def genotype_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    muts = F.array_distinct(F.transform(S.calls_of(F.col("geno")), lambda c: c["mut"]))
    of_line = B.lines(spark, folder).select("line_id", "movie", "hole").join(B.read_genotypes(spark, folder).select("movie", "hole", muts.alias("muts")), ["movie", "hole"]).select("line_id", "muts")
    pairs = match_pairs(spark, folder).where("dist <= 1").select("a", "b")
    both = pairs.join(of_line.select(F.col("line_id").alias("a"), F.col("muts").alias("ma")), "a").join(of_line.select(F.col("line_id").alias("b"), F.col("muts").alias("mb")), "b")
    return both.select("a", "b", F.size(F.array_intersect("ma", "mb")).cast("bigint").alias("common"), F.round(S.jaccard(F.col("ma"), F.col("mb")), 9).alias("jaccard"))


_PAIRS = f"SELECT DISTINCT least(query_id, ref_id) AS a, greatest(query_id, ref_id) AS b FROM barcode_matches WHERE query_id <> ref_id AND {_DIST} <= 2"


@query(
    f"""WITH RECURSIVE l AS ({_PAIRS}), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l), c(node, component) USING KEY (node) AS (
    SELECT a, min(least(a, b)) FROM e GROUP BY a UNION SELECT e.b, min(c.component) FROM c JOIN e ON e.a = c.node JOIN recurring.c AS o ON o.node = e.b WHERE c.component < o.component GROUP BY e.b) SELECT node, component FROM c"""
)
def connected_components(spark: SparkSession, folder: str) -> DataFrame:
    return components(match_pairs(spark, folder), "a", "b")


@query(
    _W("ln")
    + f""", s AS (SELECT line_id, seq, count(*) OVER (PARTITION BY seq) AS n FROM ln WHERE seq IS NOT NULL), l AS ({_PAIRS})
    SELECT a, b, round(abs(log2(x.n / y.n::DOUBLE)), 9) AS ratio FROM l JOIN s x ON x.line_id = a JOIN s y ON y.line_id = b WHERE x.seq <> y.seq"""
)
def size_disproportion(spark: SparkSession, folder: str) -> DataFrame:
    from clonewell.operators.library import precluster_members

    m = precluster_members(B.lines(spark, folder), F.col("seq"), F.col("line_id"))
    one, two = (m.select(F.col("row_id").alias(k), F.col("barcode").alias(f"s{k}"), F.col("size").alias(f"n{k}")) for k in ("a", "b"))
    both = match_pairs(spark, folder).select("a", "b").join(one, "a").join(two, "b").where("sa <> sb")
    return both.select("a", "b", F.round(S.size_ratio(F.col("na"), F.col("nb")), 9).alias("ratio"))


@query(
    _W("ln", "smp")
    + """, lib AS (SELECT seq FROM ln WHERE seq IS NOT NULL GROUP BY seq HAVING count(*) >= 20), d AS (SELECT mv AS sample, seq, count(*) AS n FROM ln WHERE seq IS NOT NULL AND mv IN (SELECT sample FROM smp) GROUP BY ALL),
    p AS (SELECT d.sample, d.seq, d.n, lib.seq AS hit, levenshtein(d.seq, lib.seq) AS dist FROM d JOIN lib ON abs(length(d.seq) - length(lib.seq)) <= 1 WHERE levenshtein(d.seq, lib.seq) <= 1),
    b AS (SELECT sample, seq, n, first(hit ORDER BY dist, hit) AS hit, count(*) FILTER (WHERE dist = m) AS nhits FROM (SELECT *, min(dist) OVER (PARTITION BY sample, seq) AS m FROM p) GROUP BY ALL)
    SELECT sample, hit, CAST(sum(n) AS BIGINT) AS n FROM b WHERE nhits = 1 GROUP BY ALL"""
)
def fuzzy_counts(spark: SparkSession, folder: str) -> DataFrame:
    per = B.lines(spark, folder).where("seq IS NOT NULL").groupBy(F.col("movie").alias("sample"), "seq").agg(F.count(F.lit(1)).alias("n"))
    per = per.join(small(B.samples(spark, folder).select("sample")), "sample", "left_semi")
    hits = N.nearest(per.select("seq"), _library(spark, folder), 1).where("hit IS NOT NULL").select("seq", "hit")
    return per.join(hits, "seq").groupBy("sample", "hit").agg(F.sum("n").alias("n"))


_MATES = "AGTC([ACGTN]{6,10}?)GAC"


@query(
    _W("bar")
    + f""", m AS (SELECT coalesce(a.mv, b.mv) AS sample, a.seq AS s1, b.seq AS s2 FROM (SELECT * FROM bar WHERE bcid = 1) a FULL JOIN (SELECT * FROM bar WHERE bcid = 2) b ON a.mv = b.mv AND a.hl = b.hl),
    x AS (SELECT sample, nullif(regexp_extract(s1, '{_MATES}', 1), '') AS one, nullif(regexp_extract(reverse(translate(s2, 'ACGT', 'TGCA')), '{_MATES}', 1), '') AS two FROM m),
    c AS (SELECT sample, CASE WHEN one IS NULL THEN two WHEN two IS NULL OR one = two THEN one END AS barcode, count(*) AS n FROM x GROUP BY ALL),
    lib AS (SELECT barcode AS seq FROM c WHERE barcode IS NOT NULL GROUP BY 1 HAVING sum(n) >= 5), d AS (SELECT DISTINCT barcode AS seq FROM c WHERE barcode IS NOT NULL),
    p AS (SELECT d.seq, lib.seq AS hit, levenshtein(d.seq, lib.seq) AS dist FROM d JOIN lib ON abs(length(d.seq) - length(lib.seq)) <= 1 WHERE levenshtein(d.seq, lib.seq) <= 1),
    b AS (SELECT seq, count(*) FILTER (WHERE dist = m) AS nhits, min(hit) FILTER (WHERE dist = m) AS hit FROM (SELECT *, min(dist) OVER (PARTITION BY seq) AS m FROM p) GROUP BY seq)
    SELECT sample, CASE WHEN barcode IS NULL THEN 'failedExtraction' WHEN nhits IS NULL THEN 'noMatch' WHEN nhits > 1 THEN 'ambiguous' ELSE 'hit' END AS fate, CASE WHEN nhits = 1 THEN hit END AS hit, CAST(sum(n) AS BIGINT) AS n
    FROM c LEFT JOIN b ON b.seq = c.barcode GROUP BY ALL"""
)
def called_reads(spark: SparkSession, folder: str) -> DataFrame:
    """Reads to counts: what stands between the flanks of both loci, taken as mates, by the nearest barcode with at least five reads; with the fates of all reads."""
    mates = paired_loci(spark, folder).select(F.col("movie").alias("sample"), F.concat_ws("/", "movie", F.col("hole").cast("string")).alias("read_id"), F.col("first").alias("seq"), F.col("second").alias("seq2"))
    barcodes = stage(R.read_barcodes(mates, "AGTC", "GAC", 8, 2), "barcodes")
    library = barcodes.where("barcode IS NOT NULL").groupBy(F.col("barcode").alias("seq")).agg(F.count(F.lit(1)).alias("n")).where("n >= 5").select("seq")
    return R.call_reads(barcodes, library, 1)


@query(
    _W("ln", "rg", "cl")
    + f""", gs AS (SELECT g.mv, g.hl, coalesce(list(DISTINCT c.mut) FILTER (WHERE c.mut IS NOT NULL), []) AS muts FROM rg g LEFT JOIN cl c ON c.mv = g.mv AND c.hl = g.hl GROUP BY g.mv, g.hl),
    m AS (SELECT least(query_id, ref_id) AS a, greatest(query_id, ref_id) AS b, min({_DIST}) AS dist FROM barcode_matches WHERE query_id <> ref_id AND {_DIST} <= 1 GROUP BY 1, 2),
    s AS (SELECT line_id, mv, hl, count(*) OVER (PARTITION BY seq) AS n FROM ln WHERE seq IS NOT NULL),
    j AS (SELECT a, b, dist, p.n AS na, q.n AS nb, len(list_intersect(x.muts, y.muts)) AS common, len(list_distinct(list_concat(x.muts, y.muts))) AS total FROM m JOIN s p ON p.line_id = a JOIN s q ON q.line_id = b JOIN gs x ON x.mv = p.mv AND x.hl = p.hl JOIN gs y ON y.mv = q.mv AND y.hl = q.hl)
    SELECT a, b, dist + total - common = 0 OR ((greatest(na, nb) <= 4 OR abs(log2(na / nb::DOUBLE)) >= pow(2.0, dist - 3)) AND CASE WHEN total = 0 THEN 1.0 ELSE common / total::DOUBLE END >= 0.2) AS merged FROM j"""
)
def older_merge_criteria(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the older clustering would join the clusters of two similar lines: by distance of barcodes and genotypes, sizes and Jaccard similarity."""
    muts = F.array_distinct(F.transform(S.calls_of(F.col("geno")), lambda c: c["mut"]))
    counts = B.lines(spark, folder).where("seq IS NOT NULL").groupBy("seq").agg(F.count(F.lit(1)).alias("n"))
    genotypes = B.read_genotypes(spark, folder).select("movie", "hole", muts.alias("muts"))
    of_line = stage(B.lines(spark, folder).where("seq IS NOT NULL").select("line_id", "movie", "hole", "seq").join(counts, "seq").join(genotypes, ["movie", "hole"]).select("line_id", "n", "muts"), "sized")
    pairs = match_pairs(spark, folder).where("dist <= 1").select("a", "b", "dist")
    one, two = (of_line.select(F.col("line_id").alias(k), F.col("n").alias(f"n{k}"), F.col("muts").alias(f"m{k}")) for k in ("a", "b"))
    both = pairs.join(one, "a").join(two, "b")
    apart = F.size(F.array_union("ma", "mb")) - F.size(F.array_intersect("ma", "mb"))
    return both.select("a", "b", S.older_merge(F.col("na"), F.col("nb"), F.col("dist"), apart, S.jaccard(F.col("ma"), F.col("mb")), 0.2).alias("merged"))
