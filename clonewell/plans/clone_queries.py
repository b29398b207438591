"""Queries that build clones: clusters of reads, their consensus, and the protein-level meaning of their calls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clonewell.functions import seq as S
from clonewell.operators import cluster as C
from clonewell.operators import consensus as K
from clonewell.operators import translate as T
from clonewell.plans import base as B
from clonewell.session import stage

QUERIES: dict = {}
SQL: dict = {}
# Thresholds of the clone queries.
JACCARD, MATCHES, QUALITY = 0.2, 1, 40


def query(sql: str | None = None):
    """Registers a query, and its SQL if it has one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _id():
    return F.concat_ws("/", "movie", F.col("hole").cast("string"))


def _reads(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    reads = B.virtual_barcodes(spark, folder).where("loci = 2").select(_id().alias("read_id"), F.col("virtual").alias("barcode"))
    return stage(reads, "reads"), stage(B.calls(spark, folder).select(_id().alias("read_id"), "pos", "mut", "q"), "calls")


_READS = B.with_tables("virt", "cl") + """, rd AS (SELECT mv || '/' || hl AS id, virtual FROM virt WHERE loci = 2),
 qc AS (SELECT mv || '/' || hl AS id, mut, min(pos) AS pos, max(q) AS q FROM cl GROUP BY ALL),
 ok AS (SELECT virtual, mut FROM rd JOIN qc USING (id) GROUP BY ALL HAVING count(*) FILTER (WHERE q > 0) > 1 OR sum(q) > 40),
 st AS (SELECT rd.id, rd.virtual, coalesce(list(qc.mut) FILTER (WHERE ok.mut IS NOT NULL AND q > 0), []) AS muts FROM rd LEFT JOIN qc ON qc.id = rd.id LEFT JOIN ok ON ok.virtual = rd.virtual AND ok.mut = qc.mut GROUP BY rd.id, rd.virtual),
 pr AS (SELECT a.id AS a, b.id AS b, a.muts AS ma, b.muts AS mb FROM st a JOIN st b ON a.virtual = b.virtual AND a.id < b.id),
 lk AS (SELECT a, b FROM pr WHERE len(ma) = 0 AND len(mb) = 0 OR len(list_intersect(ma, mb)) >= 1 AND len(list_intersect(ma, mb)) / len(list_distinct(list_concat(ma, mb)))::DOUBLE > 0.2) """


@query(
    _READS.replace("WITH ", "WITH RECURSIVE ", 1)
    + """, e AS (SELECT a, b FROM lk UNION ALL SELECT b, a FROM lk UNION ALL SELECT id, id FROM st), c(id, cluster) USING KEY (id) AS (SELECT a, min(least(a, b)) FROM e GROUP BY a
    UNION SELECT e.b, min(c.cluster) FROM c JOIN e ON e.a = c.id JOIN recurring.c AS o ON o.id = e.b WHERE c.cluster < o.cluster GROUP BY e.b) SELECT c.id AS read_id, virtual AS barcode, cluster FROM c JOIN st ON st.id = c.id"""
)
def seed_clusters(spark: SparkSession, folder: str) -> DataFrame:
    reads, calls = _reads(spark, folder)
    return C.seed_clusters(reads, calls, JACCARD, MATCHES, QUALITY)


def _clusters(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    reads, calls = _reads(spark, folder)
    seeds = stage(C.seed_clusters(reads, calls, JACCARD, MATCHES, QUALITY), "seeds")
    return C.merge_clusters(seeds, calls, 1, JACCARD, QUALITY), calls


@query()
def main_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return _clusters(spark, folder)[0]


@query()
def clone_consensus(spark: SparkSession, folder: str) -> DataFrame:
    clusters, calls = _clusters(spark, folder)
    clusters = stage(clusters, "clusters")
    return K.consensus_genotypes(clusters, calls, QUALITY).join(K.consensus_barcodes(clusters), "cluster")


def reading_frame(spark: SparkSession, folder: str) -> str:
    """The reading frame that the calls imply: at each position the most frequent reference base (``A`` where there is none)."""
    subs = B.calls(spark, folder).where((F.col("kind") == "sub") & F.col("pos").between(1, B.ORF_LENGTH))
    best = subs.groupBy("pos", "ref").agg(F.count(F.lit(1)).alias("n")).groupBy("pos").agg(F.min(F.struct((-F.col("n")).alias("neg"), "ref")).alias("b"))
    known = {r[0]: r[1] for r in best.select("pos", "b.ref").collect()}  # at most ORF_LENGTH rows
    return "".join(known.get(p, "A") for p in range(1, B.ORF_LENGTH + 1))


_FRAME = f""", fb AS (SELECT pos, first(ref ORDER BY n DESC, ref) AS ref FROM (SELECT pos, ref, count(*) AS n FROM cl WHERE kind = 'sub' AND pos BETWEEN 1 AND {B.ORF_LENGTH} GROUP BY ALL) GROUP BY pos),
 fr AS (SELECT string_agg(coalesce(ref, 'A'), '' ORDER BY p) AS orf FROM (SELECT unnest(generate_series(1, {B.ORF_LENGTH})) AS p) LEFT JOIN fb ON fb.pos = p),
 code(codon, aa) AS (VALUES {', '.join(f"('{c}', '{a}')" for c, a in S.CODONS.items())}), three(aa, name) AS (VALUES {', '.join(f"('{a}', '{n}')" for a, n in S.THREE.items())}) """


@query(
    B.with_tables("cl")
    + _FRAME
    + """, s AS (SELECT mv, hl, (pos - 1) // 3 + 1 AS aa_pos, max(alt) FILTER (WHERE (pos - 1) % 3 = 0) AS b0, max(alt) FILTER (WHERE (pos - 1) % 3 = 1) AS b1, max(alt) FILTER (WHERE (pos - 1) % 3 = 2) AS b2
    FROM cl, fr WHERE kind = 'sub' AND pos BETWEEN 1 AND length(orf) AND substr(orf, pos, 1) = ref GROUP BY ALL),
    t AS (SELECT mv, hl, aa_pos, substr(orf, aa_pos * 3 - 2, 3) AS f, coalesce(b0, substr(orf, aa_pos * 3 - 2, 1)) || coalesce(b1, substr(orf, aa_pos * 3 - 1, 1)) || coalesce(b2, substr(orf, aa_pos * 3, 1)) AS g FROM s, fr)
    SELECT mv AS movie, hl AS hole, CAST(aa_pos AS INTEGER) AS aa_pos, f AS from_codon, g AS to_codon, x.aa AS from_aa, y.aa AS to_aa,
    'p.' || p.name || aa_pos || CASE WHEN x.aa = y.aa THEN '=' ELSE q.name END AS hgvs_p FROM t JOIN code x ON x.codon = f JOIN code y ON y.codon = g JOIN three p ON p.aa = x.aa JOIN three q ON q.aa = y.aa"""
)
def codon_changes(spark: SparkSession, folder: str) -> DataFrame:
    return T.codon_changes(B.calls(spark, folder), reading_frame(spark, folder), ["movie", "hole"])


@query(
    B.with_tables("cl")
    + _FRAME
    + """, s AS (SELECT mv, hl, (pos - 1) // 3 + 1 AS aa_pos, max(alt) FILTER (WHERE (pos - 1) % 3 = 0) AS b0, max(alt) FILTER (WHERE (pos - 1) % 3 = 1) AS b1, max(alt) FILTER (WHERE (pos - 1) % 3 = 2) AS b2
    FROM cl, fr WHERE kind = 'sub' AND pos BETWEEN 1 AND length(orf) AND substr(orf, pos, 1) = ref GROUP BY ALL),
    t AS (SELECT aa_pos, coalesce(b0, substr(orf, aa_pos * 3 - 2, 1)) || coalesce(b1, substr(orf, aa_pos * 3 - 1, 1)) || coalesce(b2, substr(orf, aa_pos * 3, 1)) AS g FROM s, fr)
    SELECT CAST(aa_pos AS INTEGER) AS aa_pos, aa AS to_aa, count(*) AS n FROM t JOIN code ON codon = g GROUP BY ALL"""
)
def amino_acid_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return codon_changes(spark, folder).groupBy("aa_pos", "to_aa").agg(F.count(F.lit(1)).alias("n"))


_BASE = "coalesce(max(alt) FILTER (WHERE kind = 'ins' AND k = {k}), '') || CASE WHEN coalesce(bool_or(kind = 'del' AND k = {k}), false) THEN '' ELSE coalesce(max(alt) FILTER (WHERE kind = 'sub' AND k = {k}), substr(orf, c * 3 - 2 + {k}, 1)) END"
_AA = "array_to_string(list_transform(generate_series(1, length({s}) // 3), lambda i: aas[substr({s}, CAST(i * 3 - 2 AS BIGINT), 3)]), '')"
_BLOCKS = (
    _FRAME
    + f""", x AS (SELECT mv, hl, (pos - 1) // 3 + 1 AS c, (pos - 1) % 3 AS k, kind, alt, orf FROM cl, fr WHERE pos BETWEEN 1 AND length(orf) AND (kind <> 'sub' OR substr(orf, pos, 1) = ref)),
    e AS (SELECT mv, hl, c, orf, {' || '.join(_BASE.format(k=k) for k in range(3))} AS text FROM x GROUP BY mv, hl, c, orf),
    w AS (SELECT *, length(text) - 3 AS s, coalesce(sum(length(text) - 3) OVER (PARTITION BY mv, hl ORDER BY c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM e),
    b AS (SELECT *, sum(CASE WHEN before % 3 = 0 THEN 1 ELSE 0 END) OVER p AS blk, lead(before) OVER p AS nb, lead(c) OVER p AS nc FROM w WINDOW p AS (PARTITION BY mv, hl ORDER BY c)),
    g AS (SELECT mv, hl, orf, blk, min(c) AS c1, max(c) AS c2, string_agg(text || CASE WHEN nb % 3 <> 0 THEN substr(orf, c * 3 + 1, (nc - c - 1) * 3) ELSE '' END, '' ORDER BY c) AS new, sum(s) % 3 <> 0 AS fs FROM b GROUP BY ALL),
    h AS (SELECT *, substr(orf, c1 * 3 - 2, (c2 - c1 + 1) * 3) AS old FROM g), aam AS (SELECT map(list(codon), list(aa)) AS aas FROM code), thm AS (SELECT map(list(aa), list(name)) AS names FROM three),
    i AS (SELECT h.*, {_AA.format(s='old')} AS oa, {_AA.format(s='new')} AS na FROM h, aam),
    j AS (SELECT i.*, names[left(oa, 1)] || c1 || CASE WHEN c1 = c2 OR fs THEN '' ELSE '_' || names[right(oa, 1)] || c2 END AS span, array_to_string(list_transform(string_split(na, ''), lambda q: names[q]), '') AS nl FROM i, thm),
    n AS (SELECT mv, hl, c1, CASE WHEN fs THEN span || 'fs' WHEN oa = na THEN span || '=' WHEN c1 = c2 AND length(new) = 3 THEN span || nl WHEN na = '' THEN span || 'del' ELSE span || 'delins' || nl END AS p,
      CASE WHEN fs THEN left(oa, 1) || c1 || 'fs' WHEN oa = na THEN oa || c1 || '=' ELSE oa || c1 || coalesce(nullif(na, ''), '-') END AS aa,
      CASE WHEN fs THEN left(old, 3) || c1 || 'fs' ELSE old || c1 || coalesce(nullif(new, ''), '-') END AS codon,
      CASE WHEN fs THEN (c1 * 3 - 2) || 'fs' WHEN new = '' THEN (c1 * 3 - 2) || '_' || (c2 * 3) || 'del' ELSE (c1 * 3 - 2) || '_' || (c2 * 3) || 'delins' || new END AS c FROM j),
    tr AS (SELECT mv, hl, count(*) AS m, string_agg(p, ';' ORDER BY c1) AS p, string_agg(aa, '|' ORDER BY c1) AS aa, string_agg(codon, '|' ORDER BY c1) AS codon, string_agg(c, ';' ORDER BY c1) AS c FROM n GROUP BY mv, hl),
    wh AS (SELECT mv, hl, coalesce(string_agg(mut, ';' ORDER BY pos, mut) FILTER (WHERE pos BETWEEN 1 AND {B.ORF_LENGTH}), '=') AS hgvs_c, coalesce(string_agg(mut, ';' ORDER BY pos, mut) FILTER (WHERE pos NOT BETWEEN 1 AND {B.ORF_LENGTH}), '=') AS off_target FROM cl GROUP BY mv, hl),
    hg AS (SELECT wh.mv, wh.hl, hgvs_c, off_target, CASE WHEN m IS NULL THEN 'p.=' WHEN m = 1 THEN 'p.' || p ELSE 'p.[' || p || ']' END AS hgvs_p, CASE WHEN m IS NULL THEN 'c.=' WHEN m = 1 THEN 'c.' || c ELSE 'c.[' || c || ']' END AS codon_hgvs,
      coalesce(codon, 'WT') AS codon_changes, coalesce(aa, 'WT') AS aa_changes FROM wh LEFT JOIN tr ON tr.mv = wh.mv AND tr.hl = wh.hl) """
)


def blocks_of(table_name: str) -> str:
    """The translation in SQL of another table of calls; the reading frame is still that of all calls."""
    return _BLOCKS.replace("FROM cl, fr WHERE pos BETWEEN 1 AND length(orf)", f"FROM {table_name}, fr WHERE pos BETWEEN 1 AND length(orf)").replace("AS off_target FROM cl GROUP BY", f"AS off_target FROM {table_name} GROUP BY")


@query(B.with_tables("cl") + _BLOCKS + "SELECT mv AS movie, hl AS hole, hgvs_c, off_target, hgvs_p, codon_hgvs, codon_changes, aa_changes FROM hg")
def hgvs_translate(spark: SparkSession, folder: str) -> DataFrame:
    return T.translations(B.calls(spark, folder), reading_frame(spark, folder), ["movie", "hole"])


def _meanings(spark: SparkSession, folder: str) -> DataFrame:
    """``movie, hole, class, changes``: the class of each read's genotype by its protein-level meaning, and its changes."""
    reads = B.read_genotypes(spark, folder).select("movie", "hole")
    both = reads.join(hgvs_translate(spark, folder), ["movie", "hole"], "left").fillna({"hgvs_p": "p.=", "aa_changes": "WT"})
    return both.select("movie", "hole", T.variant_class(F.col("hgvs_p"), F.col("aa_changes")).alias("class"), F.split("aa_changes", r"\|").alias("changes"))


_CLASS = """, mn AS (SELECT rg.mv, rg.hl, coalesce(hgvs_p, 'p.=') AS hp, string_split(coalesce(aa_changes, 'WT'), '|') AS ch FROM rg LEFT JOIN hg ON hg.mv = rg.mv AND hg.hl = rg.hl),
    vk AS (SELECT mv, hl, ch, CASE WHEN ch = ['WT'] THEN 'WT' WHEN list_bool_or(list_transform(ch, lambda x: suffix(x, 'fs'))) THEN 'fs' WHEN contains(hp, 'Ter') AND NOT list_bool_and(list_transform(ch, lambda x: suffix(x, '='))) THEN 'stop' WHEN list_bool_and(list_transform(ch, lambda x: suffix(x, '='))) THEN 'syn' ELSE 'mis' END AS class FROM mn) """


@query(B.with_tables("rg", "cl") + _BLOCKS + _CLASS + "SELECT mv AS movie, hl AS hole, class FROM vk")
def protein_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Reads as wild type, frameshift, stop, synonymous or missense."""
    return _meanings(spark, folder).select("movie", "hole", "class")


@query(
    B.with_tables("rg", "cl")
    + _BLOCKS
    + _CLASS
    + r""", q AS (SELECT class, len(list_filter(ch, lambda x: NOT suffix(x, '=') AND x <> 'WT')) AS n, list_bool_or(list_transform(ch, lambda x: suffix(x, '-') OR regexp_matches(x, '\d+[A-Z*]{2,}$'))) AS ind FROM vk)
    SELECT CASE WHEN class = 'fs' THEN 'fs' WHEN ind THEN 'indel' WHEN class IN ('WT', 'syn') THEN 'WT' ELSE n::VARCHAR END AS changes, count(*) AS reads FROM q GROUP BY 1"""
)
def protein_census(spark: SparkSession, folder: str) -> DataFrame:
    """Reads by their number of amino-acid changes; frameshifts, in-frame indels and those without any change apart."""
    m = _meanings(spark, folder)
    indel = F.exists("changes", lambda x: x.endswith("-") | x.rlike(r"\d+[A-Z*]{2,}$"))
    n = F.size(F.filter("changes", lambda x: ~x.endswith("=") & (x != "WT")))
    label = F.when(F.col("class") == "fs", "fs").when(indel, "indel").when(F.col("class").isin("WT", "syn"), "WT").otherwise(n.cast("string"))
    return m.groupBy(label.alias("changes")).agg(F.count(F.lit(1)).alias("reads"))


@query(
    B.with_tables("cl")
    + _FRAME
    + f""", o AS (SELECT DISTINCT geno, pos, CASE kind WHEN 'ins' THEN alt || substr(orf, pos, 1) WHEN 'del' THEN '' ELSE alt END AS b FROM cl JOIN rg USING (mv, hl), fr WHERE pos BETWEEN 1 AND {B.ORF_LENGTH}),
    n AS (SELECT *, coalesce(lead(pos) OVER (PARTITION BY geno ORDER BY pos), {B.ORF_LENGTH} + 1) AS nx FROM o),
    z AS (SELECT geno, substr(any_value(orf), 1, min(pos) - 1) || string_agg(b || substr(orf, pos + 1, nx - pos - 1), '' ORDER BY pos) AS s FROM n, fr GROUP BY geno),
    d AS (SELECT geno, coalesce(s, orf) AS s FROM (SELECT DISTINCT geno FROM rg) LEFT JOIN z USING (geno), fr) SELECT geno, CAST(length(s) AS INTEGER) AS length, md5(s) AS digest FROM d"""
)
def genotype_apply(spark: SparkSession, folder: str) -> DataFrame:
    genos = B.read_genotypes(spark, folder).select("geno").distinct()
    made = genos.select("geno", T.apply_calls(F.lit(reading_frame(spark, folder)), S.calls_of(F.col("geno"))).alias("s"))
    return made.select("geno", F.length("s").alias("length"), F.md5("s").alias("digest"))
