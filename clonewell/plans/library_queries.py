"""Queries of the library side: barcodes, calls, preclusters, collisions, clones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window as W

from clonewell.functions import seq as S
from clonewell.functions.reads import hole_of, movie_of, operation_of
from clonewell.operators import extract as X, library as L
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


@query(_W("ln") + "SELECT DISTINCT seq, reverse(translate(seq, 'ACGT', 'TGCA')) AS revcomp, length(seq) AS len FROM ln WHERE seq IS NOT NULL")
def reverse_complement(spark: SparkSession, folder: str) -> DataFrame:
    seqs = B.lines(spark, folder).where("seq IS NOT NULL").select("seq").distinct()
    return seqs.select("seq", S.reverse_complement(F.col("seq")).alias("revcomp"), F.length("seq").cast("bigint").alias("len"))


@query(
    """SELECT line_id, CAST(round_even(avg(ascii(b) - 33), 0) AS INTEGER) AS mean_q, CAST(min(ascii(b) - 33) AS INTEGER) AS min_q, count(*) FILTER (WHERE ascii(b) - 33 < 20) AS low
    FROM (SELECT line_id, unnest(string_split(qual, '')) AS b FROM barcode_lines WHERE length(qual) > 0) GROUP BY line_id"""
)
def phred_stats(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "barcode_lines").where(F.length("qual") > 0)
    q = t.select("line_id", S.mean_phred(F.col("qual")).alias("mean_q"), S.phred(F.col("qual")).alias("q"))
    return q.select("line_id", "mean_q", F.array_min("q").alias("min_q"), F.size(F.filter("q", lambda x: x < 20)).cast("bigint").alias("low"))


@query("SELECT line_id, string_agg(chr(CAST(least(ascii(b) - 33 + 10, 60) + 33 AS INTEGER)), '' ORDER BY i) AS qual FROM (SELECT line_id, unnest(string_split(qual, '')) AS b, generate_subscripts(string_split(qual, ''), 1) AS i FROM barcode_lines WHERE length(qual) > 0) GROUP BY line_id")
def phred_recode(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "barcode_lines").where(F.length("qual") > 0)
    raised = F.transform(S.phred(F.col("qual")), lambda q: q + 10)
    return t.select("line_id", S.quality_string(raised, cap=60).alias("qual"))


@query(_W("cl") + r"SELECT DISTINCT mut, regexp_replace(mut, '\D+', '', 'g') AS digits, kind, ref, alt, CASE WHEN kind = 'ins' THEN CAST(pos - 1 AS VARCHAR) || '_' || mut ELSE mut END AS notation FROM cl")
def call_parts(spark: SparkSession, folder: str) -> DataFrame:
    m = B.calls(spark, folder)
    return m.select("mut", S.digits(F.col("mut")).alias("digits"), "kind", "ref", "alt", S.insertion_notation(F.col("mut")).alias("notation")).distinct()


@query(
    _W("rg", "cl")
    + f"""SELECT g.mv AS movie, g.hl AS hole, coalesce(string_agg(mut, ';' ORDER BY pos, mut) FILTER (WHERE pos BETWEEN 1 AND {B.ORF_LENGTH}), '=') AS main,
    coalesce(string_agg(mut, ';' ORDER BY pos, mut) FILTER (WHERE pos NOT BETWEEN 1 AND {B.ORF_LENGTH}), '=') AS outside FROM rg g LEFT JOIN cl c ON c.mv = g.mv AND c.hl = g.hl GROUP BY g.mv, g.hl"""
)
def off_target_split(spark: SparkSession, folder: str) -> DataFrame:
    def packed(inside: bool):
        chosen = F.filter("c", lambda c: S.in_frame(c["pos"], B.ORF_LENGTH) if inside else ~S.in_frame(c["pos"], B.ORF_LENGTH))
        text = F.array_join(F.transform(F.array_sort(F.transform(chosen, lambda c: F.struct(c["pos"], c["mut"]))), lambda x: x["mut"]), ";")
        return F.when(text == "", "=").otherwise(text)

    return B.read_genotypes(spark, folder).withColumn("c", S.calls_of(F.col("geno"))).select("movie", "hole", packed(True).alias("main"), packed(False).alias("outside"))


@query(
    _W("rg", "cl")
    + """SELECT g.mv AS movie, g.hl AS hole, CASE WHEN count(c.mut) = 0 THEN 'WT' WHEN bool_or(kind <> 'sub' AND length(coalesce(alt, '')) % 3 <> 0 OR kind = 'del') THEN 'fs'
    WHEN count(c.mut) = 1 THEN 'single' ELSE 'multi' END AS class, count(c.mut) AS n_calls FROM rg g LEFT JOIN cl c ON c.mv = g.mv AND c.hl = g.hl GROUP BY g.mv, g.hl"""
)
def variant_classes(spark: SparkSession, folder: str) -> DataFrame:
    shifted = F.exists("c", lambda c: (c["kind"] == "del") | ((c["kind"] == "ins") & (F.length(c["alt"]) % 3 != 0)))
    n = F.size("c")
    label = F.when(n == 0, "WT").when(shifted, "fs").when(n == 1, "single").otherwise("multi")
    return B.read_genotypes(spark, folder).withColumn("c", S.calls_of(F.col("geno"))).select("movie", "hole", label.alias("class"), n.cast("bigint").alias("n_calls"))


@query(
    """SELECT line_id, string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) AS at FROM (SELECT line_id, upper(trim(readbase)) AS t, unnest(generate_series(1, length(trim(readbase)) - 4)) AS i FROM barcode_lines)
    WHERE regexp_full_match(substr(t, i, 5), '[GN][AN][CN][TN][CN]') GROUP BY line_id"""
)
def wildcard_search(spark: SparkSession, folder: str) -> DataFrame:
    text = F.upper(F.trim("readbase"))
    hits = S.positions_of(text, "GACTC")
    t = table(spark, folder, "barcode_lines").where(text.rlike(S.degenerate_pattern("GACTC")))
    return t.select("line_id", F.array_join(F.transform(hits, lambda i: i.cast("string")), ",").alias("at"))


@query(
    _W("ln")
    + """SELECT line_id, regexp_extract(seq, 'AGTC([ACGTN]{6,10}?)GAC', 1) AS "between" FROM ln WHERE regexp_matches(seq, 'AGTC[ACGTN]{6,10}?GAC')"""
)
def between_flanks(spark: SparkSession, folder: str) -> DataFrame:
    rows = B.lines(spark, folder).where(F.col("seq").rlike("AGTC[ACGTN]{6,10}?GAC"))
    return rows.select("line_id", S.between_flanks(F.col("seq"), "AGTC", "GAC", 8, 2).alias("between"))


@query(_W("ln") + "SELECT line_id, nullif(instr(seq, 'GTC'), 0) AS first_at, CASE WHEN instr(seq, 'GTC') > 0 THEN length(seq) - instr(reverse(seq), 'CTG') - 1 END AS last_at, replace(seq, 'GTC', '') AS excised FROM ln WHERE seq IS NOT NULL")
def excise_and_locate(spark: SparkSession, folder: str) -> DataFrame:
    s, part = F.col("seq"), F.lit("GTC")
    rows = B.lines(spark, folder).where("seq IS NOT NULL")
    return rows.select("line_id", S.first_position(s, part).cast("bigint").alias("first_at"), S.last_position(s, part).cast("bigint").alias("last_at"), S.without(s, part).alias("excised"))


@query(_W("virt") + "SELECT mv AS movie, hl AS hole, up, virtual, loci, CASE WHEN up IS NOT NULL THEN substr(virtual, length(up) + 1) END AS down FROM virt")
def virtual_barcodes(spark: SparkSession, folder: str) -> DataFrame:
    v = L.convert_library(B.virtual_barcodes(spark, folder), "down").withColumnRenamed("barcode", "down")
    return v.select("movie", "hole", "up", "virtual", F.col("loci").cast("bigint").alias("loci"), "down")


@query(_W("ln") + "SELECT seq AS barcode, min(line_id) OVER w AS cluster_id, line_id AS row_id, count(*) OVER w AS size FROM ln WHERE seq IS NOT NULL WINDOW w AS (PARTITION BY seq)")
def precluster_members(spark: SparkSession, folder: str) -> DataFrame:
    return L.precluster_members(B.lines(spark, folder), F.col("seq"), F.col("line_id"))


@query(
    _W("ln")
    + """SELECT seq AS barcode, pos, CAST(CASE WHEN count(*) > 1 THEN least(sum(q), 93) ELSE sum(q) END AS INTEGER) AS q, count(*) AS n FROM (
    SELECT seq, ascii(b) - 33 AS q, pos FROM (SELECT seq, unnest(string_split(qual, '')) AS b, CAST(generate_subscripts(string_split(qual, ''), 1) AS INTEGER) AS pos FROM ln WHERE seq IS NOT NULL AND good_qual)) GROUP BY seq, pos"""
)
def precluster_quality(spark: SparkSession, folder: str) -> DataFrame:
    return L.precluster_quality(B.lines(spark, folder).where("good_qual"), F.col("seq"), F.col("qual"))


@query("SELECT bclen AS value, count(*) AS n FROM barcode_lines GROUP BY bclen")
def value_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return L.histogram(table(spark, folder, "barcode_lines"), F.col("bclen")).withColumn("value", F.col("value").cast("int"))


@query(_W("ln") + "SELECT n AS value, count(*) AS n FROM (SELECT count(*) AS n FROM ln WHERE seq IS NOT NULL GROUP BY seq) GROUP BY 1")
def histogram_of_histogram(spark: SparkSession, folder: str) -> DataFrame:
    sizes = B.lines(spark, folder).where("seq IS NOT NULL").groupBy("seq").count()
    return L.histogram(sizes, F.col("count"))


@query(
    _W("ln")
    + """SELECT v AS value, count(s) AS n FROM (SELECT unnest(generate_series(1, 20)) AS v) LEFT JOIN (SELECT least(count(*), 20) AS s FROM ln WHERE seq IS NOT NULL GROUP BY seq) ON s = v GROUP BY v"""
)
def capped_histogram(spark: SparkSession, folder: str) -> DataFrame:
    sizes = B.lines(spark, folder).where("seq IS NOT NULL").groupBy("seq").count()
    return L.histogram(sizes, F.col("count"), cap=20, fill=True)


@query(_W("clones") + "SELECT virtual, up, geno, size, CASE WHEN count(*) OVER (PARTITION BY virtual) > 1 THEN 'collision' ELSE '' END AS collision, CASE WHEN up IS NOT NULL AND count(*) OVER (PARTITION BY up) > 1 THEN 'collision' ELSE '' END AS up_collision FROM clones")
def collision_tags(spark: SparkSession, folder: str) -> DataFrame:
    return L.tag_collisions(L.tag_collisions(B.clones(spark, folder), "virtual"), "up", "up_collision").select("virtual", "up", "geno", "size", "collision", "up_collision")


@query(_W("clones") + "SELECT virtual, geno, size FROM (SELECT *, count(*) OVER (PARTITION BY up) AS k FROM clones) WHERE (up IS NULL OR k = 1) AND size >= 2")
def hard_filter(spark: SparkSession, folder: str) -> DataFrame:
    return L.clean_rows(L.tag_collisions(B.clones(spark, folder), "up", "tag"), "tag").select("virtual", "geno", "size")


@query(_W("clones") + "SELECT virtual, geno, size FROM (SELECT *, sum(size) OVER (PARTITION BY virtual) AS t FROM clones) WHERE size / t > 2 / 3.0::DOUBLE AND size >= 2")
def dominance_filter(spark: SparkSession, folder: str) -> DataFrame:
    return L.dominant(B.clones(spark, folder), "virtual", "size").select("virtual", "geno", "size")


@query(
    _W("clones")
    + """, a AS (SELECT virtual, geno, CAST(sum(size) AS BIGINT) AS s FROM clones WHERE up IS NOT NULL GROUP BY ALL), b AS (SELECT substr(virtual, 1, 25) AS virtual, geno, CAST(sum(size) AS BIGINT) AS s FROM clones GROUP BY ALL)
    SELECT coalesce(a.virtual, b.virtual) AS virtual, coalesce(a.geno, b.geno) AS geno, CAST(coalesce(a.s, 0) + coalesce(b.s, 0) AS BIGINT) AS size,
    CASE WHEN a.s IS NOT NULL AND b.s IS NOT NULL THEN 'merged' WHEN a.s IS NOT NULL THEN 'first' WHEN b.virtual IN (SELECT virtual FROM a) THEN 'conflict' ELSE 'new' END AS status
    FROM a FULL JOIN b ON a.virtual = b.virtual AND a.geno = b.geno"""
)
def library_merge(spark: SparkSession, folder: str) -> DataFrame:
    c = B.clones(spark, folder)
    return L.merge_libraries(c.where("up IS NOT NULL"), c.withColumn("virtual", F.substring("virtual", 1, 25)), key="virtual")


@query(
    _W("clones")
    + """, rp AS (SELECT lower(movie) AS mv, max(replicate) AS replicate FROM movies WHERE movie IS NOT NULL GROUP BY 1),
    rr AS (SELECT v.mv, v.hl, replicate, virtual, up, coalesce(string_agg(c.mut, ';' ORDER BY c.pos, c.mut), '=') AS geno FROM virt v JOIN rp USING (mv) JOIN rg g ON g.mv = v.mv AND g.hl = v.hl LEFT JOIN cl c ON c.mv = v.mv AND c.hl = v.hl WHERE up IS NOT NULL GROUP BY ALL),
    a AS (SELECT up, geno, virtual, count(*) AS size, row_number() OVER (PARTITION BY up, geno ORDER BY count(*) DESC, virtual) AS k FROM rr WHERE replicate = 1 GROUP BY up, geno, virtual),
    b AS (SELECT up, geno, count(*) AS more FROM rr WHERE replicate = 2 GROUP BY ALL)
    SELECT a.up, a.geno, virtual, CAST(size + CASE WHEN k = 1 THEN coalesce(more, 0) ELSE 0 END AS BIGINT) AS size, CASE WHEN k = 1 AND more IS NOT NULL THEN 'merged' ELSE 'first' END AS status FROM a LEFT JOIN b ON b.up = a.up AND b.geno = a.geno
    UNION ALL SELECT up, geno, NULL, more, CASE WHEN up IN (SELECT up FROM a) THEN 'conflict' ELSE 'new' END FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.up = b.up AND a.geno = b.geno)"""
)
def library_join(spark: SparkSession, folder: str) -> DataFrame:
    """The clones of the movies of the first replicates, joined by those of the second; a clone joins the largest one with its first barcode and genotype."""
    replicate = table(spark, folder, "movies").where("movie IS NOT NULL").groupBy(F.lower("movie").alias("movie")).agg(F.max("replicate").alias("replicate"))
    muts = F.array_join(F.transform(F.array_sort(F.transform(S.calls_of(F.col("geno")), lambda c: F.struct(c["pos"], c["mut"]))), lambda x: x["mut"]), ";")
    reads = B.virtual_barcodes(spark, folder).where("up IS NOT NULL").join(small(replicate), "movie").join(B.read_genotypes(spark, folder), ["movie", "hole"])
    clones = stage(reads.groupBy("replicate", "up", "virtual", F.when(muts == "", "=").otherwise(muts).alias("geno")).agg(F.count(F.lit(1)).alias("size")), "clones")
    return L.join_libraries(clones.where("replicate = 1"), clones.where("replicate = 2"), ["up", "geno"], "virtual")


@query(
    """WITH c AS (SELECT regexp_extract(lower(read_id), '^\\s*@?\\s*([^/\\s@]+)/\\d+', 1) AS mv, CAST(regexp_extract(read_id, '^\\s*@?\\s*[^/\\s@]+/0*(\\d+)', 1) AS BIGINT) AS hl, call_id, attempt, refpos, upper(refbase) AS refbase, upper(readbase) AS readbase, qual,
      CASE WHEN lower(trim(op)) IN ('sub','subst','substitution','snv','snp','mismatch','x') THEN 'sub' WHEN lower(trim(op)) IN ('ins','insertion','i') THEN 'ins' WHEN lower(trim(op)) IN ('del','deletion','d') THEN 'del' END AS op FROM bcs),
    u AS (SELECT * FROM c WHERE refpos IS NOT NULL AND ((op = 'sub' AND length(refbase) = 1 AND length(readbase) = 1) OR (op = 'ins' AND length(readbase) > 0) OR (op = 'del' AND length(refbase) > 0))),
    l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mv, hl, refpos ORDER BY attempt DESC, call_id DESC) AS k FROM u) WHERE k = 1),
    q AS (SELECT *, CASE WHEN length(qual) > 0 THEN CAST(round_even(list_avg(list_transform(string_split(qual, ''), lambda b: ascii(b) - 33)), 0) AS INTEGER) ELSE 0 END AS mq FROM l),
    t AS (SELECT mv, hl, refpos AS place, refpos || refbase || '>' || readbase || ':' || mq AS text FROM q WHERE op = 'sub' UNION ALL SELECT mv, hl, refpos, refpos || 'ins' || readbase || ':' || mq FROM q WHERE op = 'ins'
      UNION ALL SELECT mv, hl, refpos + d, (refpos + d) || 'del:' || mq FROM (SELECT *, unnest(generate_series(0, length(refbase) - 1)) AS d FROM q WHERE op = 'del'))
    SELECT mv AS movie, hl AS hole, string_agg(text, ';' ORDER BY place, text) AS geno FROM t GROUP BY mv, hl"""
)
def genotype_texts(spark: SparkSession, folder: str) -> DataFrame:
    """The packed genotype of each read from its basecalls, of each position the latest usable delivery."""
    t = table(spark, folder, "bcs")
    c = t.select(movie_of(F.col("read_id")).alias("movie"), hole_of(F.col("read_id")).alias("hole"), "call_id", "attempt", "refpos", F.upper("refbase").alias("refbase"), F.upper("readbase").alias("readbase"), "qual", operation_of(F.col("op")).alias("op"))
    usable = (F.col("op") == "sub") & (F.length("refbase") == 1) & (F.length("readbase") == 1) | (F.col("op") == "ins") & (F.length("readbase") > 0) | (F.col("op") == "del") & (F.length("refbase") > 0)
    last = c.where(F.col("refpos").isNotNull() & usable).groupBy("movie", "hole", "refpos").agg(F.max_by(F.struct("op", "refbase", "readbase", "qual"), F.struct("attempt", "call_id")).alias("c"))
    lines = last.select(F.struct("movie", "hole").alias("read_id"), "refpos", "c.*")
    return X.genotype_texts(lines, 1).select("read_id.movie", "read_id.hole", "geno")


@query(
    _W("virt", "cl")
    + """, s AS (SELECT virtual, count(*) AS size FROM virt GROUP BY virtual), m AS (SELECT virtual, mut, min(pos) AS pos, count(*) AS n, sum(q) AS q FROM virt v JOIN cl c ON c.mv = v.mv AND c.hl = v.hl GROUP BY virtual, mut)
    SELECT s.virtual, s.size, coalesce(string_agg(mut, ';' ORDER BY pos, mut) FILTER (WHERE q - 40 * (s.size - n) > 0), '=') AS geno FROM s LEFT JOIN m ON m.virtual = s.virtual WHERE s.size > 1 GROUP BY s.virtual, s.size"""
)
def consensus_genotype(spark: SparkSession, folder: str) -> DataFrame:
    reads = B.virtual_barcodes(spark, folder)
    sizes = reads.groupBy("virtual").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    seen = reads.select("movie", "hole", "virtual").join(B.calls(spark, folder), ["movie", "hole"]).groupBy("virtual", "mut").agg(F.min("pos").alias("pos"), F.count(F.lit(1)).alias("n"), F.sum("q").alias("q"))
    kept = seen.join(sizes, "virtual").where(F.col("q") - 40 * (F.col("size") - F.col("n")) > 0)
    # bounded: at most one entry per position and change of the amplicon
    geno = kept.groupBy("virtual").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "mut"))), lambda x: x["mut"]), ";").alias("geno"))
    return sizes.join(geno, "virtual", "left").select("virtual", "size", F.coalesce("geno", F.lit("=")).alias("geno"))


@query(
    _W("virt", "cl")
    + """, s AS (SELECT virtual, min(mv) AS mv, min(hl) AS hl FROM virt GROUP BY virtual HAVING count(*) = 1)
    SELECT s.virtual, coalesce(string_agg(mut, ';' ORDER BY pos, mut) FILTER (WHERE q >= 40), '=') AS geno FROM s LEFT JOIN cl c ON c.mv = s.mv AND c.hl = s.hl GROUP BY s.virtual"""
)
def singleton_genotype(spark: SparkSession, folder: str) -> DataFrame:
    alone = B.virtual_barcodes(spark, folder).groupBy("virtual").agg(F.count(F.lit(1)).alias("size"), F.min("movie").alias("movie"), F.min("hole").alias("hole")).where("size = 1")
    text = F.array_join(F.transform(F.array_sort(F.transform(F.filter(S.calls_of(F.col("geno")), lambda c: c["q"] >= 40), lambda c: F.struct(c["pos"], c["mut"]))), lambda x: x["mut"]), ";")
    geno = B.read_genotypes(spark, folder).select("movie", "hole", F.nullif(text, F.lit("")).alias("geno"))
    return alone.join(geno, ["movie", "hole"], "left").select("virtual", F.coalesce("geno", F.lit("=")).alias("geno"))


@query(
    _W("virt", "cl")
    + """, m AS (SELECT virtual, mut, count(*) AS n, CAST(sum(q) AS BIGINT) AS q FROM virt v JOIN cl c ON c.mv = v.mv AND c.hl = v.hl GROUP BY virtual, mut) SELECT virtual, mut, n, q FROM m WHERE n > 1 OR q > 40"""
)
def error_filter(spark: SparkSession, folder: str) -> DataFrame:
    seen = B.virtual_barcodes(spark, folder).join(B.calls(spark, folder), ["movie", "hole"]).groupBy("virtual", "mut").agg(F.count(F.lit(1)).alias("n"), F.sum("q").alias("q"))
    return seen.where((F.col("n") > 1) | (F.col("q") > 40))


@query(
    _W("virt")
    + """SELECT up, virtual AS consensus, n FROM (SELECT up, virtual, count(*) AS n, row_number() OVER (PARTITION BY up ORDER BY count(*) DESC, min(mv || '/' || hl)) AS k FROM virt WHERE up IS NOT NULL GROUP BY up, virtual) WHERE k = 1"""
)
def consensus_mode(spark: SparkSession, folder: str) -> DataFrame:
    reads = B.virtual_barcodes(spark, folder).where("up IS NOT NULL")
    counts = reads.groupBy("up", "virtual").agg(F.count(F.lit(1)).alias("n"), F.min(F.concat_ws("/", "movie", F.col("hole").cast("string"))).alias("first"))
    best = counts.groupBy("up").agg(F.min(F.struct((-F.col("n")).alias("neg"), "first", "virtual", "n")).alias("b"))
    return best.select("up", F.col("b.virtual").alias("consensus"), F.col("b.n").alias("n"))


@query(
    _W("ln")
    + """SELECT bcid, CAST(pos AS INTEGER) AS pos, base, count(*) AS n FROM (SELECT bcid, generate_subscripts(string_split(seq, ''), 1) AS pos, unnest(string_split(seq, '')) AS base FROM ln WHERE seq IS NOT NULL
    AND length(seq) <= (SELECT quantile_disc(length(seq), 0.99) FROM ln WHERE seq IS NOT NULL)) GROUP BY ALL"""
)
def base_composition(spark: SparkSession, folder: str) -> DataFrame:
    rows = B.lines(spark, folder).where("seq IS NOT NULL").select("bcid", "seq")
    # exact discrete percentile of the lengths from their histogram, which has few rows
    h = rows.groupBy(F.length("seq").alias("len")).agg(F.count(F.lit(1)).alias("n"))
    run = h.select("len", F.sum("n").over(W.orderBy("len")).alias("upto"), F.sum("n").over(W.partitionBy()).alias("total"))
    longest = run.where(F.col("upto") * 100 >= F.col("total") * 99).agg(F.min("len").alias("longest"))
    kept = rows.join(F.broadcast(longest), F.length("seq") <= F.col("longest"))
    return kept.select("bcid", F.posexplode(F.split("seq", "")).alias("i", "base")).groupBy("bcid", (F.col("i") + 1).alias("pos"), "base").agg(F.count(F.lit(1)).alias("n"))


@query(
    _W("ln")
    + """SELECT bcid, CAST(pos AS INTEGER) AS pos, round(avg(q), 9) AS mean_q, count(*) AS n FROM (SELECT bcid, refpos + i AS pos, ascii(b) - 33 AS q FROM (
    SELECT bcid, refpos, unnest(string_split(qual, '')) AS b, generate_subscripts(string_split(qual, ''), 1) AS i FROM ln WHERE good_qual)) GROUP BY ALL"""
)
def positional_quality(spark: SparkSession, folder: str) -> DataFrame:
    bases = B.lines(spark, folder).where("good_qual").select("bcid", "refpos", F.posexplode(F.split("qual", "")).alias("i", "b"))
    return bases.groupBy("bcid", (F.col("refpos") + F.col("i") + 1).alias("pos")).agg(F.round(F.avg(F.ascii("b") - 33), 9).alias("mean_q"), F.count(F.lit(1)).alias("n"))


@query(_W("cl") + "SELECT mut, count(*) AS n FROM cl GROUP BY mut HAVING count(*) > (SELECT count(*) FROM cl) / 5000.0 ORDER BY n DESC, mut LIMIT 20")
def jackpot(spark: SparkSession, folder: str) -> DataFrame:
    c = B.calls(spark, folder)
    total = c.agg((F.count(F.lit(1)) / 5000).alias("least"))
    tally = c.groupBy("mut").agg(F.count(F.lit(1)).alias("n"))
    return tally.crossJoin(F.broadcast(total)).where("n > least").orderBy(F.desc("n"), "mut").limit(20).select("mut", "n")


@query(_W("rg", "cl") + "SELECT n AS n_calls, count(*) AS reads, count(*) FILTER (WHERE fs) AS frameshift FROM (SELECT count(c.mut) AS n, coalesce(bool_or(kind <> 'sub'), false) AS fs FROM rg g LEFT JOIN cl c ON c.mv = g.mv AND c.hl = g.hl GROUP BY g.mv, g.hl) GROUP BY n")
def census(spark: SparkSession, folder: str) -> DataFrame:
    r = B.read_genotypes(spark, folder).withColumn("c", S.calls_of(F.col("geno")))
    shifted = F.exists("c", lambda c: c["kind"] != "sub")
    return r.groupBy(F.size("c").cast("bigint").alias("n_calls")).agg(F.count(F.lit(1)).alias("reads"), F.count_if(shifted).alias("frameshift"))


@query(
    _W("rg", "cl")
    + """, k AS (SELECT mv, hl, count(*) AS m FROM cl GROUP BY mv, hl), t AS (SELECT ref, alt, CAST((pos - 1) % 3 + 1 AS INTEGER) AS codon_pos, m > 1 AS multi, count(*) AS n FROM cl JOIN k USING (mv, hl) WHERE kind = 'sub' AND pos > 0 GROUP BY ALL)
    SELECT ref, alt, codon_pos, multi, n, round(n / sum(n) OVER (PARTITION BY ref, codon_pos, multi), 9) AS share FROM t"""
)
def nucleotide_bias(spark: SparkSession, folder: str) -> DataFrame:
    r = B.read_genotypes(spark, folder).withColumn("c", S.calls_of(F.col("geno"))).select((F.size("c") > 1).alias("multi"), F.explode("c").alias("c")).select("multi", "c.*")
    t = r.where("kind = 'sub' AND pos > 0").groupBy("ref", "alt", ((F.col("pos") - 1) % 3 + 1).alias("codon_pos"), "multi").agg(F.count(F.lit(1)).alias("n"))
    return t.withColumn("share", F.round(F.col("n") / F.sum("n").over(W.partitionBy("ref", "codon_pos", "multi")), 9))


@query(
    _W("ln")
    + """, b AS (SELECT line_id, unnest(string_split(qual, '')) AS c FROM ln WHERE good_qual), q AS (SELECT line_id, ascii(c) - 33 AS q FROM b),
    m AS (SELECT quantile_disc(q, 0.5) AS med FROM q) SELECT line_id, count(*) FILTER (WHERE q < med) AS drops, round(avg(q), 9) AS mean_q FROM q, m GROUP BY line_id HAVING count(*) FILTER (WHERE q < med) > 13 OR avg(q) < 25"""
)
def low_quality_lines(spark: SparkSession, folder: str) -> DataFrame:
    bases = B.lines(spark, folder).where("good_qual").select("line_id", F.explode(F.split("qual", "")).alias("c"))
    h = bases.groupBy((F.ascii("c") - 33).alias("q")).agg(F.count(F.lit(1)).alias("n"))  # at most 94 rows
    run = h.select("q", F.sum("n").over(W.orderBy("q")).alias("upto"), F.sum("n").over(W.partitionBy()).alias("total"))
    med = run.where(F.col("upto") * 2 >= F.col("total")).agg(F.min("q").alias("med"))
    q = S.phred(F.col("qual"))
    rows = B.lines(spark, folder).where("good_qual").select("line_id", q.alias("q")).crossJoin(F.broadcast(med))  # one row
    drops = F.size(F.filter("q", lambda x: x < F.col("med"))).cast("bigint")
    mean = F.aggregate("q", F.lit(0), lambda a, x: a + x) / F.size("q")
    return rows.select("line_id", drops.alias("drops"), F.round(mean, 9).alias("mean_q"), mean.alias("_m")).where("drops > 13 OR _m < 25").drop("_m")


@query(
    """WITH u AS (SELECT bcid, refpos, bclen, count(*) AS n FROM barcode_lines GROUP BY ALL),
    l AS (SELECT bcid AS locus, first(refpos ORDER BY n DESC, refpos) AS site, first(bclen ORDER BY n DESC, bclen) AS len FROM u GROUP BY bcid)
    SELECT line_id, refpos, bclen FROM barcode_lines JOIN l ON bcid = locus WHERE abs(refpos - site) < 3 AND bclen >= len - 3"""
)
def locus_candidates(spark: SparkSession, folder: str) -> DataFrame:
    # the amplicon's loci: most frequent reference position of each barcode, and its usual length
    t = table(spark, folder, "barcode_lines")
    usual = t.groupBy("bcid", "refpos", "bclen").agg(F.count(F.lit(1)).alias("n"))
    loci = usual.groupBy(F.col("bcid").alias("locus")).agg(F.max_by("refpos", F.struct("n", -F.col("refpos"))).alias("at"), F.max_by("bclen", F.struct("n", -F.col("bclen"))).alias("len"))
    near = (F.abs(F.col("refpos") - F.col("at")) < 3) & (F.col("bclen") >= F.col("len") - 3) & (F.col("bcid") == F.col("locus"))
    return t.join(small(stage(loci, "loci")), near).select("line_id", "refpos", "bclen")
