"""Derived tables that several queries share, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clonewell.functions.reads import hole_of, movie_of, sequence_of, usable_qual
from clonewell.functions.seq import calls_of
from clonewell.session import small, stage, table

#: Length of the reading frame of the amplicon: positions beyond it, or below 1, are off target.
ORF_LENGTH = 900


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Barcode lines with movie, hole and sequence (``seq``, null where unusable)."""
    t = table(spark, folder, "barcode_lines")
    return t.select("line_id", movie_of(F.col("read_id")).alias("movie"), hole_of(F.col("read_id")).alias("hole"), "attempt", "bcid", "bclen", "refpos", sequence_of(F.col("readbase")).alias("seq"), "qual", usable_qual(F.col("qual"), F.col("bclen")).alias("good_qual"), "called_at", "loaded_at", "caller")


def barcodes(spark: SparkSession, folder: str) -> DataFrame:
    """``movie, hole, bcid, seq``: of each read and locus the usable barcode of the latest attempt (then of the largest id)."""
    return lines(spark, folder).where("seq IS NOT NULL").groupBy("movie", "hole", "bcid").agg(F.max_by("seq", F.struct("attempt", "line_id")).alias("seq"))


def virtual_barcodes(spark: SparkSession, folder: str) -> DataFrame:
    """``movie, hole, up, virtual, loci``: the barcodes of a read joined in the order of their loci; ``up`` is that of locus 1."""
    loci = F.array_sort(F.collect_list(F.struct("bcid", "seq")))  # one per locus
    reads = barcodes(spark, folder).groupBy("movie", "hole").agg(loci.alias("l"), F.max(F.when(F.col("bcid") == 1, F.col("seq"))).alias("up"))
    return reads.select("movie", "hole", "up", F.array_join(F.transform("l", lambda x: x["seq"]), "").alias("virtual"), F.size("l").alias("loci"))


def read_genotypes(spark: SparkSession, folder: str) -> DataFrame:
    """``movie, hole, geno``: one genotype per read, the smallest text if deliveries differ."""
    g = table(spark, folder, "genotypes").where("geno IS NOT NULL")
    return g.select(movie_of(F.col("read_id")).alias("movie"), hole_of(F.col("read_id")).alias("hole"), "geno").groupBy("movie", "hole").agg(F.min("geno").alias("geno"))


def calls(spark: SparkSession, folder: str) -> DataFrame:
    """``movie, hole, pos, kind, ref, alt, q, mut``: the calls of each read's genotype."""
    return read_genotypes(spark, folder).select("movie", "hole", F.explode(calls_of(F.col("geno"))).alias("c")).select("movie", "hole", "c.*")


def samples(spark: SparkSession, folder: str) -> DataFrame:
    """``sample`` (the movie), assay (lower case, blanks trimmed), cond, replicate; movies without assay are no samples."""
    m = table(spark, folder, "movies")
    assay = F.lower(F.trim("assay"))
    return m.where(F.length(F.trim("assay")) > 0).select(F.lower("movie").alias("sample"), assay.alias("assay"), "cond", "replicate")


def clones(spark: SparkSession, folder: str) -> DataFrame:
    """``virtual, up, geno, size``: reads with the same virtual barcode and the same set of calls, sorted by position."""
    muts = F.array_join(F.transform(F.array_sort(F.transform(calls_of(F.col("geno")), lambda c: F.struct(c["pos"], c["mut"]))), lambda x: x["mut"]), ";")
    geno = F.when(muts == "", "=").otherwise(muts)
    reads = virtual_barcodes(spark, folder).join(read_genotypes(spark, folder), ["movie", "hole"])
    found = reads.select("virtual", "up", geno.alias("geno")).groupBy("virtual", "up", "geno").agg(F.count(F.lit(1)).alias("size"))
    return stage(found, "clones")  # collisions and totals read it several times


def variant_counts(spark: SparkSession, folder: str) -> DataFrame:
    """``lib_row, sample, n``: reads of each sample with a call, or with none (``=``)."""
    reads = read_genotypes(spark, folder)
    each = F.explode(F.when(F.size("c") == 0, F.array(F.lit("="))).otherwise(F.array_distinct(F.transform("c", lambda c: c["mut"]))))
    rows = reads.withColumn("c", calls_of(F.col("geno"))).select(F.col("movie").alias("sample"), each.alias("lib_row"))
    known = samples(spark, folder).select("sample")
    return rows.join(small(known), "sample", "left_semi").groupBy("lib_row", "sample").agg(F.count(F.lit(1)).alias("n"))


_MV = r"regexp_extract(lower(read_id), '^\s*@?\s*([^/\s@]+)/\d+', 1)"
_HL = r"CAST(regexp_extract(read_id, '^\s*@?\s*[^/\s@]+/0*(\d+)', 1) AS BIGINT)"
_CALL = r"'^(-?\d+)(?:([ACGT])>([ACGT])|(ins)([ACGT]+)|(del)):(-?\d+)$'"


def with_tables(*names: str) -> str:
    """WITH clause of the derived tables named, with those they need."""
    need: list[str] = []
    for n in names:
        for m in [*_NEEDS.get(n, ()), n]:
            if m not in need:
                need.append(m)
    return "WITH " + ", ".join(f"{n} AS ({_TABLES[n]})" for n in need) + " "


_NEEDS = {
    "bar": ("ln",),
    "virt": ("ln", "bar"),
    "cl": ("rg",),
    "clones": ("ln", "bar", "virt", "rg", "cl"),
    "vc": ("rg", "cl", "smp"),
}
_TABLES = {
    "ln": f"""SELECT line_id, {_MV} AS mv, {_HL} AS hl, attempt, bcid, bclen, refpos, CASE WHEN regexp_full_match(upper(trim(readbase)), '[ACGT]+') THEN upper(trim(readbase)) END AS seq,
        qual, coalesce(length(qual) = bclen AND length(qual) > 0 AND replace(qual, '!', '') <> '', false) AS good_qual, called_at, loaded_at, caller FROM barcode_lines""",
    "bar": "SELECT mv, hl, bcid, first(seq ORDER BY attempt DESC, line_id DESC) AS seq FROM ln WHERE seq IS NOT NULL GROUP BY mv, hl, bcid",
    "virt": "SELECT mv, hl, max(CASE WHEN bcid = 1 THEN seq END) AS up, string_agg(seq, '' ORDER BY bcid) AS virtual, count(*) AS loci FROM bar GROUP BY mv, hl",
    "rg": f"SELECT mv, hl, min(geno) AS geno FROM (SELECT {_MV} AS mv, {_HL} AS hl, geno FROM genotypes WHERE geno IS NOT NULL) GROUP BY mv, hl",
    "cl": rf"""SELECT mv, hl, CAST(regexp_extract(x, {_CALL}, 1) AS INTEGER) AS pos,
        CASE WHEN regexp_extract(x, {_CALL}, 4) <> '' THEN 'ins' WHEN regexp_extract(x, {_CALL}, 6) <> '' THEN 'del' ELSE 'sub' END AS kind,
        regexp_extract(x, {_CALL}, 2) AS ref, CASE WHEN regexp_extract(x, {_CALL}, 4) <> '' THEN regexp_extract(x, {_CALL}, 5) ELSE regexp_extract(x, {_CALL}, 3) END AS alt,
        CAST(regexp_extract(x, {_CALL}, 7) AS INTEGER) AS q, regexp_replace(x, ':-?\d+$', '') AS mut
        FROM (SELECT mv, hl, trim(unnest(string_split(geno, ';'))) AS x FROM rg) WHERE regexp_full_match(x, {_CALL})""",
    "smp": "SELECT lower(movie) AS sample, lower(trim(assay)) AS assay, cond, replicate FROM movies WHERE length(trim(assay)) > 0",
    "clones": """SELECT virtual, up, geno, count(*) AS size FROM (SELECT v.mv, v.hl, virtual, up, coalesce(string_agg(c.mut, ';' ORDER BY c.pos, c.mut), '=') AS geno
        FROM virt v JOIN rg g ON g.mv = v.mv AND g.hl = v.hl LEFT JOIN cl c ON c.mv = v.mv AND c.hl = v.hl GROUP BY v.mv, v.hl, virtual, up) GROUP BY virtual, up, geno""",
    "vc": """SELECT lib_row, mv AS sample, count(*) AS n FROM (SELECT DISTINCT g.mv, g.hl, coalesce(c.mut, '=') AS lib_row FROM rg g LEFT JOIN cl c ON c.mv = g.mv AND c.hl = g.hl)
        WHERE mv IN (SELECT sample FROM smp) GROUP BY lib_row, mv""",
}
