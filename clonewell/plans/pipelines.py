"""The two whole pipelines: from aligned long reads to a barcode library, and from short reads to scores."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from clonewell.functions.seq import calls_of
from clonewell.operators import caller, cluster, consensus, enrich, extract, library, translate
from clonewell.sources.sheets import LibraryParameters
from clonewell.session import stage


@dataclass(frozen=True)
class Library:
    """``reads``: fate, barcodes and genotype of every read. ``clusters``: read_id, barcode, cluster.
    ``clones``: one row per cluster with barcode, genotype, its meaning, and collision tags.
    ``strict``: clones of at least two reads whose barcode is unique. ``soft``: clones that hold most reads of their barcode."""

    reads: DataFrame
    clusters: DataFrame
    clones: DataFrame
    strict: DataFrame
    soft: DataFrame

    def fates(self) -> DataFrame:
        return self.reads.groupBy("fate").agg(F.count(F.lit(1)).alias("n"))


def build_library(sam: DataFrame, amplicon: extract.Amplicon, p: LibraryParameters) -> Library:
    """A library from SAM reads (columns of ``sources.tables.read_sam``).

    Reads are clustered by the barcode that ``p.mode`` names: all loci joined, the first one or the last one.
    ``up`` is the first locus' barcode; strict and soft filters look at its collisions. Stages end in the shared folder.
    """
    reads = stage(extract.extract(sam, amplicon, p.max_drops, p.min_quality), "extracted")
    ok = reads.where("fate = 'ok'")
    barcode = {"virtual": F.col("combo"), "uptag": F.get("barcodes", F.lit(0)), "downtag": F.element_at("barcodes", -1)}[p.mode]
    coded = ok.select("read_id", barcode.alias("barcode"))
    calls = stage(ok.select("read_id", F.explode(calls_of(F.col("geno"))).alias("c")).select("read_id", "c.*"), "calls")
    seeds = stage(cluster.seed_clusters(coded, calls, p.min_jaccard, p.min_matches, p.min_call_quality), "seeds")
    merged = cluster.merge_clusters(seeds, calls, p.max_diff, p.min_jaccard, p.min_call_quality) if p.max_diff else seeds
    clusters = stage(merged, "clusters")
    genos = consensus.consensus_genotypes(clusters, calls, p.min_call_quality)
    codes = consensus.consensus_barcodes(clusters).withColumnRenamed("consensus", "virtual")
    ups = consensus.consensus_barcodes(clusters.select("read_id", "cluster").join(ok.select("read_id", F.get("barcodes", F.lit(0)).alias("barcode")), "read_id")).withColumnRenamed("consensus", "up")
    clones = stage(genos.join(codes, "cluster").join(ups, "cluster"), "clones")
    orf = amplicon.sequence[amplicon.orf_start - 1 : amplicon.orf_end]
    called = clones.select("cluster", F.explode(calls_of(_with_quality(F.col("geno")))).alias("c")).select("cluster", "c.*")
    meaning = translate.translations(called, orf, ["cluster"])
    full = clones.join(meaning, "cluster", "left").fillna({"hgvs_c": "=", "hgvs_p": "p.=", "aa_changes": "WT", "off_target": "="})
    tagged = stage(library.tag_collisions(library.tag_collisions(full, "virtual"), "up", "up_collision"), "tagged")
    return Library(reads, clusters, tagged, library.clean_rows(tagged, "up_collision"), library.dominant(tagged, "up", "size"))


def _with_quality(geno):
    """Consensus calls carry no qualities; the parser of packed calls wants one."""
    return F.array_join(F.transform(F.split(geno, ";"), lambda x: F.concat(x, F.lit(":0"))), ";")


def _is_stop(change):
    """``W5*``, but not the unchanged stop ``*20=``."""
    return change.rlike(r"\*$|Ter$")


@dataclass(frozen=True)
class Assay:
    """``counts``: sample, fate, hit, n. ``ratios`` and ``scores`` by library barcode and condition. ``variants`` and ``joint`` by amino-acid change."""

    counts: DataFrame
    ratios: DataFrame
    scores: DataFrame
    variants: DataFrame
    joint: DataFrame


def score_assay(barcodes: DataFrame, lib: DataFrame, samples: DataFrame, assay: str, cond: str, max_errors: int = 1, min_freq: float = 0.0, bottleneck: float | None = None, given: tuple[float | None, float | None] = (None, None)) -> Assay:
    """Scores of one condition of an assay from read barcodes (``sample, read_id, barcode``) and a library (``barcode, aa_changes, hgvs_p``).

    Wild-type rows are those without amino-acid changes, null rows those whose ``hgvs_p`` ends in ``Ter``. With
    ``bottleneck``, controls need that mean count in all conditions of the assay, clones in the one scored.
    ``given`` are medians of the wild type and of null rows to take instead of those measured. A clone with a stop counts for its stops only.
    """
    counts = stage(caller.call_reads(barcodes, lib.select(F.col("barcode").alias("seq")), max_errors), "hits")
    hits = counts.where("fate = 'hit'").select(F.col("hit").alias("lib_row"), "sample", "n")
    stats = stage(enrich.replicate_stats(enrich.frequencies(hits, samples), samples), "stats")
    lrs = stage(enrich.log_ratios(stats, enrich.pseudocount(stats)), "ratios")
    known = lrs.join(lib.select(F.col("barcode").alias("lib_row"), "aa_changes", "hgvs_p"), "lib_row")
    if bottleneck is not None:
        known = known.join(enrich.wide_enough(stats, bottleneck), ["lib_row", "assay"], "left_semi")
    medians = enrich.control_medians(known, F.col("aa_changes") == "WT", F.col("hgvs_p").rlike(r"Ter\]?$"), min_freq, given)
    scores = stage(enrich.scores(lrs, medians), "scores")
    chosen = enrich.passing(scores.where((F.col("assay") == assay) & (F.col("cond") == cond)), min_freq)
    if bottleneck is not None:
        counted = stats.where((F.col("assay") == assay) & (F.col("cond") == cond) & (F.col("mean_count") >= bottleneck))
        chosen = chosen.join(counted.select("lib_row"), "lib_row", "left_semi")
    clones = chosen.join(lib.select(F.col("barcode").alias("lib_row"), "aa_changes"), "lib_row").where(~F.col("aa_changes").contains("fs"))
    parts = F.split(F.when(F.col("aa_changes") == "WT", "=").otherwise(F.col("aa_changes")), "\\|")
    stops = F.filter(parts, _is_stop)
    # a stop hides the other changes; a clone of a stop and others isn't a single mutant, so it keeps its number of changes
    muts = clones.select(F.col("lib_row").alias("clone"), F.when(F.size(stops) > 0, stops).otherwise(parts).alias("muts"), F.size(parts).alias("k"), "score", "sd")
    variants = stage(enrich.variant_estimates(stage(muts, "muts"), samples.select("replicate").distinct().count()), "variants")
    return Assay(counts, lrs, scores, variants, enrich.joint_table(variants))
