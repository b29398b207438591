"""Barcodes and genotypes from aligned reads: SAM fields in, basecalls, barcodes and packed genotypes out."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# SAM flag bits.
UNMAPPED, REVERSE, SECONDARY, FAILED = 0x4, 0x10, 0x100, 0x200

_CIGAR = re.compile(r"(\d+)([MIDNSHP=X])")
CALLS = "array<struct<op:string,refbase:string,refpos:int,readbase:string,qual:string>>"


@dataclass(frozen=True)
class Amplicon:
    """The reference without its barcodes (``sequence``), and where things lie on it.

    ``barcodes`` are the 1-based positions of the barcodes on the full amplicon, ``length`` theirs;
    ``orf_start`` and ``orf_end`` are positions on the sequence without barcodes.
    """

    sequence: str
    barcodes: tuple[int, ...]
    length: int
    orf_start: int
    orf_end: int

    @classmethod
    def from_full(cls, full: str, code: str, orf_start: int, orf_end: int) -> "Amplicon":
        """From the amplicon with its barcodes as a degenerate code, in one or two places, and the frame's positions on it."""
        full, places = full.upper(), []
        at = full.find(code)
        while at >= 0:
            places.append(at + 1)
            at = full.find(code, at + len(code))
        if not 1 <= len(places) <= 2:
            raise ValueError(f"the barcode code stands {len(places)} times in the amplicon")
        moved = [p - sum(len(code) for b in places if b < p) for p in (orf_start, orf_end)]
        return cls(full.replace(code, ""), tuple(places), len(code), *moved)

    def expected(self) -> list[int]:
        """Positions of the barcodes on the sequence without them."""
        return [p - k * self.length for k, p in enumerate(self.barcodes)]


def aligned(reads: DataFrame) -> DataFrame:
    """Reads that are mapped, passed quality control and aren't secondary; a null flag counts as unmapped."""
    return reads.where(F.col("flag").bitwiseAND(UNMAPPED | SECONDARY | FAILED) == 0)


def forward_pairs(reads: DataFrame) -> DataFrame:
    """Reads that are mapped forward and passed quality control."""
    return reads.where(F.col("flag").bitwiseAND(UNMAPPED | REVERSE | FAILED) == 0)


def covered_bases(cigar: Column) -> Column:
    """Reference bases that an alignment covers, deletions included."""
    lengths = F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), 1)
    return F.aggregate(lengths, F.lit(0), lambda a, x: a + x.cast("int"))


def covering(reads: DataFrame, lo: int, hi: int) -> DataFrame:
    """Reads whose alignment reaches from ``lo`` to ``hi``; null positions or CIGARs don't."""
    return reads.where(F.coalesce((F.col("pos") <= lo) & (F.col("pos") + covered_bases(F.col("cigar")) - 1 >= hi), F.lit(False)))


def _walk(pos: int, cigar: str, seq: str, qual: str, ref: str) -> list[tuple[str, str, int, str, str]]:
    """Differences of one aligned read from the reference: (op, refbase, refpos, readbase, qual).

    An insertion's refpos is the base before it; a deletion's qual is that of the read base before it.
    """
    out, r, q = [], pos, 0
    for n, op in ((int(n), op) for n, op in _CIGAR.findall(cigar)):
        if op in "M=X":
            for k in range(n):
                if seq[q + k] != ref[r - 1 + k : r + k]:
                    out.append(("sub", ref[r - 1 + k : r + k], r + k, seq[q + k], qual[q + k : q + k + 1]))
            r, q = r + n, q + n
        elif op == "I":
            out.append(("ins", "", r - 1, seq[q : q + n], qual[q : q + n]))
            q += n
        elif op in "DN":
            if op == "D":
                out.append(("del", ref[r - 1 : r - 1 + n], r, "", qual[max(0, q - 1) : q]))
            r += n
        elif op == "S":
            q += n
    return out


def basecalls(reads: DataFrame, reference: str) -> DataFrame:
    """``reads`` (``read_id, pos, cigar, seq, qual``) with ``calls``, the array of differences from the reference.

    The alignment is walked base by base, which no column expression can do; it is a map over Arrow batches.
    Reads with null or ``*`` fields have no calls.
    """

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            calls = []
            for p, c, s, q in zip(b["pos"], b["cigar"], b["seq"], b["qual"]):
                usable = c and s and p == p and p is not None and c != "*" and s != "*"
                calls.append([dict(zip(("op", "refbase", "refpos", "readbase", "qual"), x)) for x in _walk(int(p), c, s, q or "", reference)] if usable else [])
            yield pd.DataFrame({"read_id": b["read_id"], "calls": calls})

    return reads.select("read_id", "pos", "cigar", "seq", "qual").mapInPandas(walk, f"read_id string, calls {CALLS}")


def split_barcodes(calls: DataFrame, amplicon: Amplicon) -> tuple[DataFrame, DataFrame]:
    """(barcode lines, genotype lines) of exploded calls ``read_id, op, refbase, refpos, readbase, qual``.

    Insertions near exactly one locus (less than 3 bases off) and no more than 3 bases short are barcodes:
    ``bcid, bclen``, with sequences that were aligned a few bases off rotated back (``repaired``).
    All other calls are genotype lines.
    """
    spots = amplicon.expected()
    near = F.array_compact(F.array(*(F.when(F.abs(F.col("refpos") + 1 - p) < 3, F.lit(k + 1)) for k, p in enumerate(spots))))
    is_bc = (F.col("op") == "ins") & (F.length("readbase") >= amplicon.length - 3) & (F.size(near) == 1)
    lines = calls.withColumn("bcid", F.when(is_bc, F.get(near, F.lit(0)))).withColumn("bclen", F.length("readbase"))
    found = lines.where("bcid IS NOT NULL")
    expected = F.element_at(F.array(*(F.lit(p) for p in spots)), F.col("bcid"))
    shift = F.col("refpos") + 1 - expected
    ref = F.lit(amplicon.sequence)
    n = F.length("readbase")
    by = F.abs(shift)
    front, back = F.substr("readbase", F.lit(1), by), F.substr("readbase", n - by + 1, by)
    left = (shift < 0) & (front == F.substr(ref, expected + shift, by))
    right = (shift > 0) & (back == F.substr(ref, expected, by))
    turned = lambda c: (
        F.when(left, F.concat(F.substr(c, by + 1, n - by), F.substr(c, F.lit(1), by))).when(right, F.concat(F.substr(c, n - by + 1, by), F.substr(c, F.lit(1), n - by))).otherwise(F.col(c))
    )
    moved = F.coalesce(left | right, F.lit(False))
    barcodes = found.select("read_id", "bcid", "bclen", turned("readbase").alias("readbase"), turned("qual").alias("qual"), F.when(moved, expected - 1).otherwise(F.col("refpos")).alias("refpos"), moved.alias("repaired"))
    return barcodes, lines.where("bcid IS NULL").drop("bcid", "bclen")


def genotype_texts(lines: DataFrame, orf_start: int) -> DataFrame:
    """``read_id, geno``: the packed genotype of each read that has genotype lines, in order of position.

    A deletion of several bases gives one call per base. Qualities are mean Phred values, rounded half to even.
    """
    from clonewell.functions.seq import mean_phred

    q = F.coalesce(mean_phred(F.col("qual")), F.lit(0)).cast("string")
    at = F.col("refpos") - orf_start + 1
    each = F.transform(F.sequence(F.lit(0), F.length("refbase") - 1), lambda k: F.struct((at + k).alias("at"), F.concat((at + k).cast("string"), F.lit("del:"), q).alias("text")))
    single = lambda text: F.array(F.struct(at.alias("at"), text.alias("text")))
    sub = single(F.concat(at.cast("string"), "refbase", F.lit(">"), "readbase", F.lit(":"), q))
    ins = single(F.concat(at.cast("string"), F.lit("ins"), "readbase", F.lit(":"), q))
    parts = lines.select("read_id", F.explode(F.when(F.col("op") == "sub", sub).when(F.col("op") == "ins", ins).otherwise(each)).alias("c"))
    # the calls of one read
    return parts.groupBy("read_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda c: c["text"]), ";").alias("geno"))


def extract(reads: DataFrame, amplicon: Amplicon, max_drops: int, min_quality: float) -> DataFrame:
    """One row per SAM read: ``read_id, fate, barcodes, combo, combo_qual, geno``.

    Fates: ``failedQC``, ``insufficientCoverage``, ``missingBarcode`` (not every locus has one), ``lowQualBarcode`` (a barcode with
    more than ``max_drops`` bases below the median quality of all barcodes, or a mean below ``min_quality``) and ``ok``;
    only the last have barcodes, an array and joined in the order of loci (the first insertion of a locus counts), and a genotype.
    """
    lo = min(amplicon.orf_start, amplicon.orf_end, *amplicon.expected())
    hi = max(amplicon.orf_start, amplicon.orf_end, *amplicon.expected())
    mapped = aligned(reads)
    long = covering(mapped, lo, hi)
    calls = basecalls(long, amplicon.sequence).select("read_id", F.explode("calls").alias("c")).select("read_id", "c.*")
    barcodes, lines = split_barcodes(calls, amplicon)
    first = barcodes.groupBy("read_id", "bcid").agg(F.min_by(F.struct("readbase", "qual"), "refpos").alias("b")).select("read_id", "bcid", "b.*")
    values = first.select(F.explode(F.split("qual", "")).alias("x")).groupBy((F.ascii("x") - 33).alias("q")).agg(F.count(F.lit(1)).alias("n"))  # at most 94 rows
    from pyspark.sql.window import Window as W

    run = values.select("q", F.sum("n").over(W.orderBy("q")).alias("upto"), F.sum("n").over(W.partitionBy()).alias("total"))
    median = run.where("upto * 2 >= total").agg(F.min("q").alias("med"))
    phred = F.transform(F.split("qual", ""), lambda x: F.ascii(x) - 33)
    rated = first.crossJoin(F.broadcast(median)).withColumn("p", phred)  # one row
    bad = (F.size(F.filter("p", lambda x: x < F.col("med"))) > max_drops) | (F.aggregate("p", F.lit(0), lambda a, x: a + x) / F.size("p") < min_quality)
    loci = F.array_sort(F.collect_list(F.struct("bcid", "readbase", "qual")))  # one per locus
    per = rated.groupBy("read_id").agg(F.count(F.lit(1)).alias("loci"), F.bool_or(bad).alias("low"), loci.alias("l"))
    joined = lambda f: F.array_join(F.transform("l", lambda x: x[f]), "")
    status = reads.select("read_id").distinct().join(mapped.select("read_id", F.lit(True).alias("mapped")).distinct(), "read_id", "left")
    status = status.join(long.select("read_id", F.lit(True).alias("long")).distinct(), "read_id", "left").join(per, "read_id", "left").join(genotype_texts(lines, amplicon.orf_start), "read_id", "left")
    fate = (
        F.when(F.col("mapped").isNull(), "failedQC")
        .when(F.col("long").isNull(), "insufficientCoverage")
        .when(F.coalesce("loci", F.lit(0)) < len(amplicon.barcodes), "missingBarcode")
        .when(F.col("low"), "lowQualBarcode")
        .otherwise("ok")
    )
    ok = F.col("fate") == "ok"
    return status.withColumn("fate", fate).select("read_id", "fate", F.when(ok, F.transform("l", lambda x: x["readbase"])).alias("barcodes"), F.when(ok, joined("readbase")).alias("combo"), F.when(ok, joined("qual")).alias("combo_qual"), F.when(ok, F.coalesce("geno", F.lit("="))).alias("geno"))
