"""Delimited tables, SAM lines, FASTA records and sample files as DataFrames; and sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from clonewell.session import small

CALLS = "read_id string, geno string"
DISTANCES = "query_id bigint, ref_id bigint, mismatch int, indel int, dist int"
CLUSTERS = "virtual string, up string, reads string, size bigint, geno string"
LIBRARY = "barcode string, hgvsc string, hgvsp string, codon_changes string, codon_hgvs string, aa_changes string, aa_hgvs string, off_target string, size bigint"
SAMPLES = "sample string, assay string, cond string, replicate int"
REGIONS = "region string, start_aa int, end_aa int, file string"


def read_delimited(spark: SparkSession, path: str, schema: str, header: bool = True, sep: str = ",") -> DataFrame:
    """A CSV or TSV file (compressed or not) with the given schema, by position; malformed rows raise."""
    return spark.read.csv(path, schema=schema, header=header, sep=sep, mode="FAILFAST")


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of SAM text: ``read_id, flag, rname, pos, mapq, cigar, seq, qual, score, nm, md``; header lines are skipped, missing values null.

    Files are split by lines, and columns that aren't used are never parsed.
    """
    parts = spark.read.text(path).where(~F.col("value").startswith("@") & (F.col("value") != "")).select("value", F.split("value", "\t").alias("f"))
    field = lambda k: F.nullif(F.get("f", F.lit(k)), F.lit("*"))
    tag = lambda name, kind: F.nullif(F.regexp_extract("value", rf"\t{name}:{kind}:([^\t]*)", 1), F.lit(""))
    return parts.select(
        field(0).alias("read_id"),
        field(1).cast("int").alias("flag"),
        field(2).alias("rname"),
        F.nullif(field(3).cast("int"), F.lit(0)).alias("pos"),
        field(4).cast("int").alias("mapq"),
        field(5).alias("cigar"),
        field(9).alias("seq"),
        field(10).alias("qual"),
        tag("AS", "i").cast("int").alias("score"),
        tag("NM", "i").cast("int").alias("nm"),
        tag("MD", "Z").alias("md"),
    )


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """``name, seq`` of each FASTA record, upper case without white space; text before the first record is ignored."""
    blocks = spark.read.text(path, lineSep=">").where(F.length(F.trim("value")) > 0)
    name = F.trim(F.regexp_extract("value", r"^([^\r\n]*)", 1))
    seq = F.upper(F.regexp_replace(F.regexp_replace("value", r"^[^\r\n]*", ""), r"\s+", ""))
    return blocks.select(F.element_at(F.split(name, r"\s+"), 1).alias("name"), seq.alias("seq"))


def with_sample(reads: DataFrame, samples: DataFrame, column: str = "file") -> DataFrame:
    """``reads`` with ``sample`` and ``mate`` (1 or 2) by their file's name: the sample's name up to ``_R1`` or ``_R2``, compared whole."""
    base = F.element_at(F.split(F.col(column), "/"), -1)
    named = reads.withColumn("sample", F.regexp_extract(base, r"^(.+?)(?:_S\d+)?(?:_L\d+)?_R[12]", 1)).withColumn("mate", F.regexp_extract(base, r"_R([12])", 1).cast("int"))
    return named.join(small(samples.select("sample").distinct()), "sample", "left_semi")


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """``value, n`` of lines ``count value`` with leading blanks."""
    t = spark.read.text(path).select(F.regexp_extract("value", r"^\s*(\d+)\s+(.*)$", 1).alias("n"), F.regexp_extract("value", r"^\s*(\d+)\s+(.*)$", 2).alias("value"))
    return t.where("n <> ''").select("value", F.col("n").cast("bigint").alias("n"))


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """``name, n``: counters of lines ``name=count``, summed over all files."""
    t = spark.read.text(path).select(F.regexp_extract("value", r"^\s*([^=\s]+)\s*=\s*(\d+)\s*$", 1).alias("name"), F.regexp_extract("value", r"=\s*(\d+)\s*$", 1).alias("n"))
    return t.where("name <> '' AND n <> ''").groupBy("name").agg(F.sum(F.col("n").cast("bigint")).alias("n"))


def read_log_counters(spark: SparkSession, path: str) -> DataFrame:
    """``file, total, extract, passfilter, failed_extraction, failed_filter`` of extraction logs, whose fourth to sixth lines say ``there are N``; one row per file, null where a line doesn't."""
    lines = F.split("value", "\n")
    found = [F.nullif(F.regexp_extract(F.get(lines, F.lit(k)), r"there are (\d+) ", 1), F.lit("")).cast("bigint") for k in (3, 4, 5)]
    logs = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), *(c.alias(n) for c, n in zip(found, ("total", "extract", "passfilter"))))
    return logs.select("*", (F.col("total") - F.col("extract")).alias("failed_extraction"), (F.col("extract") - F.col("passfilter")).alias("failed_filter"))


def concatenate(*parts: DataFrame) -> DataFrame:
    """The rows of chunks with their ``chunk`` number, so that sorting by it keeps the chunks' order where a sink needs it."""
    numbered = [p.withColumn("chunk", F.lit(k)) for k, p in enumerate(parts)]
    return reduce(DataFrame.unionByName, numbered)


def write_csv(df: DataFrame, path: str, quote_all: bool = False) -> None:
    """Compressed CSV files with header; arrays must be packed before."""
    df.write.csv(path, header=True, compression="gzip", quoteAll=quote_all)


def write_maps(df: DataFrame, path: str) -> None:
    """One folder of CSV files per assay and condition."""
    df.write.partitionBy("assay", "cond").csv(path, header=True)
