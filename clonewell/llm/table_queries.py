"""Queries of the problems over the sequencing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clonewell.functions.reads import hole_of, movie_of, operation_of, sequence_of, usable_qual
from clonewell.llm.frequent import frequent_items
from clonewell.llm.percentiles import merge_counts, percentiles, value_counts
from clonewell.llm.star_components import star_components
from clonewell.llm.survivors import surviving_records, surviving_values
from clonewell.session import small, stage, table

FRACTIONS = ("0.01", "0.05", "0.25", "0.5", "0.75", "0.95", "0.99")


def _ranked(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table with its callers' trust_rank; a caller registered twice has the better rank."""
    callers = table(spark, folder, "callers").where("caller IS NOT NULL").groupBy("caller").agg(F.min("trust_rank").alias("trust_rank"))
    return table(spark, folder, name).join(small(callers), "caller", "left")


def _line_keys() -> dict:
    return {"movie": movie_of(F.col("read_id")), "hole": hole_of(F.col("read_id")), "bcid": F.col("bcid")}


def _line_usable() -> dict:
    return {"readbase": sequence_of(F.col("readbase")).isNotNull(), "qual": usable_qual(F.col("qual"), F.col("bclen"))}


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    lines = surviving_values(_ranked(spark, folder, "barcode_lines"), _line_keys(), F.col("line_id"), _line_usable(), F.col("trust_rank"), F.col("called_at"))
    keys = {"movie": movie_of(F.col("read_id")), "hole": hole_of(F.col("read_id")), "refpos": F.col("refpos")}
    calls = surviving_values(_ranked(spark, folder, "bcs"), keys, F.col("call_id"), {"op": operation_of(F.col("op")).isNotNull()}, F.col("trust_rank"), F.col("called_at"))
    return lines.select(F.lit("barcode_lines").alias("tab"), "field", "row_id").unionByName(calls.select(F.lit("bcs").alias("tab"), "field", "row_id"))


def p1_records(spark: SparkSession, folder: str) -> DataFrame:
    fields = {n: (F.col(n), u) for n, u in _line_usable().items()}
    return surviving_records(_ranked(spark, folder, "barcode_lines"), _line_keys(), F.col("line_id"), fields, F.col("trust_rank"), F.col("called_at"))


def _daily_qualities(spark: SparkSession, folder: str) -> DataFrame:
    """The summary of each day's usable qualities, as it would be kept: ``movie, bcid, day, value, n``."""
    lines = table(spark, folder, "barcode_lines").where(usable_qual(F.col("qual"), F.col("bclen")))
    # keys are made once per line, below the generator, which then repeats them for each base
    keyed = lines.select(movie_of(F.col("read_id")).alias("movie"), "bcid", F.to_date("loaded_at").alias("day"), "qual")
    bases = keyed.select("movie", "bcid", "day", F.explode(F.split("qual", "")).alias("base"))
    return value_counts(bases, {c: F.col(c) for c in ("movie", "bcid", "day")}, F.ascii("base") - 33)


def p2_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    days = stage(_daily_qualities(spark, folder), "days")
    out = percentiles(merge_counts(days, ["movie", "bcid"]), ["movie", "bcid"], FRACTIONS)
    return out.select("movie", "bcid", "fraction", F.col("value").alias("phred"), F.col("total").alias("n_bases"))


def linked_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs ``a, b`` that link two different lines of one locus at a distance of at most 2."""
    lines = table(spark, folder, "barcode_lines").select("line_id", "bcid")
    dist = F.when(F.col("dist") >= 0, F.col("dist")).otherwise(F.col("mismatch") + F.col("indel"))
    pairs = table(spark, folder, "barcode_matches").where((dist <= 2) & (F.col("query_id") != F.col("ref_id")))
    pairs = pairs.select(F.least("query_id", "ref_id").alias("a"), F.greatest("query_id", "ref_id").alias("b")).distinct()
    first = lines.select(F.col("line_id").alias("a"), F.col("bcid").alias("_a"))
    second = lines.select(F.col("line_id").alias("b"), F.col("bcid").alias("_b"))
    return pairs.join(first, "a").join(second, "b").where("_a = _b").select("a", "b")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return star_components(linked_lines(spark, folder), F.col("a"), F.col("b")).withColumnRenamed("node", "line_id")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    out = frequent_items(table(spark, folder, "barcode_lines"), sequence_of(F.col("readbase")), min_share=0.01)
    return out.select(F.col("item").alias("readbase"))


def p4_top(spark: SparkSession, folder: str) -> DataFrame:
    out = frequent_items(table(spark, folder, "barcode_lines"), sequence_of(F.col("readbase")), k=100)
    return out.select(F.col("item").alias("readbase"), "n")


QUERIES = {"p1_found": p1_found, "p1_records": p1_records, "p2_percentiles": p2_percentiles, "p3_found": p3_found, "p4_found": p4_found, "p4_top": p4_top}

_READ = r"""regexp_extract(lower(read_id), '^\s*@?\s*([^/\s@]+)/\d+', 1) AS movie, CAST(regexp_extract(read_id, '^\s*@?\s*[^/\s@]+/0*(\d+)', 1) AS BIGINT) AS hole"""
_RANK = "coalesce((SELECT min(c.trust_rank) FROM callers c WHERE c.caller = t.caller), 2147483647) AS trust"
_QUAL = "(length(qual) = bclen AND length(qual) > 0 AND replace(qual, '!', '') <> '')"
_BASE = "regexp_full_match(upper(trim(readbase)), '[ACGT]+')"
_OP = "lower(trim(op)) IN ('sub','subst','substitution','snv','snp','mismatch','x','ins','insertion','i','del','deletion','d')"
_POLICY = "trust, called_at DESC NULLS LAST"


def _best(tab: str, field: str, key: str, row: str, usable: str) -> str:
    return f"""SELECT '{tab}' AS tab, '{field}' AS field, row_id FROM (
        SELECT {row} AS row_id, n, row_number() OVER (PARTITION BY mv, hole, {key} ORDER BY {_POLICY}, {row}) AS k FROM (
            SELECT *, count(*) OVER (PARTITION BY mv, hole, {key}) AS n FROM (SELECT t.*, {_READ.replace('AS movie', 'AS mv')}, {_RANK} FROM {tab} t) WHERE {key} IS NOT NULL)
        WHERE {usable}) WHERE k = 1 AND n >= 2"""


_LINKS = """SELECT DISTINCT least(query_id, ref_id) AS a, greatest(query_id, ref_id) AS b FROM barcode_matches m
    JOIN barcode_lines x ON x.line_id = m.query_id JOIN barcode_lines y ON y.line_id = m.ref_id
    WHERE query_id <> ref_id AND x.bcid = y.bcid AND CASE WHEN dist >= 0 THEN dist ELSE mismatch + indel END <= 2"""

SQL = {
    "p1_found": " UNION ALL ".join(
        (
            _best("barcode_lines", "readbase", "bcid", "line_id", _BASE),
            _best("barcode_lines", "qual", "bcid", "line_id", _QUAL),
            _best("bcs", "op", "refpos", "call_id", _OP),
        )
    ),
    "p1_records": f"""SELECT mv AS movie, hole, bcid, count(*) AS n_rows,
        first(readbase ORDER BY {_POLICY}, line_id) FILTER (WHERE {_BASE}) AS readbase, first(qual ORDER BY {_POLICY}, line_id) FILTER (WHERE {_QUAL}) AS qual
        FROM (SELECT t.*, {_READ.replace('AS movie', 'AS mv')}, {_RANK} FROM barcode_lines t) GROUP BY mv, hole, bcid
        HAVING count(*) >= 2 AND (bool_or(coalesce({_BASE}, false)) OR bool_or(coalesce({_QUAL}, false)))""",
    "p2_percentiles": f"""WITH c AS (SELECT movie, bcid, ascii(b) - 33 AS phred, count(*) AS n FROM (
            SELECT {_READ}, bcid, unnest(string_split(qual, '')) AS b FROM barcode_lines WHERE {_QUAL}) GROUP BY ALL),
        r AS (SELECT *, sum(n) OVER (PARTITION BY movie, bcid ORDER BY phred) AS upto, sum(n) OVER (PARTITION BY movie, bcid) AS total FROM c),
        p AS (SELECT unnest([1, 5, 25, 50, 75, 95, 99]) AS pct)
        SELECT movie, bcid, pct / 100.0::DOUBLE AS fraction, CAST(min(phred) AS INTEGER) AS phred, CAST(total AS BIGINT) AS n_bases
        FROM r, p WHERE upto * 100 >= pct * total GROUP BY movie, bcid, pct, total""",
    "p3_found": f"""WITH RECURSIVE l AS ({_LINKS}), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        c(line_id, group_id) USING KEY (line_id) AS (
            SELECT a, min(least(a, b)) FROM e GROUP BY a
            UNION SELECT e.b, min(c.group_id) FROM c JOIN e ON e.a = c.line_id JOIN recurring.c AS o ON o.line_id = e.b WHERE c.group_id < o.group_id GROUP BY e.b)
        SELECT group_id, line_id FROM c""",
    "p4_found": f"SELECT s AS readbase FROM (SELECT upper(trim(readbase)) AS s FROM barcode_lines WHERE {_BASE}) GROUP BY s HAVING count(*) * 100 >= (SELECT count(*) FROM barcode_lines WHERE {_BASE})",
    "p4_top": f"SELECT s AS readbase, count(*) AS n FROM (SELECT upper(trim(readbase)) AS s FROM barcode_lines WHERE {_BASE}) GROUP BY s ORDER BY n DESC, s LIMIT 100",
}
