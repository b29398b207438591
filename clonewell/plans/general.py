"""The general problem: results per sequence where a few sequences hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clonewell.functions.reads import sequence_of
from clonewell.operators.skew import aggregate_hot_keys
from clonewell.session import table


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "barcode_lines")
    out = aggregate_hot_keys(lines, sequence_of(F.col("readbase")), F.col("line_id"), F.col("called_at"), min_rows=2)
    return out.select(F.col("key").alias("readbase"), "line_id")


def p5_sequences(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "barcode_lines")
    out = aggregate_hot_keys(lines, sequence_of(F.col("readbase")), F.col("line_id"), F.col("called_at"), sums={"bases": F.col("bclen")})
    return out.withColumnRenamed("key", "readbase")


QUERIES = {"p5_found": p5_found, "p5_sequences": p5_sequences}

_USABLE = "SELECT upper(trim(readbase)) AS s, * FROM barcode_lines WHERE regexp_full_match(upper(trim(readbase)), '[ACGT]+')"
_LATEST = "first(line_id ORDER BY called_at DESC NULLS LAST, line_id)"

SQL = {
    "p5_found": f"SELECT s AS readbase, {_LATEST} AS line_id FROM ({_USABLE}) GROUP BY s HAVING count(*) >= 2",
    "p5_sequences": f"""SELECT s AS readbase, count(*) AS n_rows, {_LATEST} AS line_id, min(called_at) AS first_at, max(called_at) AS last_at,
        CAST(sum(bclen) AS BIGINT) AS bases FROM ({_USABLE}) GROUP BY s""",
}
