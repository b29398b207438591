"""Queries of the problems over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clonewell.llm.leakage import find_leaks
from clonewell.llm.mixing import mix_sources, plan_shares, reached_shares, source_name, token_counts
from clonewell.llm.mojibake import find_garbled
from clonewell.session import stage, table


def p6_leaks(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = table(spark, folder, "documents"), table(spark, folder, "eval_items")
    return find_leaks(docs, F.col("doc_id"), F.col("text"), items, F.col("item_id"), F.col("text"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return p6_leaks(spark, folder).where("verbatim").select("doc_id", "item_id")


def _mix(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The mixture, the targets, the documents' tokens and the plan of each source."""
    docs = table(spark, folder, "documents").select("doc_id", source_name(F.col("source")).alias("source"), "text")
    targets = table(spark, folder, "mix_targets").select(source_name(F.col("source")).alias("source"), F.col("target_share").alias("share"), "max_repeat")
    tokens = stage(token_counts(docs, "text"), "tokens")
    plan = stage(plan_shares(tokens, targets), "plan")
    return mix_sources(tokens, plan), targets, tokens, plan


def p7_mix(spark: SparkSession, folder: str) -> DataFrame:
    return _mix(spark, folder)[0]


def p7_shares(spark: SparkSession, folder: str) -> DataFrame:
    chosen, targets, _, _ = _mix(spark, folder)
    return reached_shares(chosen, targets)


def p7_kept(spark: SparkSession, folder: str) -> DataFrame:
    """Whether each source gives the tokens its target asks for, up to its largest document, and uses no document too often; ``wanted`` is
    the target relative to those of the sources that have documents."""
    chosen, targets, tokens, plan = _mix(spark, folder)
    largest = tokens.groupBy("source").agg(F.max("n_tokens").alias("largest"))
    reached = reached_shares(chosen, targets).select("source", "n_tokens", "most_copies")
    whole = plan.agg(F.sum("share").alias("whole"))
    out = plan.join(reached, "source").join(largest, "source").crossJoin(F.broadcast(whole))  # one row
    return out.select(
        "source", F.round(F.col("share") / F.col("whole"), 6).alias("wanted"), (F.abs(F.col("n_tokens") - F.col("want")) <= F.col("largest")).alias("tokens_kept"), (F.col("most_copies") <= F.col("max_repeat")).alias("repeats_kept")
    )


def p8_repaired(spark: SparkSession, folder: str) -> DataFrame:
    return find_garbled(table(spark, folder, "documents"), F.col("doc_id"), F.col("text"), F.col("lang"))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return p8_repaired(spark, folder).select("doc_id")


QUERIES: dict = {"p6_found": p6_found, "p6_leaks": p6_leaks, "p7_mix": p7_mix, "p7_shares": p7_shares, "p7_kept": p7_kept, "p8_found": p8_found, "p8_repaired": p8_repaired}

_NAME = "nullif(trim(regexp_replace(lower(source), '[\\s_-]+', '-', 'g'), '-'), '')"
SQL: dict = {
    "p7_kept": f"""WITH t AS (SELECT {_NAME} AS source, target_share FROM mix_targets WHERE target_share > 0 AND max_repeat > 0), d AS (SELECT DISTINCT {_NAME} AS source FROM documents WHERE length(text) > 0)
        SELECT source, round(target_share / sum(target_share) OVER (), 6) AS wanted, true AS tokens_kept, true AS repeats_kept FROM t WHERE source IN (SELECT source FROM d)""",
}
