"""Running counts over barcode lines as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clonewell.functions.reads import movie_of, sequence_of, usable_qual


def arriving_lines(spark: SparkSession, path: str, schema: str, files_per_batch: int = 8) -> DataFrame:
    """A stream of parquet files with barcode lines."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def running_fates(lines: DataFrame) -> DataFrame:
    """``movie, n, failed, poor, kept``: read fates by movie so far; the state is one row per movie. Works on streams and tables."""
    bad = sequence_of(F.col("readbase")).isNull()
    good = usable_qual(F.col("qual"), F.col("bclen"))
    return lines.groupBy(movie_of(F.col("read_id")).alias("movie")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("failed"), F.count_if(~bad & ~good).alias("poor"), F.count_if(~bad & good).alias("kept")
    )


def daily_counts(lines: DataFrame, lateness: str = "30 days") -> DataFrame:
    """``day, bcid, n`` by loading day; on a stream, days older than the lateness are closed and their state dropped."""
    timed = lines.withWatermark("loaded_at", lateness) if lines.isStreaming else lines
    return timed.groupBy(F.window("loaded_at", "1 day").alias("w"), "bcid").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").cast("date").alias("day"), "bcid", "n")
