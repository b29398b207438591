"""Session helpers: table loading, lineage cuts in the shared folder, size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Rows up to which a side may be broadcast by ``small``; beyond it Spark shuffles both sides.
BROADCAST_ROWS = 100_000
#: Bytes a Python model may have to be sent to every executor.
BROADCAST_BYTES = 64 << 20


def local_spark(cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the submitted session is used as it is."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("clonewell")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CLONEWELL_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The parquet table ``name`` of ``folder``."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Only where neither the setting nor a checkpoint folder exists (local tests) a folder of this
    machine is chosen, and never when executors run elsewhere.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        if known.isDefined():
            return known.get()
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-clonewell-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends here.

    Unlike ``checkpoint()`` the rows are computed a single time, columns stay prunable and a lost
    executor costs nothing. The folder goes when the driver's JVM ends, or earlier by ``unstage``.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/clonewell/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    out = spark.read.schema(df.schema).parquet(path)
    out._clonewell_path = path
    return out


def unstage(df: DataFrame | None) -> None:
    """Delete the folder of a staged table that no later plan reads."""
    path = getattr(df, "_clonewell_path", None)
    if path:
        target = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, else as it is.

    The count reads at most ``rows + 1`` rows of each partition.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
