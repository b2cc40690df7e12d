"""Session defaults and the folder all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Set on the builder; an existing cluster session keeps whatever it already has.
SESSION_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # call-site capture costs about a millisecond per column expression while a plan is declared
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`; in local mode, where it is unset, one below the warehouse."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return (named or spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse") + "/_checkpoints").rstrip("/")


def drop_copies(spark: SparkSession) -> None:
    """Remove all copies stored for this application, of every package; frames that read them are of no use afterwards."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/*/{spark.sparkContext.applicationId}")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in files.globStatus(pattern) or ():
        files.delete(found.getPath(), True)


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is ever overwritten or reused across runs."""
    return f"{shared_dir(spark)}/tripgrain/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Used where several consumers follow. The copy outlives lost executors, and being Parquet it still
    gives every consumer column pruning and filter pushdown.
    """
    spark = df.sparkSession
    path = run_dir(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
