"""What several operators need: the shared folder, free column names, words."""

from __future__ import annotations

import ctypes
import gc
import os
import sys
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrain.session import shared_dir

HOME = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Fixed by the contracts: a word is a run of characters other than these six.
WORD_GAP = "[\\x20\\x09-\\x0D]+"
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/llm/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: lineage ends there, and Spark knows the size from then on."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, with underscores added until no column of `df` has that name (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def give_back() -> None:
    """Return to the machine what Arrow and the C library hold of memory that is no longer used. The latter keeps all pages
    below its last block in use, and so most of what large arrays have taken between small objects that stay."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc
        trim(0)


def release_memory() -> None:
    """Let go of what earlier tasks of this Python worker have kept for later ones: a tokenizer with its remembered pieces,
    and unused memory. Workers serve many stages in turn; an operator that needs none of it calls this first."""
    if tokens := sys.modules.get("tripgrain.llm.tokens"):
        tokens.encoder.cache_clear()
    gc.collect()
    give_back()


def without(df: DataFrame, *names: str) -> DataFrame:
    """`df` less the columns that a result is about to add."""
    return df.drop(*names)


def lower_ascii(column: Column) -> Column:
    return F.translate(column, ASCII_UPPER, ASCII_LOWER)


def words_of(text: Column) -> Column:
    """Words as an array; none for null or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id written as text, modulo `divisor`; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def _reach(spark: SparkSession) -> None:
    """Python workers look for this package where the driver has found it (a cluster has it installed or gets it by
    --py-files)."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if HOME not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([HOME, *filter(None, known)])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    _reach(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")
