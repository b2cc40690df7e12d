"""Rows dealt to weighted shards by rendezvous hashing, with DataFrame functions only.

Every shard draws a number for a row's key, from a hash of both; the shard whose weighted number is highest takes the row.
A draw depends on nothing but key and shard, so one more shard takes rows only into itself, and about its share of them.
A key's rows always share a shard.

A row's slot is its place in its shard by key. The rows are sorted by ranges and numbered by the files they lie in, so
no shard is ever brought into one task; of rows with one key, the place in the stored table decides, so that they too can
be dealt to many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrain.llm.common import free_name, stored, without
from tripgrain.operators.positions import with_file_place, with_positions

DIGITS = 13  # hexadecimal digits of MD5 that make a draw: 52 bits, which a double holds exactly
EQUAL_SHARDS = (1.0,) * 16


def _draw(key: Column, shard: Column, weight: Column) -> Column:
    """A shard's weighted number for a key: -weight / ln(u), u uniform in (0, 1). The highest of several wins with a
    probability in proportion to its weight."""
    digest = F.md5(F.concat(key, F.lit(":"), shard.cast("string")).cast("binary"))
    drawn = F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("long")
    return -weight / F.ln((drawn + F.lit(0.5)) / F.lit(float(16**DIGITS)))


def with_shards(docs: DataFrame, key: str = "doc_id", weights: Sequence[float] = EQUAL_SHARDS, next_weight: float = 1.0) -> DataFrame:
    """`docs` with `shard` (0 to len(weights) - 1) and `grown_shard`, the shard if one more of `next_weight` were there.

    A null key is the empty text, so such rows share a shard. Columns of these names are replaced. No shuffle.
    """
    if not weights or min(*weights, next_weight) <= 0:
        raise ValueError("a shard's weight must be above zero, and there must be a shard")
    rest = without(docs, "shard", "grown_shard")
    name, best = free_name(rest, "key_text"), free_name(rest, "best_draw")
    if key.lower() in ("shard", "grown_shard"):
        raise ValueError("the key can't be a column that is replaced")
    keyed = rest.withColumn(name, F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")))
    table = F.array(*(F.lit(float(w)) for w in weights))
    # the lesser shard of equal draws
    draws = F.transform(table, lambda w, i: F.struct(_draw(F.col(name), i, w).alias("draw"), (-i).alias("shard")))
    drawn = keyed.withColumn(best, F.array_max(draws))
    extra = _draw(F.col(name), F.lit(len(weights)), F.lit(float(next_weight)))
    shard = -F.col(best)["shard"]
    grown = F.when(extra > F.col(best)["draw"], F.lit(len(weights))).otherwise(shard)
    return drawn.select(*rest.columns, shard.cast("int").alias("shard"), grown.cast("int").alias("grown_shard"))


def shard_rows(docs: DataFrame, key: str = "doc_id", weights: Sequence[float] = EQUAL_SHARDS, next_weight: float = 1.0) -> DataFrame:
    """`docs` with `shard`, `grown_shard` and `slot`: the row's place in its shard, gapless from 0, by key (null first).

    The columns given are sorted and stored on the way, so pass the narrow ones; `write_shards` moves texts. Equal rows
    have slots of their own; an empty table gives no rows. Columns of the result's names are replaced.
    """
    rows = stored(with_shards(without(docs, "slot"), key, weights, next_weight), "shards")
    file, place = free_name(rows, "stored_file"), free_name(rows, "stored_place")
    order = (F.asc("shard"), F.asc(f"`{key}`"), F.asc(file), F.asc(place))
    return with_positions(with_file_place(rows, file, place), *order, name="slot", within=["shard"]).drop(file, place)


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", weights: Sequence[float] = EQUAL_SHARDS) -> None:
    """Write whole rows below `path`, a folder per shard. Rows move once; a large shard is written by many tasks."""
    dealt = with_shards(docs, key, weights).drop("grown_shard")
    dealt.hint("rebalance", "shard").write.mode("errorifexists").partitionBy("shard").parquet(path)


def read_shard(spark: SparkSession, path: str, shard: int) -> DataFrame:
    """The rows of one shard; the other folders are not read."""
    return spark.read.parquet(path).where(F.col("shard") == shard)
