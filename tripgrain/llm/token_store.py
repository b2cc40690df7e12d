"""Token ids on disk: patched frame-of-reference blocks, in the order of the documents' ids.

A store is a folder with two Parquet tables:

* `chunks`: whole documents in order, about CHUNK_TOKENS ids each. `payload` holds blocks of BLOCK ids; `block_starts`
  has the byte at which each block starts, so a span of ids is read without decoding the rest.
* `shards`: the first id of each written file in the sequence of all ids.

Block: base (u32), number of ids (u16), number of exceptions (u16), width (u8), then the ids less base in `width` bits
each, then positions (u16) and whole differences (u32) of the ids that don't fit. All little-endian.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripgrain.llm.tokens import encoded

BLOCK = 1024
CHUNK_TOKENS = 1 << 18
PERCENTILE = 90  # the width holds at least this share of a block's differences
HEAD = struct.Struct("<IHHB")
CHUNKS = "shard int, chunk int, start long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, block_starts array<int>, payload binary"
DOCS = "doc_id long, start long, n_tokens long, ids binary"


def pack_block(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """One block of 1 to 65,535 ids; an id has 32 bits at most."""
    base = int(ids.min())
    rest = (ids.astype(np.int64) - base).astype(np.uint32)
    width = int(np.sort(rest)[int(np.ceil(len(rest) * percentile / 100)) - 1]).bit_length()
    odd = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
    bits = np.unpackbits(rest.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    return HEAD.pack(base, len(ids), len(odd), width) + np.packbits(bits, bitorder="little").tobytes() + odd.astype("<u2").tobytes() + rest[odd].astype("<u4").tobytes()


def unpack_block(data: bytes, at: int = 0) -> np.ndarray:
    base, n, n_odd, width = HEAD.unpack_from(data, at)
    at += HEAD.size
    size = (n * width + 7) // 8
    bits = np.zeros((n, 32), np.uint8)
    bits[:, :width] = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=n * width, bitorder="little").reshape(n, width)
    ids = np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel().copy()
    at += size
    ids[np.frombuffer(data, "<u2", n_odd, at)] = np.frombuffer(data, "<u4", n_odd, at + 2 * n_odd)
    return ids + np.uint32(base)


def pack_ids(ids: np.ndarray) -> tuple[list[int], bytes]:
    """Blocks of a sequence of ids, and the byte at which each starts."""
    starts, parts, at = [], [], 0
    for k in range(0, len(ids), BLOCK):
        starts.append(at)
        parts.append(pack_block(ids[k : k + BLOCK]))
        at += len(parts[-1])
    return starts, b"".join(parts)


def unpack_span(block_starts, payload: bytes, first: int, last: int) -> np.ndarray:
    """Ids first..last-1 of a chunk; only the blocks that hold them are decoded."""
    if last <= first:
        return np.empty(0, np.uint32)
    low = first // BLOCK
    ids = np.concatenate([unpack_block(payload, block_starts[k]) for k in range(low, (last - 1) // BLOCK + 1)])
    return ids[first - low * BLOCK : last - low * BLOCK]


def _encode(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("shard", pa.int32()), ("chunk", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())), ("block_starts", pa.list_(pa.int32())), ("payload", pa.binary())]
    )
    shard, chunk, start = TaskContext.get().partitionId(), 0, 0
    doc_ids: list = []
    parts: list[bytes] = []

    def flush() -> pa.RecordBatch:
        nonlocal chunk, start, doc_ids, parts
        sizes = [len(p) // 4 for p in parts]
        starts, payload = pack_ids(np.frombuffer(b"".join(parts), "<u4"))
        row = [shard, chunk, start, sum(sizes), doc_ids, sizes, starts, payload]
        chunk, start, doc_ids, parts = chunk + 1, start + sum(sizes), [], []
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

    held = 0
    for keys, ids in encoded(batches, tokenizer, struct.pack("<I", end_id)):
        for doc_id, body in zip(keys, ids, strict=True):
            doc_ids.append(doc_id)
            parts.append(body)
            held += len(body) // 4
            if held >= CHUNK_TOKENS:
                held = 0
                yield flush()
    if parts:
        yield flush()


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text, append `end_id`, and write the store to `path` in ascending order of the ids.

    Null text counts as empty: the end id alone. Null document ids come first; rows of one id follow each other in the
    order of a hash of the text, then the text. Other columns are not looked at. An empty table gives an empty store.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # the hash lets a border fall between rows of one id
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    ordered.mapInArrow(lambda batches: _encode(batches, tokenizer, end_id), CHUNKS).write.parquet(f"{path}/chunks")
    spark = docs.sparkSession
    sizes = spark.read.schema(CHUNKS).parquet(f"{path}/chunks").groupBy("shard").agg(F.sum("n_tokens").alias("n_tokens"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per written file
    sizes.select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("shard_start"), "n_tokens").write.parquet(f"{path}/shards")


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    chunks = spark.read.schema(CHUNKS).parquet(f"{path}/chunks")
    shards = spark.read.schema("shard int, shard_start long").parquet(f"{path}/shards")
    return chunks.join(F.broadcast(shards), "shard").withColumn("start", F.col("start") + F.col("shard_start"))  # a row per file


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32-bit)."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack_span(row["block_starts"], row["payload"], 0, row["n_tokens"]).astype("<u4").tobytes()
                sizes = np.array(row["doc_tokens"], np.int64)
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(ends - sizes + row["start"]), pa.array(sizes), pa.array([ids[4 * (e - s) : 4 * e] for e, s in zip(ends, sizes, strict=True)], pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    columns = ("start", "n_tokens", "doc_ids", "doc_tokens", "block_starts", "payload")
    return _chunks(spark, path).select(*columns).mapInArrow(decode, DOCS)


def read_span(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """start, ids: the pieces of ids first..last-1 of the whole sequence, one per chunk that holds some; other chunks
    and blocks are not decoded."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                low, high = max(first - row["start"], 0), min(last - row["start"], row["n_tokens"])
                ids = unpack_span(row["block_starts"], row["payload"], low, high).astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([row["start"] + low]), pa.array([ids], pa.binary())], names=["start", "ids"])

    hit = _chunks(spark, path).where((F.col("start") < last) & (F.col("start") + F.col("n_tokens") > first))
    return hit.select("start", "n_tokens", "block_starts", "payload").mapInArrow(decode, "start long, ids binary")
