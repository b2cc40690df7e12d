"""Documents packed into training sequences: best-fit decreasing.

Documents longer than a sequence are first cut into full windows; what is left of them and the shorter documents are
pieces. Pieces go by falling length into the open sequence with the tightest room, found by a segment tree
over remaining capacities. A task packs its documents pool by pool (POOL_TOKENS ids at a time), so its memory is
bounded and no shuffle is needed; only the last few sequences of a pool have noticeable padding.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgrain.llm.tokens import encoded

SEQUENCE = 1024
POOL_TOKENS = 1 << 21
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


class OpenSequences:
    """Open sequences by remaining capacity. Node k of the tree tells whether any capacity below it has one."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.tree = bytearray(2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]

    def put(self, room: int, sequence: int) -> None:
        if room <= 0:
            return
        self.open[room].append(sequence)
        k = self.leaves + room
        while k and not self.tree[k]:
            self.tree[k] = 1
            k >>= 1

    def tightest(self, length: int) -> tuple[int, int] | None:
        """Takes out the open sequence with the least room of at least `length`: (room, sequence)."""
        k = self.leaves + length
        while not self.tree[k]:  # climb until a right neighbour holds something
            while k & 1:
                k >>= 1
            if k == 0:
                return None
            k += 1
        while k < self.leaves:
            k = 2 * k if self.tree[2 * k] else 2 * k + 1
        room = k - self.leaves
        sequence = self.open[room].pop()
        if not self.open[room]:
            while k and not (self.tree[2 * k] or self.tree[2 * k + 1] if k < self.leaves else False):
                self.tree[k] = 0
                k >>= 1
        return room, sequence


def best_fit_decreasing(lengths: np.ndarray, size: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and offset of each piece (1 <= length <= size), and the number of sequences. Ties keep their order."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    rooms, used = OpenSequences(size), 0
    for i in np.argsort(-lengths, kind="stable"):
        length = int(lengths[i])
        found = rooms.tightest(length)
        if found is None:
            found, used = (size, used), used + 1
        room, at = found
        sequence[i], offset[i] = at, size - room
        rooms.put(room - length, at)
    return sequence, offset, used


def _pool(keys: list[int | None], ids: list[bytes], size: int, first: int) -> tuple[pa.RecordBatch, int]:
    """Pieces of the documents; the number of the next free sequence."""
    n = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    parts = -(-n // size)  # an end id at least, so a document has a piece
    doc = np.repeat(np.arange(len(n)), parts)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)) * size
    length = np.minimum(size, n[doc] - start)
    sequence, offset, used = best_fit_decreasing(length, size)
    # pieces follow each other as the documents do
    edges = np.concatenate(([0], 4 * np.cumsum(length)))
    bodies = pa.Array.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(b"".join(ids))]).cast(pa.binary())
    columns = [pa.array(keys, pa.int64()).take(pa.array(doc)), *map(pa.array, (start, length, n[doc], sequence + first, offset)), bodies]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]), first + used


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, size: int = SEQUENCE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start (ids of its document before it), length, doc_tokens (with the end id),
    sequence_id, offset (place in the sequence, gapless from 0), ids (little-endian unsigned 32-bit).

    A document's ids are those of its whole text, then `end_id`; null text counts as empty. Each id lies in exactly one
    piece. Rows with repeated or null ids are documents of their own. Sequence numbers are unique, not dense. Other
    columns are not looked at; an empty table gives no pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free = TaskContext.get().partitionId() << 33
        keys: list[int | None] = []
        pool: list[bytes] = []
        held = 0
        for some, ids in encoded(batches, tokenizer, struct.pack("<I", end_id)):
            keys += some
            pool += ids
            held += sum(map(len, ids)) // 4
            if held >= POOL_TOKENS:
                out, free = _pool(keys, pool, size, free)
                keys, pool, held = [], [], 0
                yield out
        if pool:
            yield _pool(keys, pool, size, free)[0]

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, PIECES)


def sequences(pieces: DataFrame, pad_id: int, size: int = SEQUENCE) -> DataFrame:
    """sequence_id, ids, length: the sequences themselves, padded to `size` unless their length is a power of two."""
    whole = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"), F.sum("length").alias("length"))  # at most `size` pieces each
    joined = F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    pad = F.unhex(F.repeat(F.lit(struct.pack("<I", pad_id).hex()), (F.lit(size) - F.col("length")).cast("int")))
    power = F.bit_count(F.col("length")) == 1
    return whole.select("sequence_id", F.when(power, joined).otherwise(F.concat(joined, pad)).alias("ids"), "length")
