"""How filters overlap: what each removes, under every order of applying them.

Each document becomes a mask of the filters that it fails; per part there are at most 2^k masks, with counts. Of a mask
matrix (0 where a filter fails, else infinite) and the inverse of each permutation (the step at which a filter comes),
the min-plus product gives the step that removes a mask under an order. Scattering the masks' counts over those steps
gives all figures; documents themselves are never looked at per order.

Copies of a text are counted per text and part before they move, and a text's smallest id is found over its parts, so
neither a group of copies nor a part is ever brought together row by row.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripgrain.llm.common import stored

CAPITALS = bytes(range(65, 91))
MARKS = re.compile(rb"[#$%&*|]")

# Fixed by the contract: a document fails where the condition on its measures holds.
TEXT_FILTERS: tuple[tuple[str, Callable[[dict[str, np.ndarray]], np.ndarray]], ...] = (
    ("A", lambda m: m["words"] < 50),
    ("B", lambda m: 100 * m["distinct"] < 65 * m["words"]),
    ("C", lambda m: 100 * m["capitals"] > 5 * m["chars"]),
    ("D", lambda m: m["marks"]),
)
COPY_FILTER = "E"  # identical to the text of a smaller id
DIGEST = 16  # bytes of SHA-256 by which texts count as identical
ORPHAN_PARTS = 1024  # rows without an id are dealt over so many keys, as none of them has a label


def measures(texts: pa.Array) -> dict[str, np.ndarray]:
    """Per text: words, distinct words, capital letters A-Z, code points, whether it holds a mark. Nulls are empty."""
    texts = pc.fill_null(texts, "")
    words, distinct, capitals, marks = [], [], [], []
    for raw in texts.cast(pa.binary()).to_pylist():
        found = raw.split()  # bytes: at the six white space characters
        words.append(len(found))
        distinct.append(len(set(found)))
        capitals.append(len(raw) - len(raw.translate(None, CAPITALS)))
        marks.append(MARKS.search(raw) is not None)
    numbers = {"words": words, "distinct": distinct, "capitals": capitals}
    chars = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
    return {k: np.array(v, np.int64) for k, v in numbers.items()} | {"chars": chars.astype(np.int64), "marks": np.array(marks, bool)}


def failure_masks(docs: DataFrame, filters: Sequence[tuple[str, Callable]] = TEXT_FILTERS) -> DataFrame:
    """doc_id, part, key (digest of the text), mask (bit i: fails filter i), for a frame of doc_id, text and part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            found = measures(texts)
            mask = np.zeros(len(texts), np.int64)
            for bit, (_, fails) in enumerate(filters):
                mask |= fails(found).astype(np.int64) << bit
            raws = pc.fill_null(texts, "").cast(pa.binary()).to_pylist()
            keys = pa.array([hashlib.sha256(raw).digest()[:DIGEST] for raw in raws], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), keys, pa.array(mask)], names=["doc_id", "part", "key", "mask"])

    return docs.mapInArrow(run, "doc_id long, part string, key binary, mask long")


def _is_one(column: str) -> Column:
    return F.max(F.when(F.col(column) == 1, 1).otherwise(0)).cast("long")


def mask_counts(masks: DataFrame, labels: DataFrame, losses: Sequence[str], copy_bit: int) -> DataFrame:
    """part, mask, n and one count per column of `losses`, with the bit of the copy filter set.

    A row is a copy if the same text has a smaller id anywhere. A row without an id is no copy and makes none. A document
    counts as lost under a column if any of its label rows has 1 there.
    """
    rows = masks.groupBy("doc_id", "part", "key", "mask").agg(F.count(F.lit(1)).alias("n"))
    # rows without an id match no label: dealt by their text, they don't meet in one task
    spread = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("key"), F.lit(ORPHAN_PARTS))).otherwise(-1)
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*(_is_one(c).alias(c) for c in losses))
    joined = rows.withColumn("spread", spread).join(known.withColumn("spread", F.lit(-1).cast("long")), ["doc_id", "spread"], "left")
    amounts = ["n", *losses]
    joined = joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) * F.col("n") for c in losses})
    has_id = F.col("doc_id").isNotNull()
    per_text = joined.groupBy("key", "part", "mask").agg(
        *(F.sum(c).alias(c) for c in amounts),
        F.min(F.when(has_id, F.struct("doc_id", *amounts))).alias("first"),
        F.sum(F.when(has_id, 0).otherwise(F.col("n"))).alias("without_id"),
    )
    # a row per text and part: at most as many per text as there are parts
    least = F.min("first.doc_id").over(Window.partitionBy("key"))
    owns = F.col("first.doc_id") == F.col("least")
    original = {c: F.when(owns, F.col(f"first.{c}")).otherwise(0) + (F.col("without_id") if c == "n" else F.lit(0)) for c in amounts}
    original = {c: F.coalesce(v, F.col("without_id") if c == "n" else F.lit(0)) for c, v in original.items()}
    sides = F.array(
        F.struct(F.col("mask"), *(original[c].cast("long").alias(c) for c in amounts)),
        F.struct(F.col("mask").bitwiseOR(F.lit(1 << copy_bit)).alias("mask"), *((F.col(c) - original[c]).cast("long").alias(c) for c in amounts)),
    )
    split = per_text.withColumn("least", least).select("part", F.explode(sides).alias("side")).select("part", "side.*").where("n > 0")
    return split.groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in amounts))


def removal_steps(masks: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Min-plus product: the step, from 1, at which each mask (row) is removed under each order (column); the number of
    filters plus 1 where it never is. positions[p, f] is the step of filter f under order p."""
    k = positions.shape[1]
    never = k + 1
    blocked = np.where((masks[:, None] >> np.arange(k)) & 1, 0, never)  # masks x filters
    steps = np.full((len(masks), len(positions)), never, np.int64)
    for f in range(k):
        np.minimum(steps, blocked[:, f, None] + positions[None, :, f], out=steps)
    return steps


def audit_part(masks: np.ndarray, amounts: np.ndarray, orders: np.ndarray) -> dict[str, np.ndarray]:
    """Figures by order and step (arrays orders x steps); `amounts` has a row per mask: n, then the losses."""
    count, k = orders.shape
    positions = np.empty_like(orders)
    np.put_along_axis(positions, orders, np.arange(1, k + 1)[None, :].repeat(count, 0), axis=1)
    steps = removal_steps(masks, positions)
    scattered = np.zeros((amounts.shape[1], count, k + 2), np.int64)
    at = np.arange(count)[None, :].repeat(len(masks), 0)
    for a in range(amounts.shape[1]):
        np.add.at(scattered[a], (at, steps), amounts[:, a, None])
    scattered = scattered[:, :, 1 : k + 1]
    removed = scattered[0]
    fails = ((masks[:, None] >> np.arange(k)) & 1) * amounts[:, :1]  # masks x filters
    alone = np.where(masks[:, None] == 1 << np.arange(k), amounts[:, :1], 0)
    credit = np.take_along_axis(removed, positions - 1, axis=1).sum(axis=0)  # by filter
    return {
        "kept": amounts[:, 0].sum() - removed.cumsum(axis=1),
        "removed": removed,
        "redundant": fails.sum(axis=0)[orders] - removed,
        "unique_fails": alone.sum(axis=0)[orders],
        "shapley": credit[orders],
        "lost": scattered[1:],
    }


def audit_filters(
    docs: DataFrame,
    labels: DataFrame,
    losses: dict[str, str],
    filters: Sequence[tuple[str, Callable]] = TEXT_FILTERS,
    copy_filter: str = COPY_FILTER,
    doc_id: str = "doc_id",
    text: str = "text",
    part: str = "source",
) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, one column per loss, shapley: a row per part,
    order of the filters (all permutations, the copy filter included) and step.

    `losses` names the result's columns of lost documents by columns of `labels`. Null text counts as empty, a null part
    as the empty string; rows without an id are documents that are never copies; rows of one id and text are copies of a
    smaller id only; repeated label rows count once. Other columns are not looked at. An empty table gives no rows.
    """
    letters = [name for name, _ in filters] + [copy_filter]
    columns = list(losses.values())
    bare = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"))
    labels = labels.select(F.col(doc_id).alias("doc_id"), *columns)
    counts = stored(mask_counts(failure_masks(bare, filters), labels, columns, len(filters)), "filter-masks")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        orders = np.array(list(permutations(range(len(letters)))), np.int64)
        figures = audit_part(group["mask"].to_numpy(np.int64), group[["n", *columns]].to_numpy(np.int64), orders)
        lost = figures.pop("lost")
        n, k = orders.shape
        shape = {name: values.ravel() for name, values in figures.items()} | {name: lost[i].ravel() for i, name in enumerate(losses)}
        names = np.array(["".join(letters[f] for f in order) for order in orders])
        return pd.DataFrame({"part": group["part"].iloc[0], "filter_order": names.repeat(k), "step": np.tile(np.arange(1, k + 1, dtype=np.int32), n), **shape})

    numbers = ["kept", "removed", "redundant", "unique_fails", *losses, "shapley"]
    schema = "part string, filter_order string, step int, " + ", ".join(f"`{c}` long" for c in numbers)
    return counts.groupBy("part").applyInPandas(run, schema)  # at most 2^filters rows a part
