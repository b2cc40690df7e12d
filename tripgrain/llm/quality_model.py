"""A quality score by nearest neighbours.

Texts become counts of three-character shapes (letter, capital, digit, ...), weighted by rarity and projected to the
leading latent directions of a bounded labelled sample. The sample's vectors are broadcast; every text is compared with
all of them, block by block, and the labels of the nearest vote with their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgrain.llm.common import free_name, release_memory, stored

SAMPLE = 1500  # labelled rows of each class that are used at most
DIRECTIONS = 48
NEIGHBOURS = 15
SHARPNESS = 8  # power of the similarity that a vote counts
THRESHOLD = 0.7  # fixed by the contract
BLOCK = 512  # rows that a task holds features of at a time

# Ten classes of bytes; multi-byte characters are letters.
CLASSES = np.full(256, 9, np.uint8)
CLASSES[128:] = CLASSES[ord("a") : ord("z") + 1] = 0
CLASSES[ord("A") : ord("Z") + 1] = 1
CLASSES[ord("0") : ord("9") + 1] = 2
for number, characters in enumerate((b" \t\r\x0b\x0c", b"\n", b".,;:'\"()-", b"!?", b"#*$%&", b"|<>"), 3):
    CLASSES[list(characters)] = number
SHAPES = 1000


def shapes(text: str | None) -> np.ndarray:
    """Share of each three-character shape in the whole text."""
    body = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.zeros(SHAPES, np.float64)
    for k in range(0, max(0, len(body) - 2), 1 << 20):
        c = CLASSES[body[k : k + (1 << 20) + 2]].astype(np.int16)
        counts += np.bincount(c[:-2] * 100 + c[1:-1] * 10 + c[2:], minlength=SHAPES)
    return (counts / max(1.0, counts.sum())).astype(np.float32)


@dataclass(frozen=True)
class NearestModel:
    rarity: np.ndarray  # by shape
    directions: np.ndarray  # shapes x directions
    vectors: np.ndarray  # of the labelled rows, of length 1
    labels: np.ndarray
    weights: np.ndarray  # undo the equal draw of the classes
    prior: float

    def project(self, counts: np.ndarray) -> np.ndarray:
        latent = (np.sqrt(counts) * self.rarity) @ self.directions
        return latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """0 to 1; the share of label 1 where a text has no shapes or no row is labelled."""
        scores = np.full(len(counts), self.prior)
        if not len(self.labels):
            return scores
        k = min(NEIGHBOURS, len(self.labels))
        for a in range(0, len(counts), BLOCK):
            latent = self.project(counts[a : a + BLOCK])
            likeness = latent @ self.vectors.T
            nearest = np.argpartition(-likeness, k - 1, axis=1)[:, :k]
            votes = np.maximum(np.take_along_axis(likeness, nearest, 1), 0).astype(np.float64) ** SHARPNESS * self.weights[nearest]
            total = votes.sum(axis=1)
            found = (total > 0) & (np.abs(latent).sum(axis=1) > 0)
            scores[a : a + BLOCK][found] = (votes * self.labels[nearest]).sum(axis=1)[found] / total[found]
        return np.clip(scores, 0.0, 1.0)


def _sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, size: int) -> tuple[DataFrame, dict[int, int]]:
    """text and label of at most `size` rows of each class, and the number of labelled rows of each class."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("label_id"), F.col(label).cast("int").alias("label"))
    known = known.groupBy("label_id").agg(F.max("label").alias("label"))
    number = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    drawn = [known.where(F.col("label") == k).orderBy(F.xxhash64("label_id"), "label_id").limit(size) for k in (0, 1)]
    few = stored(drawn[0].unionByName(drawn[1]), "labelled-sample")
    rows = docs.select(F.col(doc_id).alias("row_id"), F.col(text).alias("body")).join(F.broadcast(few), F.col("row_id") == F.col("label_id"))  # 2 * size rows
    return rows.select("row_id", "body", "label"), number


def fit_nearest(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", size: int = SAMPLE) -> NearestModel:
    """Learn from the labelled rows given; at most `size` of each class are used, drawn by a hash of the id.

    Labels other than 0 and 1 and null ids are ignored; of an id labelled twice the higher counts, of an id with several
    texts one is used. Without any labelled row every score is 0.5.
    """
    rows, number = _sample(docs, labels, doc_id, text, label, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([shapes(t).tobytes() for t in batch.column(1).to_pylist()], pa.binary())], names=["row_id", "label", "counts"])

    kind = dict(rows.dtypes)["row_id"]
    found = rows.mapInArrow(run, f"row_id {kind}, label int, counts binary").groupBy("row_id").agg(F.min_by("label", "counts").alias("label"), F.min("counts").alias("counts"))
    found = sorted(found.collect(), key=lambda r: (str(r["row_id"])))  # at most 2 * size rows of 4 kB
    counts = np.array([np.frombuffer(r["counts"], np.float32) for r in found], np.float32).reshape(-1, SHAPES)
    truth = np.array([r["label"] for r in found], np.float64)
    total = sum(number.values())
    share = {k: number.get(k, 0) / max(1, total) for k in (0, 1)}
    weights = np.array([share[int(t)] / max(1e-9, (truth == t).mean()) for t in truth])
    rarity = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
    weighted = np.sqrt(counts) * rarity
    _, directions = np.linalg.eigh(weighted.T @ weighted)  # the leading right singular vectors of the sample
    directions = np.ascontiguousarray(directions[:, ::-1][:, :DIRECTIONS], np.float32)
    model = NearestModel(rarity, directions, np.zeros((0, DIRECTIONS), np.float32), truth, weights, share[1] if total else 0.5)
    return NearestModel(rarity, directions, model.project(counts).astype(np.float32), truth, weights, model.prior)


def score_quality(docs: DataFrame, model: NearestModel, text: str = "text") -> DataFrame:
    """`docs` with `score` (0 to 1, higher: label 1 likelier) and `predicted` (1 if score >= 0.7).

    Null and very short texts have no shapes and get the share of label 1. Every row is scored by its text alone.
    Columns named like a result are replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # 2 * SAMPLE vectors
    rest = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    names = rest if text in rest else [*rest, free_name(docs, "scored_text")]
    at = names.index(text) if text in rest else len(rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for batch in batches:
            texts, scores = batch.column(at), np.zeros(batch.num_rows)
            for a in range(0, len(texts), BLOCK):
                counts = np.array([shapes(t) for t in texts.slice(a, BLOCK).to_pylist()], np.float32).reshape(-1, SHAPES)
                scores[a : a + BLOCK] = held.value.score(counts)
            columns = [*(batch.column(k) for k in range(len(rest))), pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[*rest, "score", "predicted"])

    schema = docs.select(*rest).withColumn("score", F.lit(0.0)).withColumn("predicted", F.lit(0)).schema
    extra = [] if text in rest else [F.col(text).alias(names[-1])]
    return docs.select(*rest, *extra).mapInArrow(run, schema)
