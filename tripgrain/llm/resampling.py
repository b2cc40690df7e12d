"""Documents drawn by how much they look like a target, without replacement.

Words and runs of words are hashed into buckets. A bucket's gain compares its share in the target with its share in the
corpus; a document's weight is the mean gain of its features, looked up in an array; weight plus Gumbel noise, fixed by
the document's id, is its score, and the highest scores are drawn.

The cutoff is found without sorting the corpus: a quantile sketch brackets it, exact counts above and within the
bracket validate it (or take a wider one), and only the bracket is sorted. Ranks come from sorting what is drawn.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce
from itertools import chain, repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrain.llm.common import free_name, stored
from tripgrain.operators.positions import with_file_place, with_positions

BUCKETS, RUN, MIN_WORDS, PERCENT, SEED = 10_000, 2, 20, 25, "7"
ACCURACY = 1000  # of the sketch: ranks are off by at most a thousandth of the rows
SCORED = "doc_id long, n_words long, n_features long, weight long, score long"

# Fixed by the contract: A-Z become a-z; bytes below 128 other than letters and digits part words.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def feature_buckets(raw: bytes, run: int = RUN, buckets: int = BUCKETS) -> tuple[np.ndarray, int]:
    """Buckets of all runs of 1 to `run` words, repeats included, and the number of words. A run's checksum goes on from
    that of the shorter run it starts with."""
    words = raw.translate(_WORD_BYTES).split()
    grams = list(map(crc32, words))
    found = [grams]
    for k in range(1, min(run, len(words))):
        grams = list(map(crc32, words[k:], map(crc32, repeat(b" "), grams)))
        found.append(grams)
    size = sum(map(len, found))
    return np.fromiter(chain.from_iterable(found), np.int64, size) % buckets, len(words)


def bucket_counts(texts: DataFrame, run: int = RUN, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts (one column) per bucket. A task adds up its texts, so it passes on `buckets` rows at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for raw in batch.column(0).cast(pa.binary()).to_pylist():
                if raw:
                    total += np.bincount(feature_buckets(raw, run, buckets)[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])

    sums = texts.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in sums.collect():  # at most `buckets` rows
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of the ratio of smoothed shares, floored."""
    size = len(corpus)
    whole, aim = float(corpus.sum() + size), float(target.sum() + size)
    return np.array([math.floor(1000 * math.log(float(t + 1) * whole / (float(s + 1) * aim))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def gumbel(doc_id: int | None, seed: str = SEED) -> int:
    """Noise of a document, in thousandths; a null id is the empty text."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score_documents(docs: DataFrame, gains: np.ndarray, run: int = RUN, seed: str = SEED, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight, score. Null text has no words; no features weigh 0."""
    size = len(gains)

    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for key, raw in zip(ids, batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                found, words = feature_buckets(raw or b"", run, size)
                weight = int(gains[found].sum()) // len(found) if len(found) else 0
                rows.append((words, len(found), weight, weight + gumbel(key, seed)))
            columns = np.array(rows, np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in columns)], names=["doc_id", "n_words", "n_features", "weight", "score"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run_batches, SCORED)


def _between(low: int | None, high: int | None) -> Column:
    bounds = [F.col("score") >= low] if low is not None else []
    bounds += [F.col("score") <= high] if high is not None else []
    return reduce(lambda a, b: a & b, bounds, F.lit(True))


def bracket(scores: DataFrame, draw: int, rows: int, accuracy: int = ACCURACY) -> tuple[int | None, int | None, int]:
    """Bounds of scores between which the `draw`-th highest of `rows` lies, and the exact number of rows above them.

    One sketch gives brackets of growing width; the first that exact counts confirm is taken. The last has no bounds.
    """
    share = 1 - draw / rows
    widths = [w / accuracy for w in (2, 16, 128)]
    shares = [min(max(share + sign * w, 0.0), 1.0) for w in widths for sign in (-1, 1)]
    marks = scores.agg(F.percentile_approx("score", shares, F.lit(accuracy)).alias("marks")).first()["marks"]
    for low, high in zip(marks[::2], marks[1::2], strict=True):
        above, inside = scores.agg(F.count_if(F.col("score") > high), F.count_if(_between(low, high))).first()
        if above < draw <= above + inside:
            return low, high, above
    return None, None, 0


def draw_highest(scored: DataFrame, eligible: Column, percent: int = PERCENT, accuracy: int = ACCURACY) -> DataFrame:
    """The rows of a stored table of `doc_id` and `score` with `rank`: 1, 2, ... by falling score for the `percent` of the
    eligible rows that score highest, null for the others.

    Of equal scores the smaller id goes first, null ids last; of equal ids too, the place in the stored table decides.
    """
    file, place = free_name(scored, "stored_file"), free_name(scored, "stored_place")
    rows = with_file_place(scored, file, place)
    pool = scored.where(eligible)
    size = pool.count()
    draw = percent * size // 100
    none = F.lit(None).cast("long")
    if not draw:
        return scored.withColumn("rank", none)
    low, high, above = bracket(pool, draw, size, accuracy)
    order = (F.desc("score"), F.asc_nulls_last("doc_id"), F.asc(file), F.asc(place))
    at = free_name(rows, "at")
    near = with_positions(rows.where(eligible & _between(low, high)), *order, name=at)
    last = near.where(F.col(at) == draw - above - 1).first()
    key = F.struct(F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), F.col(file), F.col(place))
    cut = F.struct(F.lit(last["doc_id"] is None), F.lit(last["doc_id"] or 0).cast("long"), F.lit(last[file]), F.lit(last[place]).cast("long"))
    drawn = F.coalesce(eligible, F.lit(False)) & ((F.col("score") > last["score"]) | ((F.col("score") == last["score"]) & (key <= cut)))
    ranked = with_positions(rows.where(drawn), *order, name="rank").withColumn("rank", F.col("rank") + 1)
    return ranked.unionByName(rows.where(~drawn).withColumn("rank", none)).drop(file, place)


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    run: int = RUN,
    buckets: int = BUCKETS,
    seed: str = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank: one row per row of `docs`, rank null where it is not drawn.

    `target` has a column of the same name with the target's texts. Documents with fewer than `min_words` words are
    scored, not drawn. Rows of one id share their noise; null text has no words. Other columns are not looked at. An
    empty target gives every bucket the same share; an empty table gives no rows.
    """
    corpus = bucket_counts(docs.select(F.col(text).cast("string")), run, buckets)
    gains = bucket_gains(corpus, bucket_counts(target.select(F.col(text).cast("string")), run, buckets))
    scored = stored(score_documents(docs, gains, run, seed, doc_id, text), "resampling-scores")
    return draw_highest(scored, F.col("n_words") >= min_words, percent)
