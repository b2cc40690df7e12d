"""Scores of texts under a log-bilinear neural language model.

Words are mapped to classes: each of the most frequent words is its own class, the others share BUCKETS classes by
their ending. The model predicts the next class from the two before it: a context vector, made linearly from the
classes' vectors, times the target vectors plus a bias. It is trained in numpy with noise-contrastive estimation, one
pass over all training texts: each task trains on its own and the parameters are averaged with the tokens that
touched them. Scores are normalised: each context's sum over all classes is taken by a matrix product. Within a
bucket a word has its smoothed share of the bucket's counts.

Word counts cover all training texts. Those of the FREQUENT most frequent words are broadcast (a fixed number); the
rest meet their counts in a join.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgrain.llm.common import lower_ascii, stored, words_of

WORDS, BUCKETS = 959, 64  # with the end of text 1,024 classes
FREQUENT = 100_000
DIMENSIONS = 16
NOISE = 48
BATCH = 8192
RATE = 0.08
PORTION = 2_000_000  # characters whose words a task holds at a time (one text at least)
END = 0


def bucket_of(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % BUCKETS


def _split(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six white space characters only


@dataclass
class Vocabulary:
    """`index` has the frequent words in falling order of their counts; classes 1 to WORDS are the first of them."""

    index: dict[bytes, int]
    counts: np.ndarray
    total: int  # N: training tokens, ends included
    distinct: int  # V: distinct training tokens, the end included
    texts: int  # training texts, so the count of the end
    buckets: np.ndarray  # for each bucket: counts and number of its words
    word_class: np.ndarray  # by index
    least: int  # words with this count or more are in the index

    @property
    def classes(self) -> int:
        return 1 + WORDS + BUCKETS

    def class_counts(self) -> np.ndarray:
        own = np.zeros(self.classes)
        own[END] = self.texts
        n = min(WORDS, len(self.counts))
        own[1 : n + 1] = self.counts[:n]
        own[1 + WORDS :] = self.buckets[:, 0]
        return own

    def indices(self, words: list[bytes]) -> np.ndarray:
        get = self.index.get
        return np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))

    def classes_of(self, words: list[bytes], index: np.ndarray) -> np.ndarray:
        classes = self.word_class[index]  # -1 takes the last, and is put right below
        for k in np.flatnonzero(index < 0):
            classes[k] = 1 + WORDS + bucket_of(words[k])
        return classes


@dataclass
class LogBilinear:
    """target, context: vectors by class; mix: how each of the two places before counts in each dimension; bias."""

    target: np.ndarray
    context: np.ndarray
    mix: np.ndarray
    bias: np.ndarray

    @classmethod
    def start(cls, class_counts: np.ndarray) -> LogBilinear:
        dice = np.random.default_rng(7)
        n = len(class_counts)
        share = (class_counts + 0.5) / (class_counts + 0.5).sum()
        vectors = [dice.normal(0, 0.3, (n, DIMENSIONS)).astype(np.float32) for _ in range(2)]
        mix = np.full((2, DIMENSIONS), 0.5, np.float32)
        return cls(vectors[0], vectors[1], mix, np.log(share).astype(np.float32))

    def ahead(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Context vectors; `second` is the class just before."""
        return self.context[second] * self.mix[0] + self.context[first] * self.mix[1]

    def log_normaliser(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        out = np.empty(len(first), np.float32)
        for a in range(0, len(first), 4096):
            logits = self.ahead(first[a : a + 4096], second[a : a + 4096]) @ self.target.T + self.bias
            top = logits.max(axis=1)
            out[a : a + 4096] = top + np.log(np.exp(logits - top[:, None]).sum(axis=1))
        return out


class _Scorer:
    """Normalised log-probabilities; remembers the normaliser of each pair of classes."""

    def __init__(self, model: LogBilinear):
        self.model, self.n = model, len(model.bias)
        self.normaliser = np.full(self.n * self.n, np.nan, np.float32)

    def log_probability(self, first: np.ndarray, second: np.ndarray, target: np.ndarray) -> np.ndarray:
        pairs = first * self.n + second
        new = np.unique(pairs[np.isnan(self.normaliser[pairs])])
        if len(new):
            self.normaliser[new] = self.model.log_normaliser(new // self.n, new % self.n)
        out = np.empty(len(target), np.float64)
        for a in range(0, len(target), 1 << 18):
            b = slice(a, a + (1 << 18))
            logits = np.einsum("ij,ij->i", self.model.ahead(first[b], second[b]), self.model.target[target[b]]) + self.model.bias[target[b]]
            out[b] = logits - self.normaliser[pairs[b]]
        return out


def _summed(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows, the sum of the values of each, and how many there are."""
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    at = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    return ordered[at], np.add.reduceat(values[order], at, axis=0), np.diff(np.append(at, len(rows)))


class Trainer:
    """Noise-contrastive estimation: tell the next class from NOISE classes drawn by their frequency."""

    def __init__(self, model: LogBilinear, class_counts: np.ndarray, seed: int):
        self.m = model
        self.share = (class_counts + 0.5) / (class_counts + 0.5).sum()
        self.ladder = np.cumsum(self.share)
        self.odds = np.log(NOISE * self.share).astype(np.float32)
        self.squares = {name: np.full(len(model.bias), 1e-2, np.float32) for name in ("target", "context", "bias")}
        self.touched = np.zeros((2, len(model.bias)), np.int64)  # as target, as context
        self.dice = np.random.default_rng(seed)

    def _step(self, name: str, rows: np.ndarray, gradient: np.ndarray) -> None:
        distinct, total, number = _summed(rows, gradient)
        total = total / np.sqrt(number)[:, None] if total.ndim == 2 else total / np.sqrt(number)
        square = (total * total).mean(axis=1) if total.ndim == 2 else total * total
        self.squares[name][distinct] += square
        scale = RATE / np.sqrt(self.squares[name][distinct])
        getattr(self.m, name)[distinct] += total * (scale[:, None] if total.ndim == 2 else scale)

    def learn(self, first: np.ndarray, second: np.ndarray, target: np.ndarray) -> None:
        m = self.m
        noise = np.searchsorted(self.ladder, self.dice.random(NOISE)).clip(0, len(self.share) - 1)
        ahead = m.ahead(first, second)
        sure = 1 / (1 + np.exp(-(np.einsum("ij,ij->i", ahead, m.target[target]) + m.bias[target] - self.odds[target])))
        fooled = 1 / (1 + np.exp(-(ahead @ m.target[noise].T + m.bias[noise] - self.odds[noise])))  # batch x noise
        pull = (1 - sure).astype(np.float32)
        back = pull[:, None] * m.target[target] - fooled @ m.target[noise]
        up, down = pull[:, None] * ahead, fooled.T @ ahead
        mix = np.stack([(back * m.context[second]).mean(axis=0), (back * m.context[first]).mean(axis=0)])
        one, two = back * m.mix[1], back * m.mix[0]
        self._step("target", np.concatenate((target, noise)), np.concatenate((up, -down)))
        self._step("bias", np.concatenate((target, noise)), np.concatenate((pull, -fooled.sum(axis=0))))
        self._step("context", np.concatenate((first, second)), np.concatenate((one, two)))
        m.mix += RATE * mix.astype(np.float32)
        self.touched[0] += np.bincount(target, minlength=len(m.bias))
        self.touched[1] += np.bincount(first, minlength=len(m.bias)) + np.bincount(second, minlength=len(m.bias))


def _sequence(vocabulary: Vocabulary, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[bytes]], np.ndarray, np.ndarray]:
    """Classes of the two before and of each token, the words, their indices, and where each text ends."""
    split = [_split(t) for t in texts]
    flat = [w for words in split for w in words]
    index = vocabulary.indices(flat)
    classes = vocabulary.classes_of(flat, index)
    sizes = np.array([len(w) for w in split], np.int64)
    ends = np.cumsum(sizes + 1)
    target = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
    words_at = np.ones(len(target), bool)
    words_at[ends - 1] = False
    target[words_at] = classes
    second = np.concatenate(([END], target[:-1])) if len(target) else target
    first = np.concatenate(([END, END], target[:-2]))[: len(target)] if len(target) else target
    starts = ends - sizes - 1
    second[starts] = END
    first[starts] = END
    after = starts + 1
    first[after[after < len(target)]] = END  # of the word after a start, or of the next text's start
    return first, second, target, split, index, ends


def _portions(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about PORTION characters of the texts in column `at`."""
    sizes = np.array([s or 0 for s in pc.binary_length(batch.column(at)).to_pylist()], np.int64)
    start, held = 0, 0
    for k, size in enumerate(sizes):
        if held and held + size > PORTION:
            yield batch.slice(start, k - start)
            start, held = k, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """word, c: how often each word occurs, A-Z in lower case."""
    raw = docs.select(F.explode(words_of(F.col(text))).alias("raw")).groupBy("raw").agg(F.count(F.lit(1)).alias("c"))
    return raw.groupBy(lower_ascii(F.col("raw")).alias("word")).agg(F.sum("c").alias("c"))  # distinct words only


def _native_bucket(word):
    return F.crc32(F.substring(word.cast("binary"), -2, 2)) % BUCKETS


def fit_vocabulary(counts: DataFrame, texts: int) -> Vocabulary:
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    # the highest count at which all words fit; each count has a word, so the FREQUENT highest counts suffice
    levels = counts.groupBy("c").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("c")).limit(FREQUENT + 1).collect()
    least, room = (levels[0]["c"] + 1 if levels else 1), FREQUENT
    for level in levels:
        room -= level["words"]
        if room < 0:
            break
        least = level["c"]
    top = counts.where(F.col("c") >= least).toPandas().sort_values(["c", "word"], ascending=[False, True], ignore_index=True)  # at most FREQUENT rows
    words = [w.encode("utf-8", "surrogatepass") for w in top["word"]]
    own = counts.sparkSession.createDataFrame(pd.DataFrame({"word": top["word"][:WORDS], "own": True}), "word string, own boolean")
    rest = counts.join(F.broadcast(own), "word", "left_anti")  # WORDS rows
    sums = rest.groupBy(_native_bucket(F.col("word")).alias("b")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    buckets = np.zeros((BUCKETS, 2))
    for r in sums:
        buckets[r["b"]] = r["n"], r["v"]
    word_class = np.array([k + 1 if k < WORDS else 1 + WORDS + bucket_of(w) for k, w in enumerate(words)] or [END], np.int64)
    counted = np.array(top["c"], np.float64)
    return Vocabulary({w: k for k, w in enumerate(words)}, counted, int(totals["n"]) + texts, int(totals["v"]) + (texts > 0), texts, buckets, word_class, int(least))


def fit_model(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> LogBilinear:
    """One pass over all texts. Tasks start from the same parameters and train on their own texts; each class's
    vectors are averaged over the tasks, weighted by how often a task has met the class."""
    class_counts = vocabulary.class_counts()
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = held.value
        trainer, seen = Trainer(LogBilinear.start(class_counts), class_counts, TaskContext.get().partitionId()), 0
        for batch in (part for whole in batches for part in _portions(whole, 0)):
            first, second, target, *_ = _sequence(v, batch.column(0).to_pylist())
            seen += len(target)
            order = trainer.dice.permutation(len(target))
            for a in range(0, len(order), BATCH):
                pick = order[a : a + BATCH]
                trainer.learn(first[pick], second[pick], target[pick])
        if seen:
            m, (as_target, as_context) = trainer.m, trainer.touched
            parts = [("target", as_target, np.column_stack((m.target, m.bias))), ("context", as_context, m.context), ("mix", np.full(2, seen), m.mix)]
            for name, weight, values in parts:
                at = np.flatnonzero(weight)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(at)), pa.array(at.astype(np.int32)), pa.array(weight[at].astype(np.float64)), pa.array(list(values[at].astype(np.float64)), pa.list_(pa.float64()))],
                    names=["part", "row", "weight", "vector"],
                )

    trained = docs.select(text).mapInArrow(run, "part string, row int, weight double, vector array<double>")
    spread = trained.select("part", "row", "weight", F.posexplode("vector").alias("at", "x"))
    means = spread.groupBy("part", "row", "at").agg((F.sum(F.col("weight") * F.col("x")) / F.sum("weight")).alias("x"))
    model = LogBilinear.start(class_counts)
    for part, row, at, x in means.collect():  # one value per parameter
        if part == "target" and at == DIMENSIONS:
            model.bias[row] = x
        else:
            getattr(model, part)[row, at] = x
    return model


def score_texts(docs: DataFrame, training, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, in_training, n_tokens, n_known, train_tokens, base_score, score: one row per row of `docs`.

    training: a condition on `docs`; the model and all counts are learned from the whole texts that meet it. Tokens are
    the words with A-Z in lower case, then one end. base_score: sum of log10 of smoothed word frequencies; score: the
    model's log10 probability of the text. Null text is empty: the end alone. Repeated rows and null ids are texts like
    any other. If no text is for training, every token has probability 1 in base_score and all classes are alike.
    """
    spark = docs.sparkSession
    chosen = F.coalesce(training, F.lit(False))
    learn = docs.where(chosen).select(F.col(text).alias("text"))
    counts = stored(count_words(learn), "word-counts")
    vocabulary = fit_vocabulary(counts, learn.count())
    model = fit_model(learn, vocabulary)
    held = spark.sparkContext.broadcast((vocabulary, model))  # FREQUENT words and 1,024 classes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, m = held.value
        scorer, row = _Scorer(m), TaskContext.get().partitionId() << 33
        floor = np.log10(v.total + 0.5 * (v.distinct + 1))
        frequency = np.log10(v.counts + 0.5) if len(v.counts) else np.zeros(1)
        within = np.log10(v.buckets[:, 0] + 0.5 * (v.buckets[:, 1] + 1))  # all of a bucket
        in_bucket = v.word_class > WORDS
        for batch in (part for whole in batches for part in _portions(whole, 1)):
            first, second, target, split, index, ends = _sequence(v, batch.column(1).to_pylist())
            lm = scorer.log_probability(first, second, target) / np.log(10)
            in_rest = target > WORDS
            lm[in_rest] -= within[target[in_rest] - 1 - WORDS]
            base = np.full(len(target), np.log10(v.texts + 0.5) - floor)
            known = np.full(len(target), v.texts > 0, np.int64)
            at = np.ones(len(target), bool)
            at[ends - 1] = False
            seen = index >= 0
            base[at] = np.where(seen, frequency[index], 0.0) - floor  # rare words: the count follows from the join
            known[at] = seen
            lm[at] += np.where(seen & in_bucket[index], frequency[index], 0.0)
            starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
            rare, k = [], 0
            for words in split:
                odd = np.flatnonzero(index[k : k + len(words)] < 0)
                rare.append(list(Counter(words[j].decode("utf-8", "surrogatepass") for j in odd).items()))
                k += len(words)
            n = len(ends)
            columns = [pa.array(np.arange(row, row + n)), batch.column(0), batch.column(2), pa.array(ends - starts)]
            columns += [pa.array(np.add.reduceat(x, starts) if n else x) for x in (known, base, lm)]
            columns.append(pa.array([[{"word": w, "n": c} for w, c in r] for r in rare], pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())]))))
            row += n
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "in_training", "n_tokens", "n_known", "base", "lm", "rare"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), chosen.alias("in_training"))
    schema = "row long, doc_id long, in_training boolean, n_tokens long, n_known long, base double, lm double, rare array<struct<word:string,n:long>>"
    scored = stored(rows.mapInArrow(run, schema), "text-scores")
    odd = scored.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.n")
    # the frequent words are never looked up here, so their counts need not travel
    matched = odd.join(counts.where(F.col("c") < vocabulary.least), "word", "left")
    gain = F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)
    extra = matched.groupBy("row").agg(F.sum(gain).alias("gain"), F.sum(F.when(F.col("c").isNotNull(), F.col("n"))).alias("known"))
    joined = scored.drop("rare").join(extra, "row", "left")
    gain = F.coalesce("gain", F.lit(0.0))
    return joined.select(
        "doc_id",
        "in_training",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        (F.col("base") + gain).alias("base_score"),
        (F.col("lm") + gain).alias("score"),
    )
