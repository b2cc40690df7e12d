"""Quality rules: a table of thresholds compiled into one projection. No joins, no shuffles, no user functions.

Counts of a text are array expressions over its words and lines. Repeated 3-word windows are found by sorting one
long per window (hash bits above, position below); neighbours that agree in the hash bits are then compared word by
word, so a hash never decides. Cost is n log n in the words of a text, also where all windows repeat.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrain.llm.common import free_name, words_of

SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50  # base rule of the contract
# Frequent short words of the languages at hand (English, German, French, Spanish), lower case.
STOP_WORDS = (
    "the be to of and that have with in is it for on as was der die das und ist von zu mit den nicht ein eine auf für sich"
    " le la les de des et un une en du que qui est pour dans el los las y con por para se su del al no lo"
).split()


@dataclass(frozen=True)
class Threshold:
    """A text passes if `low` <= measure <= `high`; a missing bound always holds. Bounds themselves pass."""

    measure: str
    low: float | None = None
    high: float | None = None


# Measures are ratios of the counts below; see `_measures`.
THRESHOLDS = (
    Threshold("mean_word_chars", 2.0, 14.0),
    Threshold("symbols_per_word", None, 0.15),
    Threshold("shouted_share", None, 0.5),
    Threshold("duplicate_line_share", None, 0.5),
    Threshold("repeated_word_share", None, 0.5),
    Threshold("stop_word_share", 0.02, None),
)


def _adjacent_equal(sorted_array: Column, key) -> Column:
    """Elements of a sorted array whose `key` equals that of a neighbour."""
    size = F.size(sorted_array)
    return F.filter(
        sorted_array,
        lambda x, i: ((i > 0) & (key(x) == key(F.get(sorted_array, F.greatest(i - 1, F.lit(0))))))
        | ((i < size - 1) & (key(x) == key(F.get(sorted_array, F.least(i + 1, size - 1))))),
    )


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds a struct `q`, under a name that is free, of the counts of each whole text."""
    # the steps' columns are named by a prefix that no column of `docs` has
    p = "q_"
    while any(c.lower().startswith(p) for c in docs.columns):
        p += "_"
    body = F.coalesce(F.col(text), F.lit(""))
    df = docs.select(*docs.columns, words_of(F.col(text)).alias(p + "words"))
    w, n = F.col(p + "words"), F.size(p + "words")

    # position bits: 20, or as many as the text needs
    bits = F.greatest(F.lit(20), F.ceil(F.log2(n + F.lit(1))).cast("int"))
    window = lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    packed = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.call_function("shiftleft", F.call_function("shiftright", window(i), F.col(p + "bits")), F.col(p + "bits")).bitwiseOR(i.cast("bigint")))
    df = df.withColumn(p + "bits", bits)
    empty = F.array().cast("array<bigint>")
    df = df.withColumn(p + "packed", F.when(n >= 3, F.sort_array(packed)).otherwise(empty))
    df = df.withColumn(p + "near", _adjacent_equal(F.col(p + "packed"), lambda x: F.call_function("shiftright", x, F.col(p + "bits"))))
    position = lambda x: x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col(p + "bits")) - 1).cast("int")
    # the few windows whose hash bits occur again, now with their words
    exact = F.transform(p + "near", lambda x: F.struct(F.concat_ws(" ", F.slice(w, position(x) + 1, 3)).alias("window"), position(x).alias("at")))
    df = df.withColumn(p + "exact", F.array_sort(exact))
    df = df.withColumn(p + "twice", F.sort_array(F.transform(_adjacent_equal(F.col(p + "exact"), lambda x: x["window"]), lambda x: x["at"])))
    twice, m = F.col(p + "twice"), F.size(p + "twice")
    # each repeated window covers three words, less what the next one covers too
    covered = F.aggregate(
        F.transform(twice, lambda p, i: F.when(i < m - 1, F.least(F.lit(3), F.get(twice, F.least(i + 1, m - 1)) - p)).otherwise(3)),
        F.lit(0).cast("bigint"),
        lambda total, x: total + x,
    )
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    df = df.withColumn(p + "lines", lines)
    # one pass over the characters for each class: what is left after the others are deleted
    counts = F.struct(
        n.cast("bigint").alias("n_words"),
        F.aggregate(w, F.lit(0).cast("bigint"), lambda total, x: total + F.char_length(x)).alias("word_chars"),
        F.char_length(F.regexp_replace(body, "[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        F.size(p + "lines").cast("bigint").alias("n_lines"),
        (F.size(p + "lines") - F.size(F.array_distinct(p + "lines"))).cast("bigint").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.size(F.filter(w, lambda x: (F.char_length(x) >= 3) & x.endswith("!!"))).cast("bigint").alias("n_shouted"),
        F.size(F.filter(w, lambda x: F.lower(F.rtrim(x, F.lit("!?.,;:#*$%&|"))).isin(*STOP_WORDS))).cast("bigint").alias("n_stop_words"),
    )
    # the optimizer moves no filter below explode; else a filter on the result would be written out in terms of the text,
    # and the words would be split anew at every step of the array functions
    return df.select(*docs.columns, F.explode(F.array(counts)).alias(free_name(docs, "q")))


def _measures(q: Column) -> dict[str, Column]:
    over = lambda a, b: q[a] / F.greatest(q[b], F.lit(1))
    return {
        "mean_word_chars": over("word_chars", "n_words"),
        "symbols_per_word": over("n_symbols", "n_words"),
        "shouted_share": over("n_shouted", "n_words"),
        "duplicate_line_share": over("n_dup_lines", "n_lines"),
        "repeated_word_share": over("n_repeat_words", "n_words"),
        "stop_word_share": over("n_stop_words", "n_words"),
    }


def compile_thresholds(q: Column, thresholds: Sequence[Threshold]) -> Column:
    """The table as one boolean expression."""
    measures = _measures(q)
    bounds = [measures[t.measure] >= t.low for t in thresholds if t.low is not None]
    bounds += [measures[t.measure] <= t.high for t in thresholds if t.high is not None]
    return reduce(lambda a, b: a & b, bounds, F.lit(True))


RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shouted", "n_stop_words")


def judge_quality(docs: DataFrame, text: str = "text", thresholds: Sequence[Threshold] = THRESHOLDS) -> DataFrame:
    """`docs` with the counts in RESULTS, `base_failed` and `kept`.

    Null text counts as empty: no words, so base_failed. Repeated rows are judged alike and all stay; a share over no
    words or no lines is 0. Columns of `docs` named like a result are replaced.
    """
    named = {*RESULTS, "base_failed", "kept"}
    rest = [c for c in docs.columns if c.lower() not in named]
    body = docs.select(*(rest if text in rest else [*rest, text]))
    counted = with_counts(body, text)
    q = F.col(free_name(body, "q"))
    base_failed = (q["n_words"] < MIN_WORDS) | (100 * q["n_repeat_words"] > MAX_REPEAT_PERCENT * q["n_words"])
    return counted.select(
        *rest, *(q[c].alias(c) for c in RESULTS), base_failed.alias("base_failed"), (~base_failed & compile_thresholds(q, thresholds)).alias("kept")
    )
