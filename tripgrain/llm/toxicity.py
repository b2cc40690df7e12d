"""Toxicity by a lexicon that is matched fuzzily.

The lexicon (words, and stems that take any ending) is learned from labelled texts. Its entries form a trie, and each
word of a text runs a Levenshtein automaton over that trie, so misspelled terms are caught: the automaton's states are
walked together with the trie, and a branch dies as soon as no state is left. A window around each hit tells whether
the term is quoted. Kinds of hits (term, misspelled, quoted) have weights learned from the same sample; a text's score
is the probability they add up to.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgrain.llm.common import free_name, stored

SAMPLE = {1: 3000, 0: 6000}  # labelled rows of each class that are used at most
THRESHOLD = 0.7  # fixed by the contract
MIN_CONTEXTS = 8  # different words that follow an entry in toxic texts; copies of one text don't add to these
MIN_LIFT = 3.0  # times as frequent in toxic texts as in others
MIN_EXCESS = 8.0  # standard deviations above what other texts lead to expect
STEM = (4, 9)  # letters of a stem
ROOT = 3  # an entry is weighed against the words that start with its first letters
FUZZY_LETTERS = 5  # shorter entries are matched exactly
WINDOW = 6  # words on each side
MEMO_WORDS = 400_000

WORDS = re.compile(r"[^\W_]+(?:[@$!'*][^\W_]+)*")
LETTERS = re.compile(r"[^\W_]+")
QUOTE_OPENS, QUOTE_CLOSES = "\"“„«‹‘", "\"”“»›’"
REPORTED = frozenset("said says wrote writes quote quoted quoting cited reported sagte schrieb zitat dit écrit cité dijo escribió cita".split())


@dataclass
class Trie:
    """Entries by letter. An entry is (text, whether any ending may follow, whether it is a word that may be misspelled)."""

    next: list[dict[str, int]] = field(default_factory=lambda: [{}])
    end: list[tuple[str, bool, bool] | None] = field(default_factory=lambda: [None])

    def add(self, text: str, is_stem: bool) -> None:
        at = 0
        for c in text:
            if c not in self.next[at]:
                self.next[at][c] = len(self.next)
                self.next.append({})
                self.end.append(None)
            at = self.next[at][c]
        _, stem, word = self.end[at] or (text, False, False)
        self.end[at] = (text, stem or is_stem, word or not is_stem)

    def match(self, word: str) -> tuple[str, int] | None:
        """The entry nearest to the word and its distance: 0, or 1 for entries of FUZZY_LETTERS or more. One edit is a
        letter put in, left out or replaced, or two neighbours swapped. A stem needs its start to match exactly; words of
        its family that are entries themselves may be misspelled."""
        best: tuple[str, int] | None = None
        n = len(word)
        # states of the automaton: (letters read, edits so far, letter owed by a swap)
        todo = [(0, ((0, 0, ""),))]
        while todo:
            at, states = todo.pop()
            entry = self.end[at]
            if entry:
                text, is_stem, is_word = entry
                for read, edits, owed in states:
                    if owed:
                        continue
                    whole = read == n or (is_stem and edits == 0)
                    total = edits if whole else edits + 1 if is_word and edits == 0 and read == n - 1 else 9
                    if total <= (1 if len(text) >= FUZZY_LETTERS and is_word else 0) and (best is None or total < best[1]):
                        best = (text, total)
                        if total == 0:
                            return best
            for letter, child in self.next[at].items():
                after = set()
                for read, edits, owed in states:
                    if owed:
                        if letter == owed:
                            after.add((read + 2, edits, ""))
                        continue
                    if read < n and word[read] == letter:
                        after.add((read + 1, edits, ""))
                    if edits == 0:
                        after.add((read, 1, ""))  # left out of the word
                        if read < n:
                            after.add((read + 1, 1, ""))  # replaced
                        if read + 1 < n and word[read + 1] == letter:
                            after.add((read + 2, 1, ""))  # one put in before it
                            after.add((read, 1, word[read]))  # swapped
                if after:
                    todo.append((child, tuple(after)))
        return best


class Finder:
    """Hits of a lexicon in texts; remembers what words have matched."""

    def __init__(self, entries: list[tuple[str, bool]]):
        self.trie, self.memo = Trie(), {}
        for text, is_stem in entries:
            self.trie.add(text, is_stem)

    def hits(self, text: str | None) -> Iterator[tuple[str, bool, bool]]:
        """(entry, misspelled, quoted) of each hit in the whole text."""
        body = text or ""
        memo, lower = self.memo, body.lower()
        words = WORDS.findall(lower)
        for w in set(words):
            if w not in memo:
                if len(memo) >= MEMO_WORDS:
                    memo.clear()
                    break
                memo[w] = self.trie.match(w)
        if not any(memo.get(w) if w in memo else self.trie.match(w) for w in set(words)):
            return
        spans = [m.span() for m in WORDS.finditer(lower)]
        for k, w in enumerate(words):
            found = memo[w] if w in memo else self.trie.match(w)
            if found:
                yield found[0], found[1] > 0, self._quoted(lower, spans, k)

    def kinds(self, text: str | None) -> dict[str, tuple[int, int]]:
        """Hits of each kind, and the words that share the entry's root (0 for misspelled and quoted ones); misspelled
        hits of an entry are a kind of their own, "~entry"."""
        hits: dict[str, int] = {}
        for entry, misspelled, quoted in self.hits(text):
            kind = "quoted" if quoted else "~" + entry if misspelled else entry
            hits[kind] = hits.get(kind, 0) + 1
        if not hits:
            return {}
        roots: dict[str, int] = {}
        for w in WORDS.findall((text or "").lower()):
            roots[w[:ROOT]] = roots.get(w[:ROOT], 0) + 1
        return {k: (n, 0 if k == "quoted" or k[0] == "~" else roots.get(k[:ROOT], 0)) for k, n in hits.items()}

    @staticmethod
    def _quoted(body: str, spans: list[tuple[int, int]], k: int) -> bool:
        """Between quotation marks that open and close within the window, or after a word of reporting."""
        a, b = max(0, k - WINDOW), min(len(spans) - 1, k + WINDOW)
        before, after = body[spans[a][0] : spans[k][0]], body[spans[k][1] : spans[b][1] + 1]
        marks = sum(before.count(c) for c in QUOTE_OPENS) % 2 == 1 and any(c in after for c in QUOTE_CLOSES)
        return marks or any(body[s:e] in REPORTED for s, e in spans[max(0, k - 3) : k])


@dataclass(frozen=True)
class ToxicModel:
    entries: tuple[tuple[str, bool], ...]
    weights: dict[str, float]  # of a text with such hits: by entry, misspelled entry ("~entry") and "quoted"
    rates: dict[str, tuple[float, float]]  # by entry: its share of the words of its root, in toxic texts and in others
    base: float  # log-odds of a text without hits

    def gain(self, kind: str, hits: int, rooted: int) -> float:
        """Log-odds from the mere presence, or from how many words of the root are hits, whichever says more."""
        gain = self.weights.get(kind, 0.0)
        if kind in self.rates:
            toxic, other = self.rates[kind]
            gain = max(gain, hits * log(toxic / other) + max(0, rooted - hits) * log((1 - toxic) / (1 - other)))
        return gain

    def score(self, kinds: dict[str, tuple[int, int]]) -> float:
        """kinds: hits of each kind, and words of its root. The strongest counts in full, the others less and less."""
        gains = sorted((self.gain(k, *n) for k, n in kinds.items()), reverse=True)
        total = self.base + sum(g / (1 + i) for i, g in enumerate(gains))
        return 1.0 / (1.0 + exp(-max(-30.0, min(30.0, total))))


def _chosen(rows: dict[tuple[str, bool], tuple[float, float]]) -> list[tuple[str, bool]]:
    """Of words and stems (text, is_stem) with their excess and their hits in toxic texts: stems as long as they lose
    little, stems with many endings, and words. A word that a stem covers stays for its misspellings."""
    stems = {text: n for (text, stem), n in rows.items() if stem}
    words = {text: n for (text, stem), n in rows.items() if not stem}
    whole = {s: n for s, n in stems.items() if not any(o[:-1] == s and m[0] >= 0.9 * n[0] for o, m in stems.items())}
    whole = {s: n for s, n in whole.items() if n[1] > 1.3 * max((m[1] for w, m in words.items() if w.startswith(s)), default=0)}
    least = {s for s in whole if not any(s != o and s.startswith(o) for o in whole)}
    return sorted([(s, True) for s in least] + [(w, False) for w in words if len(w) >= FUZZY_LETTERS or not any(w.startswith(s) for s in least)])


def _own(entries: tuple[tuple[str, bool], ...]) -> tuple[tuple[str, bool], ...]:
    """Entries without the words that a stem covers: those are never hit as they stand."""
    stems = tuple(s for s, is_stem in entries if is_stem)
    return tuple((text, is_stem) for text, is_stem in entries if is_stem or not text.startswith(stems))


def fit_toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sizes: dict[int, int] = SAMPLE) -> ToxicModel:
    """Learn from the labelled rows given; at most `sizes` rows of each class are used, drawn by a hash of the id.

    Labels other than 0 and 1 and null ids are ignored; of an id labelled twice the higher counts. Without toxic rows the
    lexicon is empty.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("label_id"), F.col(label).cast("int").alias("toxic"))
    known = known.groupBy("label_id").agg(F.max("toxic").alias("toxic"))
    share = known.agg(F.avg("toxic")).first()[0]
    drawn = [known.where(F.col("toxic") == k).orderBy(F.xxhash64("label_id"), "label_id").limit(n) for k, n in sizes.items()]
    few = stored(drawn[0].unionByName(drawn[1]), "toxic-sample")
    rows = docs.select(F.col(doc_id).alias("row_id"), F.col(text).alias("body")).join(F.broadcast(few), F.col("row_id") == F.col("label_id"))  # sum(sizes) rows
    rows = stored(rows.select("toxic", "body"), "toxic-texts")
    number = {r[0]: r[1] for r in rows.groupBy("toxic").count().collect()}
    n_toxic, n_other = number.get(1, 0), number.get(0, 0)

    words = F.filter(F.split(F.lower(F.coalesce("body", F.lit(""))), "[^\\p{L}\\p{N}]+"), lambda w: F.char_length(w) >= ROOT)
    t, o = F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("o")
    of_word = stored(rows.select("toxic", F.explode(words).alias("word")).groupBy("word").agg(t, o), "toxic-words")
    all_t, all_o = of_word.agg(F.coalesce(F.sum("t"), F.lit(0)), F.coalesce(F.sum("o"), F.lit(0))).first()
    lengths = F.filter(F.array(*map(F.lit, range(ROOT, STEM[1] + 1))), lambda n: n <= F.char_length("word"))
    of_start = of_word.select("t", "o", "word", F.explode(lengths).alias("n")).groupBy(F.expr("substring(word, 1, n)").alias("term")).agg(F.sum("t").alias("t"), F.sum("o").alias("o"))
    of_start = stored(of_start, "toxic-starts")
    roots = of_start.where(F.char_length("term") == ROOT).select(F.col("term").alias("root"), F.col("t").alias("root_t"), F.col("o").alias("root_o"))
    terms = of_start.withColumn("is_stem", F.lit(True)).unionByName(of_word.select(F.col("word").alias("term"), "t", "o", F.lit(False).alias("is_stem")))
    terms = terms.where(F.char_length("term") >= STEM[0]).withColumn("root", F.substring("term", 1, ROOT)).join(roots, "root")
    # what the other texts lead to expect: of all words, or of those with the same root
    expected = F.greatest((F.col("o") + 0.5) * (all_t / max(1, all_o)), F.when(F.col("root_o") >= 20, (F.col("o") + 0.5) / (F.col("root_o") + 1) * F.col("root_t")).otherwise(0.0))
    likely = terms.withColumn("e", expected).where((F.col("t") >= MIN_CONTEXTS) & (F.col("t") >= MIN_LIFT * F.col("e")) & (F.col("t") - F.col("e") >= MIN_EXCESS * F.sqrt(F.col("e") + 0.1)))
    # bounded by the sample; nearly all words of a text are too rare or as frequent elsewhere
    likely = {(r["term"], r["is_stem"]): r for r in likely.collect()}

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = set()
            for body in batch.column(0).to_pylist():
                words = LETTERS.findall((body or "").lower())
                for word, following in zip(words, [*words[1:], ""], strict=True):
                    if (word, False) in likely:
                        out.add((word, False, following))
                    out.update((word[:n], True, following) for n in range(STEM[0], STEM[1] + 1) if len(word) >= n and (word[:n], True) in likely)
            columns = list(zip(*out, strict=True)) if out else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.bool_()), pa.array(columns[2], pa.string())], names=["term", "is_stem", "following"])

    around = rows.where("toxic = 1").select("body").mapInArrow(contexts, "term string, is_stem boolean, following string")
    varied = around.groupBy("term", "is_stem").agg(F.countDistinct("following").alias("n")).where(F.col("n") >= MIN_CONTEXTS)
    sure = {}
    for r in varied.collect():
        key, e = (r["term"], r["is_stem"]), likely[r["term"], r["is_stem"]]["e"]
        if r["n"] >= MIN_LIFT * e and r["n"] - e >= MIN_EXCESS * (e + 0.1) ** 0.5:
            sure[key] = (likely[key]["t"] - e, likely[key]["t"])
    entries = tuple(_chosen(sure))
    own = _own(entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(list(entries))
        for batch in batches:
            out = [(k, t, *n) for t, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for k, n in finder.kinds(body).items()]
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *(pa.array(columns[k], pa.int32()) for k in (1, 2, 3))], names=["kind", "toxic", "hits", "rooted"])

    seen = rows.select("toxic", "body").mapInArrow(run, "kind string, toxic int, hits int, rooted int").groupBy("kind").agg(
        F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("o"), F.sum(F.col("toxic") * F.col("hits")).alias("hits"), F.sum(F.col("toxic") * F.col("rooted")).alias("rooted")
    )
    seen = {r["kind"]: r for r in seen.collect()}  # at most a row per entry
    found = {k: (r["t"], r["o"]) for k, r in seen.items()}

    def weight(kind: str, belief: float) -> float:
        """Log-odds of a text with such a hit against one without; `belief` is the share of toxic texts that have it if
        nothing is known, which counts as ten texts."""
        t, o = found.get(kind, (0, 0))
        return max(0.0, log(((t + 10 * belief) / (n_toxic + 10)) / ((o + 0.1) / (n_other + 10))))

    rates = {}
    for key in own:
        r = likely[key]
        if r["root_o"] >= 20 and key[0] in seen:
            other = (r["o"] + 0.5) / (r["root_o"] + 1)
            toxic = min(0.95, max(seen[key[0]]["hits"] / max(1, seen[key[0]]["rooted"]), MIN_LIFT * other))
            if toxic > other:
                rates[key[0]] = (toxic, min(other, 0.9))
    weights = {text: weight(text, 0.2) for text, _ in own} | {"~" + text: weight("~" + text, 0.2) for text, is_stem in entries if not is_stem}
    # quoted: half of what an ordinary hit says, until labelled texts say otherwise
    typical = float(np.median([weights[t] for t, _ in own])) if own else 0.0
    t, o = found.get("quoted", (0, 0))
    weights["quoted"] = 0.25 * typical if t + o < 10 else weight("quoted", 0.02)
    share = min(max(share or 0.0, 0.001), 0.5)
    return ToxicModel(entries, weights, rates, log(share / (1 - share)) - 1.0)


def score_toxicity(docs: DataFrame, model: ToxicModel, text: str = "text") -> DataFrame:
    """`docs` with `score` (0 to 1, higher: label 1 likelier), `predicted` (1 if score >= 0.7), `n_hits`, `n_quoted`.

    Null and empty texts have no hits. Every row is scored by its whole text alone. Columns named like a result are
    replaced.
    """
    rest = [c for c in docs.columns if c.lower() not in ("score", "predicted", "n_hits", "n_quoted")]
    body = free_name(docs, "scored_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(list(model.entries))
        for batch in batches:
            kinds = [finder.kinds(t) for t in batch.column(len(rest)).to_pylist()]
            scores = np.array([model.score(k) for k in kinds], np.float64)
            columns = [
                *(batch.column(k) for k in range(len(rest))),
                pa.array(scores),
                pa.array((scores >= THRESHOLD).astype(np.int32)),
                pa.array([sum(n for n, _ in k.values()) for k in kinds], pa.int64()),
                pa.array([k.get("quoted", (0, 0))[0] for k in kinds], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*rest, "score", "predicted", "n_hits", "n_quoted"])

    zero = F.lit(0).cast("long")
    schema = docs.select(*rest).withColumn("score", F.lit(0.0)).withColumn("predicted", F.lit(0)).withColumn("n_hits", zero).withColumn("n_quoted", zero).schema
    return docs.select(*rest, F.col(text).alias(body)).mapInArrow(run, schema)
