"""Passages of a benchmark in training texts, by spaced seeds.

A seed is a fixed mask over consecutive tokens; where it has 0 the token does not enter the hash, so a substituted
token there goes unnoticed. Hashes of test items and of training texts are joined; each hit proposes a diagonal (text
position less item position). Around that diagonal the item is aligned with the text in a band, so that diagonals
next to each other, split by a token put in or left out, count together. The pair is a leak if the item as a whole
agrees well enough, or if a long enough run of it does.

Masks alone can miss an item with the edits that are allowed. So each item also has as many disjoint pieces as it may
have edits, and one more: one of them is always untouched. Items of fewer than SHORT tokens have every choice of
tokens left out instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial
from itertools import combinations
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrain.llm.common import free_name, stored

# Two masks of weight 6: a stretch with one substitution in every seven tokens still has hits.
MASKS = ("11101011", "1101001011")
MIN_OVERLAP = 0.8
MIN_RUN = 20  # so many tokens of an item in a row are a leak, whatever their share
RUN_EDIT = 2  # tokens that an edit takes from a run's length
SHORT, PIECE = 8, 4  # tokens of an item that is tried with every choice left out; of the largest piece of the others
BAND = 16  # diagonals on each side at most; items of up to 80 tokens never have more edits at MIN_OVERLAP
BROADCAST_HASHES = 4_000_000  # a hash takes 8 bytes; beyond this many the join shuffles


def tokens_of(text: Column) -> Column:
    """Runs of letters and digits in lower case, so that case and punctuation do not hide a passage."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), lambda t: t != "")


def allowed_edits(n: int, min_overlap: float) -> int:
    return max(0, n - ceil(min_overlap * n))


def left_out(n: int, edits: int) -> list[tuple[str, int]]:
    """mask, place: every choice of `edits` tokens of `n` left out, less what is left out at the ends."""
    masks = ("".join("0" if k in holes else "1" for k in range(n)) for holes in combinations(range(n), edits))
    return sorted({(m.strip("0"), m.index("1")) for m in masks if "1" in m})


def piece_length(n: int, edits: int) -> int:
    return max(1, min(PIECE, n // (edits + 1)))


def _codes(tokens: Column) -> Column:
    """A number for each token. Masks are hashed from these, so that a token's letters are read once."""
    return F.transform(tokens, lambda t: F.xxhash64(t))


def _hash(codes: Sequence[Column], mask: str) -> Column:
    """Of the codes that the mask leaves in; the mask's number keeps the hashes of different masks apart."""
    return F.xxhash64(F.lit(int(mask, 2)), *(code for code, bit in zip(codes, mask, strict=False) if bit == "1"))


def _seed(codes: Column, mask: str, at: Column | int) -> Column:
    """at, seed of the mask at a place."""
    at = F.lit(at) if isinstance(at, int) else at
    return F.struct(at.alias("at"), _hash([F.get(codes, at + F.lit(k)) for k in range(len(mask))], mask).alias("seed"))


def _piece(codes: Column, length: int, i: Column) -> Column:
    """at, seed of the piece with this number."""
    return _seed(codes, "1" * length, i * length)


def _exploded(df: DataFrame, key: str, masks: Sequence[str]) -> DataFrame:
    """key, at, seed: one row per mask and place of `codes`.

    Places become rows before masks are hashed: Spark compiles expressions on columns, and interprets those within
    transform(). The codes from a place on are columns of their own, as all masks share them. The outer form spares a
    filter on empty texts, for which Spark would cut every text into tokens twice; their one row has no place, so no seed."""
    longest = range(max(map(len, masks)))
    ahead = [f"code_{k}" for k in longest]
    places = df.select(F.col(key).alias("key"), "codes", F.size("codes").alias("n"), F.posexplode_outer("codes").alias("at", "code"))
    near = places.select("key", "at", (F.col("n") - F.col("at")).alias("room"), *(F.get("codes", F.col("at") + F.lit(k)).alias(ahead[k]) for k in longest))
    # a mask that reaches beyond the text has no hash
    hashes = F.array(*(F.when(F.col("room") >= len(m), _hash([F.col(c) for c in ahead], m)) for m in masks))
    return near.select(F.col("key").alias(key), "at", F.explode(hashes).alias("seed")).where("seed is not null")


def _let(value: Column, use) -> Column:
    """`use(value)` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _aligned(text: Column, item: Column, shift: Column, width: Column, run: bool) -> Column:
    """Best alignment within `width` diagonals of `shift`. Of the whole item: its tokens that agree, less the tokens put
    in between them. Of a run: its tokens that agree, less RUN_EDIT for each token replaced, left out or put in."""
    replaced, put_in = (-RUN_EDIT, RUN_EDIT) if run else (0, 1)

    def after(state: Column, i: Column) -> Column:
        row = state["row"]

        def on(x: Column, j: Column) -> Column:
            same = F.coalesce(F.get(text, i + shift + j - width) == F.get(item, i), F.lit(False))
            kept = F.greatest(x + F.when(same, 1).otherwise(replaced), F.get(row, j + 1) + replaced, *([F.lit(0)] if run else []))
            return kept + j * put_in  # a diagonal reached from a lower one costs the tokens between them

        ahead = _let(F.transform(row, on), lambda r: F.transform(r, lambda _, j: F.array_max(F.slice(r, F.lit(1), j + 1)) - j * put_in))
        return _let(ahead, lambda r: F.struct(r.alias("row"), F.greatest(state["best"], F.array_max(r)).alias("best")))

    start = F.struct(F.array_repeat(F.lit(0), 2 * width + 1).alias("row"), F.lit(0).alias("best"))
    return F.aggregate(F.sequence(F.lit(0), F.size(item) - 1), start, after, lambda state: state["best"] if run else F.array_max(state["row"]))


def find_leaks(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", masks: Sequence[str] = MASKS, min_overlap: float = MIN_OVERLAP,
    min_run: int = MIN_RUN,
) -> DataFrame:
    """One row per text and test item found in it: doc_id, item_id, item_tokens, matched_tokens, overlap, at.

    matched_tokens: the item's tokens that stand in the text in their order, less the tokens put in between them; overlap:
    their share of the item. A leak has an overlap of `min_overlap` or more, or a run of `min_run` tokens, from which each
    token replaced, left out or put in takes RUN_EDIT. `at` is the first place of the diagonal with most agreement
    (0-based token; negative if the item's head is cut).

    Every item with at most 1 - `min_overlap` of its tokens replaced, left out or put in is found, up to 80 tokens; of
    longer ones, alignments that drift at most BAND tokens, and runs.

    Null or empty texts and items never match. Repeated rows and ids: one row per pair of ids, the best of them. Rows
    with a null id are not reported. Other columns are not looked at.
    """
    tests = items.select(F.col(item_id).alias("item_id"), tokens_of(F.col(text)).alias("tokens")).where("item_id is not null and size(tokens) > 0").dropDuplicates()
    tests = stored(tests, "leak-items")
    coded = tests.withColumn("codes", _codes(F.col("tokens")))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null")
    size = F.size("tokens")
    edits = F.greatest(F.lit(0), size - F.ceil(F.lit(float(min_overlap)) * size)).cast("int")
    pieces = F.greatest(F.lit(1), F.least(F.lit(PIECE), F.floor(size / (edits + 1)))).cast("int")
    # fewer than SHORT and PIECE values
    lengths = sorted(r[0] for r in tests.where(size < SHORT).select(size).distinct().collect())
    cuts = sorted(r[0] for r in tests.where(size >= SHORT).select(pieces).distinct().collect())
    few_left = {n: left_out(n, allowed_edits(n, min_overlap)) for n in lengths}
    every = list(dict.fromkeys([*masks, *("1" * q for q in cuts), *(m for n in lengths for m, _ in few_left[n])]))
    seeds = _exploded(coded, "item_id", masks).select("item_id", "seed", "at")
    for n in lengths:
        table = F.array(*(_seed(F.col("codes"), m, at) for m, at in few_left[n]))
        seeds = seeds.unionByName(coded.where(size == n).select("item_id", F.explode(table).alias("p")).select("item_id", "p.seed", "p.at"))
    for q in cuts:
        last = F.least(edits, F.floor(size / q).cast("int") - 1)
        table = F.transform(F.sequence(F.lit(0), last), partial(_piece, F.col("codes"), q))
        seeds = seeds.unionByName(coded.where((size >= SHORT) & (pieces == q)).select("item_id", F.explode(table).alias("p")).select("item_id", "p.seed", "p.at"))
    seeds = stored(seeds.select("item_id", "seed", F.col("at").alias("item_at")).dropDuplicates(), "leak-seeds")
    known = stored(seeds.select("seed").distinct(), "leak-hashes")
    few = known.count() <= BROADCAST_HASHES
    # texts: only the hashes that a test item has go on
    hits = _exploded(texts.select("doc_id", _codes(tokens_of(F.col("text"))).alias("codes")), "doc_id", every).join(F.broadcast(known) if few else known, "seed", "left_semi")
    pairs = stored(
        hits.join(seeds, "seed").groupBy("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).agg(F.count(F.lit(1)).alias("n_hits")), "leak-hits"
    )
    # cut into tokens after the join
    suspects = texts.join(pairs.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", tokens_of(F.col("text")).alias("tokens"))
    t, u, shift = F.col("tokens"), F.col("item_tokens_list"), F.col("shift")
    n = F.size(u)
    # get() gives null outside the text, which counts as a mismatch
    straight = F.size(F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.coalesce(F.get(t, i + shift) == F.get(u, i), F.lit(False))))
    width = F.least(F.lit(BAND), n - F.ceil(F.lit(float(min_overlap)) * n)).cast("int")
    width = F.greatest(F.lit(0), width)

    def judged(c: Column) -> Column:
        whole = F.when(c == n, c).otherwise(_aligned(t, u, shift, width, run=False))
        return _let(whole, lambda w: F.struct(w.alias("matched"), c.alias("straight"), F.when((w >= min_overlap * n) | (n < min_run), 0).otherwise(_aligned(t, u, shift, width, run=True)).alias("run")))

    checked = (
        pairs.join(tests.select("item_id", F.col("tokens").alias("item_tokens_list")), "item_id")
        .join(suspects, "doc_id")
        .select("doc_id", "item_id", n.alias("item_tokens"), _let(straight, judged).alias("j"), shift.alias("at"))
    )
    # filtered after the aggregate: before it, Spark would align twice
    best = checked.groupBy("doc_id", "item_id").agg(
        F.max(F.struct((F.col("j.matched") / F.col("item_tokens")).alias("overlap"), F.col("j.straight").alias("straight"), (-F.col("at")).alias("back"), F.col("j.matched").alias("matched_tokens"), "item_tokens")).alias("b"),
        F.max("j.run").alias("run"),
    )
    best = best.where((F.col("b.matched_tokens") >= min_overlap * F.col("b.item_tokens")) | (F.col("run") >= min_run))
    return best.select("doc_id", "item_id", "b.item_tokens", "b.matched_tokens", "b.overlap", (-F.col("b.back")).alias("at"))


def drop_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """`docs` less those with a leak. All rows of an id go if one of them has one; rows with a null id are judged by
    their texts."""

    def kept(rows: DataFrame, key: str) -> DataFrame:
        leaked = free_name(rows, "leaked_id")
        leaks = stored(find_leaks(rows, items, doc_id=key, **options).select(F.col("doc_id").alias(leaked)).distinct(), "leaks")
        return rows.join(leaks, rows[key] == leaks[leaked], "left_anti")

    nameless = docs.where(docs[doc_id].isNull())
    if nameless.isEmpty():
        return kept(docs, doc_id)
    digest = free_name(docs, "text_digest")
    body = F.col(options.get("text", "text"))
    by_text = kept(nameless.withColumn(digest, F.sha2(F.coalesce(body, F.lit("")).cast("binary"), 256)), digest).drop(digest)
    return kept(docs.where(docs[doc_id].isNotNull()), doc_id).unionByName(by_text)
