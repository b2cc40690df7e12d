"""Near copies by SimHash, found with meet-in-the-middle ball hashing.

Two fingerprints that differ in at most r bits have a point in the middle that lies within half of r of both. So
every fingerprint emits all points of its ball, points are shuffled, and fingerprints that meet are verified.

With 64 bits and r = 4 a ball of radius 2 has 2,081 points, too many to shuffle. The bits are therefore cut into
`blocks` blocks, and a ball is drawn once for each block left out: of r differing bits, the best choice leaves out at
least r / blocks, so with three blocks at most 2 differ in the rest, and a ball of radius 1 around those 43 bits
suffices: 131 points in all. No pair is lost; `blocks=1` is the plain ball.

Few fingerprints meet at a point; they are compared with each other there. Where more than MEETING meet, each
emits the ball over the block that was left out too, so that all that meet are within r of each other, and a star to
the first of them joins them without any comparison of all pairs. Links become components by rounds of stars.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrain.llm.common import free_name, release_memory, stored

SHINGLE, MAX_BITS, BLOCKS = 4, 4, 3
SEED = 42  # fixed by the contract
MEETING = 64  # so many fingerprints at one point are compared with each other


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits; bit i is 1 if it is set in over half of the hashes of the shingles, repeats included."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six white space characters only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    counts, n = np.zeros(64, np.int64), len(ends)
    for k in range(0, n, 1 << 16):
        hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[k : k + (1 << 16)], ends[k : k + (1 << 16)], strict=False)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long). Null or blank text has fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for batch in batches:
            prints = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, fp long")


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _ball(positions: list[int], radius: int) -> list[int]:
    """Masks that flip up to `radius` of the positions."""
    return [_signed(sum(1 << p for p in flips)) for k in range(radius + 1) for flips in combinations(positions, k)]


def _blocks(blocks: int) -> list[list[int]]:
    return [[int(p) for p in part] for part in np.array_split(np.arange(64), blocks)]


def _points(prints: DataFrame, max_bits: int, blocks: int) -> DataFrame:
    """left_out, point, fp: the balls of all fingerprints."""
    parts = _blocks(blocks)
    masks = []
    for k, part in enumerate(parts):
        kept = [p for p in range(64) if p not in part] if blocks > 1 else part
        most = max_bits - -(-max_bits // blocks) if blocks > 1 else max_bits  # differing bits that the rest can have at most
        keep = _signed(sum(1 << p for p in kept))
        masks += [(k, keep, flip) for flip in _ball(kept, -(-most // 2))]
    table = F.array(*(F.struct(F.lit(k).cast("byte").alias("k"), F.lit(keep).cast("long").alias("keep"), F.lit(flip).cast("long").alias("flip")) for k, keep, flip in masks))
    spread = prints.select("fp", F.explode(table).alias("m"))
    return spread.select(F.col("m.k").alias("left_out"), F.col("fp").bitwiseAND(F.col("m.keep")).bitwiseXOR(F.col("m.flip")).alias("point"), "fp")


def _spanning(members: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that join whatever is linked among a few fingerprints, without the superfluous ones."""
    near = np.bitwise_count(members[:, None] ^ members[None, :]) <= max_bits
    left, links = set(range(len(members))), []
    while left:
        at = left.pop()
        todo = [at]
        while todo:
            at = todo.pop()
            for other in [o for o in left if near[at, o]]:
                left.discard(other)
                todo.append(other)
                links.append((at, other))
    return links


def _meet(batches: Iterator[pa.RecordBatch], max_bits: int, meeting: int) -> Iterator[pa.RecordBatch]:
    """Rows (left_out, point, fp) sorted by all three. Gives links (left_out -1, a, b) and, where more than `meeting`
    meet, the rows themselves."""
    held = [np.empty(0, np.int64)] * 3
    crowded = False  # the group at the end of the last batch has already been passed on in part

    def groups(k: np.ndarray, point: np.ndarray, fp: np.ndarray, last: bool) -> Iterator[list[np.ndarray]]:
        nonlocal held, crowded
        cut = np.flatnonzero((np.diff(point) != 0) | (np.diff(k) != 0)) + 1
        edge = np.concatenate(([0], cut, [len(fp)]))
        sizes = np.diff(edge)
        out = []
        for g in np.flatnonzero((sizes > 1) | ((edge[:-1] == 0) & crowded)):
            a, b = edge[g], edge[g + 1]
            open_end = b == len(fp) and not last
            if (a == 0 and crowded) or b - a > meeting:
                out.append([k[a:b], point[a:b], fp[a:b]])
                continue
            if open_end:
                continue
            members = np.unique(fp[a:b]).view(np.uint64)
            pairs = _spanning(members, max_bits)
            if pairs:
                i, j = np.array(pairs).T
                out.append([np.full(len(i), -1, np.int64), members[i].view(np.int64), members[j].view(np.int64)])
        if last:
            held, crowded = [np.empty(0, np.int64)] * 3, False
        else:
            a = edge[-2] if len(fp) else 0
            was = crowded and a == 0
            crowded = was or len(fp) - a > meeting
            # of a crowded group one row stays, already passed on, to tell where the group goes on
            held = [x[-1:] if crowded else x[a:] for x in (k, point, fp)]
        if out:
            yield [np.concatenate(c) for c in zip(*out, strict=True)]

    def batch_of(columns: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[0].astype(np.int8)), pa.array(columns[1]), pa.array(columns[2])], names=["left_out", "point", "fp"])

    for batch in batches:
        fresh = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(3)]
        joined = [np.concatenate((h, f)) for h, f in zip(held, fresh, strict=True)]
        yield from map(batch_of, groups(*joined, last=False))
    yield from map(batch_of, groups(*held, last=True))


def _stars(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Rows (point, fp) sorted by both: each fingerprint linked to the first at its point."""
    point = first = None
    for batch in batches:
        points, prints = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(2))
        head = np.concatenate(([len(points) > 0 and points[0] != point], np.diff(points) != 0)) if len(points) else np.empty(0, bool)
        start = np.maximum.accumulate(np.where(head, np.arange(len(points)), -1))
        hubs = np.where(start >= 0, prints[start], first if first is not None else 0)
        near = (prints != hubs) & (np.bitwise_count((prints ^ hubs).view(np.uint64)) <= max_bits)
        yield pa.RecordBatch.from_arrays([pa.array(hubs[near]), pa.array(prints[near])], names=["a", "b"])
        if len(points):
            point, first = points[-1], hubs[-1]


def link_prints(prints: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS, meeting: int = MEETING) -> DataFrame:
    """a, b: links between distinct fingerprints (column fp) that join all those connected by at most `max_bits`
    differing bits. Not every pair is listed, but every component is joined."""
    schema = "left_out byte, point long, fp long"
    dealt = _points(prints, max_bits, blocks).repartition("point", "left_out").sortWithinPartitions("point", "left_out", "fp")
    met = stored(dealt.mapInArrow(lambda b: _meet(b, max_bits, meeting), schema), "simhash-meetings")
    plain = met.where("left_out = -1").select(F.col("point").alias("a"), F.col("fp").alias("b"))
    parts, radius = _blocks(blocks), -(-max_bits // 2)
    flips = [(k, flip, abs(int.bit_count(flip & ((1 << 64) - 1)))) for k, part in enumerate(parts) for flip in _ball(part if blocks > 1 else [], radius)]
    keeps = [_signed(sum(1 << p for p in range(64) if p not in part)) if blocks > 1 else -1 for part in parts]
    out = F.col("left_out").cast("int")
    keep = F.element_at(F.array(*map(F.lit, keeps)), out + 1).cast("long")
    table = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(flip).cast("long").alias("flip"), F.lit(n).alias("n")) for k, flip, n in flips))
    used = F.bit_count(F.col("fp").bitwiseAND(keep).bitwiseXOR(F.col("point")))  # of the radius, by the kept bits
    spread = (
        met.where("left_out >= 0")
        .select("point", "fp", keep.alias("keep"), used.alias("used"), out.alias("out"))
        .withColumn("m", F.explode(F.filter(table, lambda m: (m["k"] == F.col("out")) & (m["n"] + F.col("used") <= radius))))
        .select(F.col("point").bitwiseOR(F.col("fp").bitwiseAND(F.bitwise_not("keep")).bitwiseXOR(F.col("m.flip"))).alias("point"), "fp")
    )
    crowded = spread.repartition("point").sortWithinPartitions("point", "fp").mapInArrow(lambda b: _stars(b, max_bits), "a long, b long")
    return plain.unionByName(crowded).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node of each component, for every node of a link (a, b).

    Large and small stars in turn: each node hands its larger neighbours, then its smaller ones, to the least of them.
    A round is written to the shared folder; rounds grow with the logarithm of a component's size.
    """
    edges = stored(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = stored(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        after = stored(small.where("a != b").distinct(), "small-star")
        # both tables hold distinct links; they are stars at the end
        if after.count() == edges.count() and after.join(edges, ["a", "b"], "left_anti").isEmpty():
            return after.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(after.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        edges = after


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """doc_id, fp, component_id: one row per row of `docs`.

    component_id is the smallest id reachable over links, the row's own included. Null and blank texts have
    fingerprint 0 and are linked like any other; fewer words than a shingle make one shingle. Rows of one text always
    share a component. Null ids are ignored in the minimum (null if a component has no other). Other columns are not
    looked at; an empty table gives no rows.
    """
    rows = stored(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    rooted = components(link_prints(prints.select("fp"), max_bits, blocks)).withColumnRenamed("node", "fp")
    linked = rooted.join(prints, "fp")
    least = linked.groupBy("root").agg(F.min("first").alias("least"))
    named = linked.join(least, "root").select("fp", "least")
    named = stored(prints.join(named, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id")), "components")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def print_text(fp: Column) -> Column:
    """16 lower-case hexadecimal digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """`docs` with one row of each group of near copies, that with the smallest id. Of rows with one id one stays;
    rows with a null id can't be told apart and all stay."""
    groups = stored(near_copies(docs, doc_id, **options).where("doc_id is not null"), "groups")
    known, number = free_name(docs, "known_id"), free_name(docs, "rows_kept")
    counts = groups.groupBy(F.col("doc_id").alias(known)).agg(F.count_if(F.col("doc_id") == F.col("component_id")).alias(number))
    # ids that go, or stay once of several rows: far fewer than those that simply stay, so the texts seldom have to move
    other = stored(counts.where(F.col(number) != 1), "not-kept-once")
    key = docs[doc_id].cast("long")
    alone = docs.join(other, key == F.col(known), "left_anti")
    repeated = docs.join(other.where(F.col(number) > 1), key == F.col(known), "left_semi").dropDuplicates([doc_id])
    return alone.unionByName(repeated)
