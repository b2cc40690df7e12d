"""Filter audit, sharding and resampling against brute force, and on nulls, empty and long texts, ties, repeated rows,
empty tables and extra columns with clashing names."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripgrain.llm import filter_audit, resampling, sharding
from tripgrain.llm.common import stored

GAP = re.compile(r"[\x20\x09-\x0D]+")
SHAPE = (
    "doc_id long, text string, source string, part string, mask int, n int, first string, key string, spread int, shard string, slot int, "
    "grown_shard int, stored_file string, rank string, score string, rows_before int, quality int"
)


def prose(n, seed):
    dice = random.Random(seed)
    return " ".join("".join(dice.choice("aeiou bcdfg ÄéZ9-#") for _ in range(dice.randint(1, 6))) for _ in range(n))


ODD = [None, "", " \n\t ", "x", "\x0b\x0c\x1c", "One ONE one " * 40, "é😀" * 30, "A" * 70, prose(4000, 1), "z" * 50_000, "the same #" * 30]


def full(doc_id, text, source):
    return (doc_id, text, source, "p", 1, 2, "f", "k", 3, "s", 4, 5, "file", "r", "sc", 6, 7)


@pytest.fixture(scope="module")
def raw():
    rows = [(k, t, f"s{k % 3}") for k, t in enumerate(ODD)] + [(50 + k, prose(40 + 3 * k, k), "s1") for k in range(25)]
    rows += [(k, "hot copy of one text, again", ["s0", "", None][k % 3]) for k in range(100, 160)]  # a group of copies
    rows += [(7, "Other text under an id met before", "s2"), (105, "hot copy of one text, again", "s0"), (105, "hot copy of one text, again", "s0")]
    return rows + [(None, "x", "s1"), (None, "hot copy of one text, again", None), (None, "hot copy of one text, again", None), (None, prose(30, 99), None)]


@pytest.fixture(scope="module")
def docs(spark, raw):
    return spark.createDataFrame([full(*r) for r in raw], SHAPE).repartition(5)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def words(text):
    return [w for w in GAP.split(text or "") if w]


# --- 11: filter audit


def failing(text):
    w, body = words(text), text or ""
    found = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", body)) > 5 * len(body)}
    return {k for k, v in found.items() if v} | ({"D"} if re.search(r"[#$%&*|]", body) else set())


def audit_by_hand(raw, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    copies = [d is not None and any(e is not None and e < d and (u or "") == (t or "") for e, u, _ in raw) for d, t, _ in raw]
    docs = [(d, s or "", failing(t) | ({"E"} if c else set())) for (d, t, s), c in zip(raw, copies, strict=True)]
    want = {}
    for part in {s for _, s, _ in docs}:
        mine, credit = [x for x in docs if x[1] == part], collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left = list(mine)
            for step, letter in enumerate(order, 1):
                gone = [x for x in left if letter in x[2]]
                left = [x for x in left if letter not in x[2]]
                fails = [x for x in mine if letter in x[2]]
                credit[letter] += len(gone)
                want[part, "".join(order), step] = [
                    len(left), len(gone), len(fails) - len(gone), sum(x[2] == {letter} for x in mine),
                    sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone), letter,
                ]
        for (p, _, _), row in want.items():
            if p == part:
                row[-1] = credit[row[-1]]
    return want


def test_filter_audit_against_brute_force(spark, docs, none, raw):
    labels = [(k, k % 2, 1 - k % 2) for k in range(0, 160, 3)] + [(3, 0, 0), (105, 1, 1), (105, 0, None), (None, 1, 1), (999, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    losses = {"good_lost": "quality", "toxic_lost": "toxic"}
    got = {tuple(r)[:3]: list(r)[3:] for r in filter_audit.audit_filters(docs, table, losses).collect()}
    assert got == audit_by_hand(raw, labels)
    assert filter_audit.audit_filters(none, table, losses).collect() == []
    without = filter_audit.audit_filters(docs, table.where("false"), losses).agg(F.sum("good_lost"), F.sum("toxic_lost")).first()
    assert tuple(without) == (0, 0)


def test_filter_audit_takes_other_filters(spark, docs, raw):
    filters = (("short", lambda m: m["words"] < 5), ("marked", lambda m: m["marks"]))
    out = filter_audit.audit_filters(docs, spark.createDataFrame([], "doc_id long, quality int"), {"lost": "quality"}, filters, "copy").collect()
    assert {r.filter_order for r in out} == {"".join(p) for p in itertools.permutations(["short", "marked", "copy"])}
    for part, n in collections.Counter(s or "" for _, _, s in raw).items():
        for order in {r.filter_order for r in out}:
            steps = sorted((r for r in out if (r.part, r.filter_order) == (part, order)), key=lambda r: r.step)
            assert n == steps[-1].kept + sum(r.removed for r in steps)


def test_min_plus_steps():
    orders = np.array(list(itertools.permutations(range(4))))
    positions = np.argsort(orders, axis=1) + 1
    steps = filter_audit.removal_steps(np.arange(16), positions)
    for mask in range(16):
        for p, order in enumerate(orders):
            assert steps[mask, p] == next((s for s, f in enumerate(order, 1) if mask >> f & 1), 5)


# --- 12: sharding


def shard_by_hand(key, weights):
    best = []
    for k, w in enumerate(weights):
        h = int(hashlib.md5(f"{'' if key is None else key}:{k}".encode()).hexdigest()[:13], 16)
        best.append((-w / math.log((h + 0.5) / 16**13), -k))
    return -max(best)[1]


@pytest.mark.parametrize("weights", [(1.0,) * 16, (0.5, 3.0, 1.0), (1.0,)])
def test_shards_against_brute_force(docs, none, raw, weights):
    out = sharding.shard_rows(docs.select("doc_id", "text", "shard", "slot", "stored_file", "rows_before"), weights=weights)
    assert out.columns == ["doc_id", "text", "stored_file", "rows_before", "shard", "grown_shard", "slot"]
    got = out.collect()
    assert collections.Counter((r.doc_id, r.text) for r in got) == collections.Counter((d, t) for d, t, _ in raw)
    for r in got:
        assert r.shard == shard_by_hand(r.doc_id, weights) and r.grown_shard == shard_by_hand(r.doc_id, [*weights, 1.0])
        assert r.grown_shard in (r.shard, len(weights))
    for shard in {r.shard for r in got}:
        mine = sorted((r for r in got if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in mine] == list(range(len(mine)))
        ids = [-1 if r.doc_id is None else r.doc_id for r in mine]
        assert ids == sorted(ids)
    assert sharding.shard_rows(none, weights=weights).collect() == []


def test_shards_follow_their_weights(spark):
    ids = spark.range(30_000).withColumnRenamed("id", "doc_id")
    sizes = dict(map(tuple, sharding.with_shards(ids, weights=(1, 2, 3, 4)).groupBy("shard").count().collect()))
    assert [round(sizes[k] / 3000) for k in range(4)] == [1, 2, 3, 4]
    moved = sharding.with_shards(ids, weights=(1, 2, 3, 4), next_weight=2.0).where("shard <> grown_shard")
    assert abs(moved.count() - 5000) < 300 and {r[0] for r in moved.select("grown_shard").distinct().collect()} == {4}
    for weights in ((), (1, 0), (-1,)):
        with pytest.raises(ValueError):
            sharding.with_shards(ids, weights=weights)


def test_written_shards_hold_whole_rows(spark, docs, raw, tmp_path):
    path = str(tmp_path / "shards")
    sharding.write_shards(docs.drop("shard", "slot", "grown_shard"), path, weights=(1, 1, 2))
    back = [r for k in range(3) for r in sharding.read_shard(spark, path, k).select("doc_id", "text", "source").collect()]
    assert collections.Counter(map(tuple, back)) == collections.Counter(raw)
    assert all(shard_by_hand(r.doc_id, (1, 1, 2)) == 1 for r in sharding.read_shard(spark, path, 1).collect())


# --- 13: resampling

FEATURE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def features(text, run):
    w = FEATURE_WORD.findall((text or "").translate(UPPER))
    return [zlib.crc32(" ".join(w[i : i + k]).encode()) for k in range(1, run + 1) for i in range(len(w) - k + 1)], len(w)


@pytest.mark.parametrize("run", [1, 2, 3])
def test_features_against_brute_force(raw, run):
    for _, text, _ in raw:
        got, n = resampling.feature_buckets((text or "").encode(), run, 997)
        want, m = features(text, run)
        assert n == m and sorted(got.tolist()) == sorted(x % 997 for x in want)


def test_resampling_against_brute_force(spark, docs, none, raw):
    aims = [prose(60, 500), None, "hot copy of one text", ""]
    target = spark.createDataFrame([(k, t, "x") for k, t in enumerate(aims)], "item_id int, text string, score string")
    s, t = collections.Counter(), collections.Counter()
    for _, text, _ in raw:
        s.update(x % 10_000 for x in features(text, 2)[0])
    for text in aims:
        t.update(x % 10_000 for x in features(text, 2)[0])
    whole, aim = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    want = []
    for d, text, _ in raw:
        found, n = features(text, 2)
        gains = [math.floor(1000 * math.log((t[x % 10_000] + 1) * whole / ((s[x % 10_000] + 1) * aim))) for x in found]
        weight = math.floor(sum(gains) / len(gains)) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        want.append((d, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n))
    pool = sorted((w for w in want if w[4] >= 20), key=lambda w: (-w[3], w[0] is None, w[0] or 0))
    out = resampling.resample(docs, target)
    got = out.collect()
    plain = lambda rows: sorted(rows, key=str)
    assert plain((r.doc_id, r.n_features, r.weight, r.score, r.n_words) for r in got) == plain(want)
    drawn = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in drawn] == list(range(1, 25 * len(pool) // 100 + 1))
    assert [(r.score, r.doc_id) for r in drawn] == [(w[3], w[0]) for w in pool[: len(drawn)]]
    assert resampling.resample(none, target).collect() == []
    assert {r.weight for r in resampling.resample(docs, target.where("false")).where("n_features = 0").collect()} == {0}


@pytest.mark.parametrize("accuracy", [1, 3, 1000])
@pytest.mark.parametrize("percent", [0, 1, 25, 99, 100])
def test_cutoff_is_exact_whatever_the_sketch_says(spark, accuracy, percent):
    dice = random.Random(accuracy)
    rows = [(k, 50 if k % 3 == 0 else dice.randint(-400, 400)) for k in range(900)] + [(4, 50)] * 40 + [(None, 50)] * 3 + [(5, None)]
    scored = stored(spark.createDataFrame(rows, "doc_id long, score long").repartition(4), "scores")
    out = resampling.draw_highest(scored, F.col("score") > -300, percent, accuracy).collect()
    pool = sorted((r for r in rows if r[1] is not None and r[1] > -300), key=lambda r: (-r[1], r[0] is None, r[0] or 0))
    drawn = sorted((r for r in out if r["rank"] is not None), key=lambda r: r["rank"])
    assert [(r.doc_id, r.score) for r in drawn] == pool[: percent * len(pool) // 100]
    assert [r["rank"] for r in drawn] == list(range(1, len(drawn) + 1))
    assert len(out) == len(rows)


def test_a_wrong_bracket_is_widened(spark, monkeypatch):
    rows = [(k, k) for k in range(1000)]
    scored = stored(spark.createDataFrame(rows, "doc_id long, score long"), "scores")
    low, high, above = resampling.bracket(scored, 100, 1000)
    assert low <= 900 <= high and above == 999 - high
    monkeypatch.setattr(F, "percentile_approx", lambda *a: F.array(*map(F.lit, (10, 20, 30, 40, 850, 950))))
    assert resampling.bracket(scored, 100, 1000) == (850, 950, 49)
    monkeypatch.setattr(F, "percentile_approx", lambda *a: F.array(*map(F.lit, (10, 20, 30, 40, 50, 60))))
    assert resampling.bracket(scored, 100, 1000) == (None, None, 0)
