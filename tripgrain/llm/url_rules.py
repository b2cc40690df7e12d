"""Allow and block rules on hosts and paths: a sort-merge range join.

A host written backwards label by label ("com,example,blog,") turns "this host and its subdomains" into a prefix, and
so into one interval of the sort order. Urls and rules are dealt out by ranges of that order; a rule goes to every
range its interval meets. In each range one sweep over the sorted rows keeps a stack of the rules whose interval
holds the current url; nested hosts are nested intervals, so leaving one is a pop. Path prefixes are looked up in
the rules on the stack.

A range holds about as many urls as any other, however many share a host: rows of one key are told apart by a salt.
A task holds the rules of one chain of nested hosts.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrain.llm.common import free_name, lower_ascii, without

SAMPLED_PER_RANGE = 40  # keys looked at to place the borders of the ranges; borders only balance the work
MOST_RANGES = 2000
LAST = "\U0010ffff"  # sorts after whatever may follow a prefix


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; empty for null or without `://`."""
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty for null or without `://`."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(","))


class _Level:
    """The rules of one host on the stack."""

    def __init__(self, key: str, host: str):
        self.key, self.host, self.rules, self.lengths = key, host, {}, []

    def add(self, path: str, rule: str, verdict: str) -> None:
        old = self.rules.get(path)
        if old is None or (old[1] != "block" and verdict == "block"):
            self.rules[path] = (rule, verdict)
        if old is None and len(path) not in self.lengths:
            self.lengths = sorted([*self.lengths, len(path)], reverse=True)

    def fits(self, host: str, path: str) -> tuple[str, str] | None:
        if host != self.host and not host.endswith("." + self.host):
            return None
        return next((self.rules[path[:n]] for n in self.lengths if path[:n] in self.rules and n <= len(path)), None)


def _sweep(batches: Iterator[pa.RecordBatch], names: Sequence[str], default: str) -> Iterator[pa.RecordBatch]:
    """Rows of one range in sort order. `names`: key, rule path, rule, rule verdict, host, path."""
    stack: list[_Level] = []
    for batch in batches:
        columns = {n: batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names}
        keep, found = [], []
        for i, (key, rule_path, rule, verdict, host, path) in enumerate(zip(*(columns[n] for n in names), strict=True)):
            while stack and not key.startswith(stack[-1].key):
                stack.pop()
            if rule is not None:
                if not stack or stack[-1].key != key:
                    stack.append(_Level(key, host))
                stack[-1].add(rule_path, rule, verdict)
                continue
            hits = [(len(hit[0]), len(level.host), hit) for level in stack if (hit := level.fits(host, path))]
            keep.append(i)
            found.append(max(hits)[2] if hits else (None, default))
        rest = batch.take(pa.array(keep, pa.int64()))
        kept = [n for n in batch.schema.names if n not in names[:4]]
        yield pa.RecordBatch.from_arrays(
            [*(rest.column(rest.schema.get_field_index(n)) for n in kept), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.string())],
            names=[*kept, "rule", "verdict"],
        )


def judge_urls(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """`urls` with `host`, `path`, `rule` and `verdict`.

    rules: columns `host`, `path`, `verdict` (allow or block). A rule fits its host and all subdomains if the path
    starts with the rule's path. The longest rule (host and path together) wins; of equally long ones that with the
    longer host, and of two verdicts on the same host and path the block. `rule` is host and path of the winner,
    null if none fits; then the verdict is `default`.

    Null and odd urls: host and path are empty, no rule fits. Rules with a null host or verdict are left out, a null
    path is empty. Repeated urls each keep their row. Columns of `urls` named like the four results are replaced.
    """
    spark = urls.sparkSession
    ranges = max(1, min(MOST_RANGES, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    address = F.col(url)
    urls = without(urls.withColumn(free_name(urls, "judged_url"), address), "host", "path", "rule", "verdict")
    address = F.col(urls.columns[-1])
    named = {n: free_name(urls, n) for n in ("sort_key", "rule_path", "rule_text", "rule_verdict", "range_no")}
    key, rule_path, rule_text, rule_verdict, range_no = named.values()
    judged = urls.withColumn("host", host_of(address)).withColumn("path", path_of(address)).drop(urls.columns[-1])
    # the salt tells rows of one key apart, so that a border may fall between them
    salt = F.hex(F.xxhash64(F.monotonically_increasing_id()))
    judged = judged.withColumn(key, F.concat(host_key(F.col("host")), F.lit("\0"), salt))
    sample = judged.select(key).orderBy(F.xxhash64(key)).limit(SAMPLED_PER_RANGE * ranges).collect()
    drawn = sorted(row[0].encode() for row in sample)
    borders = sorted({drawn[len(drawn) * i // ranges] for i in range(1, ranges)}) if drawn else []

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(borders, k.encode()) for k in keys], dtype="int32")

    @F.pandas_udf("array<int>")
    def ranges_of(keys: pd.Series) -> pd.Series:
        return pd.Series([list(range(bisect_right(borders, k.encode()), bisect_left(borders, (k + LAST).encode()) + 1)) for k in keys])

    host = lower_ascii(F.col("host"))
    spread = (
        rules.where(F.col("host").isNotNull() & F.col("verdict").isNotNull())
        .select(
            host.alias("host"),
            F.coalesce("path", F.lit("")).alias(rule_path),
            F.concat(host, F.coalesce("path", F.lit(""))).alias(rule_text),
            F.col("verdict").alias(rule_verdict),
        )
        .withColumn(key, host_key(F.col("host")))
        .withColumn(range_no, F.explode(ranges_of(key)))
    )
    both = judged.withColumn(range_no, range_of(key)).unionByName(spread, allowMissingColumns=True)
    dealt = both.repartitionById(ranges, F.col(range_no)).drop(range_no).sortWithinPartitions(key, F.col(rule_text).isNull())
    names = (key, rule_path, rule_text, rule_verdict, "host", "path")
    schema = judged.drop(key).withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(None).cast("string")).schema
    order = schema.fieldNames()
    return dealt.select(*[c for c in order if c in judged.columns], *names[:4]).mapInArrow(lambda batches: _sweep(batches, names, default), schema)


def rules_frame(spark, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (host, path, verdict)."""
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")
