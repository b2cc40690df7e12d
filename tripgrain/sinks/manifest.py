"""Versions of published data: folders that never change, and a manifest that is written last.

    root/data/<id>/...            written once, by one run
    root/manifests/00000007.json  one version: which folder holds each partition, and which holds each dataset

A version exists from the moment its manifest is complete; until then, and if the run is killed at any step, readers
find the version before, whole. Nothing is renamed, deleted or overwritten to publish. A manifest takes the next free
number and is created only if that is still free, so of two runs that end at once one is refused. A frame that was read
from a version goes on reading that version's files whatever is published meanwhile.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

PART = "part"  # name of the folders that hold one partition each


class Superseded(RuntimeError):
    """Another run has published in the meantime."""


@dataclass(frozen=True)
class Version:
    """`partitions` and `datasets` name folders relative to the root."""

    number: int = 0
    schema: str = ""
    partitions: dict[str, str] = field(default_factory=dict)
    datasets: dict[str, str] = field(default_factory=dict)


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _names(spark: SparkSession, path: str) -> list[str]:
    files, where = _files(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(where)) if files.exists(where) else []


def _manifest(root: str, number: int) -> str:
    return f"{root}/manifests/{number:08d}.json"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n[:8]) for n in _names(spark, f"{root}/manifests") if n.endswith(".json") and n[:8].isdigit())


def _read(spark: SparkSession, root: str, number: int) -> Version | None:
    """None if the manifest was never finished."""
    files, where = _files(spark, _manifest(root, number))
    stream = files.open(where)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        found = json.loads(text)
    except ValueError:
        return None
    return Version(number, found["schema"], found["partitions"], found["datasets"])


def current(spark: SparkSession, root: str, number: int | None = None) -> Version | None:
    """The version of that number, else the latest; None if there is none."""
    for n in reversed(_numbers(spark, root)):
        if number in (None, n) and (version := _read(spark, root, n)) is not None:
            return version
    return None


def fresh_folder(root: str) -> str:
    """A folder below the root that no other run uses."""
    return f"{root}/data/{uuid.uuid4().hex[:12]}"


def written_partitions(spark: SparkSession, root: str, folder: str) -> dict[str, str]:
    """Partition values and their folders, as just written by `partitionBy(PART)`."""
    found = (n.removeprefix(f"{PART}=") for n in _names(spark, folder) if n.startswith(f"{PART}="))
    return {key: f"{folder.removeprefix(root + '/')}/{PART}={key}" for key in found}


def publish(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    partitions: dict[str, str],
    replaced: Callable[[str], bool],
    datasets: dict[str, str],
    after: Version | None,
) -> Version:
    """Make a version of the one it comes `after`: its partitions that are `replaced` go, those given come in."""
    held = {} if after is None else {k: v for k, v in after.partitions.items() if not replaced(k)}
    numbers = _numbers(spark, root)
    latest = current(spark, root)
    if (latest.number if latest else 0) != (after.number if after else 0):
        raise Superseded(f"{root} is at version {latest.number if latest else 0} now")
    version = Version((numbers[-1] if numbers else 0) + 1, schema.json(), {**held, **partitions}, datasets)
    text = json.dumps({"schema": version.schema, "partitions": version.partitions, "datasets": version.datasets})
    files, where = _files(spark, _manifest(root, version.number))
    try:
        stream = files.create(where, False)  # refused if the number was taken just now
    except Exception as error:
        raise Superseded(f"version {version.number} of {root} can't be created") from error
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return version


def read_partitions(spark: SparkSession, root: str, version: Version | None, wanted: Callable[[str], bool] = lambda key: True) -> DataFrame:
    """Rows of the partitions wanted; no other folder is listed or read."""
    if version is None:
        raise FileNotFoundError(f"nothing is published below {root}")
    schema = T.StructType.fromJson(json.loads(version.schema))
    paths = [f"{root}/{folder}" for key, folder in sorted(version.partitions.items()) if wanted(key)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def drop(spark: SparkSession, path: str) -> None:
    files, where = _files(spark, path)
    files.delete(where, True)


def drop_unused(spark: SparkSession, root: str, keep: int = 2, sparing: Iterable[str] = ()) -> list[str]:
    """Remove manifests before the last `keep` versions and the data that no kept one names. Folders of runs still at
    work must be named in `sparing`; readers of older versions lose their files."""
    whole = [v for n in _numbers(spark, root) if (v := _read(spark, root, n)) is not None]
    kept = whole[-keep:]
    named = {folder.split("/")[1] for v in kept for folder in (*v.partitions.values(), *v.datasets.values())} | set(sparing)
    dropped = [name for name in _names(spark, f"{root}/data") if name not in named]
    for v in whole[: len(whole) - len(kept)]:
        drop(spark, _manifest(root, v.number))
    for name in dropped:
        drop(spark, f"{root}/data/{name}")
    return dropped
