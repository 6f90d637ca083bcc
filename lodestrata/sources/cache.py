"""A keyed cache with commits: numbered snapshots, merged by key, swapped in only if nobody else was first.

A snapshot is a manifest, a small file whose number is the snapshot's, that names a
folder of rows for each bucket of keys. A commit writes the merged rows of the
buckets that the new rows touch into a folder of its own, then creates the next
manifest, which fails if it exists: then the newer snapshot is merged instead, and
again. Until the manifest exists nothing of a commit can be seen, and files are never
changed, so readers and a crash between the steps leave a whole cache.

Creating a file that must not exist is one step on local, distributed and most other
file systems of Hadoop's; a store without that needs a lock around :func:`commit`.
A manifest that cannot be read counts as not there.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.components import checkpointed

BUCKETS = 16
#: How often a commit that others overtake is tried.
TRIES = 20


class Conflict(RuntimeError):
    """Others committed first each time."""


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _snapshots(spark: SparkSession, path: str) -> list[int]:
    fs, p = _fs(spark, f"{path}/manifests")
    if not fs.exists(p):
        return []
    names = (str(s.getPath().getName()) for s in fs.listStatus(p))
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _manifest(spark: SparkSession, path: str, number: int) -> dict[str, str] | None:
    """Folder of each bucket; None if it cannot be read."""
    lines = spark.read.text(f"{path}/manifests/{number:012d}.json").collect()  # one short line for each bucket
    try:
        held = json.loads("".join(r["value"] for r in lines))
    except ValueError:
        return None
    return held if isinstance(held, dict) else None


def latest(spark: SparkSession, path: str) -> tuple[int, dict[str, str]]:
    """(number, manifest) of the newest snapshot that can be read; the number of the newest of all."""
    numbers = _snapshots(spark, path)
    for n in reversed(numbers):
        if (held := _manifest(spark, path, n)) is not None:
            return numbers[-1], held
    return (numbers or [0])[-1], {}


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _rows(spark: SparkSession, path: str, held: dict[str, str], schema: str, buckets: set[int] | None = None) -> DataFrame:
    folders = [f"{path}/{held[b]}" for b in sorted(held) if buckets is None or int(b) in buckets]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The newest snapshot; a cache that is not there is empty."""
    return _rows(spark, path, latest(spark, path)[1], schema)


def _create(spark: SparkSession, path: str, number: int, held: dict[str, str]) -> bool:
    """Whether the manifest could be created: False if it exists."""
    fs, p = _fs(spark, f"{path}/manifests/{number:012d}.json")
    try:
        stream = fs.create(p, False)
    except Exception as e:  # noqa: BLE001  Hadoop's file systems raise several kinds
        if fs.exists(p):
            return False
        raise e
    try:
        stream.write(bytearray(json.dumps(held, indent=0, sort_keys=True).encode()))
    finally:
        stream.close()
    return True


def commit(new: DataFrame, path: str, key: str = "cache_key", before_swap=None) -> int:
    """Put ``new`` (one row for each key; null keys are left out) over the cached rows; returns the snapshot's number.

    before_swap: called before each swap, for tests of what happens meanwhile.
    """
    spark = new.sparkSession
    fresh = checkpointed(new.where(F.col(key).isNotNull()))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fresh.schema.fields)
    touched = {r[0] for r in fresh.select(_bucket(F.col(key))).distinct().collect()}  # at most BUCKETS
    for _ in range(TRIES):
        number, held = latest(spark, path)
        old = _rows(spark, path, held, ddl, touched)
        merged = old.join(fresh.select(key), key, "left_anti").select(*fresh.columns).unionByName(fresh)
        data = f"data/{uuid.uuid4().hex}"
        merged.withColumn("_bucket", _bucket(F.col(key))).write.partitionBy("_bucket").parquet(f"{path}/{data}")
        if before_swap:
            before_swap()
        if _create(spark, path, number + 1, held | {str(b): f"{data}/_bucket={b}" for b in touched}):
            return number + 1
    raise Conflict(f"{path}: {TRIES} commits of others came first")
