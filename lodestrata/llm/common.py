"""Helpers shared by the operators of this subpackage.

All Python stages here are Arrow-batched ``mapInArrow`` stages that look at one
record batch at a time, so a task's memory is bounded by a batch and never by a
partition or a key.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows handed to a per-document routine at once (bounds Python objects alive).
SLICE_ROWS = 512
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the synthetic tables, read by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_HELD: dict[str, object] = {}


def held(name: str, make: Callable[[], object]) -> object:
    """What this Python worker keeps between tasks under ``name``.

    A worker keeps one thing at a time: tables and memos of the operator that
    ran before go, so that the operators of a pipeline do not add up in memory.
    """
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = make()
    return _HELD[name]


def release(keep: str = "") -> None:
    """Drop what this worker keeps, but for ``keep``."""
    for name in [n for n in _HELD if n != keep]:
        del _HELD[name]


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of at most ``rows`` rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def slices_of(batches: Iterable[pa.RecordBatch], column: int, size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces whose texts in ``column`` take at most ``size`` bytes (or one row)."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            past = int(np.searchsorted(ends, size + (ends[start - 1] if start else 0), "right"))
            past = max(start + 1, past)
            yield batch.slice(start, past - start)
            start = past


def map_texts(
    df: DataFrame,
    columns: list[str],
    fn: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str,
    rows: int = SLICE_ROWS,
    keep: str = "",
) -> DataFrame:
    """Apply ``fn`` to slices of the named columns (others are pruned from the scan).

    keep: the name under which ``fn`` asks for :func:`held` things, if it does.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release(keep)
        for piece in slices(batches, rows):
            yield fn(piece)

    return df.select(*columns).mapInArrow(run, schema)


def shuffle_width(spark: SparkSession) -> int:
    """The session's shuffle partition count: how far a hot key is salted."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; one of our own only where none is set."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not shared and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    sc.setCheckpointDir(shared or "/tmp/checkpoints")  # one machine: its folder is shared
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and read it from there.

    Survives lost executors (unlike localCheckpoint) and cuts the lineage of
    Python stages that must not run twice.
    """
    ensure_checkpoint_dir(df.sparkSession)
    with _shuffles_dropped(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # a query takes the setting when it is built


@contextmanager
def _shuffles_dropped(spark: SparkSession):
    """Spark removes the shuffle files of each query that ends meanwhile: its result is stored."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def unused(columns: list[str], *names: str) -> list[str]:
    """``names``, each led by underscores until no column has it (Spark does not tell case apart)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(names: list[str]) -> list[str]:
    """Column names as Spark reads them whatever they hold."""
    return ["`" + n.replace("`", "``") + "`" for n in names]


def sha_hex(col) -> F.Column:
    return F.sha2(col, 256)


#: A key of more rows than this, and than a ``HOT_KEYS``-th of all rows, is hot.
HOT_ROWS, HOT_KEYS = 20_000, 1 << 17


def join_counted(rows: DataFrame, keyed: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join of ``rows`` with one row for each key, whose column ``c`` counts the key's rows.

    Both sides have to be stored. Rows of a hot key are never brought together:
    there are at most ``HOT_KEYS`` such keys, and these are broadcast.
    """
    least = max(HOT_ROWS, rows.count() // HOT_KEYS)
    hot = keyed.where(F.col("c") > least)
    if not hot.limit(1).collect():
        return rows.join(keyed.drop("c"), keys)
    others = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(keyed.where(F.col("c") <= least).drop("c"), keys)
    return others.unionByName(rows.join(F.broadcast(hot.drop("c")), keys))


class Stored:
    """A DataFrame written as Parquet under the shared checkpoint folder, while the ``with`` block lasts.

    For rows that are read several times: hashes take half the room they take
    in a checkpoint, and the files go as soon as the caller is done, or fails.
    """

    def __init__(self, df: DataFrame):
        self.spark = df.sparkSession
        self.path = f"{ensure_checkpoint_dir(self.spark)}/rows-{uuid.uuid4().hex}"
        with _shuffles_dropped(self.spark):
            df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def __enter__(self) -> DataFrame:
        return self.df

    def __exit__(self, *error) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
