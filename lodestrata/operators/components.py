"""Connected components of an edge DataFrame by alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A node of more edges than this, and than a ``HUBS``-th of all, is a hub: its edges never meet.
HUB_ROWS, HUBS = 20_000, 1 << 17
#: So many edges that are left are settled by one task.
FINISH = 1 << 17
#: Rows that are dealt out come to about so many rows, or so many bytes, a task, however many they are.
DEALT_ROWS, DEALT_BYTES = 1 << 16, 1 << 25


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder (our own where none is set and one machine runs all)."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if not shared and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(shared or "/tmp/checkpoints")
    return df.checkpoint(eager=True)


def spread(df: DataFrame, *by: str, rows: int = 0, size: int = 0) -> DataFrame:
    """``df`` dealt over all cores by ``by``: a small file is read by few tasks, though its rows may cost much.

    With its number of ``rows`` or ``size`` in bytes, a large table is dealt to more tasks, so that what a task holds does not grow with it.
    """
    spark = df.sparkSession
    least = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    return df.repartition(max(least, -(-rows // DEALT_ROWS), -(-size // DEALT_BYTES)), *by)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def join_keyed(rows: DataFrame, keyed: DataFrame, key: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with one row for each value of ``key``, whose column ``c`` counts the key's rows.

    Rows of a key with more than ``HUB_ROWS`` are not brought together: these keys
    (at most ``HUBS``, as ``total`` rows are more) are broadcast. Equal to a plain join.
    """
    if total <= HUB_ROWS:
        return rows.join(keyed.drop("c"), key)
    least = max(HUB_ROWS, total // HUBS)
    hot = keyed.where(F.col("c") > least)
    others = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(keyed.where(F.col("c") <= least).drop("c"), key)
    return others.unionByName(rows.join(F.broadcast(hot.drop("c")), key))


def join_stored(rows: DataFrame, keyed: DataFrame, key: str) -> DataFrame:
    """As :func:`join_keyed`, for stored ``rows``, whose keys are counted here."""
    total = rows.count()
    if total <= HUB_ROWS:
        return rows.join(keyed, key)
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("c"))
    return join_keyed(rows, keyed.join(counts, key), key, total)


def _large_star(e: DataFrame, total: int) -> DataFrame:
    """Every node hands its larger neighbours to the smallest node it knows."""
    around = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = around.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("c")).select("a", F.least("a", "m").alias("m"), "c")
    bigger = join_keyed(around.where("b > a"), least, "a", 2 * total)
    return bigger.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(e: DataFrame, total: int) -> DataFrame:
    """Every node joins its smaller neighbours and itself to the smallest of them."""
    least = e.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("c"))
    linked = join_keyed(e, least, "a", total)
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _settled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(a, b): each node and the smallest it reaches, of a bounded number of edges."""
    parent: dict = {}

    def root(x):
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for x, y in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True):
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
    rows = [(n, root(n)) for n in list(parent)]
    found = [(n, r) for n, r in rows if n != r]
    yield pd.DataFrame(found, columns=["a", "b"])


def connected_components(edges: DataFrame, left: str = "a", right: str = "b", finish: int = 0) -> DataFrame:
    """(node, component): each node that has an edge, and the smallest node it reaches.

    Work per round is linear in the edges; a hub's edges are reduced by partial
    aggregation and, like those of any frequent node, never gathered. Once ``finish``
    edges or fewer are left, one task settles them. Nodes without an edge, null
    ends and loops give no row.
    """
    e = edges.select(F.col(left).alias("x"), F.col(right).alias("y")).where("x is not null and y is not null and x <> y")
    e = checkpointed(e.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct())
    before = _state(e)
    while before[0] > finish:
        e = checkpointed(_small_star(_large_star(e, before[0]), before[0]))
        now = _state(e)
        if now == before:
            break
        before = now
    else:
        if before[0]:
            e = checkpointed(e.coalesce(1).mapInPandas(_settled, e.schema))
    out = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return out.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


def component_of(spark: SparkSession, nodes: DataFrame, edges: DataFrame, node: str) -> DataFrame:
    """``nodes`` with ``component``; nodes without edges are their own."""
    found = connected_components(edges, finish=FINISH).withColumnRenamed("node", "_cc_node")
    joined = nodes.join(found, F.col(node) == F.col("_cc_node"), "left")
    return joined.withColumn("component", F.coalesce("component", F.col(node))).drop("_cc_node")
