"""Delivery of playlists in batches, with a ledger: what was acknowledged is never sent again.

A batch is up to a hundred ids of one playlist, in order; its key hashes playlist,
number and ids. The stage that sends returns an outcome row for each batch, and the
outcomes are appended to the ledger. A later run leaves acknowledged keys out. A task
that is lost between a sending and its row sends again under the same key, so a
receiver that remembers keys is never doubled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.components import checkpointed, join_keyed
from ..operators.ordering import numbered

#: Ids in a batch.
BATCH = 100
LEDGER = "playlist string, batch long, key string, ids array<string>, ok boolean, error string, run long"


def batches(tracks: DataFrame, playlist: str, id_col: str, pos: str, size: int = BATCH, numeric: bool = False) -> DataFrame:
    """(playlist, batch, key, ids): the distinct ids of each playlist, at their first place, in batches.

    numeric: ids that are no numbers are left out; empty ones always are. Ids are
    numbered in one order of all playlists' ids, so that no more than a batch ever meets.
    """
    rows = tracks.where(F.col(id_col).rlike(r"^\d+$") if numeric else F.coalesce(F.col(id_col), F.lit("")) != "")
    firsts = rows.groupBy(F.col(playlist).alias("playlist"), F.col(id_col).alias("id")).agg(F.min(pos).alias("pos"))
    ids = numbered(firsts, ["playlist", "pos", "id"], "_n").withColumn("_key", F.coalesce(F.concat(F.lit("p"), F.col("playlist").cast("string")), F.lit("")))  # null is a playlist, too
    starts = ids.groupBy("_key").agg(F.min("_n").alias("_first"), F.count(F.lit(1)).alias("c"))
    placed = join_keyed(ids, starts, "_key", ids.count()).withColumn("batch", F.floor((F.col("_n") - F.col("_first")) / size))
    cut = placed.groupBy("playlist", "batch").agg(F.array_sort(F.collect_list(F.struct("_n", "id"))).alias("l"))  # at most ``size``
    cut = cut.select("playlist", "batch", F.transform("l", lambda x: x["id"]).alias("ids"))
    key = F.sha2(F.concat_ws("\n", F.col("playlist").cast("string"), F.col("batch").cast("string"), F.array_join("ids", "\n")), 256)
    return cut.select(F.col("playlist").cast("string").alias("playlist"), F.col("batch").cast("long").alias("batch"), key.alias("key"), "ids")


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """Outcomes so far; none without a ledger."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def deliver(payload: DataFrame, path: str, send: Callable[..., None], run: int, with_batch: bool = False) -> DataFrame:
    """Send the batches that the ledger at ``path`` does not acknowledge; returns this run's outcomes.

    send(playlist, key, ids) raises if the batch was not taken; with_batch: it is also
    given the batch's number. An error is an outcome, not a failure of the run.
    """
    spark = payload.sparkSession
    done = ledger(spark, path).where("ok").select("key").distinct()
    todo = payload.join(done, "key", "left_anti").select("playlist", "batch", "key", "ids")

    def sent(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for playlist, batch, key, ids in part.itertuples(index=False):
                try:
                    send(playlist, key, list(ids), *((int(batch),) if with_batch else ()))
                    rows.append((playlist, batch, key, list(ids), True, None, run))
                except Exception as e:  # noqa: BLE001  the sender's own
                    rows.append((playlist, batch, key, list(ids), False, str(e)[:500], run))
            yield pd.DataFrame(rows, columns=["playlist", "batch", "key", "ids", "ok", "error", "run"])

    outcomes = checkpointed(todo.mapInPandas(sent, LEDGER))  # once: reading them again must not send again
    outcomes.write.mode("append").parquet(path)
    return outcomes


def report(outcomes: DataFrame) -> DataFrame:
    """By playlist: batches and ids that were taken and that were not."""
    n = F.size("ids")
    return outcomes.groupBy("playlist").agg(
        F.count_if("ok").alias("batches_sent"), F.sum(F.when(F.col("ok"), n).otherwise(0)).alias("ids_sent"), F.count_if(~F.col("ok")).alias("batches_failed"), F.sum(F.when(F.col("ok"), 0).otherwise(n)).alias("ids_failed")
    )
