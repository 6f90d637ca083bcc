"""Release sightings as a stream: newest files are read, deduplicated and appended.

Groups over identifiers are not incremental (a new sighting may join old
groups), so each micro-batch only deduplicates within the watermark; ranking is
recomputed over the retained table by the batch operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import key_part
from ..schema import RELEASE


def read(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """JSON lines of releases as they arrive, with ``seen_at``."""
    rows = spark.readStream.schema(RELEASE).option("maxFilesPerTrigger", files_per_trigger).json(folder)
    return rows.withColumn("seen_at", F.col("_metadata.file_modification_time"))


def deduplicated(rows: DataFrame, delay: str = "14 days") -> DataFrame:
    """The first sighting of each (artist, title, type) within the delay."""
    keyed = rows.withColumns({"_ka": key_part(F.col("artist")), "_kt": key_part(F.col("track_or_project_title")), "_kr": key_part(F.col("release_type"))})
    return keyed.withWatermark("seen_at", delay).dropDuplicatesWithinWatermark(["_ka", "_kt", "_kr"]).drop("_ka", "_kt", "_kr")


def run(rows: DataFrame, table: str, checkpoint: str, after: Callable[[DataFrame], None] | None = None) -> StreamingQuery:
    """Append to a Parquet folder and call ``after`` with each batch; a repeated batch overwrites its own folder."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={epoch}")
        if after:
            after(batch)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
