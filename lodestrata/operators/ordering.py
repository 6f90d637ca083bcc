"""Numbers of rows in a global order, without a global window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import checkpointed


def numbered(rows: DataFrame, order: list[str], name: str, ranges: int | None = None) -> DataFrame:
    """``rows`` with ``name``: their place (from 1) by the columns ``order``, which should tell rows apart.

    Rows are range-sorted and stored; a row's place is its place in its range and the
    rows of the ranges before, of which there is one number for each range.
    """
    spark = rows.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    sorted_ranges = rows.repartitionByRange(max(1, n), *order).sortWithinPartitions(*order)
    placed = checkpointed(sorted_ranges.withColumn("_at", F.monotonically_increasing_id()))  # the range's number, then the place in it
    range_of = F.shiftright("_at", 33)
    sizes = sorted(tuple(r) for r in placed.groupBy(range_of.alias("_range")).count().collect())  # one row for each range
    starts, before = [], 0
    for r, count in sizes:
        starts.append((r, before))
        before += count
    offsets = spark.createDataFrame(starts, "_range long, _before long")
    within = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("_range", range_of).join(F.broadcast(offsets), "_range").withColumn(name, F.col("_before") + within + 1).drop("_at", "_range", "_before")
