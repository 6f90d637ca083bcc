"""Command line: rank recorded sightings.

``python -m lodestrata.cli rank --input-dir DIR --output OUT --unique-output OUT2 --as-of DATE``
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from .operators.dedupe import best_first
from .plans.pipeline import PipelineConfig, rank_inputs, today
from .sources.sinks import write_json

#: Working columns that do not leave the engine.
INNER = ("aliases", "group_ordinal", "load_ordinal", "ranking_score", "rank_factors", "rank_score")


def published(ranked: DataFrame) -> DataFrame:
    """The rank takes the place of the source's own score only here."""
    return ranked.select("*", ranked["rank_score"].alias("_score"), ranked["rank_factors"].alias("_factors")).drop(*INNER, "ranking_factors").withColumnsRenamed({"_score": "ranking_score", "_factors": "ranking_factors"})


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    r = sub.add_parser("rank", help="rank JSON arrays of sightings")
    r.add_argument("--input", action="append", default=[])
    r.add_argument("--input-dir", action="append", default=[])
    r.add_argument("--output", required=True)
    r.add_argument("--unique-output")
    r.add_argument("--no-unique-output", action="store_true")
    r.add_argument("--as-of", default=None, help="yyyy-MM-dd; today by default")
    r.add_argument("--lookback-days", type=int, default=0, help="0: no window")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("lodestrata").getOrCreate()
    config = PipelineConfig(as_of=args.as_of or today(), lookback_days=args.lookback_days)
    ranked, unique = rank_inputs(spark, args.input_dir, args.input, config)
    write_json(published(best_first(ranked)), args.output)
    if args.unique_output and not args.no_unique_output:
        write_json(published(best_first(unique)), args.unique_output)


if __name__ == "__main__":
    main()
