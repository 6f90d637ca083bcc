"""The end-to-end flows: sources to one ranked list, to a curated playlist, to its reports."""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.classify import classify
from ..operators.dedupe import cache_key, dedupe_releases, distinct_top_k, merge_cards, rank_records, unique_records
from ..operators.extract import parse_articles
from ..operators.filters import chosen, lookback, lower_bound
from ..operators.match import cache_lookup, distrusted, resolve
from ..operators.ordering import numbered
from ..operators.select import curate
from ..sources.pages import enrich
from ..sources.records import input_files, release_arrays
from ..sources.sinks import push_report

LOG = logging.getLogger(__name__)
#: Seconds that a cancelled source is given to end.
GRACE_S = 10.0


@dataclass(frozen=True)
class PipelineConfig:
    """What changes the computation; ``as_of`` is never taken from the clock."""

    as_of: str
    lookback_days: int = 7
    max_pages: int = 10
    top_n: int = 50
    candidate_pool_size: int = 150
    soundcloud_target_count: int = 50
    max_per_artist: int = 2
    max_per_associated_artist: int = 3
    allow_speed_variants: bool = False
    allow_old_isrc_years: bool = False
    only_sources: tuple[str, ...] = ()
    skip_sources: tuple[str, ...] = ()
    skip_api_sources: bool = False
    continue_on_source_error: bool = True
    refresh_lookback_days: int = 14
    playlist_name: str = ""
    extra: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Source:
    """A named source: how to build its releases, and whether it needs an interface."""

    name: str
    build: Callable[[SparkSession, PipelineConfig], DataFrame]
    api_source: bool = False
    optional: bool = False


# Names of the sources in the order in which they are read, and whether each needs an interface.
SOURCE_ORDER = (
    ("edmcom", False),
    ("edmtunes", False),
    ("soundcloud_playlists", True),
    ("spotify_playlists", True),
    ("submithub", False),
    ("weraveyou", False),
    ("1001tracklists", False),
    ("followed_soundcloud", True),
    ("top_artists_recent", True),
)


def default_sources(builders: dict[str, Callable[[SparkSession, PipelineConfig], DataFrame]]) -> list[Source]:
    """The known sources for which there is a builder, in order."""
    return [Source(n, builders[n], api) for n, api in SOURCE_ORDER if n in builders]


def source_table(spark: SparkSession, sources: list[Source]) -> DataFrame:
    return spark.createDataFrame([(n, s.name, s.api_source, s.optional) for n, s in enumerate(sources)], "ordinal int, name string, api_source boolean, optional boolean")


def run_sources(spark: SparkSession, sources: list[Source], config: PipelineConfig) -> tuple[list[tuple[str, DataFrame]], DataFrame]:
    """(name, releases) of each chosen source that works, and a status table (name, success, error)."""
    picked = chosen(source_table(spark, sources), "name", list(config.only_sources), list(config.skip_sources), not config.skip_api_sources)
    names = {r["name"] for r in picked.collect()}  # a configuration table
    built, status = [], []
    for s in sources:
        if s.name not in names:
            continue
        try:
            df = s.build(spark, config)
            df.schema  # noqa: B018  analysis errors show here
            built.append((s.name, df))
            status.append((s.name, True, None))
        except Exception as e:
            if not config.continue_on_source_error:
                raise
            LOG.warning("source %s failed: %s", s.name, e)
            status.append((s.name, False, str(e)[:500]))
    return built, spark.createDataFrame(status, "name string, success boolean, error string")


def run_isolated(spark: SparkSession, sources: list[Source], config: PipelineConfig, folder: str, limit_s: float = 600.0) -> tuple[list[tuple[str, DataFrame]], DataFrame]:
    """As :func:`run_sources`, but every source is also run, apart from the others, and written under ``folder``.

    A source that fails in a task, or is not done after ``limit_s`` seconds, has its
    own jobs cancelled (by their tag) and takes no other down. Status: name, success,
    rows, error.
    """
    sc, out, status = spark.sparkContext, [], []
    picked = {s.name for s in sources} & {r["name"] for r in chosen(source_table(spark, sources), "name", list(config.only_sources), list(config.skip_sources), not config.skip_api_sources).collect()}
    for s in sources:
        if s.name not in picked:
            continue
        tag, path, failed = f"source-{uuid.uuid4().hex}", f"{folder.rstrip('/')}/{s.name}-{uuid.uuid4().hex}", []

        def run(s=s, tag=tag, path=path, failed=failed) -> None:
            sc.addJobTag(tag)
            try:
                s.build(spark, config).write.parquet(path)
            except BaseException as e:  # noqa: BLE001  whatever a source raises is its own
                failed.append(str(e)[:500] or type(e).__name__)
            finally:
                sc.removeJobTag(tag)

        worker = InheritableThread(target=run, session=spark)
        worker.daemon = True
        worker.start()
        worker.join(limit_s)
        if worker.is_alive():
            sc.cancelJobsWithTag(tag)
            failed.insert(0, f"not done after {limit_s:g} s")
            worker.join(GRACE_S)
        if failed:
            if not config.continue_on_source_error:
                raise RuntimeError(f"source {s.name}: {failed[0]}")
            LOG.warning("source %s failed: %s", s.name, failed[0])
            status.append((s.name, False, 0, failed[0]))
            continue
        df = spark.read.parquet(path)
        out.append((s.name, df))
        status.append((s.name, True, df.count(), None))
    return out, spark.createDataFrame(status, "name string, success boolean, rows long, error string")


def union_sources(parts: list[tuple[str, DataFrame]]) -> DataFrame:
    """All sources' rows by name, with ``source_file`` and a load order by source, then row.

    A source without an order of its own (``load_ordinal``) is ordered by what its rows
    hold, so that the order never depends on partitions.
    """
    placed = []
    for n, (name, df) in enumerate(parts):
        if "load_ordinal" not in df.columns:
            held = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
            df = numbered(df.withColumn("_held", F.sha2(held, 256)), ["_held"], "load_ordinal").drop("_held")
        placed.append(df.withColumns({"load_ordinal": F.lit(n) * F.lit(1 << 52) + F.col("load_ordinal"), "source_file": F.lit(name) if "source_file" not in df.columns else F.col("source_file")}))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), placed)


def extract_releases(cards: DataFrame, pages: DataFrame | None, profile: str = "A") -> DataFrame:
    """Cards (with ordinal) to deduplicated releases: merged, classified, enriched, parsed.

    Classification comes before the HTML functions, so only release news is
    parsed. Without ``pages`` there is no enrichment.
    """
    merged = merge_cards(cards).where(classify(F.col("title"), F.col("snippet"), profile)["release_article"])
    if pages is None:
        none = {"open_graph": "cast(null as map<string,string>)", "body_text": "cast(null as string)", "embedded_music_links": "cast(null as array<string>)", "body_release_matches": "cast(null as array<string>)"}
        rich = merged.withColumns({k: F.expr(e) for k, e in none.items()})
    else:
        rich = enrich(merged, pages, profile)
    return dedupe_releases(parse_articles(rich, profile).withColumnRenamed("ordinal", "load_ordinal"))


def recent_only(releases: DataFrame, as_of: str, days: int) -> DataFrame:
    """The playlist sources' own filter: dated at the window's start or later."""
    return lower_bound(releases, as_of, days)


def rank(records: DataFrame, config: PipelineConfig) -> tuple[DataFrame, DataFrame]:
    """(all ranked, unique), both filtered to the window only after uniqueness was decided."""
    ranked = rank_records(records, config.as_of)
    unique = unique_records(ranked)
    return lookback(ranked, config.as_of, config.lookback_days), lookback(unique, config.as_of, config.lookback_days)


def rank_inputs(spark: SparkSession, folders: list[str], files: list[str], config: PipelineConfig) -> tuple[DataFrame, DataFrame]:
    """Ranking of recorded JSON arrays."""
    return rank(release_arrays(spark, input_files(spark, folders, files, [])), config)


def pool_size(config: PipelineConfig) -> int:
    return max(config.top_n, config.candidate_pool_size)


def top_tracks(unique: DataFrame, cache: DataFrame | None, config: PipelineConfig, payloads: DataFrame | None = None) -> DataFrame:
    """The best records as tracks to be resolved, with what the cache knows and is trusted for.

    payloads: present data of cached uploads, by which their links are checked.
    """
    n = pool_size(config)
    best = unique.orderBy(F.desc("rank_score"), "group_ordinal", "load_ordinal").limit(n)
    numbered = best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("rank_score"), "group_ordinal", "load_ordinal")))  # of ``n`` rows
    tracks = numbered.select(
        "rank", F.col("load_ordinal").alias("query_id"), F.col("rank_score").alias("ranking_score"), "artist", F.col("track_or_project_title").alias("title"), F.col("cross_source_sources").alias("source_names"),
        cache_key().alias("cache_key"), "source_article_title", "source_article_url", "embedded_music_links", "open_graph",
    )
    if cache is None:
        return tracks.withColumns({c: F.lit(None).cast("string") for c in ("spotify_id", "spotify_uri", "soundcloud_track_id", "soundcloud_url")}).withColumn("notes", F.expr("cast(array() as array<string>)"))
    known = cache_lookup(tracks, cache.select("cache_key", "spotify_id", "spotify_uri", "spotify_match_version", "soundcloud_track_id", "soundcloud_url"))
    return distrusted(known, payloads, config.as_of, config.lookback_days)


def playlist(tracks: DataFrame, catalogue: DataFrame, uploads: DataFrame, config: PipelineConfig, limited_from: int | None = None, **recorded: DataFrame) -> dict[str, DataFrame]:
    """Resolved, curated and cut tracks with their report.

    recorded: further lookups of :func:`~lodestrata.operators.match.resolve`.
    Returns ``pool`` (all, with notes), ``catalogue`` (first top_n kept),
    ``uploads`` (first distinct uploads of the kept), and ``report``.
    """
    found = resolve(tracks, catalogue, uploads, config.as_of, config.lookback_days, limited_from, **recorded)
    pool = curate(
        found, config.as_of, config.lookback_days, config.max_per_artist, config.max_per_associated_artist, not config.allow_speed_variants, not config.allow_old_isrc_years, pool=pool_size(config)
    )
    kept = pool.where("note is null")
    first = kept.where(F.col("playlist_rank") <= config.top_n)
    backfill = distinct_top_k(kept, "soundcloud_track_id", "playlist_rank", config.soundcloud_target_count)
    return {"pool": pool, "catalogue": first, "uploads": backfill, "report": push_report(first)}


def today() -> str:
    """For command lines only: operators never ask the clock."""
    return dt.date.today().isoformat()
