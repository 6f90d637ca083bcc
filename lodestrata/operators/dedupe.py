"""Aliases, duplicate groups, ranking and deduplication of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import rank_or_last
from ..functions.text import clean_id, first_filled, key_part, normalize_artist_name, normalize_text, normalize_title
from .components import FINISH, checkpointed, connected_components, join_keyed
from .score import bag, cross_source_factors

# Prefixes of aliases, best first.
PREFIXES = ("spotify:", "isrc:", "soundcloud:", "text:")


def aliases(all_artists: Column | None = None) -> Column:
    """Identifiers under which a record may be sighted elsewhere, best prefix first."""
    artist = normalize_text(first_filled(bag("all_artists") if all_artists is None else all_artists, F.col("artist")))
    title = normalize_title(F.col("track_or_project_title"))
    with_prefix = lambda p, c: F.concat(F.lit(p), c)  # noqa: E731  null stays null
    found = F.array(
        with_prefix("spotify:", clean_id(bag("spotify_track_id"))),
        with_prefix("isrc:", F.upper(clean_id(bag("isrc")))),
        with_prefix("soundcloud:", clean_id(bag("soundcloud_track_id"))),
        F.when((artist != "") & (title != ""), F.concat(F.lit("text:"), artist, F.lit("|"), title)),
    )
    return F.array_compact(found)


def prefix_rank(alias: Column) -> Column:
    out = F.lit(len(PREFIXES))
    for n, p in enumerate(PREFIXES):
        out = F.when(F.startswith(alias, F.lit(p)), n).otherwise(out)
    return out


def alias_edges(records: DataFrame, id_col: str, alias_col: str) -> DataFrame:
    """Star edges (a, b): each record and the first one under the same alias; linear in the aliases."""
    pairs = checkpointed(records.select(F.col(id_col).alias("a"), F.explode(alias_col).alias("alias")))
    hubs = pairs.groupBy("alias").agg(F.min("a").alias("b"), F.count(F.lit(1)).alias("c")).where("c > 1")
    return join_keyed(pairs, hubs, "alias", pairs.count()).where("a <> b").select("a", "b").distinct()


def group_records(records: DataFrame, id_col: str = "load_ordinal", alias_col: str = "aliases") -> DataFrame:
    """``records`` with ``group_ordinal`` (the group's first id) and ``duplicate_group_key``.

    The key is the group's alias with the best prefix, smallest of its kind.
    """
    found = connected_components(alias_edges(records, id_col, alias_col), finish=FINISH).withColumnRenamed("node", "_node")
    placed = records.join(found, F.col(id_col) == F.col("_node"), "left").withColumn("group_ordinal", F.coalesce("component", F.col(id_col))).drop("_node", "component")
    keys = (
        placed.select("group_ordinal", F.explode(alias_col).alias("alias"))
        .groupBy("group_ordinal")
        .agg(F.min(F.struct(prefix_rank(F.col("alias")).alias("p"), F.col("alias"))).alias("k"))
        .select("group_ordinal", F.col("k.alias").alias("duplicate_group_key"))
    )
    return placed.join(keys, "group_ordinal", "left")


def duplicate_context(records: DataFrame, group: str = "group_ordinal", source: str = "source_name", file: str = "source_file") -> DataFrame:
    """One row per group: sightings, sorted distinct source names (a missing one is its file), sorted distinct files."""
    name = F.coalesce(F.nullif(F.col(source), F.lit("")), F.col(file))
    return records.groupBy(group).agg(
        F.count(F.lit(1)).alias("cross_source_duplicate_count"),
        F.array_sort(F.collect_set(name)).alias("cross_source_sources"),
        F.array_sort(F.collect_set(file)).alias("source_files"),
    )


def rank_records(records: DataFrame, as_of: str) -> DataFrame:
    """All records with ``rank_score`` and their group; :func:`best_first` puts them in order.

    Expects the release columns, ``load_ordinal`` (distinct) and ``source_file``; an
    input ``ranking_score`` is a signal of its own and stays as it is. Groups and
    their context are found on stored slim rows; whole records are read once more
    and joined once.
    """
    if "ranking_score" not in records.columns:
        records = records.withColumn("ranking_score", F.lit(None).cast("double"))
    slim = checkpointed(records.select("load_ordinal", aliases().alias("aliases"), "source_name", "source_file").where(F.size("aliases") > 0))
    grouped = checkpointed(group_records(slim))
    placed = grouped.join(duplicate_context(grouped), "group_ordinal").drop("source_name", "source_file")
    scored = records.join(placed, "load_ordinal").withColumn("cross_source_source_count", F.size("cross_source_sources"))
    factors = cross_source_factors(as_of, F.col("cross_source_duplicate_count"), F.col("cross_source_sources"))
    return scored.withColumn("rank_factors", factors).withColumn("rank_score", F.col("rank_factors.score"))


def best_first(ranked: DataFrame) -> DataFrame:
    """Ranked records in their order (ties by group, then load order): for sinks, as the operators do not sort."""
    return ranked.orderBy(F.desc("rank_score"), "group_ordinal", "load_ordinal")


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row of each key that is smallest in ``order`` (ascending columns).

    An aggregation, not a window: a key that holds a third of all rows is
    reduced on the map side.
    """
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), F.struct(*[c.alias(f"o{n}") for n, c in enumerate(order)])).alias("_row"))
    return picked.select("_row.*")


def unique_records(ranked: DataFrame) -> DataFrame:
    """The best record of each group (the first of equals)."""
    return first_per_key(ranked, ["duplicate_group_key"], [-F.col("rank_score"), F.col("group_ordinal"), F.col("load_ordinal")])


def dedupe_releases(records: DataFrame) -> DataFrame:
    """Most confident record of each (artist, title, type), at the place where the key first occurs."""
    keyed = records.withColumns({"_ka": key_part(F.col("artist")), "_kt": key_part(F.col("track_or_project_title")), "_kr": key_part(F.col("release_type"))})
    keys = ["_ka", "_kt", "_kr"]
    order = F.struct(-F.col("confidence_score"), F.col("load_ordinal"))
    picked = keyed.groupBy(*keys).agg(F.min_by(F.struct(*records.columns), order).alias("_row"), F.min("load_ordinal").alias("_first"))
    return picked.orderBy("_first").select("_row.*")


def dedupe_artists(rows: DataFrame) -> DataFrame:
    """Artists merged by identifier or name: all genres in order, best rank and its genre, most listeners, first links."""
    key = F.coalesce(F.nullif("spotify_id", F.lit("")), normalize_artist_name(F.col("artist_name")))
    listed = rows.withColumns({"_key": key, "_genres": F.when(F.coalesce(F.size("genres"), F.lit(0)) > 0, F.col("genres")).otherwise(F.array("genre"))})
    first = lambda c: F.min_by(F.nullif(F.col(c), F.lit("")), F.when(F.nullif(F.col(c), F.lit("")).isNotNull(), F.col("ordinal")))
    best_rank = F.struct(rank_or_last(F.col("rank")), F.col("ordinal"))
    merged = listed.groupBy("_key").agg(
        F.min_by("artist_name", "ordinal").alias("artist_name"),
        F.min_by("genre", best_rank).alias("genre"),
        F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "_genres"))), lambda x: x["_genres"]))).alias("genres"),
        F.min("rank").alias("rank"),
        F.max("monthly_listeners").alias("monthly_listeners"),
        *[first(c).alias(c) for c in ("spotify_url", "spotify_id", "soundcloud_url", "soundcloud_user_id") if c in rows.columns],
    )
    return merged.drop("_key").orderBy(rank_or_last(F.col("rank")), F.lower("artist_name"))


def distinct_in_order(df: DataFrame, id_col: str, pos: str) -> DataFrame:
    """Each id that is filled, once, at its first place."""
    return df.where(F.coalesce(F.col(id_col).cast("string"), F.lit("")) != "").groupBy(id_col).agg(F.min(pos).alias(pos)).orderBy(pos)


def distinct_top_k(df: DataFrame, id_col: str, pos: str, k: int) -> DataFrame:
    """The first k distinct ids; a k below 1 still gives one."""
    return distinct_in_order(df, id_col, pos).limit(max(k, 1))


def merge_cards(cards: DataFrame) -> DataFrame:
    """Cards by URL: each field from the first card (by ordinal) in which it is filled."""
    fields = [c for c in ("title", "source_name", "category", "publish_date", "snippet") if c in cards.columns]
    held = lambda c: F.nullif(F.col(c), F.lit(""))
    return cards.groupBy("url").agg(*[F.min_by(held(c), F.when(held(c).isNotNull(), F.col("ordinal"))).alias(c) for c in fields], F.min("ordinal").alias("ordinal")).orderBy("ordinal")


def cache_key() -> Column:
    """Key of the link cache: raw identifiers by field, else normalised artist and title."""
    raw = lambda n: F.nullif(F.trim(F.coalesce(bag(n), F.lit(""))), F.lit(""))
    tagged = [F.concat(F.lit(f"{n}:"), raw(n)) for n in ("spotify_track_id", "isrc", "soundcloud_track_id")]
    return F.coalesce(*tagged, F.concat(F.lit("text:"), normalize_text(F.col("artist")), F.lit("|"), normalize_title(F.col("track_or_project_title"))))
