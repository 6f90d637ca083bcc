"""Scores from 0 to 100 as weighted sums of components, some of them only where known."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.dates import parse_date
from ..functions.numbers import bounded, log_score, parse_float, parse_int, rank_score, recency_score

# Quality of each source, weights of each score.
SOURCE_QUALITY = {
    "Spotify Artist Profile": 0.90,
    "SoundCloud Artist Profile": 0.82,
    "Spotify Playlist": 0.82,
    "SoundCloud Playlist": 0.76,
    "SubmitHub": 0.78,
    "We Rave You": 0.72,
    "EDMTunes": 0.72,
    "EDM.com": 0.72,
    "1001Tracklists": 0.88,
}
DEFAULT_QUALITY = 0.65
CROSS_WEIGHTS = {
    "existing_source_ranking": 0.20,
    "confidence": 0.12,
    "source_quality": 0.10,
    "recency": 0.12,
    "music_link": 0.06,
    "platform_popularity": 0.18,
    "source_chart": 0.12,
    "cross_source_duplicates": 0.20,
}
PROFILE_WEIGHTS = {
    "monthly_listeners": 0.30,
    "source_rank": 0.15,
    "spotify_artist_popularity": 0.20,
    "spotify_artist_followers": 0.10,
    "spotify_track_popularity": 0.15,
    "recency": 0.10,
}
FOLLOWED_WEIGHTS = {"recency": 0.25, "artist_followers": 0.15, "track_plays": 0.20, "track_likes": 0.15, "track_reposts": 0.10, "metadata_confidence": 0.15}
RECENCY_DAYS = 21


def lookup(c: Column, table: dict[str, float], default: float) -> Column:
    out = F.lit(default)
    for k, v in table.items():
        out = F.when(c == k, v).otherwise(out)
    return out


def weighted(components: dict[str, Column], weights: dict[str, float], known: dict[str, Column]) -> tuple[Column, Column]:
    """(sum of component x weight over the known, sum of the known weights)."""
    total, weight = F.lit(0.0), F.lit(0.0)
    for k, w in weights.items():
        own = F.when(known[k], w).otherwise(0.0) if k in known else F.lit(w)
        total, weight = total + components[k] * own, weight + own
    return total, weight


def bag(name: str, column: str = "open_graph") -> Column:
    return F.try_element_at(F.col(column), F.lit(name))


def duplicate_score(count: Column, sources: Column) -> Column:
    part = lambda n, most: F.least(F.greatest(n - 1, F.lit(0)) / F.lit(float(most)), F.lit(1.0))
    return part(count, 4) * 0.35 + part(sources, 3) * 0.65


def best(*scores: Column) -> Column:
    """The largest that is known, else 0."""
    return F.coalesce(F.array_max(F.array(*scores)), F.lit(0.0))


def where_known(value: Column, score: Column) -> Column:
    return F.when(value.isNotNull(), score)


def platform_popularity(track_popularity: Column, popularity: Column, plays: Column, likes: Column, reposts: Column) -> Column:
    return best(
        where_known(track_popularity, bounded(track_popularity, 100)),
        where_known(popularity, bounded(popularity, 100)),
        where_known(plays, log_score(plays, 1_000_000)),
        where_known(likes, log_score(likes, 50_000)),
        where_known(reposts, log_score(reposts, 5_000)),
    )


def source_chart(source: Column, points: Column, likes: Column, rank: Column, playlist_tracks: Column) -> Column:
    charted, listed = source == "SubmitHub", source == "1001Tracklists"
    return best(
        F.when(charted & points.isNotNull(), bounded(points, 100)),
        F.when(charted & likes.isNotNull(), bounded(likes, 100)),
        F.when(charted & rank.isNotNull(), rank_score(rank, 100)),
        F.when(listed & rank.isNotNull(), rank_score(rank, 30)),
        F.when(playlist_tracks.isNotNull(), 0.55),
    )


def has_chart(source: Column, points: Column, likes: Column, rank: Column, playlist_tracks: Column) -> Column:
    return (
        F.when(source == "SubmitHub", points.isNotNull() | likes.isNotNull() | rank.isNotNull())
        .when(source == "1001Tracklists", rank.isNotNull())
        .otherwise(playlist_tracks.isNotNull())
    )


def cross_source_factors(as_of: str, count: Column, sources: Column) -> Column:
    """struct(score, unrounded, available_weight, components...) of a release sighting.

    count: sightings in the group; sources: its distinct source names (array).
    A known score of 0 counts with its weight; a missing one does not.
    """
    source = F.coalesce(F.col("source_name"), F.lit(""))
    existing = parse_float(F.col("ranking_score"))
    platform = [parse_float(bag(n)) for n in ("spotify_track_popularity", "spotify_popularity", "playback_count", "likes_count", "reposts_count")]
    chart = [parse_float(bag(n)) for n in ("popular_points", "hot_or_not_likes", "chart_rank", "playlist_track_count")]
    age = F.greatest(F.date_diff(F.lit(as_of).cast("date"), parse_date(F.col("article_date"))), F.lit(0))
    components = {
        "existing_source_ranking": bounded(existing, 100),
        "confidence": bounded(parse_float(F.col("confidence_score")), 1),
        "source_quality": lookup(source, SOURCE_QUALITY, DEFAULT_QUALITY),
        "recency": recency_score(F.when(parse_date(F.col("article_date")).isNotNull(), age), RECENCY_DAYS),
        "music_link": F.when(F.coalesce(F.size("embedded_music_links"), F.lit(0)) > 0, 1.0).otherwise(0.0),
        "platform_popularity": platform_popularity(*platform),
        "source_chart": source_chart(source, *chart),
        "cross_source_duplicates": duplicate_score(count, F.size(sources)),
    }
    any_platform = platform[0].isNotNull()
    for p in platform[1:]:
        any_platform = any_platform | p.isNotNull()
    known = {"existing_source_ranking": existing.isNotNull(), "platform_popularity": any_platform, "source_chart": has_chart(source, *chart)}
    total, weight = weighted(components, CROSS_WEIGHTS, known)
    exact = total / weight * 100
    return F.struct(
        F.least(F.round(exact, 2), F.lit(100.0)).alias("score"),
        exact.alias("unrounded"),
        F.round(weight, 4).alias("available_weight"),
        *[F.round(v, 4).alias(k) for k, v in components.items()],
    )


def profile_score(listeners: Column, rank: Column, artist_popularity: Column, followers: Column, track_popularity: Column, age_days: Column, lookback_days: int) -> Column:
    """Artist-profile score: weights of what is unknown go to the rest."""
    values = {"monthly_listeners": listeners, "source_rank": rank, "spotify_artist_popularity": artist_popularity, "spotify_artist_followers": followers, "spotify_track_popularity": track_popularity}
    components = {
        "monthly_listeners": log_score(listeners, 25_000_000),
        "source_rank": rank_score(rank, 500),
        "spotify_artist_popularity": bounded(artist_popularity, 100),
        "spotify_artist_followers": log_score(followers, 20_000_000),
        "spotify_track_popularity": bounded(track_popularity, 100),
        "recency": recency_score(age_days, lookback_days, None),
    }
    total, weight = weighted(components, PROFILE_WEIGHTS, {k: v.isNotNull() for k, v in values.items()})
    return F.round(total / weight * 100, 2)


def followed_score(age_days: Column, followers: Column, plays: Column, likes: Column, reposts: Column, confidence: Column, lookback_days: int) -> Column:
    """Followed-artist score: unknown components count as 0."""
    components = {
        "recency": recency_score(age_days, lookback_days, None),
        "artist_followers": log_score(followers, 1_000_000),
        "track_plays": log_score(plays, 1_000_000),
        "track_likes": log_score(likes, 100_000),
        "track_reposts": log_score(reposts, 10_000),
        "metadata_confidence": confidence,
    }
    return F.round(weighted(components, FOLLOWED_WEIGHTS, {})[0] * 100, 2)


def rerank(records, as_of: str, lookback_days: int):
    """Existing records scored anew from their bag, best first; a bad date scores 0."""
    day = F.when(F.col("article_date").rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), parse_date(F.col("article_date")))
    age = F.greatest(F.date_diff(F.lit(as_of).cast("date"), day), F.lit(0))
    number = lambda n: parse_int(bag(n))
    score = profile_score(
        number("source_artist_monthly_listeners"), number("source_artist_rank"), number("source_artist_spotify_popularity"), number("source_artist_followers"), number("spotify_track_popularity"), age, lookback_days
    )
    return records.withColumn("ranking_score", F.when(day.isNull(), 0.0).otherwise(score)).orderBy(F.desc("ranking_score"), "load_ordinal")
