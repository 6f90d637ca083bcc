"""Recent tracks of artist profiles and followed artists, and the artist lists themselves."""

from __future__ import annotations

import json
from urllib.parse import urlparse

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import day_precision_date, in_window, release_date
from ..functions.numbers import parse_int
from ..functions.text import clean, clean_html, first_filled, split_genre_terms
from ..functions.udf import arrow_udf
from ..functions.urls import BARE_ID, CATALOGUE_ROOT, catalogue_artist_id, listing_artist_id
from ..operators.components import checkpointed
from ..operators.dedupe import dedupe_artists, first_per_key
from ..operators.extract import filled, rubric, type_from_album_track, type_from_title
from ..operators.filters import genre_terms, looks_like_release
from ..operators.match import best_user, first_hit
from ..operators.score import followed_score, profile_score
from .dom import parse
from .playlists import artist_and_title, text, upload_bag, v
from .records import first_per_target


def _bag(entries: dict[str, Column]) -> Column:
    return F.create_map(*[x for k, c in entries.items() for x in (F.lit(k), c)])


def _links(*urls: Column) -> Column:
    return F.filter(F.array(*urls), lambda u: u != "")


def once(rows: DataFrame, key: Column, order: list[Column]) -> DataFrame:
    """The first row of each key; rows without a key all stay."""
    keyed = rows.withColumn("_key", F.nullif(key, F.lit("")))
    first = first_per_key(keyed.where("_key is not null"), ["_key"], order)
    return first.unionByName(keyed.where("_key is null")).drop("_key")


def catalogue_recent(profiles: DataFrame, albums: DataFrame, tracks: DataFrame, as_of: str, days: int = 14, stats: bool = False) -> DataFrame:
    """Recent catalogue tracks of profiles as releases with their profile score.

    albums: ordinal (of the profile), pos, album (variant), and with ``stats`` also
    artist (variant). tracks: album_id, pos, track (variant), with ``stats`` also
    stats (variant). An album counts for the first profile that has it, even when
    it is too old; then a track counts once.
    """
    known = profiles.withColumn("artist_id", catalogue_artist_id(F.col("spotify_url"))).where("artist_id <> ''")
    a = lambda path, kind="string": F.try_variant_get("album", f"$.{path}", kind)
    listed = albums.join(known.select("ordinal"), "ordinal", "left_semi").withColumn("album_id", F.coalesce(a("id"), F.lit(""))).where("album_id <> ''")
    firsts = first_per_key(listed, ["album_id"], [F.col("ordinal"), F.col("pos")]).withColumn("_day", day_precision_date(a("release_date"), a("release_date_precision")))
    recent = firsts.where(in_window(F.col("_day"), as_of, days, False)).withColumnRenamed("pos", "album_pos")
    rows = recent.join(tracks.withColumnRenamed("pos", "track_pos"), "album_id")
    rows = once(rows, F.coalesce(v("id"), F.lit("")), [F.col("ordinal"), F.col("album_pos"), F.col("track_pos")]).join(known, "ordinal")
    artist_v = (lambda p: F.try_variant_get("artist", f"$.{p}", "string")) if stats else (lambda p: F.lit(None).cast("string"))
    stat_v = (lambda p: F.try_variant_get("stats", f"$.{p}", "string")) if stats else (lambda p: F.lit(None).cast("string"))
    people = v("artists", "array<struct<id:string,name:string>>")
    names = F.array_join(F.filter(F.transform(people, lambda x: F.trim(x["name"])), lambda n: n != ""), ", ")
    ids = F.array_join(F.filter(F.transform(people, lambda x: F.coalesce(x["id"], F.lit(""))), lambda n: n != ""), ", ")
    artist, title = first_filled(names, F.col("artist_name")), F.trim(text("name"))
    age = F.greatest(F.date_diff(F.lit(as_of).cast("date"), "_day"), F.lit(0))
    score = profile_score(parse_int(F.col("monthly_listeners")), parse_int(F.col("rank")), parse_int(artist_v("popularity")), parse_int(artist_v("followers.total")), parse_int(stat_v("popularity")), age, days)
    blank = lambda c: F.coalesce(c, F.lit(""))
    track_url, album_url = text("external_urls.spotify"), blank(a("external_urls.spotify"))
    bag = {
        "spotify_track_id": text("id"), "spotify_album_id": F.col("album_id"), "spotify_artist_id": F.col("artist_id"), "spotify_artist_ids": blank(ids), "artist_profile_url": F.col("spotify_url"),
        "source_artist_name": F.col("artist_name"), "source_artist_genres": F.col("genre"), "source_artist_rank": F.col("rank"), "source_artist_monthly_listeners": F.col("monthly_listeners"),
        "source_artist_spotify_popularity": blank(artist_v("popularity")), "source_artist_followers": blank(artist_v("followers.total")), "all_artists": artist, "album_name": blank(a("name")),
        "album_type": blank(a("album_type")), "album_total_tracks": blank(a("total_tracks")), "album_release_date_precision": blank(a("release_date_precision")), "album_url": album_url,
        "duration_ms": text("duration_ms"), "explicit": text("explicit"), "spotify_track_popularity": blank(stat_v("popularity")), "isrc": blank(stat_v("external_ids.isrc")),
        "track_number": text("track_number"), "disc_number": text("disc_number"), "preview_url": text("preview_url"),
    }
    return rows.select(
        artist.alias("artist"), title.alias("track_or_project_title"), type_from_album_track(a("album_type"), a("total_tracks"), title).alias("release_type"), F.lit(1.0).alias("confidence_score"),
        F.lit("spotify_artist_recent_releases_api").alias("extraction_method"), F.concat_ws(" - ", artist, title).alias("source_article_title"), first_filled(track_url, album_url, F.col("spotify_url")).alias("source_article_url"),
        F.lit("Spotify Artist Profile").alias("source_name"), F.col("_day").cast("string").alias("article_date"), score.alias("ranking_score"), _links(track_url, album_url).alias("embedded_music_links"), _bag(bag).alias("open_graph"),
        F.lit(True).alias("release_article"), F.struct("ordinal", "album_pos", "track_pos").alias("order_key"),
    )


def _upload_confidence() -> Column:
    return rubric(0.70, (filled(v("permalink_url")), 0.10), (filled(v("publisher_metadata.isrc")), 0.10), (filled(v("publisher_metadata.artist")) | filled(v("publisher_metadata.release_title")), 0.10))


def _upload_rows(artists: DataFrame, tracks: DataFrame, as_of: str, days: int, after_party: bool, seen_first: bool) -> DataFrame:
    """Release-like uploads of the window with _at (artist, title) and _day.

    seen_first: a track is marked as seen before it is checked (so an invalid
    first sighting hides later ones), else only valid sightings count.
    """
    rows = artists.where("soundcloud_user_id <> ''").join(tracks, "soundcloud_user_id")
    order = [F.col("ordinal"), F.col("pos")]
    if seen_first:
        rows = once(rows, text("id"), order)
    fits = looks_like_release(v("title"), v("publisher_metadata.isrc"), v("publisher_metadata.release_title"), parse_int(v("duration")), after_party)
    rows = rows.withColumn("_day", release_date(clean(v("release_date")), clean(v("display_date")), clean(v("created_at")))).where(fits & in_window(F.col("_day"), as_of, days, False))
    rows = rows.withColumn("_at", artist_and_title(F.col("artist_name"))).where("_at.artist <> '' and _at.title <> ''")
    return rows if seen_first else once(rows, text("id"), order)


def _upload_release(rows: DataFrame, method: str, source: str, score: Column, bag: dict[str, Column]) -> DataFrame:
    link = text("permalink_url")
    return rows.select(
        F.col("_at.artist").alias("artist"), F.col("_at.title").alias("track_or_project_title"), type_from_title(F.col("_at.title")).alias("release_type"), _upload_confidence().alias("confidence_score"),
        F.lit(method).alias("extraction_method"), F.concat_ws(" - ", "_at.artist", "_at.title").alias("source_article_title"), first_filled(link, F.col("soundcloud_url")).alias("source_article_url"), F.lit(source).alias("source_name"),
        F.col("_day").cast("string").alias("article_date"), score.alias("ranking_score"), _links(link).alias("embedded_music_links"), _bag(upload_bag() | bag).alias("open_graph"), F.lit(True).alias("release_article"),
        F.struct("ordinal", "pos").alias("order_key"),
    )


def profile_uploads(profiles: DataFrame, tracks: DataFrame, as_of: str, days: int = 14, failed_from: int | None = None) -> DataFrame:
    """Recent uploads of artist profiles. failed_from: only profiles from this ordinal on (a fallback)."""
    asked = profiles if failed_from is None else profiles.where(F.col("ordinal") >= failed_from)
    rows = _upload_rows(asked, tracks, as_of, days, after_party=True, seen_first=True)
    age = F.greatest(F.date_diff(F.lit(as_of).cast("date"), "_day"), F.lit(0))
    none = F.lit(None).cast("bigint")
    score = profile_score(parse_int(F.col("monthly_listeners")), parse_int(F.col("rank")), none, none, none, age, days)
    bag = {
        "soundcloud_user_id": F.coalesce(first_filled(F.col("soundcloud_user_id"), v("user.id")), F.lit("")), "soundcloud_username": text("user.username"), "soundcloud_profile_url": F.col("soundcloud_url"),
        "source_artist_name": F.col("artist_name"), "source_artist_genres": F.col("genre"), "source_artist_rank": F.col("rank"), "source_artist_monthly_listeners": F.col("monthly_listeners"), "all_artists": F.col("_at.artist"),
    }
    return _upload_release(rows, "soundcloud_artist_profile_api", "SoundCloud Artist Profile", score, bag)


def followed_uploads(artists: DataFrame, tracks: DataFrame, as_of: str, days: int = 14) -> DataFrame:
    """Recent uploads of followed artists, best score first."""
    rows = _upload_rows(artists, tracks, as_of, days, after_party=False, seen_first=False)
    age = F.greatest(F.date_diff(F.lit(as_of).cast("date"), "_day"), F.lit(0))
    likes = parse_int(first_filled(F.nullif(v("likes_count"), F.lit("0")), v("favoritings_count")))
    score = followed_score(age, F.col("followers_count"), parse_int(v("playback_count")), likes, parse_int(v("reposts_count")), _upload_confidence(), days)
    bag = {
        "soundcloud_user_id": F.col("soundcloud_user_id"), "soundcloud_username": clean(first_filled(v("user.username"), F.col("artist_name"))), "soundcloud_profile_url": F.col("soundcloud_url"),
        "followed_artist_genres": F.array_join("genres", " | "), "followed_artist_edm_match_terms": F.array_join("edm_match_terms", " | "),
        "followed_artist_followers_count": F.coalesce(F.nullif("followers_count", F.lit(0)).cast("string"), F.lit("")), "all_artists": F.col("_at.artist"),
    }
    return _upload_release(rows, "soundcloud_followed_artist_api", "SoundCloud Followed Artist", score, bag).orderBy(F.desc("ranking_score"), "order_key")


def followed_artists(users: DataFrame, tracks: DataFrame, sample: int = 10, only_genre: bool = True, max_users: int | None = None) -> DataFrame:
    """Followed users with the genres of their first tracks; without a genre term they are left out.

    users: ordinal, user (variant). tracks: soundcloud_user_id, pos, track (variant).
    """
    u = lambda p, kind="string": F.try_variant_get("user", f"$.{p}", kind)
    rows = users.orderBy("ordinal").limit(max_users) if max_users else users
    rows = rows.select("ordinal", "user", F.coalesce(u("id"), F.lit("")).alias("soundcloud_user_id"), clean(u("username")).alias("artist_name")).where("soundcloud_user_id <> '' and artist_name <> ''")
    terms = F.concat(split_genre_terms(v("genre")), split_genre_terms(v("tag_list")))
    sampled = tracks.where(F.col("pos") < sample).select("soundcloud_user_id", "pos", terms.alias("terms"))
    genres = sampled.groupBy("soundcloud_user_id").agg(F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("pos", "terms"))), lambda x: x["terms"]))).alias("genres"))  # at most ``sample`` entries
    rows = rows.join(genres, "soundcloud_user_id", "left").withColumn("genres", F.coalesce("genres", F.expr("cast(array() as array<string>)")))
    rows = rows.withColumn("edm_match_terms", genre_terms(u("username"), u("description"), F.col("genres")))
    rows = rows.where("size(edm_match_terms) > 0") if only_genre else rows
    return rows.select(
        "artist_name", F.coalesce(u("permalink_url"), F.lit("")).alias("soundcloud_url"), "soundcloud_user_id", "genres", "edm_match_terms", parse_int(u("followers_count")).alias("followers_count"),
        parse_int(u("track_count")).alias("track_count"), clean(first_filled(u("country_code"), u("country"))).alias("country"), clean(u("city")).alias("city"), "ordinal",
    )


# --- artist lists ----------------------------------------------------------------------------

_ARTIST = "array<struct<name:string,spotify_id:string,rank:string,listeners:string,href:string>>"


@arrow_udf(_ARTIST)
def listed_artists(html: pd.Series) -> pd.Series:
    """Artists of a genre page: the embedded snapshot's collection, else links to artists."""

    def as_text(x) -> str | None:
        return None if x is None or isinstance(x, (list, dict)) else str(x)

    def one(page: str) -> list[dict]:
        root = parse(page or "")
        for n in root.walk():
            try:
                data = json.loads(n.attrs.get("wire:snapshot") or "").get("data") or {}
            except (ValueError, AttributeError):
                continue
            if "allArtists" not in data:
                continue
            held = data["allArtists"]
            held = held[0] if isinstance(held, list) and held else held
            items = [i[0] if isinstance(i, list) and i else i for i in held] if isinstance(held, list) else []
            found = [{"name": i.get("name"), "spotify_id": i.get("spotify_id"), "rank": as_text(i.get("_original_rank")), "listeners": as_text(i.get("listeners")), "href": None} for i in items if isinstance(i, dict)]
            if found:
                return found
            break
        return [{"name": n.text(), "spotify_id": None, "rank": None, "listeners": None, "href": urlparse(n.attrs["href"]).path} for n in root.walk() if n.tag == "a" and n.attrs.get("href")]

    return html.map(one)


def genre_artists(pages: DataFrame) -> DataFrame:
    """Artists of recorded genre pages (target, genre, limit, html), at most ``limit`` for each target."""
    rows = pages.select("target", "genre", "limit", F.posexplode(listed_artists("html")).alias("pos", "a"))
    linked = F.col("a.href").isNotNull()
    rows = rows.withColumns({"artist_name": clean_html(F.col("a.name").cast("string")), "spotify_id": F.when(linked, listing_artist_id(F.col("a.href"))).otherwise(clean(F.col("a.spotify_id").cast("string")))})
    rows = rows.where((F.col("artist_name") != "") & (~linked | F.col("spotify_id").rlike(BARE_ID))).withColumn("linked", linked)
    by_link = first_per_key(rows.where("linked"), ["target", "spotify_id"], [F.col("pos")])
    both = by_link.unionByName(rows.where("not linked"))
    strict = lambda c: F.when(c.rlike(r"^[+-]?\d+$"), c.try_cast("bigint"))
    cut = first_per_target(both, "target", "limit", "pos")
    nth = F.row_number().over(Window.partitionBy("target").orderBy("pos"))
    return cut.select(
        "target", "artist_name", "genre", F.array("genre").alias("genres"), F.when(F.col("linked"), nth.cast("bigint")).otherwise(strict(F.col("a.rank"))).alias("rank"), strict(F.col("a.listeners")).alias("monthly_listeners"),
        F.when(F.col("spotify_id") != "", F.concat(F.lit(f"{CATALOGUE_ROOT}/artist/"), "spotify_id")).otherwise("").alias("spotify_url"), F.nullif("spotify_id", F.lit("")).alias("spotify_id"), "pos",
    )


def artist_list(pages: DataFrame, catalogue_hits: DataFrame | None = None, users: DataFrame | None = None, limit: int = 0) -> DataFrame:
    """Genre pages to one merged artist list, completed by searches.

    catalogue_hits: artist_name, pos, url. users: query_id (the artist's name)
    and the columns of :func:`..operators.match.best_user`.
    """
    rows = genre_artists(pages).withColumns({"soundcloud_url": F.lit(""), "soundcloud_user_id": F.lit(""), "ordinal": F.struct("target", "pos")})
    merged = dedupe_artists(rows)
    merged = merged.limit(limit) if limit else merged
    merged = merged if users is None else checkpointed(merged)  # it is looked up and completed: the pages are read once
    if catalogue_hits is not None:
        hit = first_hit(catalogue_hits, "artist_name", "url", "pos")
        merged = merged.join(hit, "artist_name", "left").withColumn("spotify_url", F.coalesce(F.nullif("spotify_url", F.lit("")), "url", F.lit(""))).drop("url")
    if users is not None:
        found = best_user(merged.select(F.col("artist_name").alias("query_id"), F.col("artist_name").alias("artist")), users)
        found = found.select(F.col("query_id").alias("artist_name"), F.col("permalink_url").alias("_url"), F.col("id").cast("string").alias("_uid"))
        merged = merged.join(found, "artist_name", "left").withColumns({"soundcloud_url": F.coalesce("_url", "soundcloud_url"), "soundcloud_user_id": F.coalesce("_uid", "soundcloud_user_id")}).drop("_url", "_uid")
    return merged
