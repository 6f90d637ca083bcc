"""Playlists of a catalogue and of an upload service, from recorded JSON or pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import release_date_text
from ..functions.text import clean, first_filled, split_artist_title, strip_artist_prefix
from ..functions.urls import CATALOGUE_ROOT
from ..operators.extract import filled, rubric, type_from_album, type_from_title
from .pages import json_ld_objects

NO_LINKS = "cast(array() as array<string>)"


def v(path: str, kind: str = "string", column: str = "track") -> Column:
    """A path of a variant column; null where it is missing or of another kind."""
    return F.try_variant_get(F.col(column), f"$.{path}", kind)


def text(path: str, column: str = "track") -> Column:
    return F.coalesce(v(path, column=column), F.lit(""))


def python_bool(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit(False)), "True").otherwise("False")


def catalogue_items(playlists: DataFrame) -> DataFrame:
    """Recorded playlists (ordinal, playlist variant, items variant) to one row per item.

    ``playlist`` and ``item`` are variants; a playlist whose items are missing
    or no array gives no row (see :func:`failed_playlists`).
    """
    items = F.try_variant_get("items", "$", "array<variant>")
    return playlists.select("ordinal", "playlist", F.posexplode(items).alias("pos", "item"))


def failed_playlists(playlists: DataFrame) -> DataFrame:
    return playlists.where(F.try_variant_get("items", "$", "array<variant>").isNull()).select("ordinal", F.try_variant_get("playlist", "$.id", "string").alias("playlist_id"))


def catalogue_releases(items: DataFrame) -> DataFrame:
    """Catalogue playlist items as releases; local files and other kinds are dropped."""
    rows = items.withColumn("track", F.try_variant_get("item", "$.track", "variant"))
    rows = rows.where((v("type") == "track") & ~F.coalesce(v("is_local", "boolean"), F.lit(False)))
    names = F.filter(F.transform(v("artists", "array<struct<id:string,name:string>>"), lambda a: clean(a["name"])), lambda n: n != "")
    ids = F.filter(F.transform(v("artists", "array<struct<id:string,name:string>>"), lambda a: F.coalesce(a["id"], F.lit(""))), lambda i: i != "")
    rows = rows.withColumns({"_names": names, "_title": clean(v("name"))}).where("size(_names) > 0 and _title <> ''")
    url = first_filled(v("external_urls.spotify"), F.concat(F.lit(f"{CATALOGUE_ROOT}/track/"), F.coalesce(v("id"), F.lit("None"))))
    p = lambda path: text(path, "playlist")
    bag = {
        "playlist_id": p("id"),
        "playlist_name": clean(v("name", column="playlist")),
        "playlist_owner": clean(first_filled(v("owner.display_name", column="playlist"), v("owner.id", column="playlist"))),
        "playlist_url": first_filled(v("external_urls.spotify", column="playlist"), F.concat(F.lit(f"{CATALOGUE_ROOT}/playlist/"), p("id"))),
        "spotify_track_id": text("id"),
        "spotify_album_id": text("album.id"),
        "spotify_artist_ids": F.array_join(ids, ", "),
        "all_artists": F.array_join("_names", ", "),
        "album_name": clean(v("album.name")),
        "album_type": clean(v("album.album_type")),
        "album_total_tracks": text("album.total_tracks"),
        "album_release_date_precision": clean(v("album.release_date_precision")),
        "album_url": text("album.external_urls.spotify"),
        "spotify_popularity": text("popularity"),
        "duration_ms": text("duration_ms"),
        "explicit": python_bool(v("explicit", "boolean")),
        "isrc": text("external_ids.isrc"),
        "added_at": clean(v("added_at", column="item")),
        "added_by": text("added_by.id", "item"),
        "track_number": text("track_number"),
        "disc_number": text("disc_number"),
        "preview_url": text("preview_url"),
    }
    artist = F.element_at("_names", 1)
    sure = rubric(0.75, (filled(v("id")), 0.10), (filled(v("external_urls.spotify")), 0.10), (filled(v("external_ids.isrc")), 0.05))
    return rows.select(
        artist.alias("artist"), F.col("_title").alias("track_or_project_title"), type_from_album(clean(v("album.album_type")), v("album.total_tracks")).alias("release_type"), sure.alias("confidence_score"),
        F.lit("spotify_playlist_api").alias("extraction_method"), F.concat_ws(" - ", artist, "_title").alias("source_article_title"), url.alias("source_article_url"), F.lit("Spotify Playlist").alias("source_name"),
        F.nullif(clean(v("album.release_date")), F.lit("")).alias("article_date"), F.array(url).alias("embedded_music_links"), F.create_map(*[x for k, c in bag.items() for x in (F.lit(k), c)]).alias("open_graph"),
        F.lit(True).alias("release_article"), "ordinal", "pos",
    )


# --- upload service --------------------------------------------------------------------------


def hydration(html: Column) -> Column:
    """array<variant>: the first hydration array of a page that is JSON."""
    found = F.regexp_extract_all(html, F.lit(r"(?s)window\.__sc_hydration\s*=\s*(\[.*?\])\s*;"), F.lit(1))
    parsed = F.filter(F.transform(found, lambda s: F.try_parse_json(s)), lambda x: x.isNotNull())
    return F.try_variant_get(F.try_element_at(parsed, F.lit(1)), "$", "array<variant>")


def looks_like_playlist(data: Column) -> Column:
    has_tracks = F.try_variant_get(data, "$.tracks", "array<variant>").isNotNull()
    kind = F.try_variant_get(data, "$.kind", "string").isin("playlist", "system-playlist")
    return F.coalesce(has_tracks & (F.coalesce(kind, F.lit(False)) | F.try_variant_get(data, "$.track_count", "string").isNotNull()), F.lit(False))


def playlist_data(entries: Column) -> Column:
    """The first playlist among hydration entries, or inside an entry's collection."""

    def one(e: Column) -> Column:
        data = F.try_variant_get(e, "$.data", "variant")
        inner = F.filter(F.try_variant_get(data, "$.collection", "array<variant>"), looks_like_playlist)
        return F.when(looks_like_playlist(data), data).otherwise(F.try_element_at(inner, F.lit(1)))

    return F.try_element_at(F.filter(F.transform(entries, one), lambda x: x.isNotNull()), F.lit(1))


def pages_to_playlists(pages: DataFrame) -> DataFrame:
    """Recorded playlist pages (ordinal, url, html) to (ordinal, url, playlist, method).

    The hydration data, else JSON-LD with a track list; a page with neither
    gives no row.
    """
    rows = pages.withColumns({"_h": playlist_data(hydration(F.col("html"))), "_l": F.try_element_at(F.filter(json_ld_objects(F.col("html")), lambda o: F.try_variant_get(o, "$.track", "variant").isNotNull()), F.lit(1))})
    ld_tracks = F.coalesce(F.try_variant_get("_l", "$.track", "array<variant>"), F.array(F.try_variant_get("_l", "$.track", "variant")))
    one = lambda t, p: F.try_variant_get(t, f"$.{p}", "string")
    rebuilt = F.transform(
        ld_tracks,
        lambda t: F.struct(
            one(t, "name").alias("title"), one(t, "url").alias("permalink_url"), F.struct(one(t, "byArtist.name").alias("username")).alias("user"),
            F.struct(one(t, "byArtist.name").alias("artist"), one(t, "name").alias("release_title")).alias("publisher_metadata"),
        ),
    )
    from_ld = F.parse_json(F.to_json(F.struct(one(F.col("_l"), "name").alias("title"), one(F.col("_l"), "url").alias("permalink_url"), F.struct(one(F.col("_l"), "byArtist.name").alias("username")).alias("user"), rebuilt.alias("tracks"))))
    rows = rows.withColumn("playlist", F.coalesce("_h", F.when(F.col("_l").isNotNull(), from_ld))).where("playlist is not null")
    return rows.select("ordinal", "url", "playlist", F.lit("soundcloud_playlist_page").alias("method"))


def upload_tracks(playlists: DataFrame, details: DataFrame | None = None) -> DataFrame:
    """One row per track of (ordinal, url, playlist, method); stubs are completed and come last.

    details: recorded tracks (id, track variant) for the stubs, which have an
    id but no title or no link.
    """
    rows = playlists.select("ordinal", "url", "playlist", "method", F.posexplode(F.try_variant_get("playlist", "$.tracks", "array<variant>")).alias("pos", "track"))
    rows = rows.where(F.schema_of_variant("track").like("OBJECT%"))
    stub = ~(filled(v("title")) & filled(v("permalink_url")))
    rows = rows.withColumn("stub", stub)
    if details is not None:
        known = details.select(F.col("id").cast("string").alias("_id"), F.col("track").alias("_full"))
        rows = rows.join(known, F.col("stub") & (v("id") == F.col("_id")), "left").withColumn("track", F.coalesce("_full", "track")).drop("_id", "_full")
    return rows.withColumn("order_key", F.struct("ordinal", "stub", "pos"))


def artist_and_title(fallback: Column) -> Column:
    """struct(artist, title): publisher's data, else a dashed title, else ``fallback`` and the title."""
    title = clean(v("title"))
    publisher, published = clean(v("publisher_metadata.artist")), clean(v("publisher_metadata.release_title"))
    own = first_filled(published, strip_artist_prefix(title, publisher), title)
    return F.when(publisher != "", F.struct(publisher.alias("artist"), F.coalesce(own, F.lit("")).alias("title"))).otherwise(
        F.coalesce(split_artist_title(title), F.struct(fallback.alias("artist"), title.alias("title")))
    )


def upload_bag() -> dict[str, Column]:
    """Bag entries that every upload has."""
    label = F.coalesce(first_filled(v("label_name"), v("publisher_metadata.publisher")), F.lit(""))
    return {
        "soundcloud_track_id": text("id"),
        "genre": clean(v("genre")),
        "tag_list": clean(v("tag_list")),
        "label": clean(label),
        "album_name": clean(v("publisher_metadata.album_title")),
        "isrc": clean(v("publisher_metadata.isrc")),
        "explicit": python_bool(v("publisher_metadata.explicit", "boolean")),
        "duration_ms": text("duration"),
        "playback_count": text("playback_count"),
        "likes_count": F.coalesce(first_filled(v("likes_count"), v("favoritings_count")), F.lit("")),
        "reposts_count": text("reposts_count"),
        "created_at": clean(v("created_at")),
    }


def upload_releases(tracks: DataFrame) -> DataFrame:
    """Tracks of upload playlists as releases; what has no artist or title is dropped."""
    rows = tracks.withColumn("_at", artist_and_title(clean(v("user.username")))).where((clean(v("title")) != "") & (F.col("_at.artist") != "") & (F.col("_at.title") != ""))
    p = lambda path: text(path, "playlist")
    n_tracks = F.size(F.try_variant_get("playlist", "$.tracks", "array<variant>")).cast("string")
    link = text("permalink_url")
    own_url = first_filled(p("permalink_url"), F.col("url"))
    bag = {
        "playlist_id": p("id"),
        "playlist_name": clean(v("title", column="playlist")),
        "playlist_owner": clean(v("user.username", column="playlist")),
        "playlist_url": own_url,
        "playlist_track_count": first_filled(p("track_count"), n_tracks),
        "playlist_likes_count": F.coalesce(first_filled(p("likes_count"), p("favoritings_count")), F.lit("")),
        "playlist_reposts_count": p("reposts_count"),
        "soundcloud_user_id": text("user.id"),
        "soundcloud_username": clean(v("user.username")),
        "all_artists": clean(first_filled(v("publisher_metadata.artist"), F.col("_at.artist"))),
        "upc": clean(v("publisher_metadata.upc_or_ean")),
        "purchase_url": text("purchase_url"),
        "license": clean(v("license")),
        **upload_bag(),
    }
    sure = rubric(
        0.65, (link != "", 0.10), (filled(v("publisher_metadata.isrc")), 0.10), (filled(v("publisher_metadata.artist")) | split_artist_title(clean(v("title"))).isNotNull(), 0.10), (F.col("_at.artist") != "", 0.05)
    )
    return rows.select(
        F.col("_at.artist").alias("artist"), F.col("_at.title").alias("track_or_project_title"), type_from_title(F.col("_at.title")).alias("release_type"), sure.alias("confidence_score"), F.col("method").alias("extraction_method"),
        F.concat_ws(" - ", "_at.artist", "_at.title").alias("source_article_title"), first_filled(link, own_url).alias("source_article_url"), F.lit("SoundCloud Playlist").alias("source_name"),
        release_date_text(v("release_date"), v("display_date"), v("created_at")).alias("article_date"), F.when(link != "", F.array(link)).otherwise(F.expr(NO_LINKS)).alias("embedded_music_links"),
        F.create_map(*[x for k, c in bag.items() for x in (F.lit(k), c)]).alias("open_graph"), F.lit(True).alias("release_article"), "order_key",
    )
