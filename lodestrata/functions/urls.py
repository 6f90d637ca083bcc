"""Identifiers and URLs by pattern."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean

# Identifier patterns and page roots.
CATALOGUE_TRACK = r"(?:open\.spotify\.com/track/|spotify:track:)([A-Za-z0-9]+)"
CATALOGUE_ARTIST = r"(?:open\.spotify\.com/artist/|spotify:artist:)([A-Za-z0-9]+)"
UPLOAD_TRACK = r"https?://(?:www\.)?soundcloud\.com/[^/]+/[^/?#]+"
CATALOGUE_ROOT = "https://open.spotify.com"
UPLOAD_ROOT = "https://soundcloud.com"
CHART_ROOT = "https://www.submithub.com"
BARE_ID = r"^[A-Za-z0-9]{16,}$"
MUSIC_DOMAINS = ("open.spotify.com", "spotify.link", "soundcloud.com", "music.apple.com", "itunes.apple.com", "youtube.com", "youtu.be", "beatport.com")


def _filled(c: Column) -> Column:
    return F.when(c != "", c)


def host(u: Column) -> Column:
    return F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def path(u: Column) -> Column:
    return F.regexp_extract(u, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:(?://[^/?#]*)?)?([^?#]*)", 1)


def parts(u: Column) -> Column:
    return F.filter(F.split(path(u), "/"), lambda x: x != "")


def query_value(u: Column, name: str) -> Column:
    """A query parameter, decoded."""
    return F.try_url_decode(_filled(F.regexp_extract(u, rf"[?&]{name}=([^&#]*)", 1)))


def canonical(u: Column, new_host: str | None = None) -> Column:
    """Without query and fragment; ``new_host`` replaces the host."""
    bare = F.regexp_replace(u, r"[?#].*$", "")
    return F.regexp_replace(bare, r"^([A-Za-z][A-Za-z0-9+.-]*://)[^/]*", f"$1{new_host}") if new_host else bare


def _until(p: Column, *stops: str) -> Column:
    """Path parts before the first of the stop words."""
    at = F.array_min(F.filter(F.array(*[F.array_position(p, s) for s in stops]), lambda x: x > 0))
    return F.when(at.isNull(), p).otherwise(F.slice(p, F.lit(1), at.cast("int") - 1))


def category(u: Column, default: str, *stops: str) -> Column:
    p = _until(parts(u), *stops) if stops else parts(u)
    return F.coalesce(F.try_element_at(p, F.lit(-1)), F.lit(default))


def _with_path(u: Column, p: Column) -> Column:
    tail = F.regexp_extract(u, r"^[^?#]*([?#].*)?$", 1)
    return F.concat(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1), F.lit("/"), F.array_join(p, "/"), F.lit("/"), tail)


def paginated(u: Column, page: Column) -> Column:
    base = _until(parts(u), "page")
    return _with_path(u, F.when(page > 1, F.concat(base, F.array(F.lit("page"), page.cast("string")))).otherwise(base))


def feed(u: Column) -> Column:
    base = _until(parts(u), "page")
    return _with_path(u, F.when(F.try_element_at(base, F.lit(-1)) == "feed", base).otherwise(F.concat(base, F.array(F.lit("feed")))))


def genre_from_listing(u: Column) -> Column:
    p = parts(u)
    return F.when((F.size(p) >= 2) & (p[0] == "genres"), F.replace(p[1], F.lit("-"), F.lit(" "))).otherwise("unknown")


def genre_from_chart(u: Column) -> Column:
    """Title case of the ``/genre/<name>/`` part; House without one."""
    raw = F.regexp_extract(u, "/genre/([^/]+)/", 1)
    return F.when(raw == "", "House").otherwise(clean(F.initcap(F.replace(raw, F.lit("-"), F.lit(" ")))))


def catalogue_playlist_id(value: Column) -> Column:
    """From a URI, a page or query URL, or a bare identifier."""
    t = clean(value)
    p = parts(t)
    in_url = F.when((F.size(p) >= 2) & (p[0] == "playlist"), p[1])
    return F.coalesce(
        F.when(F.startswith(t, F.lit("spotify:playlist:")), F.substring_index(t, ":", -1)),
        F.when(F.contains(t, F.lit("open.spotify.com")), F.coalesce(in_url, query_value(t, "playlist"))),
        F.when(t.rlike(BARE_ID), t),
    )


def upload_playlist_url(value: Column) -> Column:
    """A full URL, or ``user/sets/name`` completed; null for what is neither."""
    t = clean(value)
    absolute = t.rlike("^https?://")
    return (
        F.when(absolute & F.contains(host(t), F.lit("soundcloud.com")), t)
        .when(absolute | (t == ""), F.lit(None).cast("string"))
        .when(F.startswith(t, F.lit("soundcloud.com/")), F.concat(F.lit("https://"), t))
        .when(F.contains(t, F.lit("/")), F.concat(F.lit(UPLOAD_ROOT + "/"), F.trim(t, F.lit("/"))))
    )


def catalogue_artist_id(value: Column) -> Column:
    p = parts(value)
    n = F.size(p)
    by_path = F.when((n >= 2) & (F.try_element_at(p, F.lit(-2)) == "artist"), F.element_at(p, -1))
    bare = F.when(~F.contains(value, F.lit("/")) & ~F.contains(value, F.lit(":")) & (value != ""), F.trim(value))
    return F.coalesce(_filled(F.regexp_extract(value, CATALOGUE_ARTIST, 1)), by_path, bare, F.lit(""))


def listing_artist_id(u: Column) -> Column:
    """The identifier of ``.../artists/<slug>/<id>``."""
    p = parts(u)
    last = F.try_element_at(p, F.lit(-1))
    return F.when((F.size(p) >= 3) & (F.try_element_at(p, F.lit(-3)) == "artists") & last.rlike(BARE_ID), last)


def catalogue_track_id(bag_id: Column, article_url: Column, links: Column) -> Column:
    """From the bag, the article URL or a link, whichever matches first; else a bare bag identifier."""
    tried = F.transform(F.concat(F.array(bag_id, article_url), F.coalesce(links, F.expr("cast(array() as array<string>)"))), lambda x: F.regexp_extract(F.coalesce(x, F.lit("")), CATALOGUE_TRACK, 1))
    hit = F.try_element_at(F.filter(tried, lambda x: x != ""), F.lit(1))
    return F.coalesce(hit, F.when(clean(bag_id).rlike(BARE_ID), clean(bag_id)), F.lit(""))


def upload_track_url(article_url: Column, links: Column) -> Column:
    tried = F.transform(F.concat(F.array(article_url), F.coalesce(links, F.expr("cast(array() as array<string>)"))), lambda x: F.regexp_extract(F.coalesce(x, F.lit("")), UPLOAD_TRACK, 0))
    return F.coalesce(F.try_element_at(F.filter(tried, lambda x: (x != "") & ~F.contains(x, F.lit("/sets/"))), F.lit(1)), F.lit(""))


def upload_track_id(bag_id: Column) -> Column:
    t = clean(bag_id)
    return F.when(t.rlike(r"^\d+$"), t).otherwise("")


def song_url(slug: Column, track_id: Column) -> Column:
    """Page of a charted song by its slug, else by its identifier."""
    quoted = F.replace(F.replace(F.url_encode(F.trim(slug, F.lit("/"))), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/"))
    return F.when(F.coalesce(slug, F.lit("")) != "", F.concat(F.lit(f"{CHART_ROOT}/song/"), quoted)).otherwise(F.concat(F.lit(f"{CHART_ROOT}/popular/"), track_id))


def looks_like_article(u: Column, site: str) -> Column:
    """Whether a URL has the shape of an article of ``site`` (``A``, ``B`` or ``C``)."""
    h, p = host(u), path(u)
    dated = p.rlike(r"/20\d{2}/\d{2}/[^/]+/?$")
    if site == "A":
        return h.isin("edm.com", "www.edm.com") & F.startswith(p, F.lit("/music-releases/")) & (F.rtrim(p, F.lit("/")) != "/music-releases")
    if site == "B":
        return F.contains(h, F.lit("edmtunes.com")) & ~F.rtrim(p, F.lit("/")).isin("", "/music") & ~p.rlike("/page/|/tag/|/category/") & dated
    return F.contains(h, F.lit("weraveyou.com")) & ~p.rlike("/tag/|/category/") & dated


def is_music_link(u: Column, profile: str = "A") -> Column:
    """Links to releases on music platforms; users, channels and artist pages do not count."""
    low = F.lower(u)
    h, p = host(low), F.trim(path(low), F.lit("/"))
    known = F.lit(False)
    for d in MUSIC_DOMAINS:
        known = known | F.contains(low, F.lit(d))
    upload = h.rlike(r"soundcloud\.com$")
    own = ("weraveyou", "we-rave-you") if profile == "C" else ("weraveyou", "we-rave-you", "edmtunes")
    bad = ((h == "open.spotify.com") & p.rlike("^user/")) | (h.rlike(r"youtube\.com$") & p.rlike("^(user|channel|c)/")) | (upload & p.isin(*own))
    if profile != "C":
        bad = bad | ((h == "open.spotify.com") & p.rlike("^artist/")) | (upload & (F.size(parts(low)) == 1))
    return known & ~bad
