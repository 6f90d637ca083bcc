"""Column functions on facts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lodestrata.functions import dates, numbers, text, urls


def value(spark, column, **inputs):
    schema = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in inputs.items()) or "x int"
    return spark.createDataFrame([tuple(inputs.values()) or (1,)], schema).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "fn, given, want",
    [
        (text.normalize_text, "Chris Lake & D.O.D feat. Someone", "chris lake and d o d someone"),
        (text.normalize_text, "Beyoncé x Zoë", "beyonce zoe"),
        (text.normalize_text, None, ""),
        (text.normalize_title, "Big Track (Extended Mix)", "big track"),
        (text.normalize_title, "Make You Fight - Extended Mix", "make you fight"),
        (text.base_version_title, "Disco Cherry - Extended", "disco cherry"),
        (text.clean_text, "  Title -;", "Title"),
        (text.key_part, "Sørën & Co", "s ren and co"),
        (text.clean_id, " None ", None),
        (text.clean_optional, "nan", ""),
        (text.primary_artist_key, "A (live) & B", "a"),
        (text.normalize_artist_name, "Tom &amp; Jerry!", "tom jerry"),
    ],
)
def test_text(spark, fn, given, want):
    assert value(spark, fn(F.col("a")), a=given) == want


def test_lists_of_names(spark):
    assert value(spark, text.unique_nonempty(F.col("a")), a=["B", " b ", "", "A", None, "a"]) == ["B", "A"]
    assert value(spark, text.artist_aliases(F.col("a")), a="Ann (DJ) feat. Bo, Cy") == ["Ann (DJ) feat. Bo, Cy", "Ann feat. Bo, Cy", "Ann", ". Bo", "Cy"]
    assert value(spark, text.associated_artist_keys(F.col("a"), F.col("b"), F.col("c")), a="Ann & Bo", b="Bo, Cy", c=None) == ["ann", "bo", "cy"]
    assert value(spark, text.split_genre_terms(F.col("a")), a='"house, tech house"/"edm"#') == ["house", "tech house", "edm"]
    assert value(spark, text.split_artist_title(F.col("a")), a="Ann – Sea") == ("Ann", "Sea")
    assert value(spark, text.split_artist_title(F.col("a")), a="no dash") is None
    assert value(spark, text.strip_artist_prefix(F.col("a"), F.col("b")), a="Ann.+ — Sea", b="ann.+") == "Sea"


@pytest.mark.parametrize(
    "given, want",
    [("April 24, 2026", "2026-04-24"), ("Apr 4, 2026", "2026-04-04"), ("Fri, 24 Apr 2026 10:00:00 +0000", "2026-04-24"), ("2026-04-24", "2026-04-24"), ("soon", None), ("", None)],
)
def test_human_dates(spark, given, want):
    got = value(spark, dates.human_date(F.col("a")), a=given)
    assert (str(got) if got else None) == want


def test_other_dates(spark):
    d = dt.date
    assert value(spark, dates.release_date(F.col("a"), F.col("b")), a="2026/02/30 x", b="2026-01-01") is None
    assert value(spark, dates.release_date(F.col("a"), F.col("b")), a="", b="2026/01/02 10:00") == d(2026, 1, 2)
    assert value(spark, dates.track_date(F.lit(2026), F.lit(4), F.lit(30), F.col("a")), a="2026/04/10 00:00:00 +0000") == d(2026, 4, 30)
    assert value(spark, dates.structured_date(F.lit(2026), F.lit(None).cast("int"), F.lit(0))) == d(2026, 1, 1)
    assert value(spark, dates.structured_date(F.lit(2026), F.lit(2), F.lit(30))) is None
    assert value(spark, dates.day_precision_date(F.col("a"), F.col("b")), a="2026", b="year") is None
    assert value(spark, dates.millis_date(F.lit(1776988800000), "America/New_York")) == d(2026, 4, 23)
    assert value(spark, dates.millis_date(F.lit(1776988800000))) == d(2026, 4, 24)


def test_numbers(spark):
    got = lambda c, **k: value(spark, c, **k)
    assert got(numbers.parse_float(F.col("a")), a="1,234.5") == 1234.5
    assert got(numbers.parse_float(F.col("a")), a="x") is None
    assert got(numbers.parse_int(F.col("a")), a="12.9") == 12
    assert got(numbers.strict_int(F.col("a")), a="12.9") is None
    assert got(numbers.recency_score(F.lit(None).cast("int"), 21)) == 0.35
    assert got(numbers.recency_score(F.lit(30), 0, None)) == 1.0
    assert got(numbers.number_string(F.lit(3.0))) == "3" and got(numbers.number_string(F.lit(2.456))) == "2.46"
    assert got(numbers.bounded(F.lit(-1.0), 10)) == 0.0 and got(numbers.rank_score(F.lit(700), 500)) == 0.0


def test_urls(spark):
    got = lambda c, a: value(spark, c(F.col("a")), a=a)
    assert got(urls.catalogue_playlist_id, "https://open.spotify.com/playlist/abc?si=1") == "abc"
    assert got(urls.catalogue_playlist_id, "spotify:playlist:xyz") == "xyz"
    assert got(urls.catalogue_playlist_id, "short") is None
    assert got(urls.upload_playlist_url, "dj/sets/mix/") == "https://soundcloud.com/dj/sets/mix"
    assert got(urls.upload_playlist_url, "https://else.org/x") is None
    assert got(urls.catalogue_artist_id, "https://open.spotify.com/artist/A1?x") == "A1"
    assert got(urls.listing_artist_id, "/artists/name/1234567890abcdefXY") == "1234567890abcdefXY"
    assert got(lambda u: urls.paginated(u, F.lit(3)), "https://x.org/music/page/2/?a=1") == "https://x.org/music/page/3/?a=1"
    assert got(urls.feed, "https://x.org/music/page/2/") == "https://x.org/music/feed/"
    assert got(lambda u: urls.canonical(u, "edm.com"), "https://www.edm.com/a?b#c") == "https://edm.com/a"
    assert got(urls.genre_from_listing, "https://x.org/genres/deep-house") == "deep house"
    assert got(lambda s: urls.song_url(s, F.lit("7")), "a b/c") == "https://www.submithub.com/song/a%20b/c"
    assert got(lambda u: urls.looks_like_article(u, "B"), "https://edmtunes.com/2026/04/some-news/")
    assert not got(lambda u: urls.looks_like_article(u, "B"), "https://edmtunes.com/tag/2026/04/x")
    links = ["https://soundcloud.com/artist", "https://soundcloud.com/artist/track", "https://open.spotify.com/artist/1", "https://open.spotify.com/track/1", "https://youtube.com/channel/x", "https://x.org"]
    assert [got(urls.is_music_link, u) for u in links] == [False, True, False, True, False, False]
    assert got(lambda u: urls.is_music_link(u, "C"), links[0])
