"""Registered queries, continued: sources over pages and payloads made of whole driver tables.

A page or payload is written as SQL that makes it from a row; the engine reads it
back, and the SQL beside it says what has to come out.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import extract
from ..sources import arrays, charts, pages, playlists, profiles, records, sinks
from .pipeline import PipelineConfig, Source, run_sources
from .queries import AS_OF, dealt, query, table

X = F.expr

# --- pages of parts ---------------------------------------------------------------------------------

_HTML = """concat('<!DOCTYPE html><html><head><title>t</title><meta property="og:title" content="', p_name, ' &amp; co"><meta name="twitter:title" content="T', p_partkey, '"><meta name="author" content="x">',
  '<script type="application/ld+json">{"name": "n', p_partkey, '", "size": ', p_size, '}</script><script type="application/ld+json">{broken</script></head><body><nav><a href="/x">menu</a></nav><article><h1>Part <b>', p_name, '</b></h1>',
  '<p>', p_brand, ' has a new single "', p_name, '" and an album called "', p_type, ' &lt;3"</p><a href="https://open.spotify.com/track/t', p_partkey, '">listen</a><a href="/about">about</a><script>var a;</script>',
  '<iframe src="https://soundcloud.com/u/s', p_partkey, '"></iframe><a href="https://open.spotify.com/track/t', p_partkey, '">again</a></article><p>foot</p></body></html>')"""


def part_pages(spark, sf):
    return dealt(spark, sf, "part", "p_partkey").select("p_partkey", "p_name", "p_brand", "p_type", F.concat(F.lit("https://example.org/p/"), "p_partkey").alias("url"), X(_HTML).alias("html"))


@query("""SELECT p_partkey, p_name || ' & co' AS og, 'T' || p_partkey AS twitter, 2 AS n, 'n' || p_partkey || ':' || p_size AS ld, 'Part ' || p_name AS heading,
  'https://open.spotify.com/track/t' || p_partkey || ' https://soundcloud.com/u/s' || p_partkey AS links, 'Part ' || p_name || ' ' || p_brand || ' has a new single "' || p_name || '" and an album called "' || p_type || ' <3" listen about again' AS body FROM part""")
def page_contents(spark, sf):
    """Metadata, JSON-LD, heading, music links and text of pages."""
    meta = F.col("p.meta")
    ld = F.transform(pages.parsed_objects(F.col("p.ld")), lambda o: F.concat(F.try_variant_get(o, "$.name", "string"), F.lit(":"), F.try_variant_get(o, "$.size", "string")))
    read = part_pages(spark, sf).select("p_partkey", "url", pages.page_contents("html").alias("p"))
    return read.select(
        "p_partkey", meta["og:title"].alias("og"), meta["twitter:title"].alias("twitter"), F.size(meta).alias("n"), F.array_join(ld, ",").alias("ld"), F.col("p.heading").alias("heading"),
        F.array_join(pages.music_hrefs(F.col("p.hrefs"), F.col("url")), " ").alias("links"), F.col("p.text").alias("body"),
    )


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 <> 2 THEN p_name || ' & co' END AS og, CASE WHEN p_partkey % 3 <> 2 THEN 2 END AS links,
  CASE WHEN p_partkey % 3 <> 2 THEN 'new single "' || p_name || '"|album called "' || p_type || ' <3"' END AS said FROM part""")
def enriched_articles(spark, sf):
    """Articles with what their pages say; some pages are missing, some recorded twice."""
    p = part_pages(spark, sf)
    held = p.where("p_partkey % 3 <> 2").unionByName(p.where("p_partkey % 3 = 1")).select("url", "html")
    out = pages.enrich(p.select("p_partkey", "url"), held)
    return out.select("p_partkey", F.col("open_graph")["og:title"].alias("og"), F.size("embedded_music_links").alias("links"), F.array_join("body_release_matches", "|").alias("said"))


_SAID = """CASE p_partkey % 4 WHEN 0 THEN concat('They put out the single titled "', p_name, '" today') WHEN 1 THEN concat('Here is a new track ''', p_name, ''', and more') WHEN 2 THEN concat('A remix of "', p_name, '" is out') ELSE concat('Nothing by ', p_name) END"""


@query("""SELECT p_partkey, CASE WHEN p_partkey % 4 < 3 THEN p_name END AS title, CASE p_partkey % 4 WHEN 0 THEN 'single titled "' || p_name || '"' WHEN 1 THEN 'new track ''' || p_name || '''' WHEN 2 THEN 'remix of "' || p_name || '"' ELSE '' END AS found,
  CASE p_partkey % 4 WHEN 0 THEN 'single' WHEN 1 THEN 'track' WHEN 2 THEN 'remix' ELSE 'unknown' END AS kind FROM part""")
def body_titles(spark, sf):
    """Titles that a body quotes, what it says, and the type it speaks of."""
    b = X(_SAID)
    return table(spark, sf, "part").select("p_partkey", extract.title_from_body(b).alias("title"), F.array_join(extract.body_matches(b), "|").alias("found"), extract.release_type(b, F.lit("")).alias("kind"))


_LINE = """CASE p_partkey % 5 WHEN 0 THEN concat(p_brand, ' Drops New Single ''', p_name, ''': Listen') WHEN 1 THEN concat(p_brand, ' unveils fresh album "', p_name, '" | Site') WHEN 2 THEN concat(p_brand, ' – ', p_name, ' [Label]')
  WHEN 3 THEN concat(p_brand, ' remixes “', p_name, '”') ELSE concat('The year of ', p_name) END"""
_BY = "SELECT p_partkey, CASE WHEN p_partkey % 5 < 4 THEN p_brand END AS {0}, CASE WHEN p_partkey % 5 < 4 THEN p_name END AS {1} FROM part"


@query("""SELECT p_partkey, CASE WHEN p_partkey % 5 < 4 THEN p_brand || '|' || p_name END AS a, CASE WHEN p_partkey % 5 < 4 THEN p_brand || '|' || p_name END AS b, CASE WHEN p_partkey % 5 < 4 THEN p_brand || '|' || p_name END AS c FROM part""")
def headline_titles(spark, sf):
    """Artist and title of headlines, by the patterns of the three profiles."""
    t = table(spark, sf, "part").select("p_partkey", *[extract.from_title(X(_LINE), p.upper()).alias(p) for p in "abc"])
    return t.select("p_partkey", *[F.when(F.col(f"{p}.title").isNotNull(), F.concat(F.col(f"{p}.artist"), F.lit("|"), F.col(f"{p}.title"))).alias(p) for p in "abc"])


@query("""SELECT p_brand AS artist, p_name AS track_or_project_title, CASE p_partkey % 5 WHEN 0 THEN 'single' WHEN 1 THEN 'album' WHEN 3 THEN 'remix' ELSE 'unknown' END AS release_type, 'https://example.org/p/' || p_partkey AS source_article_url, '2026-01-30' AS article_date,
  CASE WHEN p_partkey % 2 = 0 THEN 'regex+embedded_player' ELSE 'regex' END AS extraction_method FROM part WHERE p_partkey % 5 = 0 OR p_partkey % 5 = 1""")
def parsed_articles(spark, sf):
    """Articles to releases: classified, parsed, typed and scored."""
    none = "cast(null as map<string,string>)"
    cards = table(spark, sf, "part").select(
        X(_LINE).alias("title"), F.concat(F.lit("https://example.org/p/"), "p_partkey").alias("url"), F.lit("S").alias("source_name"), F.lit("2026-01-30").alias("publish_date"), F.lit("").alias("snippet"), F.lit("").alias("body_text"),
        X("CASE WHEN p_partkey % 2 = 0 THEN array('https://open.spotify.com/track/x') END").alias("embedded_music_links"), X(none).alias("open_graph"), X("cast(null as array<string>)").alias("body_release_matches"),
    )
    return extract.parse_articles(cards).select("artist", "track_or_project_title", "release_type", "source_article_url", "article_date", "extraction_method")


_ARCHIVE = """concat('<html><body><div><h2><a href="/music-releases/a-', p_partkey, '?x=1">', p_brand, ' drops the ', p_name, ' single</a></h2><p>April ', 1 + p_partkey % 28, ', 2026</p></div>',
  '<article><a href="https://www.edm.com/music-releases/b-', p_partkey, '">Read more</a></article><article><a href="/features/c">Quite another thing</a></article></body></html>')"""


@query("SELECT p_partkey AS page, p_brand || ' drops the ' || p_name || ' single' AS title, 'https://edm.com/music-releases/a-' || p_partkey AS url, make_date(2026, 4, 1 + (p_partkey % 28)::INTEGER)::VARCHAR AS publish_date FROM part WHERE p_partkey % 28 >= 9")
def archive_cards(spark, sf):
    """Article cards of archive pages, without those before a cutoff."""
    p = dealt(spark, sf, "part", "p_partkey").select(F.col("p_partkey").alias("page"), F.lit("https://edm.com/music-releases").alias("url"), X(_ARCHIVE).alias("html"))
    return pages.distinct_cards(pages.cards_from_pages(p, "A", "music", "2026-04-10"), "A").select("page", "title", "url", "publish_date")


@query("SELECT p_partkey AS page, 'u' || p_partkey AS url FROM part WHERE p_partkey BETWEEN 1 AND 30")
def crawl_stop(spark, sf):
    """Cards of the pages up to the one that reaches the cutoff."""
    p = table(spark, sf, "part").where("p_partkey > 0")
    cards = p.select(F.col("p_partkey").alias("page"), F.concat(F.lit("u"), "p_partkey").alias("url"), F.lit(False).alias("old"))
    old = p.where("p_partkey >= 30").select(F.col("p_partkey").alias("page"), F.lit("old").alias("url"), F.lit(True).alias("old"))
    return pages.crawled(cards.unionByName(old)).select("page", "url")


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'https://example.org/more/' || p_partkey WHEN 1 THEN 'https://example.org/wp-json/ajaxloadmore/posts?page=2&category=music-releases&post_type=p' || p_size END AS next, CASE WHEN p_partkey % 2 = 0 THEN '<p>' || p_name || '</p>' ELSE p_name END AS inner_html FROM part""")
def load_more(spark, sf):
    """Where a listing's next batch comes from, and the markup inside an answer."""
    page = X("""CASE p_partkey % 3 WHEN 0 THEN concat('<div><button data-url="/more/', p_partkey, '">Load  More</button></div>') WHEN 1 THEN concat('<ul class="a alm-listing" data-post-type="p', p_size, '"></ul>') ELSE '<p>end</p>' END""")
    answer = X("""CASE WHEN p_partkey % 2 = 0 THEN concat('{"html": "<p>', p_name, '</p>"}') ELSE p_name END""")
    return dealt(spark, sf, "part", "p_partkey").select("p_partkey", pages.load_more_url(page, F.lit("https://example.org/list/"), F.lit(2)).alias("next"), pages.unwrapped(answer).alias("inner_html"))


_FEED = """concat('<rss><channel><title>t</title><item><title>', p_brand, ' &amp; ', p_name, '</title><link>https://www.edm.com/music-releases/f-', p_partkey, '?utm=1</link><pubDate>Fri, ', lpad(CAST(1 + p_partkey % 28 AS {text}), 2, '0'), ' May 2026 10:00:00 +0000</pubDate>',
  '<category>', p_type, '</category><category> two </category><description>&lt;p&gt;About ', p_size, '&lt;/p&gt;</description></item><item><title>No link</title></item></channel></rss>')"""


@query("SELECT p_brand || ' & ' || p_name AS title, 'https://edm.com/music-releases/f-' || p_partkey AS url, p_type || ', two' AS category, make_date(2026, 5, 1 + (p_partkey % 28)::INTEGER)::VARCHAR AS publish_date, 'About ' || p_size AS snippet FROM part WHERE p_partkey % 28 >= 4")
def feed_cards(spark, sf):
    f = dealt(spark, sf, "part", "p_partkey").select(X(_FEED.replace("{text}", "STRING")).alias("xml"))
    return pages.cards_from_feed(f, "A", "music", "2026-05-05").select("title", "url", "category", "publish_date", "snippet")


# --- payloads ---------------------------------------------------------------------------------------------


@query("SELECT p_partkey, p_size::VARCHAR AS params, CASE WHEN p_partkey % 2 = 0 THEN 'x y' END AS mode, CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE 3 END AS n FROM part")
def updater_settings(spark, sf):
    """Settings of a chart's updater script."""
    script = X("""concat('<h3>', CASE WHEN p_partkey % 3 = 0 THEN 'Other' ELSE 'Most Heard House Tracks' END, '</h3><script>new StatisticUpdater (''#a'', {params: "', p_size, '", mode: ''', CASE WHEN p_partkey % 2 = 0 THEN 'x y' ELSE '9' END, ''', genre: 7})</script>')""")
    m = charts.updater_params(script, "Most Heard House Tracks")
    p = table(spark, sf, "part").select("p_partkey", "p_size", m.alias("m"))
    return p.select("p_partkey", F.coalesce(F.try_element_at("m", F.lit("params")), F.col("p_size").cast("string")).alias("params"), F.when(X("p_partkey % 2 = 0"), F.coalesce(F.try_element_at("m", F.lit("mode")), F.lit("x y"))).alias("mode"), F.size("m").alias("n"))


@query("""SELECT p_brand AS artist, p_name AS track_or_project_title, CASE WHEN p_size % 2 = 0 THEN 'remix' ELSE 'track' END AS release_type, round(least(1.0, 0.65 + CASE WHEN p_size >= 20 THEN 0.15 ELSE 0 END + CASE WHEN p_partkey % 40 >= 20 THEN 0.10 ELSE 0 END + 0.05), 6)::DOUBLE AS confidence,
  'https://www.submithub.com/song/s-' || p_partkey AS url, '2026-01-' || lpad((1 + p_partkey % 28)::VARCHAR, 2, '0') AS article_date, p_partkey::VARCHAR AS chart_rank FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 28 < 20""")
def submission_rows(spark, sf):
    """Chart summaries joined with their last track; future and unknown tracks go."""
    p = table(spark, sf, "part")
    sums = p.select(
        F.col("p_partkey").alias("rank"), F.array(F.lit("zz"), F.concat(F.lit("k"), "p_partkey")).alias("tracks"), F.col("p_size").cast("double").alias("points"), X("p_partkey % 40").alias("approved"), F.lit(1).alias("rgb"), F.lit(1).alias("complete"),
        F.lit("US").alias("country"), F.array("p_type").alias("tags"),
    )
    released = X("unix_millis(timestamp'2026-01-01 12:00:00 UTC') + (p_partkey % 28) * 86400000L")
    tracks = p.where("p_partkey % 7 <> 0").select(
        F.concat(F.lit("k"), "p_partkey").alias("id"), F.col("p_partkey").alias("pos"), F.col("p_brand").alias("artist"), F.concat(F.lit('"'), "p_name", F.lit('"')).alias("title"), released.alias("released"), F.concat(F.lit("s-"), "p_partkey").alias("slug"),
        F.when(X("p_size % 2 = 0"), F.array(F.lit("remix"))).alias("unoriginal"), F.lit("").alias("label"), F.array(F.lit("")).alias("source_urls"),
    )
    out = charts.submission_releases(sums, tracks, "2026-01-20")
    return out.select("artist", "track_or_project_title", "release_type", F.round("confidence_score", 6).alias("confidence"), F.col("source_article_url").alias("url"), "article_date", F.col("open_graph")["chart_rank"].alias("chart_rank"))


_TRACK = """named_struct('id', p_partkey, 'title', CASE p_partkey % 4 WHEN 0 THEN concat(p_brand, ' - ', p_name) WHEN 1 THEN p_name WHEN 2 THEN concat(p_type, ' – ', p_name) ELSE concat(p_name, ' DJ set') END, 'permalink_url', concat('https://soundcloud.com/u/', p_partkey),
  'user', named_struct('username', p_type), 'created_at', concat('2026/01/', lpad(cast(1 + p_partkey % 28 as string), 2, '0'), ' 10:00:00 +0000'), 'playback_count', p_size * 1000, 'likes_count', p_size, 'reposts_count', 1, 'duration', 200000, 'genre', 'House',
  'publisher_metadata', CASE WHEN p_partkey % 4 = 0 THEN named_struct('artist', p_brand) END)"""
_ARTIST = "CASE p_partkey % 4 WHEN 0 THEN p_brand ELSE p_type END"


def _tracks(spark, sf):
    return table(spark, sf, "part").select("*", F.parse_json(F.to_json(X(_TRACK))).alias("track"))


@query(f"SELECT p_partkey, {_ARTIST} AS artist, CASE WHEN p_partkey % 4 = 3 THEN p_name || ' DJ set' ELSE p_name END AS title FROM part")
def upload_names(spark, sf):
    """Artist and title of uploads: publisher, prefix, dash, uploader."""
    at = _tracks(spark, sf).select("p_partkey", playlists.artist_and_title(F.col("p_type")).alias("a"))
    return at.select("p_partkey", "a.artist", "a.title")


@query(f"SELECT {_ARTIST} AS artist, p_name AS track_or_project_title, '2026-01-' || lpad((1 + p_partkey % 28)::VARCHAR, 2, '0') AS article_date, 'https://soundcloud.com/u/' || p_partkey AS link, p_partkey::VARCHAR AS upload_id FROM part WHERE p_partkey % 4 <> 3 AND 1 + p_partkey % 28 BETWEEN 16 AND 30 ORDER BY 5")
def profile_upload_rows(spark, sf):
    """Recent uploads of artist profiles as releases."""
    who = table(spark, sf, "part").select(F.col("p_partkey").alias("ordinal"), F.concat(F.lit("u"), "p_partkey").alias("soundcloud_user_id"), F.col("p_type").alias("artist_name"), F.lit("https://soundcloud.com/u").alias("soundcloud_url"), F.lit("house").alias("genre"), F.lit("5").alias("rank"), F.lit("1000").alias("monthly_listeners"))
    t = _tracks(spark, sf).select(F.concat(F.lit("u"), "p_partkey").alias("soundcloud_user_id"), F.lit(0).alias("pos"), "track")
    out = profiles.profile_uploads(who, t, "2026-01-30", 14)
    return out.select("artist", "track_or_project_title", "article_date", F.col("embedded_music_links")[0].alias("link"), F.col("open_graph")["soundcloud_track_id"].alias("upload_id"))


@query(f"""SELECT {_ARTIST} AS artist, p_partkey::VARCHAR AS upload_id, round((greatest(1.0 - (29 - p_partkey % 28) / 14.0, 0.0) * 0.25 + least(log10(501) / log10(1000001), 1.0) * 0.15 + least(log10(p_size * 1000 + 1) / log10(1000001), 1.0) * 0.20 + least(log10(p_size + 1) / log10(100001), 1.0) * 0.15
  + least(log10(2) / log10(10001), 1.0) * 0.10 + (0.80 + CASE WHEN p_partkey % 4 = 0 THEN 0.10 ELSE 0 END) * 0.15) * 100, 2) AS ranking_score FROM part WHERE p_partkey % 4 <> 3 AND 1 + p_partkey % 28 BETWEEN 16 AND 30""")
def followed_upload_rows(spark, sf):
    """Recent uploads of followed artists with their score."""
    who = table(spark, sf, "part").select(F.col("p_partkey").alias("ordinal"), F.concat(F.lit("u"), "p_partkey").alias("soundcloud_user_id"), F.col("p_type").alias("artist_name"), F.lit("https://soundcloud.com/u").alias("soundcloud_url"), F.array(F.lit("house")).alias("genres"), F.array(F.lit("house")).alias("edm_match_terms"), F.lit(500).cast("long").alias("followers_count"))
    t = _tracks(spark, sf).select(F.concat(F.lit("u"), "p_partkey").alias("soundcloud_user_id"), F.lit(0).alias("pos"), "track")
    return profiles.followed_uploads(who, t, "2026-01-30", 14).select("artist", F.col("open_graph")["soundcloud_track_id"].alias("upload_id"), "ranking_score")


@query("SELECT c_custkey::VARCHAR AS id, c_name AS artist_name, 'House|t' || c_nationkey AS genres, CASE WHEN c_nationkey % 2 = 0 THEN 'club,house' ELSE 'house' END AS terms, (c_custkey * 2)::BIGINT AS followers FROM customer WHERE c_custkey % 3 <> 0")
def followed_list(spark, sf):
    """Followed users with the genres of their tracks; users without a genre term go."""
    c = dealt(spark, sf, "customer", "c_custkey")
    user = X("named_struct('id', c_custkey, 'username', c_name, 'description', CASE WHEN c_nationkey % 2 = 0 AND c_custkey % 3 <> 0 THEN 'club life' ELSE 'life' END, 'followers_count', c_custkey * 2)")
    users = c.select(F.col("c_custkey").alias("ordinal"), F.parse_json(F.to_json(user)).alias("user"))
    track = X("named_struct('genre', 'House', 'tag_list', concat('t', c_nationkey))")
    tracks = c.where("c_custkey % 3 <> 0").select(F.col("c_custkey").cast("string").alias("soundcloud_user_id"), F.lit(0).alias("pos"), F.parse_json(F.to_json(track)).alias("track"))
    return profiles.followed_artists(users, tracks).select(F.col("soundcloud_user_id").alias("id"), "artist_name", F.array_join("genres", "|").alias("genres"), F.array_join("edm_match_terms", ",").alias("terms"), F.col("followers_count").alias("followers"))


@query("""SELECT p_partkey AS target, p_name AS artist_name, 'https://open.spotify.com/artist/abcdefghij' || lpad(p_partkey::VARCHAR, 8, '0') AS spotify_url, CASE WHEN p_partkey % 2 = 0 THEN p_size::BIGINT ELSE 1 END AS rank FROM part
  UNION ALL SELECT p_partkey, p_brand, '', 2 FROM part WHERE p_partkey % 4 = 0""")
def genre_page_artists(spark, sf):
    """Artists of genre pages: from the embedded snapshot, else from links."""
    key = "concat('abcdefghij', lpad(cast(p_partkey as string), 8, '0'))"
    snapshot = f"""concat('<div wire:snapshot="{{&quot;data&quot;:{{&quot;allArtists&quot;:[[{{&quot;name&quot;:&quot;', p_name, '&quot;,&quot;spotify_id&quot;:&quot;', {key}, '&quot;,&quot;_original_rank&quot;:', p_size, '}},{{&quot;name&quot;:&quot;', CASE WHEN p_partkey % 4 = 0 THEN p_brand ELSE '' END, '&quot;,&quot;_original_rank&quot;:2}}]]}}}}"></div>')"""
    nested = snapshot.replace("[[{", "[[[{").replace("},{&quot;", "}],[{&quot;").replace("2}]]", "2}]]]")
    linked = f"concat('<a href=\"https://x.org/en/artists/n/', {key}, '\">', p_name, '</a><a href=\"/home\">Home</a>')"
    p = dealt(spark, sf, "part", "p_partkey").select(F.col("p_partkey").alias("target"), F.lit("house").alias("genre"), F.lit(5).alias("limit"), X(f"CASE WHEN p_partkey % 2 = 0 THEN {nested} ELSE {linked} END").alias("html"))
    return profiles.genre_artists(p).select("target", "artist_name", "spotify_url", "rank")


# --- files and sinks ----------------------------------------------------------------------------------------


@query("SELECT p_partkey * 4 AS load_ordinal, p_name AS artist, p_size::DOUBLE AS ranking_score, p_brand AS noted FROM part WHERE p_partkey % 3 <> 0")
def release_files(spark, sf):
    """Bodies of JSON files to releases; objects, numbers, broken bodies and what is no release go."""
    body = X("""CASE p_partkey % 3 WHEN 0 THEN '{"artist": "x"}' ELSE concat('[{"artist": "', p_name, '", "ranking_score": ', p_size, ', "open_graph": {"noted": "', p_brand, '"}}, 5, {"artist": "no", "release_article": false}', CASE WHEN p_partkey % 9 = 8 THEN ']' ELSE ']' END) END""")
    files = table(spark, sf, "part").select(body.alias("body"), F.col("p_name").alias("source_file"), F.col("p_partkey").cast("int").alias("file_no"))
    rows = records.releases_of(spark, files)
    return rows.select((F.floor(F.col("load_ordinal") / F.lit(1 << 40)) * 4 + F.pmod("load_ordinal", F.lit(1 << 40))).alias("load_ordinal"), "artist", "ranking_score", F.col("open_graph")["noted"].alias("noted"))


@query("SELECT c_custkey AS ordinal, c_name AS artist_name, CASE WHEN c_custkey % 4 = 1 THEN '' ELSE 'https://open.spotify.com/artist/a' || c_custkey END AS spotify_url, CASE WHEN c_custkey % 4 = 1 THEN c_custkey::VARCHAR ELSE '' END AS user_id FROM customer WHERE c_custkey % 4 NOT IN (0, 3)")
def profile_rows(spark, sf):
    """Rows of an artist file: those with an identifier that can be read."""
    c = table(spark, sf, "customer")
    url = X("CASE c_custkey % 4 WHEN 0 THEN 'https://x.org/b' WHEN 1 THEN 'None' WHEN 2 THEN concat(' https://open.spotify.com/artist/a', c_custkey) END")
    rows = c.select(F.col("c_custkey").alias("ordinal"), F.concat(F.lit(" "), "c_name").alias("artist_name"), url.alias("spotify_url"), X("CASE WHEN c_custkey % 4 = 1 THEN cast(c_custkey as string) ELSE 'nan' END").alias("soundcloud_user_id"))
    return records.profiles_of(rows).select("ordinal", "artist_name", "spotify_url", F.col("soundcloud_user_id").alias("user_id"))


@query("SELECT c_name AS artist_name, c_mktsegment || '|b' AS genres, (c_custkey * 1000)::BIGINT AS followers FROM customer")
def followed_rows(spark, sf):
    raw = table(spark, sf, "customer").select(
        F.concat("c_name", F.lit("  ")).alias("artist_name"), *[F.lit("").alias(n) for n in ("soundcloud_url", "soundcloud_user_id", "country", "city", "edm_match_terms", "track_count")],
        F.concat("c_mktsegment", F.lit(" | | b")).alias("genres"), F.concat("c_custkey", F.lit(",000")).alias("followers_count"), F.col("c_custkey").alias("ordinal"),
    )
    return records.followed_of(raw).select("artist_name", F.array_join("genres", "|").alias("genres"), F.col("followers_count").alias("followers"))


@query("SELECT p_partkey AS ordinal, 'https://x/' || p_partkey AS url, p_size AS lim, CASE WHEN p_partkey % 2 = 0 THEN p_type END AS genre FROM part WHERE p_partkey % 5 NOT IN (3, 4)")
def target_lines(spark, sf):
    """Lines of a target list; blank lines and comments go."""
    line = X("CASE p_partkey % 5 WHEN 3 THEN '   ' WHEN 4 THEN '# no' ELSE concat(' https://x/', p_partkey, ' , ', p_size, CASE WHEN p_partkey % 2 = 0 THEN concat(', ', p_type) ELSE '' END) END")
    rows = table(spark, sf, "part").select(line.alias("value"), F.col("p_partkey").alias("ordinal"))
    return records.targets_of(records.lines_of(rows)).select("ordinal", "url", F.col("limit").alias("lim"), "genre")


@query("SELECT row_number() OVER (ORDER BY o_orderkey) AS n, o_custkey AS customer, o_orderpriority AS priority, row_number() OVER (ORDER BY o_orderkey) = 1 AS opens, row_number() OVER (ORDER BY o_orderkey DESC) = 1 AS closes FROM orders")
def pretty_array(spark, sf):
    """Orders as one JSON array, line by line, and read back."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    lines = arrays.array_lines(o, ["o_orderkey"], ("o_orderkey",))
    r = F.from_json(F.regexp_replace("value", r"^\[\n|,$|\n\]$", ""), "o_custkey bigint, o_orderpriority string")
    return lines.select("n", r["o_custkey"].alias("customer"), r["o_orderpriority"].alias("priority"), F.startswith("value", F.lit("[\n")).alias("opens"), F.endswith("value", F.lit("\n]")).alias("closes"))


@query("""SELECT p_partkey + 1 AS rank, p_name AS track_or_project_title, p_brand AS source, CASE WHEN p_size % 2 = 0 THEN 'https://open.spotify.com/track/t' || p_partkey END AS spotify_url, CASE WHEN p_size % 3 = 0 THEN 'late' ELSE '' END AS notes, p_type AS kind FROM part""")
def resolved_tracks(spark, sf):
    """Resolved tracks in their nested shape."""
    s = X("cast(null as string)")
    p = table(spark, sf, "part").select(
        (F.col("p_partkey") + 1).alias("rank"), F.col("p_retailprice").alias("ranking_score"), F.lit("a").alias("artist"), F.col("p_name").alias("title"), F.array("p_brand").alias("source_names"), s.alias("spotify_uri"),
        X("CASE WHEN p_size % 2 = 0 THEN concat('t', p_partkey) END").alias("spotify_id"), s.alias("soundcloud_url"), s.alias("soundcloud_track_id"), X("CASE WHEN p_size % 3 = 0 THEN array('late') ELSE array() END").alias("notes"), "p_type",
    )
    r = sinks.resolved_rows(p, F.struct("p_type"))
    return r.select("rank", "track_or_project_title", F.element_at("source_names", 1).alias("source"), "spotify_url", F.array_join("notes", ",").alias("notes"), F.col("source_record.p_type").alias("kind"))


@query("SELECT 'nations' AS name, true AS success, count(*)::BIGINT AS n FROM nation UNION ALL SELECT 'broken', false, 0 UNION ALL SELECT 'regions', true, count(*) FROM region")
def source_runs(spark, sf):
    """Sources that run, and one that fails."""
    count = lambda t: lambda s, c: table(s, sf, t).select(F.lit(t).alias("artist"))
    sources = [Source("nations", count("nation")), Source("broken", lambda s, c: table(s, sf, "nation").select("no such column")), Source("regions", count("region")), Source("skipped", count("region"), api_source=True)]
    built, status = run_sources(spark, sources, PipelineConfig(as_of=AS_OF, skip_api_sources=True))
    rows = None
    for name, df in built:
        one = df.groupBy().agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        rows = one if rows is None else rows.unionByName(one)
    return status.join(rows, "name", "left").select("name", "success", F.coalesce("n", F.lit(0)).alias("n"))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_brand || '|' || p_name WHEN 1 THEN p_type || '|' || p_name || ' - x' END AS halves, CASE WHEN p_partkey % 3 = 0 THEN p_name END AS rest, p_name || ' & <b>' AS plain FROM part""")
def dash_titles(spark, sf):
    """Titles split at a dash, or freed of the artist before it; entities to characters."""
    t = X("CASE p_partkey % 3 WHEN 0 THEN concat(p_brand, '  -  ', p_name) WHEN 1 THEN concat(p_type, ' – ', p_name, ' - x') ELSE concat(p_brand, '-', p_name) END")
    dashes = (" – ", " - ")
    pair = tx.split_artist_title(t, dashes)
    rest = tx.strip_artist_prefix(F.when(X("p_partkey % 3 = 0"), F.upper(t)).otherwise(F.lit("x")), F.lower("p_brand"))
    rows = table(spark, sf, "part").select("p_partkey", pair.alias("p"), F.lower(rest).alias("rest"), tx.clean_html(F.concat("p_name", F.lit("  &amp; &lt;b&gt; "))).alias("plain"))
    return rows.select("p_partkey", F.when(F.col("p.title").isNotNull(), F.concat("p.artist", F.lit("|"), "p.title")).alias("halves"), "rest", "plain")
