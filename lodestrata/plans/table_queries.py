"""Registered queries, continued: functions and operators over inputs made of whole driver tables.

Inputs are written once, as SQL that Spark and DuckDB both read; results are
computed by the engine here and, on their own, by the SQL beside it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, numbers, urls
from ..functions import text as tx
from ..operators import dedupe, extract, filters, match
from ..sources import charts, records, sinks
from .queries import AS_OF, dealt, query, table

X = F.expr


def _list(items) -> str:
    return "[" + ", ".join("'" + i.replace("'", "''") + "'" for i in items) + "]"


def _squeezed(c: str) -> str:
    return f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"


def _normal(c: str) -> str:
    """Normalised text of an ASCII column."""
    return f"trim(regexp_replace(regexp_replace(replace(lower({c}), '&', ' and '), '\\b({tx.JOINING_WORDS})\\b', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'))"


def _without(c: str, phrases: str) -> str:
    return f"trim(regexp_replace(regexp_replace({c}, '\\b({phrases})\\b', ' ', 'g'), '\\s+', ' ', 'g'))"


def _unique(c: str) -> str:
    """Filled entries, each once without regard to case."""
    clean = f"list_filter(list_transform({c}, lambda x: {_squeezed('x')}), lambda x: x <> '')"
    return f"list_filter({clean}, lambda x, i: list_position(list_transform({clean}, lambda y: lower(y)), lower(x)) = i)"


# --- inputs: credits and titles made of part names ------------------------------------------------

CREDIT = """CASE p_partkey % 7 WHEN 0 THEN concat(p_brand, ' & ', p_name) WHEN 1 THEN concat(p_name, ' feat. ', p_brand) WHEN 2 THEN concat(p_brand, ',', p_type)
  WHEN 3 THEN concat(p_name, ' (live)  x ', p_type) WHEN 4 THEN concat(p_type, ' featuring ', p_name, ' + ', p_brand) WHEN 5 THEN concat(p_name, ', ', upper(p_name)) ELSE p_name END"""
TITLE = """CASE p_partkey % 9 WHEN 0 THEN concat(p_name, ' (Original Mix)') WHEN 1 THEN concat(p_name, ' - Radio Edit') WHEN 2 THEN concat(upper(p_name), ' Sped  Up') WHEN 3 THEN concat(p_name, ' Nightcore')
  WHEN 4 THEN concat(p_name, ' discover') WHEN 5 THEN concat(p_name, ' (Extended Version)') WHEN 6 THEN concat(p_name, ' remix') WHEN 7 THEN concat('The rework of ', p_name) ELSE p_name END"""
_SPLIT = tx.ARTIST_SPLIT.replace("(?iU)", "(?i)")
_ALIASES = tx.ALIAS_SPLIT.replace("(?iU)", "(?i)")
_BARE = f"regexp_replace({_squeezed(CREDIT)}, '\\([^)]*\\)', ' ', 'g')"
_NAMES = f"string_split_regex({_BARE}, '{_SPLIT}')"
_ALIAS_LIST = _unique(f"list_concat([{_squeezed(CREDIT)}, {_BARE}], string_split_regex({_BARE}, '{_ALIASES}'))")


@query(f"SELECT p_partkey, array_to_string({_NAMES}, '|') AS parts, {_normal(_NAMES + '[1]')} AS primary_key FROM part")
def credit_parts(spark, sf):
    """Names of a credit line, and the key of the first."""
    c = X(CREDIT)
    return table(spark, sf, "part").select("p_partkey", F.array_join(tx.artist_parts(c), "|").alias("parts"), tx.primary_artist_key(c).alias("primary_key"))


@query(f"SELECT p_partkey, array_to_string({_ALIAS_LIST}, '|') AS aliases, array_to_string({_unique(f'list_transform(({_ALIAS_LIST})[1:4], lambda a: concat(a, chr(32), p_type))')}, '|') AS searches FROM part")
def search_texts(spark, sf):
    """Aliases of a credit and the searches made of them."""
    c = X(CREDIT)
    return dealt(spark, sf, "part", "p_partkey").select("p_partkey", F.array_join(tx.artist_aliases(c), "|").alias("aliases"), F.array_join(match.search_queries(c, F.col("p_type")), "|").alias("searches"))


@query(f"SELECT p_partkey, array_to_string(list_distinct_ordered, '|') AS keys FROM (SELECT p_partkey, list_filter(k, lambda x, i: x <> '' AND list_position(k, x) = i) AS list_distinct_ordered FROM (SELECT p_partkey, list_transform(list_concat({_NAMES}, string_split_regex(p_type, '{_SPLIT}')), lambda x: {_normal('x')}) AS k FROM part))")
def associated_keys(spark, sf):
    p = dealt(spark, sf, "part", "p_partkey")
    keys = tx.associated_artist_keys(X(CREDIT), F.col("p_type"), F.lit(""))
    return p.select("p_partkey", F.array_join(keys, "|").alias("keys"))


@query(f"SELECT p_partkey, array_to_string(list_filter(list_transform(string_split_regex(p_brand || ' ,' || p_type || '/ \"' || p_name || '\";|', '[,#/;|]+'), lambda x: {_squeezed('''regexp_replace(x, '^[\"\\s]+|[\"\\s]+$', '', 'g')''')}), lambda x: x <> ''), '|') AS terms FROM part")
def genre_split(spark, sf):
    raw = X("""concat(p_brand, ' ,', p_type, '/ "', p_name, '";|')""")
    return table(spark, sf, "part").select("p_partkey", F.array_join(tx.split_genre_terms(raw), "|").alias("terms"))


@query(f"SELECT p_partkey, {_without(_normal(TITLE), tx.VERSION_PHRASES)} AS base, {_without(_normal(TITLE), tx.MIX_PHRASES)} AS title FROM part")
def version_titles(spark, sf):
    t = X(TITLE)
    return table(spark, sf, "part").select("p_partkey", tx.base_version_title(t).alias("base"), tx.normalize_title(t).alias("title"))


@query(f"SELECT p_partkey, regexp_matches(concat_ws(' ', {_squeezed(TITLE)}, nullif(p_type, '')), '{filters.VARIANTS.replace('(?iU)', '(?i)')}') AS variant, regexp_matches({_squeezed(TITLE)}, '{filters.EXTENDED.replace('(?iU)', '(?i)')}') AS extended, CASE WHEN contains(lower({TITLE}), 'remix') THEN 'remix' WHEN contains(lower({TITLE}), 'rework') THEN 'rework' WHEN p_size % 3 = 0 THEN CASE WHEN p_size <= 3 THEN 'single' ELSE 'EP' END WHEN p_size % 3 = 1 THEN CASE WHEN p_size > 6 THEN 'album' ELSE 'EP' END ELSE 'track' END AS kind FROM part")
def version_vetoes(spark, sf):
    """Speed variants, extended versions, and the type by title and album."""
    t = X(TITLE)
    album = X("CASE p_size % 3 WHEN 0 THEN 'Single' WHEN 1 THEN 'album' ELSE NULL END")
    kind = extract.type_from_album_track(album, F.col("p_size").cast("string"), t)
    return table(spark, sf, "part").select("p_partkey", filters.unwanted_variant(t, F.col("p_type")).alias("variant"), filters.extended_version(t).alias("extended"), kind.alias("kind"))


_ISRC = "concat('usabc', lpad(CAST(p_partkey % 100 AS VARCHAR(9)), 2, '0'), CASE WHEN p_partkey % 11 = 0 THEN '' ELSE '00001' END)"


@query(f"SELECT p_partkey, y AS year, y NOT IN (2026, 2025) AS outside FROM (SELECT p_partkey, (CASE WHEN p_partkey % 100 <= 79 THEN 2000 ELSE 1900 END + p_partkey % 100)::INTEGER AS y, {_ISRC} AS isrc FROM part)")
def isrc_rules(spark, sf):
    """Year of a code, and whether it lies outside the window in the first days of a year."""
    code = X(_ISRC.replace("VARCHAR(9)", "STRING"))
    return table(spark, sf, "part").select("p_partkey", filters.isrc_year(code).alias("year"), filters.isrc_outside_window(code, "2026-01-05", 7).alias("outside"))


_UPLOAD = """CASE event_id % 6 WHEN 0 THEN concat(event_type, ' DJ Set') WHEN 1 THEN concat('Live @ ', event_type) WHEN 2 THEN concat(event_type, ' podcast 12') WHEN 3 THEN 'Boiler  Room' ELSE event_type END"""


@query(f"SELECT event_id, CASE WHEN event_id % 5 = 0 THEN true WHEN value * 10000 > 900000 THEN false ELSE NOT list_bool_or(list_transform({_list(filters.SET_TERMS)}, lambda t: contains(lower({_squeezed(_UPLOAD)}), t))) END AS release FROM events")
def upload_checks(spark, sf):
    """Whether an upload looks like a release."""
    isrc, name = X("CASE WHEN event_id % 10 = 0 THEN 'X1' ELSE '' END"), X("CASE WHEN event_id % 10 = 5 THEN event_type END")
    return table(spark, sf, "events").select("event_id", filters.looks_like_release(X(_UPLOAD), isrc, name, F.col("value") * 10000).alias("release"))


_ABOUT = "CASE p_partkey % 5 WHEN 0 THEN 'Deep House and TECHNO' WHEN 1 THEN 'club nights' WHEN 2 THEN 'dnb / UKG' WHEN 3 THEN p_name ELSE 'bassline' END"


@query(f"SELECT p_partkey, array_to_string(list_sort(list_filter({_list(filters.GENRE_TERMS)}, lambda t: contains(lower(concat_ws(' ', p_brand, {_ABOUT}, concat(p_type, ' trap'))), t))), ',') AS terms FROM part")
def genre_members(spark, sf):
    found = filters.genre_terms(F.col("p_brand"), X(_ABOUT), F.array("p_type", F.lit("trap")))
    return table(spark, sf, "part").select("p_partkey", F.array_join(found, ",").alias("terms"))


# --- addresses made of order keys -----------------------------------------------------------------

_LINK = """CASE o_orderkey % 12 WHEN 0 THEN concat('https://open.spotify.com/track/', o_orderkey) WHEN 1 THEN concat('https://open.spotify.com/artist/', o_orderkey) WHEN 2 THEN concat('https://soundcloud.com/user', o_custkey)
  WHEN 3 THEN concat('https://soundcloud.com/user', o_custkey, '/song-', o_orderkey) WHEN 4 THEN 'https://www.youtube.com/channel/x' WHEN 5 THEN concat('https://www.youtube.com/watch?v=', o_orderkey)
  WHEN 6 THEN 'https://soundcloud.com/edmtunes' WHEN 7 THEN concat('https://example.org/', o_orderkey) WHEN 8 THEN concat('https://music.apple.com/album/', o_orderkey) WHEN 9 THEN 'https://open.spotify.com/user/abc'
  WHEN 10 THEN concat('https://www.beatport.com/track/a/', o_orderkey) ELSE concat('HTTPS://YOUTU.BE/', o_orderkey) END"""


@query("SELECT o_orderkey, o_orderkey % 12 IN (0, 3, 5, 8, 10, 11) AS on_a, o_orderkey % 12 IN (0, 1, 2, 3, 5, 6, 8, 10, 11) AS on_c FROM orders")
def music_link_rules(spark, sf):
    """Which links lead to releases, for profiles A and C."""
    u = X(_LINK)
    return table(spark, sf, "orders").select("o_orderkey", urls.is_music_link(u, "A").alias("on_a"), urls.is_music_link(u, "C").alias("on_c"))


_PAGE = """CASE o_orderkey % 8 WHEN 0 THEN concat('https://edm.com/music-releases/a-', o_orderkey) WHEN 1 THEN 'https://edm.com/music-releases/' WHEN 2 THEN concat('https://www.edmtunes.com/2026/04/t-', o_orderkey, '/')
  WHEN 3 THEN 'https://www.edmtunes.com/tag/2026/04/x' WHEN 4 THEN concat('https://weraveyou.com/2026/04/t-', o_orderkey) WHEN 5 THEN 'https://weraveyou.com/category/a' WHEN 6 THEN 'https://example.org/2026/04/x' ELSE 'https://www.edm.com/features/x' END"""


@query(f"SELECT o_orderkey, u LIKE '%//edm.com/music-releases/_%' AS a, u LIKE '%edmtunes.com/20__/__/%' AS b, u LIKE '%weraveyou.com/20__/__/%' AS c FROM (SELECT o_orderkey, {_PAGE} AS u FROM orders)")
def article_shapes(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", *[urls.looks_like_article(X(_PAGE), s.upper()).alias(s) for s in "abc"])


_SIXTEEN = "concat('abcdefghij', lpad(CAST(o_orderkey AS {text}), 8, '0'))"


@query(f"""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN '' ELSE {_SIXTEEN.format(text='VARCHAR')} END AS track, CASE WHEN o_orderkey % 2 = 0 THEN 'https://soundcloud.com/u/t' || o_orderkey ELSE '' END AS upload,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey::VARCHAR ELSE '' END AS upload_id FROM orders""")
def direct_ids(spark, sf):
    """Identifiers that stand in a record: in its bag, its address, or its links."""
    key = _SIXTEEN.format(text="STRING")
    bag = X(f"CASE o_orderkey % 4 WHEN 0 THEN concat('spotify:track:', {key}) WHEN 1 THEN {key} ELSE 'none at all' END")
    links = X(f"array('https://example.org', CASE WHEN o_orderkey % 4 = 2 THEN concat('https://open.spotify.com/track/', {key}, '?si=1') END, 'https://soundcloud.com/sets/x', CASE WHEN o_orderkey % 2 = 0 THEN concat('https://soundcloud.com/u/t', o_orderkey, '?x=1') END)")
    own = X("CASE WHEN o_orderkey % 3 = 0 THEN concat(' ', o_orderkey) ELSE concat('a', o_orderkey) END")
    return table(spark, sf, "orders").select("o_orderkey", urls.catalogue_track_id(bag, F.lit("https://example.org/a"), links).alias("track"), urls.upload_track_url(F.lit("https://example.org/a"), links).alias("upload"), urls.upload_track_id(own).alias("upload_id"))


@query(f"""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 4 THEN NULL ELSE {_SIXTEEN.format(text='VARCHAR')} END AS playlist, CASE o_orderkey % 3 WHEN 0 THEN 'https://soundcloud.com/u/sets/' || o_orderkey WHEN 1 THEN 'https://soundcloud.com/u' || o_orderkey || '/sets/b' ELSE NULL END AS upload_playlist,
  {_SIXTEEN.format(text='VARCHAR')} AS artist, CASE WHEN o_orderkey % 2 = 0 THEN {_SIXTEEN.format(text='VARCHAR')} END AS listed FROM orders""")
def playlist_addresses(spark, sf):
    key = _SIXTEEN.format(text="STRING")
    pl = X(f"CASE o_orderkey % 5 WHEN 0 THEN concat('spotify:playlist:', {key}) WHEN 1 THEN concat('https://open.spotify.com/playlist/', {key}, '?si=2') WHEN 2 THEN concat('https://open.spotify.com/x?playlist=', {key}) WHEN 3 THEN concat('  ', {key}) ELSE 'too short' END")
    up = X("CASE o_orderkey % 3 WHEN 0 THEN concat('https://soundcloud.com/u/sets/', o_orderkey) WHEN 1 THEN concat('/u', o_orderkey, '/sets/b/') ELSE 'https://example.org/x' END")
    ar = X(f"CASE o_orderkey % 3 WHEN 0 THEN concat('spotify:artist:', {key}) WHEN 1 THEN concat('https://open.spotify.com/artist/', {key}) ELSE {key} END")
    li = X(f"CASE WHEN o_orderkey % 2 = 0 THEN concat('https://example.org/en/artists/name/', {key}) ELSE 'https://example.org/artists/name/7' END")
    return table(spark, sf, "orders").select("o_orderkey", urls.catalogue_playlist_id(pl).alias("playlist"), urls.upload_playlist_url(up).alias("upload_playlist"), urls.catalogue_artist_id(ar).alias("artist"), urls.listing_artist_id(li).alias("listed"))


@query("""SELECT page_id, CASE WHEN page_id % 4 > 1 THEN regexp_replace(url, '^([a-z]+://[^/?#]*)/*([^?#]*[^/?#])/*([?#].*)?$', '\\1/\\2/page/' || (page_id % 4) || '/\\3') ELSE regexp_replace(url, '^([a-z]+://[^/?#]*)/*([^?#]*[^/?#])/*([?#].*)?$', '\\1/\\2/\\3') END AS page_url,
  regexp_replace(url, '^([a-z]+://[^/?#]*)/*([^?#]*[^/?#])/*([?#].*)?$', '\\1/\\2/feed/\\3') AS feed_url FROM pages WHERE regexp_matches(url, '^[a-z]+://[^/?#]+/+[^?#/]')""")
def listing_pages(spark, sf):
    """Addresses of a listing's further pages and of its feed."""
    p = table(spark, sf, "pages").where(F.col("url").rlike("^[a-z]+://[^/?#]+/+[^?#/]"))
    return p.select("page_id", urls.paginated(F.col("url"), X("page_id % 4")).alias("page_url"), urls.feed(F.col("url")).alias("feed_url"))


@query("""SELECT p_partkey, 'deep ' || split_part(p_name, ' ', 1) AS listed, CASE WHEN p_partkey % 2 = 0 THEN upper(left(split_part(p_name, ' ', 1), 1)) || lower(substr(split_part(p_name, ' ', 1), 2)) || ' House' ELSE 'House' END AS charted FROM part""")
def genre_of_address(spark, sf):
    first = X("split_part(p_name, ' ', 1)")
    listed = F.concat(F.lit("https://example.org/genres/deep-"), first)
    charted = F.when(X("p_partkey % 2 = 0"), F.concat(F.lit("https://example.org/genre/"), first, F.lit("-house/index.html"))).otherwise("https://example.org/")
    return table(spark, sf, "part").select("p_partkey", urls.genre_from_listing(listed).alias("listed"), urls.genre_from_chart(charted).alias("charted"))


# --- dates and numbers -----------------------------------------------------------------------------


@query("""SELECT o_orderkey, d AS written, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE make_date(year(d), CASE WHEN o_orderkey % 3 = 1 THEN month(d) ELSE 1 END, CASE WHEN o_orderkey % 3 = 1 THEN day(d) ELSE 1 END) END AS made, CASE WHEN o_orderkey % 3 = 0 THEN d ELSE make_date(year(d), CASE WHEN o_orderkey % 3 = 1 THEN month(d) ELSE 1 END, CASE WHEN o_orderkey % 3 = 1 THEN day(d) ELSE 1 END) END AS track_day,
  d AS mentioned, d AS from_millis FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)""")
def release_dates(spark, sf):
    """Written, structured, mentioned and counted dates."""
    day = F.to_date("o_orderdate")
    wr = F.when(X("o_orderkey % 2 = 0"), F.date_format(day, "yyyy/MM/dd HH:mm")).otherwise(F.date_format(day, "yyyy-MM-dd"))
    part = lambda f: F.when(X("o_orderkey % 3 = 1"), f(day)).when(X("o_orderkey % 3 = 2"), F.lit(0))
    y = F.when(X("o_orderkey % 3 <> 0"), F.year(day))
    said = F.concat(F.lit("Out on "), F.date_format(day, "MMMM d, yyyy"), F.lit(" worldwide"))
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.release_date(F.lit(""), wr).alias("written"), dates.structured_date(y, part(F.month), part(F.day)).alias("made"), dates.track_date(y, part(F.month), part(F.day), F.lit(None).cast("string"), wr).alias("track_day"),
        dates.date_in_text(said).alias("mentioned"), dates.millis_date(F.unix_millis(F.to_timestamp(day)) + 3_600_000).alias("from_millis"),
    )


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN floor(o_totalprice)::BIGINT::VARCHAR ELSE printf('%.2f', o_totalprice) END AS written, o_orderdate::DATE <= DATE '1998-06-01' AS released FROM orders WHERE o_orderkey % 2 = 0 OR o_totalprice <> floor(o_totalprice)")
def written_numbers(spark, sf):
    o = table(spark, sf, "orders").where("o_orderkey % 2 = 0 or o_totalprice <> floor(o_totalprice)")
    v = F.when(X("o_orderkey % 2 = 0"), F.floor("o_totalprice").cast("double")).otherwise(F.col("o_totalprice"))
    return o.select("o_orderkey", numbers.number_string(v).alias("written"), filters.not_in_future(F.to_date("o_orderdate"), "1998-06-01").alias("released"))


@query("SELECT c_custkey, least(1.0, 0.65 + CASE WHEN c_acctbal >= 2000 THEN 0.15 ELSE 0 END + CASE WHEN c_nationkey >= 20 THEN 0.10 ELSE 0 END + CASE WHEN c_mktsegment = 'MACHINERY' THEN 0.05 ELSE 0 END)::DOUBLE AS points, least(1.0, greatest(0.0, c_acctbal / 10000 + CASE WHEN c_custkey % 2 = 0 THEN 0.2 ELSE 0 END + CASE WHEN c_custkey % 3 = 0 THEN 0.1 ELSE 0 END))::DOUBLE AS article FROM customer")
def confidence_rules(spark, sf):
    some = lambda n: F.when(X(f"c_custkey % {n} = 0"), F.array(F.lit("x")))
    points = extract.rubric(0.65, (F.col("c_acctbal") >= 2000, 0.15), (F.col("c_nationkey") >= 20, 0.10), (F.col("c_mktsegment") == "MACHINERY", 0.05))
    return table(spark, sf, "customer").select("c_custkey", points.alias("points"), extract.article_score(F.col("c_acctbal") / 10000, some(2), some(3)).alias("article"))


# --- operators ----------------------------------------------------------------------------------------


@query("SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE') AND c_mktsegment <> 'MACHINERY' AND c_acctbal >= 0")
def source_choice(spark, sf):
    rows = table(spark, sf, "customer").withColumn("api_source", F.col("c_acctbal") < 0)
    return filters.chosen(rows, "c_mktsegment", ["BUILDING", "MACHINERY", "FURNITURE"], ["MACHINERY"], False).select("c_custkey")


@query("SELECT event_id, coalesce(event_type, '') <> '' AND event_id % 3 = 0 OR event_id % 5 = 0 AS linked FROM events")
def platform_links(spark, sf):
    linked = filters.has_platform_link(X("CASE WHEN event_id % 3 = 0 THEN event_type END"), X("CASE WHEN event_id % 5 = 0 THEN 'x' ELSE '' END"))
    return table(spark, sf, "events").select("event_id", linked.alias("linked"))


@query("SELECT r_name AS parent, coalesce(nullif(string_agg(n_name, '|' ORDER BY n_name), ''), r_name) AS names FROM region LEFT JOIN nation ON n_regionkey = r_regionkey WHERE r_regionkey = 0 GROUP BY r_name UNION ALL SELECT 'NOWHERE', 'NOWHERE'")
def parent_genres(spark, sf):
    """Children of a parent, and a parent without any."""
    g = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("parent"), F.col("n_name").alias("name"))
    known = table(spark, sf, "region").where("r_regionkey = 0").first()["r_name"]
    named = lambda p: charts.subgenres(g, p).select(F.lit(p).alias("parent"), F.array_join(F.array_sort("names"), "|").alias("names"))
    return named(known).unionByName(named("NOWHERE"))


_NOW = 1705330800000 + 1234  # within 2024-01-15T15:00Z


@query("""SELECT event_id, true AS summary FROM events WHERE epoch_ms(ts) >= 1705330800000 - 192 * 3600000 AND (event_id % 3 <> 0 OR event_id % 2 = 0) AND value >= 2 AND event_id % 7 <> 0 AND event_type IN ('click', 'view')
  UNION ALL SELECT event_id, false FROM events WHERE epoch_ms(ts) >= 1705330800000 - 2592000000 AND (event_id % 3 <> 0 OR event_id % 2 = 0)""")
def popular_rows(spark, sf):
    """Active summaries of some genres, and tracks released lately."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    week = F.when(X("event_id % 3 = 0"), F.when(X("event_id % 2 = 0"), F.lit(_NOW)).otherwise(F.lit(0)))
    e = table(spark, sf, "events").select("event_id", ms.alias("updated"), ms.alias("released"), week.alias("popular_week"), F.col("value").alias("points"), X("event_id % 7 = 0").alias("hidden"), F.array("event_type").alias("top_3"))
    names = spark.createDataFrame([(["click", "view"],)], "names array<string>")
    return charts.popular(e, names, _NOW).select("event_id", F.lit(True).alias("summary")).unionByName(charts.popular_tracks(e, _NOW).select("event_id", F.lit(False).alias("summary")))


@query("SELECT o_custkey, arg_min(o_orderkey, o_totalprice * 100000000 + o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey")
def first_hits(spark, sf):
    o = table(spark, sf, "orders").withColumn("pos", F.col("o_totalprice") * 100000000 + F.col("o_orderkey"))
    return match.first_hit(o, "o_custkey", "o_orderkey", "pos")


@query("SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus, min(o_orderkey) AS pos FROM orders GROUP BY o_custkey")
def candidate_unions(spark, sf):
    """Candidates by key: the last version, at the first place."""
    return match.candidate_union(table(spark, sf, "orders").select("o_custkey", "o_orderstatus", F.col("o_orderkey").alias("pos")), ["o_custkey"], "pos")


_FOLLOWERS = "CAST(c_acctbal * 20 AS BIGINT)"


@query(f"""WITH s AS (SELECT c_nationkey AS query_id, c_custkey AS id, round(least(1.0, CASE WHEN c_custkey % 4 = 0 THEN 0.65 WHEN c_custkey % 4 = 1 THEN 0.35 ELSE 0.0 END + CASE WHEN c_custkey % 3 = 0 THEN 0.25 WHEN c_custkey % 3 = 1 THEN 0.20 ELSE 0.0 END
  + CASE WHEN f >= 100000 THEN 0.10 WHEN f >= 10000 THEN 0.06 WHEN f >= 1000 THEN 0.03 ELSE 0.0 END + CASE WHEN c_custkey % 5 = 0 THEN 0.10 ELSE 0.0 END), 6)::DOUBLE AS score FROM (SELECT *, {_FOLLOWERS} AS f FROM customer) WHERE c_custkey % 13 <> 0)
  SELECT query_id, id, round(score, 3) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id DESC) AS n FROM s) WHERE n = 1 AND score >= 0.72""")
def best_users(spark, sf):
    """The user that best fits an artist's name; the last of equals."""
    name = F.concat(F.lit("North Star "), F.col("c_nationkey"))
    user = F.when(X("c_custkey % 4 = 0"), F.upper(name)).when(X("c_custkey % 4 = 1"), F.concat(F.lit("the "), name)).otherwise("someone")
    link = F.when(X("c_custkey % 3 = 0"), F.replace(name, F.lit(" "), F.lit("-"))).when(X("c_custkey % 3 = 1"), F.replace(name, F.lit(" "), F.lit(""))).otherwise("x")
    c = table(spark, sf, "customer")
    users = c.select(F.col("c_nationkey").alias("query_id"), F.col("c_custkey").alias("id"), F.col("c_custkey").alias("pos"), user.alias("username"), link.alias("permalink"), X(_FOLLOWERS).alias("followers_count"), X("c_custkey % 5 = 0").alias("verified"), X("CASE WHEN c_custkey % 13 <> 0 THEN 'https://x' END").alias("permalink_url"))
    return match.best_user(c.select(F.col("c_nationkey").alias("query_id"), name.alias("artist")).distinct(), users).select("query_id", "id", "score")


_GOOD = "p_partkey % 4 IN (0, 1) AND p_partkey % 3 <> 1 AND p_partkey % 5 <> 2"


def _payloads(parts, key: str):
    """Uploads made of parts: title, uploader and date fit or do not."""
    title = F.when(X("p_partkey % 4 = 0"), F.col("p_name")).when(X("p_partkey % 4 = 1"), F.concat(F.upper("p_name"), F.lit(" (Original Mix)"))).otherwise("quite another")
    by = F.when(X("p_partkey % 3 = 1"), F.lit("Someone")).otherwise(F.col("p_brand"))
    day = F.when(X("p_partkey % 5 = 2"), F.lit("2020-01-01")).when(X("p_partkey % 5 = 3"), F.lit("2026-01-30T00:00:00Z"))
    none = lambda c, t: F.lit(None).cast(t).alias(c)
    return parts.select(
        F.col("p_partkey").alias(key), F.col("p_partkey").alias("pos"), title.alias("title"), by.alias("publisher_artist"), none("writer_composer", "string"), F.lit("uploader").alias("username"), F.lit("uploads").alias("permalink"), F.lit(0).alias("playback_count"),
        none("release_year", "int"), none("release_month", "int"), none("release_day", "int"), day.alias("release_date"), none("display_date", "string"), none("created_at", "string"),
    )


@query(f"SELECT p_partkey AS query_id, p_partkey % 2 = 0 AS by_version, {_GOOD} AS by_payload FROM part")
def cache_trust(spark, sf):
    """Which cached links are trusted: by version, or because the present upload still fits."""
    parts = table(spark, sf, "part")
    cached = parts.select(F.col("p_partkey").alias("query_id"), F.col("p_brand").alias("artist"), F.col("p_name").alias("title"), F.col("p_partkey").alias("soundcloud_track_id"))
    good = match.trusted_uploads(cached, _payloads(parts, "soundcloud_track_id"), AS_OF, 7).withColumn("by_payload", F.lit(True))
    version = match.trusted_catalogue(X("CASE WHEN p_partkey % 2 = 0 THEN 'strict_v3_date_checked' WHEN p_partkey % 4 = 1 THEN 'old' END"))
    return parts.select(F.col("p_partkey").alias("query_id"), version.alias("by_version")).join(good, "query_id", "left").withColumn("by_payload", F.coalesce("by_payload", F.lit(False)))


@query(f"""SELECT p_partkey AS query_id, CASE WHEN p_partkey % 10 = 0 THEN 'c' || p_partkey WHEN p_partkey % 50 >= 41 THEN NULL WHEN p_partkey % 6 = 1 THEN CASE WHEN p_partkey % 4 = 1 THEN 'd' || p_partkey END WHEN p_partkey % 4 IN (0, 1) THEN 's' || p_partkey END AS spotify_id,
  CASE WHEN p_partkey % 8 = 3 THEN CASE WHEN p_partkey % 16 = 3 THEN 'r' || p_partkey END WHEN {_GOOD} THEN 'u' || p_partkey WHEN p_partkey % 2 = 0 THEN 'f' || p_partkey END AS upload,
  CASE WHEN p_partkey % 8 = 3 THEN 'https://soundcloud.com/u/t' || p_partkey WHEN {_GOOD} THEN 'https://up/' || p_partkey WHEN p_partkey % 2 = 0 THEN 'https://f/' || p_partkey END AS upload_url,
  CASE WHEN p_partkey % 10 <> 0 AND p_partkey % 50 >= 41 THEN CASE WHEN p_partkey % 50 = 41 THEN 'spotify_resolution_rate_limited' ELSE 'spotify_resolution_deferred' END ELSE '' END AS notes FROM part""")
def resolved_links(spark, sf):
    """Links of records: cached, direct, searched, by profile, or put off."""
    p = dealt(spark, sf, "part", "p_partkey")
    none = F.lit(None).cast("string")
    rank = X("cast(p_partkey % 50 as int)")
    rows = p.select(
        F.col("p_partkey").alias("query_id"), rank.alias("rank"), F.col("p_brand").alias("artist"), F.col("p_name").alias("title"), F.create_map(F.lit("x"), F.lit("y")).alias("open_graph"),
        X("CASE WHEN p_partkey % 6 = 1 THEN concat('https://open.spotify.com/track/d', p_partkey) END").alias("source_article_url"), X("CASE WHEN p_partkey % 8 = 3 THEN array('x', concat('https://soundcloud.com/u/t', p_partkey)) END").alias("embedded_music_links"),
        X("CASE WHEN p_partkey % 10 = 0 THEN concat('c', p_partkey) END").alias("spotify_id"), none.alias("spotify_uri"), none.alias("soundcloud_track_id"), none.alias("soundcloud_url"),
    )
    songs = p.select(
        "p_partkey", F.lit(0).alias("pos"), X("CASE WHEN p_partkey % 4 IN (0, 1) THEN p_name ELSE 'no such song' END").alias("name"), F.array("p_brand").alias("artist_names"), F.lit(80).alias("popularity"),
        F.lit("2026-01-30").alias("release_date"), F.lit("day").alias("release_date_precision"),
    )
    searched = songs.withColumns({"query_id": F.col("p_partkey"), "id": F.concat(F.lit("s"), "p_partkey")}).drop("p_partkey")
    direct = songs.withColumn("id", F.concat(F.lit("d"), "p_partkey")).drop("p_partkey", "pos")
    ups = _payloads(p, "query_id").withColumns({"id": F.concat(F.lit("u"), "query_id"), "permalink_url": F.concat(F.lit("https://up/"), "query_id")})
    known = p.select(F.concat(F.lit("https://soundcloud.com/u/t"), "p_partkey").alias("url"), X("CASE WHEN p_partkey % 16 = 3 THEN 'track' ELSE 'playlist' END").alias("kind"), F.concat(F.lit("r"), "p_partkey").alias("id"), F.lit("").alias("permalink_url"))
    users = p.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("query_id"), F.col("p_partkey").alias("user_id"), F.upper("p_brand").alias("username"), F.lit("u").alias("permalink"), none.alias("full_name"))
    own = _payloads(p, "user_id").join(p.select(F.col("p_partkey").alias("user_id"), F.col("p_name").alias("_t"), F.col("p_brand").alias("_b")), "user_id")
    own = own.withColumns({"title": F.col("_t"), "publisher_artist": F.col("_b"), "release_date": none, "id": F.concat(F.lit("f"), "user_id"), "permalink_url": F.concat(F.lit("https://f/"), "user_id")}).drop("_t", "_b")
    out = match.resolve(rows, searched, ups, AS_OF, 7, 41, direct, known, users, own)
    return out.select("query_id", "spotify_id", F.col("soundcloud_track_id").alias("upload"), F.col("soundcloud_url").alias("upload_url"), F.array_join("notes", ",").alias("notes"))


@query("SELECT p_partkey AS query_id, p_partkey * 10 AS track FROM part WHERE p_partkey % 3 <> 1")
def profile_tracks(spark, sf):
    """Tracks of the users that an artist is likely to be."""
    p = dealt(spark, sf, "part", "p_partkey")
    user = F.when(X("p_partkey % 3 = 1"), F.lit("Someone")).otherwise(F.upper("p_brand"))
    users = p.select(F.col("p_partkey").alias("query_id"), F.col("p_partkey").alias("user_id"), user.alias("username"), F.lit("u").alias("permalink"), F.lit(None).cast("string").alias("full_name"))
    tracks = p.select(F.col("p_partkey").alias("user_id"), X("p_partkey * 10").alias("track"))
    return match.profile_candidates(p.select(F.col("p_partkey").alias("query_id"), F.col("p_brand").alias("artist")), users, tracks).select("query_id", "track")


@query("""SELECT source || '/' || (doc_id % 50) AS url, arg_min(lang, doc_id) FILTER (coalesce(lang, '') <> '') AS title, arg_min(CASE WHEN doc_id % 3 = 0 THEN md5(text) END, doc_id) FILTER (doc_id % 3 = 0 AND text IS NOT NULL) AS snippet FROM documents WHERE source IS NOT NULL GROUP BY 1""")
def merged_cards(spark, sf):
    """Cards by address, each field from the first card that fills it."""
    d = table(spark, sf, "documents").where("source is not null")
    cards = d.select(F.concat("source", F.lit("/"), X("doc_id % 50")).alias("url"), F.col("lang").alias("title"), F.when(X("doc_id % 3 = 0"), F.md5("text")).alias("snippet"), F.col("doc_id").alias("ordinal"))
    return dedupe.merge_cards(cards).select("url", "title", "snippet")


@query("""SELECT p_brand AS artist, p_name AS track_or_project_title, CASE WHEN contains(lower(p_name), 'remix') THEN 'remix' ELSE 'track' END AS release_type, p_brand || ' - ' || p_name AS source_article_title, p_partkey::VARCHAR AS chart_rank, 'p' || p_size AS chart_metric FROM part""")
def chart_release_rows(spark, sf):
    none = F.lit(None).cast("string")
    t = table(spark, sf, "part").select(F.col("p_brand").alias("artist"), F.col("p_name").alias("title"), F.col("p_partkey").alias("rank"), F.lit("Top").alias("chart_name"), F.lit("day").alias("chart_window"), F.concat(F.lit("p"), "p_size").alias("chart_metric"), none.alias("label"), none.alias("label_href"), none.alias("track_href"), F.lit(0.8).alias("confidence"))
    return charts.chart_releases(t).select("artist", "track_or_project_title", "release_type", "source_article_title", F.col("open_graph")["chart_rank"].alias("chart_rank"), F.col("open_graph")["chart_metric"].alias("chart_metric"))


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders) WHERE n <= 1 + o_custkey % 4")
def limit_per_target(spark, sf):
    o = table(spark, sf, "orders").withColumn("lim", X("1 + o_custkey % 4"))
    return records.first_per_target(o, "o_custkey", "lim", "o_orderkey").select("o_custkey", "o_orderkey")


@query("SELECT user_id AS cursor, event_id AS page, pos::INTEGER AS pos, (event_id + pos)::BIGINT AS item FROM (SELECT user_id, event_id, pos, row_number() OVER (PARTITION BY user_id ORDER BY event_id, pos) AS n FROM events, (SELECT unnest([0, 1, 2]) AS pos)) WHERE n <= 7")
def collection_pages(spark, sf):
    """Items of paged collections, bounded by collection."""
    pages = table(spark, sf, "events").select(F.col("user_id").alias("cursor"), F.col("event_id").alias("page"), F.parse_json(F.to_json(F.array(F.col("event_id"), F.col("event_id") + 1, F.col("event_id") + 2))).alias("items"))
    return records.paged_items(pages, 7).select("cursor", "page", "pos", F.variant_get("item", "$", "bigint").alias("item"))


@query("""SELECT p_partkey, c.p_brand AS artist, p_name AS title, 'later' AS logged_at FROM part c WHERE p_partkey >= 50 AND p_partkey % 2 = 0""")
def put_off(spark, sf):
    """Records whose catalogue link was refused or deferred."""
    p = table(spark, sf, "part")
    notes = F.when(X("p_partkey >= 50 and p_partkey % 2 = 0"), F.array(F.lit("x"), F.lit("spotify_resolution_deferred"))).otherwise(F.array(F.lit("x")))
    rows = p.select(F.col("p_partkey").alias("rank"), F.col("p_brand").alias("artist"), F.col("p_name").alias("title"), notes.alias("notes"))
    return match.backlog(rows, "later").withColumnRenamed("rank", "p_partkey")


@query("SELECT c_name AS artist_name, c_mktsegment || ' | ' || c_nationkey AS genres, CASE WHEN c_acctbal < 0 THEN '' ELSE c_custkey::VARCHAR END AS rank FROM customer")
def artist_rows(spark, sf):
    """Artist rows as they go to a CSV file."""
    c = table(spark, sf, "customer").select(F.col("c_name").alias("artist_name"), F.array("c_mktsegment", F.col("c_nationkey").cast("string")).alias("genres"), F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("rank"))
    return sinks.artist_csv_rows(c).select("artist_name", "genres", "rank")
