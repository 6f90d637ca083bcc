"""Registered queries, continued: search, capped selection and crawls over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import match, search, select
from ..operators.components import checkpointed
from ..sources import cache, crawl, delivery, profiles
from .pipeline import PipelineConfig, Source, extract_releases, rank, run_isolated
from .queries import _NORM, _RECORDS, AS_OF, dealt, document_records, query, table
from .source_queries import _LINE

X = F.expr

# --- search ---------------------------------------------------------------------------------------


def _sql_search(catalogue: str, asked: str, k: int) -> str:
    """CTEs up to ``hits`` (query, doc, score, place): every row compared with every query by shared words."""
    return f"""cat AS (SELECT p_partkey AS doc, unnest(list_distinct(string_split({_NORM.format(catalogue)}, ' '))) AS word FROM part),
  stats AS (SELECT word, floor(1000 * ln(1 + (SELECT count(DISTINCT doc) FROM cat)::DOUBLE / count(*)))::BIGINT AS weight FROM cat GROUP BY word),
  ask AS (SELECT p_partkey AS query, unnest(list_distinct(string_split({_NORM.format(asked)}, ' '))) AS word FROM part),
  sums AS (SELECT query, doc, sum(weight)::BIGINT AS score FROM ask JOIN stats USING (word) JOIN cat USING (word) GROUP BY query, doc),
  hits AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc) AS place FROM sums) WHERE place <= {k})"""


@query(f"WITH {_sql_search('concat_ws(chr(32), p_name, p_type, p_brand, p_size)', 'concat_ws(chr(32), p_name, p_brand, p_size)', 5)} SELECT query AS query_id, doc, score, place::INTEGER AS place FROM hits")
def search_best(spark, sf):
    """The five best parts for what each part is called, by the index."""
    p = table(spark, sf, "part")
    index = search.token_index(p, "p_partkey", X("concat_ws(' ', p_name, p_type, p_brand, p_size)"), 5)
    return search.search(p.withColumnRenamed("p_partkey", "query_id"), index, X("concat_ws(' ', p_name, p_brand, p_size)"))


@query(f"""WITH {_sql_search('concat_ws(chr(32), p_brand, p_name)', 'concat_ws(chr(32), p_brand, p_name)', search.TRACKS)},
  n AS (SELECT p_partkey, {_NORM.format('p_name')} AS t, {_NORM.format('p_brand')} AS b, p_size AS sz FROM part),
  s AS (SELECT query, doc, place, CASE WHEN a.t = c.t THEN 1.0 WHEN contains(c.t, a.t) THEN 0.86 WHEN contains(c.b || ' ' || c.t, a.t) THEN 0.74 ELSE 0.0 END AS ts,
      CASE WHEN a.b = c.b THEN 1.0 WHEN contains(c.b, a.b) OR contains(a.b, c.b) THEN 0.84 ELSE 0.0 END AS ar, least(c.sz / 50.0, 1.0) AS pl FROM hits JOIN n a ON a.p_partkey = query JOIN n c ON c.p_partkey = doc),
  v AS (SELECT query, doc, ts * 0.55 + ar * 0.40 + pl * 0.05 AS score, place FROM s WHERE ts >= 0.72 AND ar >= 0.72)
  SELECT query AS query_id, doc AS id, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, place) AS n FROM v) WHERE n = 1 AND score >= 0.76""")
def searched_matches(spark, sf):
    """The best upload for each part among what a search for its make and name finds."""
    p = table(spark, sf, "part")
    records = p.select(F.col("p_partkey").alias("query_id"), F.col("p_brand").alias("artist"), F.col("p_name").alias("title"))
    s, i = F.lit(None).cast("string"), F.lit(None).cast("int")
    tracks = p.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_brand").alias("publisher_artist"), s.alias("writer_composer"), s.alias("username"), s.alias("permalink"), (F.col("p_size") * 20_000).alias("playback_count"),
        i.alias("release_year"), i.alias("release_month"), i.alias("release_day"), s.alias("release_date"), s.alias("display_date"), s.alias("created_at"),
    )
    best = lambda asked, found: match.best_upload_match(asked, found, AS_OF, 7).select("query_id", "id", F.round("score", 6).alias("score"))
    return search.searched_matches(records, tracks, F.concat_ws(" ", "publisher_artist", "title"), best)


# --- capped selection -------------------------------------------------------------------------------


def _sql_kept(primary: int, associated: int) -> str:
    """CTEs up to ``told`` (pool's columns, why): each step finds the next row that both caps admit. pool: rank, artist, keys, note."""
    full = lambda names, one, n: f"len(list_filter({names}, lambda x: x = {one})) >= {n}"
    return f"""free AS MATERIALIZED (SELECT * FROM pool WHERE note IS NULL),
  walk(rank, artists, used) AS (SELECT 0::BIGINT, []::VARCHAR[], []::VARCHAR[] UNION ALL
    SELECT p.rank, list_append(w.artists, p.artist), list_concat(w.used, p.keys) FROM (
      SELECT w.artists, w.used, min(p.rank) AS upto FROM walk w JOIN free p ON p.rank > w.rank AND NOT ({full('w.artists', 'p.artist', primary)}) AND len(list_filter(p.keys, lambda k: {full('w.used', 'k', associated)})) = 0
      GROUP BY w.artists, w.used) w JOIN free p ON p.rank = w.upto),
  kept AS (SELECT p.* FROM walk JOIN pool p USING (rank)),
  a_full AS (SELECT artist, rank AS upto FROM (SELECT artist, rank, row_number() OVER (PARTITION BY artist ORDER BY rank) AS n FROM kept) WHERE n = {primary}),
  k_full AS (SELECT k, rank AS upto FROM (SELECT k, rank, row_number() OVER (PARTITION BY k ORDER BY rank) AS n FROM (SELECT rank, unnest(keys) AS k FROM kept)) WHERE n = {associated}),
  late AS (SELECT rank, arg_min(k, i) AS k FROM (SELECT rank, unnest(keys) AS k, generate_subscripts(keys, 1) AS i FROM free) JOIN k_full USING (k) WHERE rank > upto GROUP BY rank),
  told AS (SELECT p.*, CASE WHEN note IS NOT NULL THEN note WHEN p.rank > a.upto THEN 'skipped_artist_cap_{primary}' WHEN late.k IS NOT NULL THEN 'skipped_associated_artist_cap_{associated}:' || late.k END AS why
    FROM pool p LEFT JOIN a_full a ON a.artist = p.artist LEFT JOIN late ON late.rank = p.rank)"""


@query(f"""WITH RECURSIVE pool AS MATERIALIZED (SELECT row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rank, 'n' || s_nationkey AS artist, [p_brand || '-' || p_size, p_type || '-' || l_linenumber] AS keys,
    CASE WHEN l_returnflag = 'R' AND l_discount > 0.08 THEN 'returned' END AS note FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey), {_sql_kept(3, 2)}
  SELECT rank, artist AS artist_key, why AS note FROM told""")
def greedy_caps_all(spark, sf):
    """Both caps over every line item, dearest first: three of a supplier's nation, two of a make and size or a type and line."""
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_size", "p_type")
    nations = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.concat(F.lit("n"), "s_nationkey").alias("artist_key"))
    order = ["_price", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    vetoed = F.when((F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.08), "returned")
    lines = table(spark, sf, "lineitem").select((-F.col("l_extendedprice")).alias("_price"), *order[1:], vetoed.alias("note"))
    keys = F.array(X("concat(p_brand, '-', p_size)"), X("concat(p_type, '-', l_linenumber)"))
    lines = lines.join(p, "l_partkey").join(nations, "l_suppkey").select(*order, "note", "artist_key", keys.alias("associated_keys"))
    pool = select.numbered(lines, order, "rank").select("rank", "note", "artist_key", "associated_keys")
    return select.greedy_caps(pool, 3, 2).select("rank", "artist_key", "note")


@query(f"""WITH RECURSIVE t AS (SELECT p_partkey + 1 AS rank, p_brand || ' ' || p_size % 9 AS artist, p_name || CASE WHEN p_partkey % 3 = 0 THEN ' (Extended Mix)' ELSE '' END AS title, p_partkey % 7 <> 0 AS link, p_partkey % 11 = 5 AS slow, p_partkey % 13 = 2 AS old_code,
      {_NORM.format("p_brand || ' ' || p_size % 9")} AS a, {_NORM.format("p_name")} AS base, {_NORM.format("p_type || ' ' || p_partkey % 40")} AS other, p_retailprice AS sc FROM part),
  v AS (SELECT *, row_number() OVER (PARTITION BY a, base ORDER BY CASE WHEN rank % 3 = 1 THEN 0 ELSE 1 END DESC, link DESC, sc DESC, rank) AS n FROM t),
  pool AS MATERIALIZED (SELECT rank, a AS artist, [a, other] AS keys, CASE WHEN n > 1 THEN 'skipped_duplicate_version' WHEN slow THEN 'skipped_unwanted_speed_variant' WHEN old_code THEN 'skipped_old_isrc_year' WHEN NOT link THEN 'skipped_no_verified_platform_link' END AS note FROM v),
  {_sql_kept(2, 3)}
  SELECT rank, why AS note, CASE WHEN why IS NULL THEN row_number() OVER (PARTITION BY why IS NULL ORDER BY rank) END AS playlist_rank FROM told""")
def curated_parts(spark, sf):
    """A playlist's whole curation over every part: versions, vetoes, caps, ranks."""
    credit = X("concat(p_brand, ' ', p_size % 9)")
    bag = F.create_map(
        F.lit("all_artists"), F.concat(credit, F.lit(", "), X("concat(p_type, ' ', p_partkey % 40)")), F.lit("isrc"), X("CASE WHEN p_partkey % 13 = 2 THEN 'QZABC1900001' ELSE 'QZABC2600001' END"),
        F.lit("tag_list"), X("CASE WHEN p_partkey % 11 = 5 THEN 'slowed reverb' ELSE 'x' END"),
    )
    text = F.lit("").alias
    tracks = dealt(spark, sf, "part", "p_partkey").select(
        (F.col("p_partkey") + 1).alias("rank"), credit.alias("artist"), X("concat(p_name, CASE WHEN p_partkey % 3 = 0 THEN ' (Extended Mix)' ELSE '' END)").alias("title"), F.col("p_retailprice").alias("ranking_score"),
        X("CASE WHEN p_partkey % 7 <> 0 THEN concat('spotify:track:', p_partkey) END").alias("spotify_uri"), X("cast(null as string)").alias("spotify_id"), X("cast(null as string)").alias("soundcloud_track_id"),
        text("soundcloud_url"), text("source_article_title"), text("source_article_url"), bag.alias("open_graph"),
    )
    return select.curate(tracks, AS_OF).select("rank", "note", "playlist_rank")


# --- crawls -----------------------------------------------------------------------------------------

_LISTING = """concat('<div><h2><a href=\\'/music-releases/a-', p_partkey, '\\'>', p_brand, ' drops the ', p_name, ' single</a></h2><p>April ', 1 + p_partkey % 28, ', 2026</p></div>',
  CASE WHEN p_size % 5 = 0 THEN '' ELSE concat('<button data-url=\\'/list/', (p_partkey * 7 + p_size) % 211, '\\'>Load More</button>') END)"""
_REACHED = """step AS (SELECT p_partkey AS k, CASE WHEN p_size % 5 <> 0 THEN (p_partkey * 7 + p_size) % 211 END AS nxt, 1 + p_partkey % 28 AS d, p_brand || ' drops the ' || p_name || ' single' AS title FROM part),
  walk(crawl, n, k, seen) AS (SELECT k, 1, k, []::BIGINT[] FROM step UNION ALL
    SELECT w.crawl, w.n + 1, t.k, list_append(w.seen, t.k) FROM walk w JOIN step s ON s.k = w.k JOIN step t ON t.k = s.nxt WHERE w.n < 6 AND NOT list_contains(w.seen, t.k)),
  used AS (SELECT w.*, d, title, min(CASE WHEN d < 4 THEN n END) OVER (PARTITION BY crawl) AS stop FROM walk w JOIN step USING (k))"""


def _listings(spark, sf):
    p = dealt(spark, sf, "part", "p_partkey")
    at = F.concat(F.lit("https://edm.com/list/"), F.col("p_partkey"))
    html = F.when(F.col("p_partkey") % 2 == 1, F.concat(F.lit('{"html": "'), X(_LISTING), F.lit('"}'))).otherwise(X(_LISTING))
    return p.select(at.alias("url"), html.alias("html")), p.select(F.col("p_partkey").alias("crawl"), at.alias("url"))


@query(f"""WITH RECURSIVE {_REACHED} SELECT crawl, min(n)::INTEGER AS n, 'https://edm.com/music-releases/a-' || k AS url, any_value(title) AS title, make_date(2026, 4, any_value(d)::INTEGER)::VARCHAR AS publish_date
  FROM used WHERE d >= 4 AND n <= coalesce(stop, 6) GROUP BY crawl, k""")
def crawl_cards(spark, sf):
    """Cards of a crawl from each part's listing, along its next-links."""
    recorded, seeds = _listings(spark, sf)
    return crawl.crawl(recorded, seeds, "A", "music", "2026-04-04", 6)[0].select("crawl", "n", "url", "title", "publish_date")


@query(f"WITH RECURSIVE {_REACHED} SELECT crawl, count(*) AS pages, 'https://edm.com/list/' || arg_max(k, n) AS last FROM used WHERE n <= coalesce(stop, 6) GROUP BY crawl")
def crawl_reach(spark, sf):
    """How far each of these crawls goes."""
    recorded, seeds = _listings(spark, sf)
    return crawl.crawl(recorded, seeds, "A", "music", "2026-04-04", 6)[1].select("crawl", "pages", "last")


@query("""WITH p AS (SELECT *, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) AS n FROM part), c AS (SELECT p_brand || p_type AS crawl, n, p_size % 9 AS slug, n % 8 = 7 AS old, p_partkey FROM p WHERE n <= 9),
  f AS (SELECT *, n = min(CASE WHEN NOT old THEN n END) OVER (PARTITION BY crawl, slug) AS fresh FROM c),
  s AS (SELECT crawl, coalesce(min(CASE WHEN old OR NOT coalesce(fresh, false) THEN n END), max(n)) AS stop FROM f GROUP BY crawl)
  SELECT crawl, min(n)::INTEGER AS n, 'https://weraveyou.com/2026/04/t-' || slug AS url, arg_min('Long title of part ' || p_partkey, n) AS title FROM c JOIN s USING (crawl) WHERE NOT old AND n <= stop GROUP BY crawl, slug""")
def crawl_numbered(spark, sf):
    """Cards of numbered archive pages, one crawl for each make and type, up to the first page without a new card."""
    n = F.row_number().over(Window.partitionBy("p_brand", "p_type").orderBy("p_partkey"))
    p = dealt(spark, sf, "part", "p_partkey").withColumn("n", n)
    base = X("concat('https://weraveyou.com/', replace(p_brand, '#', ''), '/', p_type, '/')")
    page = X("concat('<p><a href=\"/2026/04/t-', p_size % 9, '\">March ', CASE WHEN n % 8 = 7 THEN 1 ELSE 9 END, ', 2026 Long title of part ', p_partkey, '</a></p>')")
    recorded = p.select(F.when(F.col("n") == 1, base).otherwise(F.concat(base, F.lit("page/"), "n", F.lit("/"))).alias("url"), page.alias("html"))
    seeds = p.select(F.concat("p_brand", "p_type").alias("crawl"), base.alias("url")).distinct()
    return crawl.crawl(recorded, seeds, "C", "house", "2026-03-05", 9)[0].select("crawl", "n", "url", "title")


# --- refusals, cache, delivery, isolation ---------------------------------------------------------------

_FIRST = "(SELECT event_type AS t, min(event_id) AS first FROM events WHERE value >= 3 AND value < 5 AND user_id % 3 = 0 GROUP BY 1)"


@query(f"SELECT event_id, CASE WHEN event_id = first THEN 'rate_limited' WHEN event_id > first THEN 'deferred' END AS state FROM events LEFT JOIN {_FIRST} ON t = event_type WHERE value >= 3")
def breaker_calls(spark, sf):
    """Events as calls of the interface that is their type: refused where cheap, not made where cheaper."""
    e = table(spark, sf, "events").select(F.col("event_id").alias("query_id"), F.col("event_type").alias("interface"), "value", "user_id")
    refusals = e.where("value < 5 and user_id % 3 = 0")
    return match.breaker(e.where("value >= 3"), refusals, "query_id").select(F.col("query_id").alias("event_id"), F.col("breaker").alias("state"))


@query("""WITH p AS (SELECT p_partkey + 1 AS rank, p_partkey % 10 = 0 AS cached, p_partkey % 97 = 41 OR p_partkey % 97 = 30 AS refused FROM part), f AS (SELECT min(rank) AS first FROM p WHERE refused AND NOT cached)
  SELECT rank, CASE WHEN cached THEN 'c' || rank WHEN rank < first OR first IS NULL THEN 's' || rank END AS spotify_id, CASE WHEN cached OR rank < first OR first IS NULL THEN '' WHEN rank = first THEN 'spotify_resolution_rate_limited' ELSE 'spotify_resolution_deferred' END AS notes FROM p, f""")
def refused_links(spark, sf):
    """Links of every part where the catalogue refuses calls at several ranks."""
    none = F.lit(None).cast("string")
    p = table(spark, sf, "part").withColumn("rank", F.col("p_partkey") + 1)
    rows = p.select(
        F.col("rank").alias("query_id"), "rank", F.lit("An artist").alias("artist"), F.lit("A song").alias("title"), F.create_map(F.lit("x"), F.lit("y")).alias("open_graph"), F.lit("").alias("source_article_url"), X("cast(array() as array<string>)").alias("embedded_music_links"),
        X("CASE WHEN p_partkey % 10 = 0 THEN concat('c', rank) END").alias("spotify_id"), none.alias("spotify_uri"), none.alias("soundcloud_track_id"), none.alias("soundcloud_url"),
    )
    found = p.select(
        F.col("rank").alias("query_id"), F.lit(0).alias("pos"), F.concat(F.lit("s"), "rank").alias("id"), F.lit("A song").alias("name"), F.array(F.lit("An artist")).alias("artist_names"), F.lit(9).alias("popularity"), F.lit("2026-01-30").alias("release_date"),
        F.lit("day").alias("release_date_precision"),
    )
    s, i = none, F.lit(None).cast("int")
    uploads = p.limit(0).select(
        F.col("rank").alias("query_id"), F.lit(0).alias("pos"), s.alias("id"), s.alias("permalink_url"), s.alias("title"), s.alias("publisher_artist"), s.alias("writer_composer"), s.alias("username"), s.alias("permalink"), i.alias("playback_count"),
        i.alias("release_year"), i.alias("release_month"), i.alias("release_day"), s.alias("release_date"), s.alias("display_date"), s.alias("created_at"),
    )
    refusals = p.where("p_partkey % 97 in (30, 41)").select(F.col("rank").alias("query_id"))
    out = match.resolve(rows, found, uploads, AS_OF, 7, refusals=refusals)
    return out.select("rank", "spotify_id", F.array_join("notes", ",").alias("notes"))


def _scratch(spark, name: str) -> str:
    """A folder of this run's own under the shared checkpoint folder."""
    checkpointed(spark.range(1))  # sets the folder where none is set
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


@query("SELECT c_custkey AS cache_key, CASE WHEN n > 0 THEN 'orders' ELSE c_mktsegment END AS v, coalesce(n, 0)::BIGINT AS n FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_totalprice > 200000 GROUP BY 1) ON o_custkey = c_custkey")
def cache_commits(spark, sf):
    """Customers committed to a cache, then those with dear orders over them."""
    path = _scratch(spark, "cache")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("cache_key"), F.col("c_mktsegment").alias("v"), F.lit(0).cast("long").alias("n"))
    cache.commit(c, path)
    o = table(spark, sf, "orders").where("o_totalprice > 200000").groupBy(F.col("o_custkey").alias("cache_key")).agg(F.lit("orders").alias("v"), F.count(F.lit(1)).alias("n"))
    cache.commit(o.join(c.select("cache_key"), "cache_key", "left_semi"), path)
    return cache.read(spark, path, "cache_key bigint, v string, n bigint").select("cache_key", "v", "n")


@query("""WITH f AS (SELECT o_orderpriority AS playlist, o_custkey::VARCHAR AS id, min(o_orderkey) AS pos FROM orders GROUP BY ALL), b AS (SELECT *, (row_number() OVER (PARTITION BY playlist ORDER BY pos, id) - 1) // 100 AS batch FROM f)
  SELECT playlist, batch, count(*)::INTEGER AS ids, arg_min(id, pos) AS first, playlist NOT LIKE '1%' OR batch % 2 = 0 AS sent FROM b GROUP BY playlist, batch""")
def delivered_batches(spark, sf):
    """Customers by order priority as playlists, sent in batches of a hundred to a receiver that refuses some."""

    def send(playlist: str, key: str, ids: list[str], batch: int) -> None:
        if playlist.startswith("1") and int(ids[0]) >= 0 and batch % 2 == 1:  # the receiver's own rule
            raise ValueError("refused")

    payload = delivery.batches(table(spark, sf, "orders").withColumn("id", F.col("o_custkey").cast("string")), "o_orderpriority", "id", "o_orderkey", numeric=True)
    out = delivery.deliver(payload, _scratch(spark, "ledger"), send, 1, with_batch=True)
    return out.select("playlist", "batch", F.size("ids").alias("ids"), F.element_at("ids", 1).alias("first"), F.col("ok").alias("sent"))


@query("SELECT 'nations' AS name, true AS success, count(*) AS rows FROM nation UNION ALL SELECT 'fails', false, 0 UNION ALL SELECT 'orders', true, count(*) FROM orders")
def isolated_runs(spark, sf):
    """Sources that are run apart: one fails in a task."""
    whole = lambda t: lambda s, c: table(s, sf, t)
    fails = Source("fails", lambda s, c: table(s, sf, "orders").select(F.when(F.col("o_orderkey") >= 0, F.raise_error(F.lit("in a task"))).cast("string").alias("x")))
    sources = [Source("nations", whole("nation")), fails, Source("orders", whole("orders"))]
    return run_isolated(spark, sources, PipelineConfig(as_of=AS_OF), _scratch(spark, "sources"))[1].select("name", "success", "rows")


# --- whole flows ------------------------------------------------------------------------------------------


@query("""WITH a AS (SELECT p_partkey // 2 AS album, min(p_partkey) AS ordinal FROM part GROUP BY 1)
  SELECT p_partkey AS ordinal, p_brand AS artist, 'Song ' || album AS title, make_date(2026, 1, (10 + album % 20)::INTEGER)::VARCHAR AS article_date, 'single' AS release_type FROM a JOIN part ON p_partkey = ordinal WHERE album % 20 >= 7""")
def catalogue_scan(spark, sf):
    """Recent catalogue tracks of profiles: an album that two profiles have counts for the first."""
    p = table(spark, sf, "part")
    people = p.select(
        F.col("p_partkey").cast("long").alias("ordinal"), F.col("p_brand").alias("artist_name"), F.concat(F.lit("https://open.spotify.com/artist/a"), "p_partkey").alias("spotify_url"), F.lit("").alias("soundcloud_url"), F.lit("").alias("soundcloud_user_id"),
        F.col("p_type").alias("genre"), F.col("p_size").cast("string").alias("rank"), F.lit("1000").alias("monthly_listeners"),
    )
    n = X("cast(floor(p_partkey / 2) as long)")
    album = F.concat(F.lit('{"id":"al'), n, F.lit('","release_date":"2026-01-'), 10 + n % 20, F.lit('","release_date_precision":"day","album_type":"single","total_tracks":1}'))
    albums = p.select(F.col("p_partkey").cast("long").alias("ordinal"), F.lit(0).alias("pos"), F.parse_json(album).alias("album"))
    song = F.concat(F.lit('{"id":"t'), "n", F.lit('","name":"Song '), "n", F.lit('"}'))
    songs = p.select(n.alias("n")).distinct().select(F.concat(F.lit("al"), "n").alias("album_id"), F.explode(F.array(F.lit(0), F.lit(1))).alias("pos"), F.parse_json(song).alias("track"))
    out = profiles.catalogue_recent(people, albums, songs, "2026-01-31")
    return out.select(F.col("order_key.ordinal").alias("ordinal"), "artist", F.col("track_or_project_title").alias("title"), "article_date", "release_type")


@query(f"WITH RECURSIVE {_RECORDS}, best AS (SELECT doc_id, row_number() OVER (PARTITION BY g ORDER BY sc DESC, doc_id) AS n FROM ranked) SELECT doc_id, n = 1 AS is_unique FROM best WHERE doc_id % 40 <= 7")
def ranked_window(spark, sf):
    """All and unique sightings of the last week: the window is applied only after uniqueness was decided."""
    every, unique = rank(document_records(spark, sf), PipelineConfig(as_of=AS_OF, lookback_days=7))
    first = unique.select(F.col("load_ordinal").alias("doc_id"), F.lit(True).alias("is_unique"))
    return every.select(F.col("load_ordinal").alias("doc_id")).join(first, "doc_id", "left").withColumn("is_unique", F.coalesce("is_unique", F.lit(False)))


@query("""SELECT DISTINCT p_brand AS artist, p_name AS title, CASE p_partkey % 5 WHEN 0 THEN 'single' ELSE 'album' END AS kind FROM part WHERE p_partkey % 5 IN (0, 1)""")
def extracted_releases(spark, sf):
    """Cards of every part through the whole extraction: merged, classified, enriched, parsed, deduplicated."""
    p = dealt(spark, sf, "part", "p_partkey")
    at = F.concat(F.lit("https://example.org/p/"), "p_partkey")
    card = p.select(X(_LINE).alias("title"), at.alias("url"), F.lit("S").alias("source_name"), F.lit("c").alias("category"), F.lit("2026-01-30").alias("publish_date"), F.lit("").alias("snippet"), (2 * F.col("p_partkey")).alias("ordinal"))
    empty = card.select(F.lit("").alias("title"), "url", "source_name", "category", F.lit(None).cast("string").alias("publish_date"), F.lit("later").alias("snippet"), (F.col("ordinal") + 1).alias("ordinal"))
    pages = p.select(at.alias("url"), X("concat('<article><p>', p_type, '</p><a href=\"https://open.spotify.com/track/t', p_partkey, '\">x</a></article>')").alias("html"))
    out = extract_releases(card.unionByName(empty), pages)
    return out.select("artist", F.col("track_or_project_title").alias("title"), F.col("release_type").alias("kind"))


@query("""WITH p AS (SELECT p_partkey, 'Artist ' || p_partkey % 300 AS name, p_partkey % 300 AS k, p_type FROM part), f AS (SELECT name, k, min(p_partkey) AS first, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS genres FROM p GROUP BY ALL)
  SELECT name AS artist_name, genres, CASE WHEN k % 2 = 0 THEN 'https://open.spotify.com/artist/1234567890abcdef' || (1000 + k) ELSE 'https://open.spotify.com/artist/found' || k END AS spotify_url, CASE WHEN k % 3 = 0 THEN k::VARCHAR ELSE '' END AS user_id FROM f""")
def merged_artists(spark, sf):
    """Genre pages, one for each part, to one artist list, completed by a catalogue's and a user search."""
    p = dealt(spark, sf, "part", "p_partkey").withColumn("k", F.col("p_partkey") % 300)
    name = F.concat(F.lit("Artist "), "k")
    linked = X("concat('<a href=\"https://x.org/artists/n/1234567890abcdef', 1000 + k, '\">Artist ', k, '</a>')")
    bare = X("""concat('<div wire:snapshot="', replace(concat('{"data": {"allArtists": [[[{"name": "Artist ', k, '"}, {}]]]}}'), '"', '&quot;'), '"></div>')""")
    listing = p.select(F.col("p_partkey").alias("target"), F.col("p_type").alias("genre"), F.lit(5).alias("limit"), F.when(F.col("k") % 2 == 0, linked).otherwise(bare).alias("html"))
    hits = p.select(name.alias("artist_name"), F.col("p_partkey").alias("pos"), F.concat(F.lit("https://open.spotify.com/artist/found"), "k").alias("url"))
    users = p.where("k % 3 = 0").select(
        name.alias("query_id"), F.col("p_partkey").alias("pos"), F.col("k").alias("id"), name.alias("username"), F.concat(F.lit("artist-"), "k").alias("permalink"), F.concat(F.lit("https://soundcloud.com/artist-"), "k").alias("permalink_url"),
        F.lit(200_000).alias("followers_count"), F.lit(True).alias("verified"),
    )
    out = profiles.artist_list(listing, hits, users)
    return out.select("artist_name", F.array_join(F.array_sort("genres"), "|").alias("genres"), "spotify_url", F.coalesce("soundcloud_user_id", F.lit("")).alias("user_id"))
