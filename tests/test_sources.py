"""Sources and sinks on recorded payloads."""

import json

import pytest
from pyspark.sql import functions as F

from lodestrata import cli
from lodestrata.plans import pipeline
from lodestrata.sources import charts, pages, profiles, records, sinks
from lodestrata.streaming import sightings


def test_json_arrays(spark, tmp_path):
    (tmp_path / "b.json").write_text(json.dumps([{"artist": "B", "open_graph": {"n": "1"}}, 5, {"artist": "No", "release_article": False}]))
    (tmp_path / "a.json").write_text(json.dumps([{"artist": "A", "confidence_score": 0.5, "ranking_score": 3}]))
    (tmp_path / "c.json").write_text("{not json")
    (tmp_path / "d.json").write_text('{"an": "object"}')
    paths = records.input_files(spark, [str(tmp_path)], [str(tmp_path / "missing.json")], [])
    assert [p.rpartition("/")[2] for p in paths] == ["a.json", "b.json", "c.json", "d.json"]
    got = records.release_arrays(spark, paths).orderBy("load_ordinal").collect()
    assert [(r["artist"], r["ranking_score"]) for r in got] == [("A", 3.0), ("B", None)] and got[1]["open_graph"] == {"n": "1"}
    with pytest.raises(Exception, match="(?i)malformed"):
        records.release_arrays(spark, paths, "FAILFAST").collect()
    assert records.release_arrays(spark, []).count() == 0


def test_json_arrays_of_equal_names_and_blanks(spark, tmp_path):
    files = [tmp_path / "a" / "x.json", tmp_path / "b" / "x.json", tmp_path / "b" / "y + z%.json"]
    for n, f in enumerate(files):
        f.parent.mkdir(exist_ok=True)
        f.write_text(json.dumps([{"artist": f"A{n}"}, {"artist": f"B{n}"}]))
    got = records.release_arrays(spark, [str(f) for f in reversed(files)] + [str(files[0])]).orderBy("load_ordinal").collect()
    assert [r["artist"] for r in got] == ["A2", "B2", "A1", "B1", "A0", "B0"] and len({r["load_ordinal"] for r in got}) == 6


def test_corrupt_cache_is_empty(spark, tmp_path):
    (tmp_path / "cache.json").write_text('{"cache_key": "k"}\n{broken\n')
    assert sinks.read_cache(spark, str(tmp_path / "cache.json"), "cache_key string").count() == 0
    (tmp_path / "cache.json").write_text('{"cache_key": "k"}\n')
    assert sinks.read_cache(spark, str(tmp_path / "cache.json"), "cache_key string").columns == ["cache_key"]


def test_text_sources(spark, tmp_path):
    (tmp_path / "artists.csv").write_text('artist_name,spotify_url,soundcloud_url,soundcloud_user_id,genre,rank,monthly_listeners\nA,https://open.spotify.com/artist/a1,,,house,1,5\nB,https://x.org/b,,,,,\nC,,,77,"a | b",,\nD,,,,,,\n')
    got = records.artist_profiles(spark, str(tmp_path / "artists.csv")).orderBy("ordinal").collect()
    assert [r["artist_name"] for r in got] == ["A", "C"]
    assert records.artist_profiles(spark, str(tmp_path / "artists.csv"), 1).count() == 1
    (tmp_path / "followed.csv").write_text("artist_name,soundcloud_url,soundcloud_user_id,genres,edm_match_terms,followers_count,track_count,country,city\nA,u,7,house | techno,house,\"1,200\",x,,\n")
    row = records.followed_artists(spark, str(tmp_path / "followed.csv")).first()
    assert (row["genres"], row["followers_count"], row["track_count"]) == (["house", "techno"], 1200, None)
    (tmp_path / "genres.txt").write_text("# c\n\nhttps://x.org/genres/house,20,House\nhttps://x.org/genres/dub,5\n")
    assert [tuple(r)[:3] for r in records.genre_targets(spark, str(tmp_path / "genres.txt")).orderBy("ordinal").collect()] == [("https://x.org/genres/house", 20, "House"), ("https://x.org/genres/dub", 5, None)]
    (tmp_path / "bad.txt").write_text("only\n")
    with pytest.raises(Exception, match="expected url,limit"):
        records.genre_targets(spark, str(tmp_path / "bad.txt")).collect()


ARTICLE = """<html><head><meta property="og:title" content="One"><meta name="og:title" content="Two"><script type="application/ld+json">{"@type":"x"}</script></head>
<body><nav><a href="https://soundcloud.com/n/t">n</a></nav><article><p>Body <script>no</script>text</p><a href="https://open.spotify.com/album/1">a</a><a href="https://soundcloud.com/profile">p</a>
<iframe src="//open.spotify.com/embed/track/9"></iframe></article></body></html>"""


def test_page_functions(spark):
    df = spark.createDataFrame([("https://x.org/p", ARTICLE), ("u", None)], "url string, html string")
    got = df.select(pages.html_meta("html").alias("m"), pages.html_text("html").alias("t"), pages.music_links(F.col("html"), F.col("url")).alias("l"), F.size(pages.json_ld_objects(F.col("html"))).alias("j")).collect()
    assert got[0]["m"] == {"og:title": "Two"} and got[0]["t"] == "Body text a p" and got[0]["j"] == 1
    assert got[0]["l"] == ["https://open.spotify.com/album/1", "https://open.spotify.com/embed/track/9"]
    assert got[1]["t"] == "" and got[1]["l"] == []


def archive(page, *items):
    return (page, "https://www.edm.com/music-releases", "<body>" + "".join(f"<article><h2><a href='{u}'>{t}</a></h2>{d}</article>" for u, t, d in items) + "</body>")


def test_archive_cards_and_stop(spark):
    df = spark.createDataFrame(
        [
            archive(1, ("/music-releases/one?x=1", "A long enough title", "<p>April 24, 2026 more</p>"), ("/music-releases/one", "A long enough title again", "<p>April 24, 2026</p>"), ("/about", "Another long enough title", "")),
            archive(2, ("/music-releases/two", "Second long enough title", "<p>April 1, 2026</p>"), ("/music-releases/three", "Third long enough title", "<p>April 23, 2026</p>")),
            archive(3, ("/music-releases/four", "Fourth long enough title", "<p>April 25, 2026</p>")),
        ],
        "page int, url string, html string",
    )
    cards = pages.cards_from_pages(df, "A", "music-releases", "2026-04-20")
    got = pages.distinct_cards(pages.crawled(cards), "A").orderBy("page", "pos").collect()
    assert [(r["url"], r["title"], r["publish_date"]) for r in got] == [
        ("https://edm.com/music-releases/one", "A long enough title again", "2026-04-24"),
        ("https://edm.com/music-releases/three", "Third long enough title", "2026-04-23"),
    ]


def test_load_more(spark):
    df = spark.createDataFrame([("<button data-url='/next'>Load More</button>", "https://x.org/a", 2, '{"html": "<p>1</p>"}'), ("<div class='alm-listing' data-post-type='p'></div>", "https://x.org/a", 2, "<b>raw</b>")], "html string, url string, n int, answer string")
    got = [tuple(r) for r in df.select(pages.load_more_url("html", "url", "n"), pages.unwrapped("answer")).collect()]
    assert got == [("https://x.org/next", "<p>1</p>"), ("https://x.org/wp-json/ajaxloadmore/posts?page=2&category=music-releases&post_type=p", "<b>raw</b>")]


def test_blog_pipeline(spark):
    cards = spark.createDataFrame([("Ann Drops New Single 'Sea'", "u", "S", "c", None, None, 0), ("", "u", "S", "c", "2026-04-24", "sn", 1), ("A tour", "v", "S", "c", None, None, 2)], "title string, url string, source_name string, category string, publish_date string, snippet string, ordinal int")
    recorded = spark.createDataFrame([("u", ARTICLE)], "url string, html string")
    got = pipeline.extract_releases(cards, recorded).collect()
    assert [(r["artist"], r["track_or_project_title"], r["article_date"], r["extraction_method"]) for r in got] == [("Ann", "Sea", "2026-04-24", "regex+embedded_player")]
    assert pipeline.extract_releases(cards, None).count() == 1


def test_chart_script(spark):
    html = "<h2>Top House Newcomer Tracks</h2><script>new StatisticUpdater(this, {limit: 10, name: 'x y', \"q\": 1})</script>"
    df = spark.createDataFrame([(html,), ("none",)], "html string")
    got = [r[0] for r in df.select(charts.updater_params(F.col("html"), "Top House Newcomer Tracks")).collect()]
    assert got[0]["mode"] == "9" and got[0]["params"] == "nc" and got[0]["limit"] == "10" and got[0]["name"] == "x y" and got[1] == {}


def test_submission_chart(spark):
    s = spark.createDataFrame([(1, ["x", "t1"], 30.0, 25, 1, 2, "US", ["house"]), (2, ["gone"], 99.0, 1, 0, 0, None, []), (3, ["t2"], 40.0, 1, 0, 0, None, []), (4, [], 1.0, 1, 0, 0, None, [])], "rank int, tracks array<string>, points double, approved int, rgb int, complete int, country string, tags array<string>")
    t = spark.createDataFrame([("t1", 0, "Old", "o", 1776988800000, "s", None, [], []), ("t1", 1, "Ann", "“Sea”", 1776988800000, "s/x", "L", ["u", "u"], ["remix"]), ("t2", 2, "Bo", "Sky", None, None, None, None, None)], "id string, pos int, artist string, title string, released long, slug string, label string, source_urls array<string>, unoriginal array<string>")
    got = charts.submission_releases(s, t, "2026-04-30").collect()
    assert [(r["artist"], r["track_or_project_title"], r["open_graph"]["chart_rank"], r["release_type"]) for r in got] == [("Bo", "Sky", "3", "track"), ("Ann", "Sea", "1", "remix")]
    assert got[1]["embedded_music_links"] == ["u"] and got[1]["article_date"] == "2026-04-24" and abs(got[1]["confidence_score"] - 0.95) < 1e-9
    assert charts.submission_releases(s, t, "2026-04-01").count() == 1
    names = charts.subgenres(spark.createDataFrame([("deep", "house")], "name string, parent string"), "house")
    assert names.first()["names"] == ["deep"] and charts.subgenres(spark.createDataFrame([("deep", "house")], "name string, parent string"), "dub").first()["names"] == ["dub"]


def variant(df, *columns):
    return df.withColumns({c: F.parse_json(c) for c in columns})


def test_profile_scans(spark):
    people = spark.createDataFrame([(0, "Ann", "https://open.spotify.com/artist/a1", "su", "7", "house", "1", "100"), (1, "Bo", "https://open.spotify.com/artist/b1", "sv", "8", "", "", "")], "ordinal long, artist_name string, spotify_url string, soundcloud_url string, soundcloud_user_id string, genre string, rank string, monthly_listeners string")
    album = lambda i, d: json.dumps({"id": i, "release_date": d, "release_date_precision": "day", "album_type": "single", "total_tracks": 1})
    albums = variant(spark.createDataFrame([(0, 0, album("x", "2026-04-30")), (1, 0, album("x", "2026-04-30")), (1, 1, album("old", "2020-01-01"))], "ordinal long, pos int, album string"), "album")
    songs = variant(spark.createDataFrame([("x", 0, '{"id":"t","name":"Sea","artists":[{"name":"Ann","id":"a1"}]}'), ("x", 1, '{"id":"t","name":"Sea again"}'), ("old", 0, '{"id":"z","name":"Z"}')], "album_id string, pos int, track string"), "track")
    got = profiles.catalogue_recent(people, albums, songs, "2026-05-04").collect()
    assert [(r["artist"], r["track_or_project_title"], r["release_type"]) for r in got] == [("Ann", "Sea", "single")] and got[0]["ranking_score"] > 0
    ups = [("7", 0, '{"id":1,"title":"DJ Set","created_at":"2026/05/01 x"}'), ("8", 0, '{"id":1,"title":"Bo - Sky","created_at":"2026/05/01 x"}'), ("8", 1, '{"id":2,"title":"Old","created_at":"2020/05/01 x"}')]
    tracks = variant(spark.createDataFrame(ups, "soundcloud_user_id string, pos int, track string"), "track")
    assert profiles.profile_uploads(people, tracks, "2026-05-04").count() == 0  # the set is seen first and hides the song
    followed = people.select("artist_name", "soundcloud_url", "soundcloud_user_id", F.array(F.lit("house")).alias("genres"), F.array(F.lit("house")).alias("edm_match_terms"), F.lit(10).cast("long").alias("followers_count"), "ordinal")
    assert [r["track_or_project_title"] for r in profiles.followed_uploads(followed, tracks, "2026-05-04").collect()] == ["Sky"]
    users = variant(spark.createDataFrame([(0, '{"id":7,"username":"Ann","description":"techno"}'), (1, '{"id":8,"username":"Bo"}')], "ordinal long, user string"), "user")
    tagged = variant(spark.createDataFrame([("7", 0, '{"genre":"Deep House","tag_list":"x, y"}')], "soundcloud_user_id string, pos int, track string"), "track")
    got = profiles.followed_artists(users, tagged).collect()
    assert [(r["artist_name"], r["genres"], r["edm_match_terms"]) for r in got] == [("Ann", ["Deep House", "x", "y"], ["deep house", "house", "techno"])]


def test_genre_pages(spark):
    snap = json.dumps({"data": {"allArtists": [[[{"name": "Ann", "spotify_id": "1234567890abcdefXY", "listeners": 9, "_original_rank": 2}, {}], [{"name": "Bo"}, {}]]]}}).replace('"', "&quot;")
    link = "<a href='https://x.org/artists/cy/1234567890abcdefZZ'>Cy</a><a href='https://x.org/artists/cy/1234567890abcdefZZ'>Cy</a><a href='/other'>no</a>"
    df = spark.createDataFrame([(0, "house", 5, f"<div wire:snapshot=\"{snap}\"></div>"), (1, "dub", 5, link)], "target int, genre string, limit int, html string")
    got = [(r["artist_name"], r["rank"], r["monthly_listeners"], r["spotify_id"]) for r in profiles.genre_artists(df).orderBy("target", "pos").collect()]
    assert got == [("Ann", 2, 9, "1234567890abcdefXY"), ("Bo", None, None, None), ("Cy", 1, None, "1234567890abcdefZZ")]
    assert [r["artist_name"] for r in profiles.artist_list(df).collect()] == ["Cy", "Ann", "Bo"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "é", ["a", "b"]), (0, None, None)], "o int, t string, l array<string>")
    sinks.write_json_array(df, str(tmp_path / "j"), ["o"], ("o",))
    text = "".join(p.read_text() for p in sorted((tmp_path / "j").glob("part*")))
    assert json.loads(text) == [{"t": None, "l": None}, {"t": "é", "l": ["a", "b"]}] and text.endswith("\n")
    sinks.write_artist_csv(df, str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True).where("o = '1'").first()["l"] == "a | b"
    cache = spark.createDataFrame([("k", "old"), ("m", "old")], "cache_key string, v string")
    path = str(tmp_path / "cache")
    sinks.write_cache(cache, path, path + "-new")
    merged = sinks.merged_cache(sinks.read_cache(spark, path, "cache_key string, v string"), spark.createDataFrame([("k", "new")], "cache_key string, v string"))
    sinks.write_cache(merged, path, path + "-new")
    assert {tuple(r) for r in sinks.read_cache(spark, path, "cache_key string, v string").collect()} == {("k", "new"), ("m", "old")}
    assert sinks.read_cache(spark, path + "-none", "cache_key string, v string").count() == 0
    ids = spark.createDataFrame([(i, str(i % 150)) for i in range(300)] + [(301, "x")], "pos int, id string")
    got = sinks.playlist_payload(ids, "id", "pos", numeric=True).collect()
    assert len(got) == 150 and max(r["batch"] for r in got) == 1


def test_paged_items(spark):
    df = variant(spark.createDataFrame([("c", 1, "[3]"), ("c", 0, "[1, 2]"), ("d", 0, '{"not": "a list"}')], "cursor string, page int, items string"), "items")
    got = records.paged_items(df, 2).select("cursor", F.col("item").cast("int").alias("i")).orderBy("page", "pos").collect()
    assert [tuple(r) for r in got] == [("c", 1), ("c", 2)] and records.paged_items(df).count() == 3


def test_command_line_ranks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [{"artist": "A", "track_or_project_title": "T", "article_date": "2026-01-30", "confidence_score": c} for c in (0.1, 0.9)]
    (tmp_path / "in" / "a.json").write_text(json.dumps(rows))
    cli.main(["rank", "--input-dir", str(tmp_path / "in"), "--output", str(tmp_path / "all"), "--unique-output", str(tmp_path / "best"), "--as-of", "2026-02-01", "--lookback-days", "7"], spark)
    assert spark.read.json(str(tmp_path / "all")).count() == 2
    assert [r["confidence_score"] for r in spark.read.json(str(tmp_path / "best")).collect()] == [0.9]


def test_source_run(spark):
    ok = pipeline.Source("ok", lambda s, c: s.range(2).withColumnRenamed("id", "n"))
    bad = pipeline.Source("bad", lambda s, c: s.range(1).select("nothing"))
    api = pipeline.Source("api", lambda s, c: s.range(1), api_source=True)
    config = pipeline.PipelineConfig(as_of="2026-01-01", skip_api_sources=True)
    built, status = pipeline.run_sources(spark, [ok, bad, api], config)
    assert [n for n, _ in built] == ["ok"] and {(r["name"], r["success"]) for r in status.collect()} == {("ok", True), ("bad", False)}


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    line = json.dumps({"artist": "A", "track_or_project_title": "T", "release_type": "track"})
    (tmp_path / "in" / "a.json").write_text(line + "\n" + line.replace('"A"', '"a!"') + "\n" + line.replace('"T"', '"U"') + "\n")
    query = sightings.run(sightings.deduplicated(sightings.read(spark, str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
