"""Operators on small inputs: groups, scores, selection, matching, extraction."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.operators import classify, dedupe, extract, filters, match, score
from lodestrata.operators.components import connected_components
from lodestrata.operators.select import curate
from lodestrata.plans import pipeline
from lodestrata.schema import RELEASE


def release(**k):
    base = {"artist": "A", "track_or_project_title": "T", "release_type": "track", "confidence_score": 1.0, "extraction_method": "m", "source_article_title": "t", "source_article_url": "u", "source_name": "S", "article_date": None,
            "embedded_music_links": [], "open_graph": {}, "release_article": True}
    return tuple((base | k)[f.name] for f in RELEASE.fields)


def releases(spark, *rows):
    df = spark.createDataFrame([(*release(**r), i) for i, r in enumerate(rows)], T.StructType([*RELEASE.fields, T.StructField("load_ordinal", T.LongType())]))
    return df.withColumn("source_file", F.lit("f"))


@pytest.mark.parametrize("parts", [1, 6])
@pytest.mark.parametrize("seed", range(3))
def test_components_match_union_find(spark, seed, parts):
    rng = random.Random(seed)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)] + [(5, 5)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    df = spark.createDataFrame(edges + [(None, 3)], "a long, b long").repartition(parts)
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    assert got == {n: root(n) for n in nodes}


def test_groups_ranking_and_uniqueness(spark):
    df = releases(
        spark,
        {"artist": "Chris & Co", "track_or_project_title": "Song - Extended Mix", "open_graph": {"spotify_track_id": "abc"}, "source_name": "SubmitHub"},
        {"artist": "Chris and Co", "track_or_project_title": "Song", "source_name": "1001Tracklists", "confidence_score": 0.2},
        {"artist": "Other", "track_or_project_title": "Else", "open_graph": {"isrc": "none"}},
        {"artist": "", "track_or_project_title": ""},
    )
    ranked = dedupe.rank_records(df, "2026-01-10")
    got = {r["load_ordinal"]: (r["duplicate_group_key"], r["cross_source_duplicate_count"], r["cross_source_source_count"]) for r in ranked.collect()}
    assert got == {0: ("spotify:abc", 2, 2), 1: ("spotify:abc", 2, 2), 2: ("text:other|else", 1, 1)}
    assert sorted(r["load_ordinal"] for r in dedupe.unique_records(ranked).collect()) == [0, 2]


@pytest.mark.parametrize("count, sources, want", [(1, 1, 56.7399), (3, 3, 72.3382)])
def test_cross_source_score(spark, count, sources, want):
    df = releases(spark, {"source_name": "Spotify Playlist", "article_date": "2026-05-02", "embedded_music_links": ["x"], "open_graph": {"spotify_popularity": "40"}}).withColumn("ranking_score", F.lit(None).cast("double"))
    got = df.select(score.cross_source_factors("2026-05-04", F.lit(count), F.array(*[F.lit(str(i)) for i in range(sources)])).alias("s")).first()["s"]
    assert abs(got["unrounded"] - want) < 1e-3 and got["score"] == round(want, 2)


def test_zero_score_counts_missing_does_not(spark):
    df = releases(spark, {}, {}).withColumn("ranking_score", F.when(F.col("load_ordinal") == 0, 0.0))
    got = [r["s"]["available_weight"] for r in df.select(score.cross_source_factors("2026-01-01", F.lit(1), F.array(F.lit("S"))).alias("s"), "load_ordinal").orderBy("load_ordinal").collect()]
    assert got == [0.8, 0.6]


def test_dedupe_releases_keeps_first_place(spark):
    df = releases(spark, {"artist": "B", "confidence_score": 0.1}, {"artist": "A"}, {"artist": "b!", "confidence_score": 0.9}, {"artist": "A", "release_type": "single"})
    assert [r["load_ordinal"] for r in dedupe.dedupe_releases(df).collect()] == [2, 1, 3]


def test_artist_merge(spark):
    rows = [("N", "id", "house", None, 10, 100, 0), ("N", "id", "tech house", ["tech house"], 2, 80, 1), ("M", None, "x", None, None, None, 2)]
    df = spark.createDataFrame(rows, "artist_name string, spotify_id string, genre string, genres array<string>, rank long, monthly_listeners long, ordinal int")
    got = [tuple(r) for r in dedupe.dedupe_artists(df).select("artist_name", "genre", "genres", "rank", "monthly_listeners").collect()]
    assert got == [("N", "tech house", ["house", "tech house"], 2, 100), ("M", "x", ["x"], None, None)]


def tracks(spark, *rows):
    out = []
    for i, (artist, title, s, link, bag) in enumerate(rows, 1):
        out.append((i, float(s), artist, title, link, None, None, None, "", "", bag))
    return spark.createDataFrame(out, "rank int, ranking_score double, artist string, title string, spotify_id string, spotify_uri string, soundcloud_track_id string, soundcloud_url string, source_article_title string, source_article_url string, open_graph map<string,string>")


def notes(df):
    return [r["note"] for r in df.orderBy("rank").collect()]


def test_caps_and_vetoes(spark):
    df = tracks(
        spark,
        ("Noxies", "One", 9, "1", {}), ("Noxies", "Two", 8, "2", {}), ("Noxies", "Three", 7, "3", {}), ("Other", "Four", 6, "4", {}),
        ("X1", "Slowed thing", 5, "5", {}), ("X2", "Five", 4, "6", {"isrc": "GBEFR2309157"}), ("X3", "Six", 3, None, {}),
    )
    got = curate(df, "2026-05-04")
    assert notes(got) == [None, None, "skipped_artist_cap_2", None, "skipped_unwanted_speed_variant", "skipped_old_isrc_year", "skipped_no_verified_platform_link"]
    assert [r["playlist_rank"] for r in got.orderBy("rank").collect()] == [1, 2, None, 3, None, None, None]


def test_associated_cap_and_versions(spark):
    rows = [(f"A{i}", f"Tune number {i}", 9 - i, str(i), {"all_artists": f"A{i}, Cafe De Anatolia"}) for i in range(4)]
    assert notes(curate(tracks(spark, *rows), "2026-05-04"))[3] == "skipped_associated_artist_cap_3:cafe de anatolia"
    two = tracks(spark, ("D", "Disco Cherry - Extended", 99, "1", {}), ("D", "Disco Cherry", 90, "2", {}))
    assert notes(curate(two, "2026-05-04")) == ["skipped_duplicate_version", None]


def test_greedy_invariants(spark):
    rng = random.Random(1)
    rows = [(f"a{rng.randint(0, 6)}", f"title {i}", 100 - i, "x", {"all_artists": f"b{rng.randint(0, 4)}"}) for i in range(60)]
    got = curate(tracks(spark, *rows), "2026-05-04", max_per_artist=3, max_per_associated=5).orderBy("rank").collect()
    kept = [r for r in got if r["note"] is None]
    assert kept and max(sum(k["artist"] == a for k in kept) for a in {k["artist"] for k in kept}) <= 3
    assert notes(curate(tracks(spark, *rows).repartition(5), "2026-05-04", max_per_artist=3, max_per_associated=5)) == [r["note"] for r in got]


def test_windows(spark):
    df = releases(spark, *[{"article_date": d} for d in ("2026-05-04", "2026-04-27", "2026-04-26", None, "2026-05-05")])
    assert [r["load_ordinal"] for r in filters.lookback(df, "2026-05-04", 7).collect()] == [0, 1]
    assert [r["load_ordinal"] for r in filters.lower_bound(df, "2026-05-04", 7).collect()] == [0, 1, 4]
    assert filters.lookback(df, "2026-05-04", 0).count() == 5


def test_uniqueness_comes_before_the_window(spark):
    rows = [{"open_graph": {"isrc": "Q"}, "article_date": None, "confidence_score": 1.0}, {"open_graph": {"isrc": "Q"}, "article_date": "2020-01-01", "confidence_score": 0.1}]
    ranked, unique = pipeline.rank(releases(spark, *rows), pipeline.PipelineConfig(as_of="2026-05-04"))
    assert ranked.count() == 0 and unique.count() == 0


def test_catalogue_match(spark):
    asked = spark.createDataFrame([(1, "Ann & Bo", "Sea Song (Radio Edit)"), (2, "Cy", "Nothing")], "query_id long, artist string, title string")
    rows = [(1, 0, "Sea Song", ["Wrong"], 90, "2026-05-01", "day"), (1, 1, "Sea Song", ["Ann & Bo"], 10, "2026", "year"), (1, 2, "Sea Song", ["ann and bo"], 10, "2026-05-01", "day"), (1, 3, "Sea Song", ["Ann & Bo"], 10, "2026-05-01", "day")]
    cands = spark.createDataFrame(rows, "query_id long, pos int, name string, artist_names array<string>, popularity int, release_date string, release_date_precision string")
    got = match.best_catalogue_match(asked, cands, "2026-05-04", 7).collect()
    assert [(r["query_id"], r["pos"]) for r in got] == [(1, 2)]


def test_best_user_last_of_equals(spark):
    users = spark.createDataFrame([(1, 0, 5, "u", "Ann", "ann", 10, False), (1, 1, 6, "v", "Ann", "ann", 10, False), (1, 2, 7, "w", "Annabel", "x", 10**6, True)], "query_id long, pos int, id long, permalink_url string, username string, permalink string, followers_count long, verified boolean")
    asked = spark.createDataFrame([(1, "Ann")], "query_id long, artist string")
    assert [r["id"] for r in match.best_user(asked, users).collect()] == [6]


@pytest.mark.parametrize("profile", ["A", "B", "C"])
def test_classifier_profiles(spark, profile):
    df = spark.createDataFrame([("Watch Ann Drops New Single 'Sea'",), ("Ann Drops New Single 'Sea'",)], "t string")
    got = [r[0] for r in df.select(classify.classify(F.col("t"), profile=profile)["release_article"]).collect()]
    assert got == [profile == "C", True]


def test_article_parsing(spark):
    schema = "title string, url string, source_name string, publish_date string, snippet string, body_text string, embedded_music_links array<string>, open_graph map<string,string>, body_release_matches array<string>"
    rows = [
        ("Ann Drops New Single 'Sea'", "u1", "S", "2026-01-01", None, "the single called 'Sea'", ["l"], {}, ["m"]),
        ("New Single Out Now", "u2", "S", None, None, "", [], {"og:title": "Bo Releases 'Sky' Single"}, []),
        ("Just a tour", "u3", "S", None, None, "", [], {}, []),
    ]
    got = {r["source_article_url"]: r for r in extract.parse_articles(spark.createDataFrame(rows, schema)).collect()}
    assert (got["u1"]["artist"], got["u1"]["track_or_project_title"], got["u1"]["release_type"], got["u1"]["extraction_method"]) == ("Ann", "Sea", "single", "regex+embedded_player")
    assert "u3" not in got


def test_body_evidence(spark):
    df = spark.createDataFrame([("a new single 'Sea' and a track called \"Sky\"; album 'Sun'",)], "b string")
    assert df.select(extract.body_matches(F.col("b"))).first()[0] == ["track called \"Sky\"", "new single 'Sea'", "album 'Sun'"]
    assert df.select(extract.title_from_body(F.col("b"))).first()[0] == "Sky"


def test_resolution_trusts_only_what_is_checked(spark):
    schema = "query_id long, rank int, artist string, title string, open_graph map<string,string>, source_article_url string, embedded_music_links array<string>, cache_key string"
    rows = [(i, i, "Nova Reyes", "Glass Harbor", {}, None, None, f"k{i}") for i in range(1, 5)] + [(5, 5, "", "No artist", {}, "https://soundcloud.com/a/b", None, "k5"), (6, 6, "Nova Reyes", "Glass Harbor", {"soundcloud_track_id": "77"}, "https://soundcloud.com/a/c", None, "k6")]
    cache = [("k1", "c1", "uri1", "strict_v3_date_checked", "9", "u9"), ("k2", "c2", "uri2", "old", "8", "u8"), ("k3", "c3", "uri3", None, None, None), ("k4", "", None, None, "7", "u7")]
    cached = spark.createDataFrame(cache, "cache_key string, spotify_id string, spotify_uri string, spotify_match_version string, soundcloud_track_id string, soundcloud_url string")
    upload = "pos int, title string, publisher_artist string, writer_composer string, username string, permalink string, playback_count long, release_year int, release_month int, release_day int, release_date string, display_date string, created_at string"
    data = lambda title, day: (0, title, "Nova Reyes", None, "u", "p", 5, None, None, None, day, None, None)
    payloads = spark.createDataFrame([("9", *data("Glass Harbor", None)), ("8", *data("Glass Harbor", "2020-01-01"))], f"soundcloud_track_id string, {upload}")
    known = match.distrusted(match.cache_lookup(spark.createDataFrame(rows, schema), cached), payloads, "2026-05-04", 7)
    got = {r["query_id"]: (r["spotify_id"] or None, r["soundcloud_track_id"], r["notes"]) for r in known.collect()}
    both = ["discarded_untrusted_cached_soundcloud_match", "discarded_legacy_cached_spotify_match"]
    assert got == {1: ("c1", "9", []), 2: (None, None, both), 3: (None, None, both[1:]), 4: (None, None, both[:1]), 5: (None, None, []), 6: (None, None, [])}
    none = spark.createDataFrame([], "query_id long, pos int, id string, name string, artist_names array<string>, popularity int, release_date string, release_date_precision string")
    found = spark.createDataFrame([(2, "21", "https://x/21", *data("Glass Harbor", "2026-05-01"))], f"query_id long, id string, permalink_url string, {upload}")
    out = {r["query_id"]: r for r in match.resolve(known, none, found, "2026-05-04", 7, 3).collect()}
    assert (out[1]["spotify_uri"], out[1]["soundcloud_url"], out[1]["notes"]) == ("uri1", "u9", [])
    assert (out[2]["soundcloud_track_id"], out[2]["soundcloud_url"]) == ("21", "https://x/21") and out[2]["notes"] == both
    assert out[3]["notes"] == [both[1], "spotify_resolution_rate_limited"] and out[4]["notes"] == [both[0], "spotify_resolution_deferred"]
    assert (out[5]["soundcloud_track_id"], out[5]["soundcloud_url"]) == (None, "https://soundcloud.com/a/b")
    assert (out[6]["soundcloud_track_id"], out[6]["soundcloud_url"]) == ("77", "https://soundcloud.com/a/c")


def test_playlist_longer_than_the_usual_pool(spark):
    rows = [(n, 200.0 - n, f"A{n}", f"T{n}", f"s{n}") for n in range(1, 181)]
    tracks = spark.createDataFrame(rows, "rank int, ranking_score double, artist string, title string, spotify_id string").withColumns(
        {
            "query_id": F.col("rank").cast("long"), "open_graph": F.create_map(F.lit("x"), F.lit("y")), "embedded_music_links": F.array(F.lit("x")),
            **{c: F.lit(None).cast("string") for c in ("source_article_title", "source_article_url", "spotify_uri", "soundcloud_track_id", "soundcloud_url")},
        }
    )
    upload = "query_id long, pos int, id string, permalink_url string, title string, publisher_artist string, writer_composer string, username string, permalink string, playback_count long, release_year int, release_month int, release_day int, release_date string, display_date string, created_at string"
    catalogue = "query_id long, pos int, id string, name string, artist_names array<string>, popularity int, release_date string, release_date_precision string"
    config = pipeline.PipelineConfig(as_of="2026-05-04", top_n=170)
    got = pipeline.playlist(tracks, spark.createDataFrame([], catalogue), spark.createDataFrame([], upload), config)
    assert got["pool"].count() == 170 and got["catalogue"].count() == 170
    assert curate(tracks, "2026-05-04").count() == 180
