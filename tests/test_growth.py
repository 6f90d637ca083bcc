"""Steps that once grew faster than their input, or differed from their SQL on rarer input."""

import random
import time
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from lodestrata.operators import components, search, select
from lodestrata.plans.queries import ORACLES, QUERIES, source_queries
from lodestrata.sources import delivery, pages


def against_sql(spark, path, name, **tables):
    """Rows of a query and of its SQL over small tables."""
    con = duckdb.connect()
    for t, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{t}.parquet")
        con.sql(f"create view {t} as from '{path}/{t}.parquet/*.parquet'")
    want = con.sql(ORACLES[name])
    df = QUERIES[name](spark, str(path)).select(*want.columns)
    return sorted(tuple(r) for r in df.collect()), sorted(want.fetchall())


def test_crawled_finds_the_gap_without_a_list_of_all_pages(spark):
    n = 60_000
    cards = spark.range(1, n).select(F.col("id").alias("page"), F.concat(F.lit("u"), "id").alias("url"), F.lit(False).alias("old")).where(f"page <> {n - 10}")
    began = time.time()
    assert pages.crawled(cards).count() == n - 11
    assert time.time() - began < 20  # a list of all pages, looked through for each, took minutes
    repeated = cards.where("page < 9").withColumn("url", F.when(F.col("page") == 5, "u4").otherwise(F.col("url")))
    assert sorted(r.page for r in pages.crawled(repeated, True).collect()) == [1, 2, 3, 4]


def test_batches_of_one_long_playlist(spark):
    n = 60_000
    tracks = spark.range(n).select(F.when(F.col("id") % 1000 > 0, "p").alias("playlist"), (n - F.col("id")).cast("string").alias("id"), F.col("id").alias("pos"))
    began = time.time()
    got = {(r.playlist, r.batch): r.ids for r in delivery.batches(tracks, "playlist", "id", "pos", numeric=True).collect()}
    assert time.time() - began < 12  # cutting each batch out of the whole list grew with its square
    every = [i for i in range(n) if i % 1000]
    assert len(got) == 601 and got["p", 599] == [str(n - i) for i in every[59_900:]] and got[None, 0] == [str(n - i) for i in range(0, n, 1000)]


def test_html_title_with_an_unfinished_reference(spark, tmp_path):
    p = spark.createDataFrame([(1, "x", "<h1>a &amp;&amp</h1>"), (2, "x", "<h1>b &lt;c&gt; &amp;amp; d</h1><p>e</p>"), (3, "x", "<h1> f & g&quot; </h1>")], "page_id long, url string, html string")
    got, want = against_sql(spark, tmp_path, "html_title", pages=p)
    assert got == want and got[0] == (1, "a &&amp")


def test_pages_are_dealt_out_and_parsed_once(spark):
    p = source_queries.part_pages(spark, "/root/testdata/sf0.001")
    assert p.rdd.getNumPartitions() >= 3  # one small file was one task
    h = F.col("html")
    one = p.limit(20).unionByName(p.limit(1).withColumn("html", F.lit(None).cast("string"))).select(pages.page_contents("html").alias("p"), pages.html_meta(h).alias("m"), pages.html_title(h).alias("t"), pages.html_links(h).alias("l"), pages.html_text(h).alias("b"), pages.json_ld(h).alias("j"))
    rows = one.collect()
    assert len(rows) == 21 and all(tuple(r.p) == (r.m, r.t, r.l, r.b, r.j) for r in rows)


def test_best_other_part_of_a_large_group_of_equals(spark, tmp_path):
    n = 6000
    p = spark.range(n).select(F.col("id").alias("p_partkey"), F.when(F.col("id") % 3000 == 7, "red bolt x").otherwise("red bolt").alias("p_name"), F.lit("Brand#7").alias("p_brand"), F.lit("SMALL").alias("p_type"), F.lit(8).alias("p_size"))
    p.write.parquet(f"{tmp_path}/part.parquet")
    for name in ("fuzzy_match_best", "upload_match_best"):
        began = time.time()
        got = {r.query_id: r.best for r in QUERIES[name](spark, str(tmp_path)).collect()}
        assert time.time() - began < 25  # every pair was made and its names were normalised
        assert len(got) == n and got[0] == 1 and all(got[i] == 0 for i in range(1, n))


def test_rows_of_equal_words_are_one_entry(spark):
    c = spark.range(60).select("id", F.lit("hot bolt").alias("t"))
    index = search.token_index(c, "id", F.col("t"), 3)
    assert index.docs.count() == 1 and index.postings.count() == 2
    got = search.search(c.limit(1).select(F.lit("q").alias("query_id"), F.lit("bolt").alias("t")), index, F.col("t"))
    assert sorted((r.place, r.doc) for r in got.collect()) == [(1, 0), (2, 1), (3, 2)]


def capped(rows, primary, associated):
    """What a walk in order notes."""
    used, out = Counter(), {}
    for pos, note, artist, keys in sorted(rows, key=lambda r: r[0]):
        names = ([("a", artist)] if artist else []) + [("k", k) for k in dict.fromkeys(keys or []) if k is not None]
        full = [n for n in names if used[n] >= (primary if n[0] == "a" else associated)]
        if note is None and full:
            note = f"skipped_artist_cap_{primary}" if full[0][0] == "a" else f"skipped_associated_artist_cap_{associated}:{full[0][1]}"
        elif note is None:
            used.update(names)
        out[pos] = note
    return out


@pytest.mark.parametrize(("seed", "primary", "associated", "names", "hubs"), [(1, 2, 3, 60, 99), (2, 3, 2, 400, 5), (3, 1, 0, 30, 99), (4, 0, 1, 30, 99), (5, 2, 2, 12, 99)])
def test_caps_by_heads_and_rounds_equal_the_walk(spark, monkeypatch, seed, primary, associated, names, hubs):
    monkeypatch.setattr(select, "HUBS", hubs)
    rng = random.Random(seed)
    name = lambda: f"n{int(names * rng.random() ** 2)}"
    rows = [(i * 2, "vetoed" if rng.random() < 0.1 else None, rng.choice([None, "", name(), name(), name()]), rng.choice([None, [], [None, name()], [name() for _ in range(rng.randrange(4))]])) for i in range(1200)]
    df = spark.createDataFrame(rows, "rank long, note string, artist_key string, associated_keys array<string>").repartition(4)
    for walk in (3, 5000):
        assert {r["rank"]: r["note"] for r in select.greedy_caps(df, primary, associated, walk=walk).collect()} == capped(rows, primary, associated)


def test_caps_over_few_names_need_no_rounds(spark, monkeypatch):
    rows = [(i, None, f"a{i % 7}", [f"k{i // 7 % 11}", f"m{i // 5 % 13}"]) for i in range(6000)]
    df = spark.createDataFrame(rows, "rank long, note string, artist_key string, associated_keys array<string>")
    stored = []
    monkeypatch.setattr(select, "checkpointed", lambda d: stored.append(1) or components.checkpointed(d))
    assert {r["rank"]: r["note"] for r in select.greedy_caps(df, 3, 2, walk=20).collect()} == capped(rows, 3, 2)
    assert len(stored) <= 8  # every round stores its rows; there were as many rounds as rows that wait for each other


def test_pages_are_dealt_by_their_size(spark, monkeypatch):
    monkeypatch.setattr(components, "DEALT_BYTES", 2_000, raising=False)
    dealt = []
    monkeypatch.setattr(pages, "spread", lambda *a, **k: dealt.append(components.spread(*a, **k)) or dealt[-1])
    rows = [(f"u{i}", f"<article><h1>x</h1><p>{'word ' * 40}{i}</p></article>") for i in range(100)]
    held = spark.createDataFrame([*rows, ("u7", "<article> a</article>"), ("none", None), (None, "<p>lost</p>"), ("unasked", "<p>z</p>")], "url string, html string")
    asked = spark.createDataFrame([(i, f"u{i}") for i in range(100)] + [(100, "u7"), (101, "none"), (102, None), (103, "missing")], "id long, url string")
    out = pages.enrich(asked, held)
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()  # what pages say went to every task
    got = {r.id: r.body_text for r in out.collect()}
    assert dealt[0].rdd.getNumPartitions() >= 10  # as many tasks for any number of pages held more and more of them
    assert len(got) == 104 and got[3].endswith(" word 3") and got[7] == got[100] == "a"
    assert (got[101], got[102], got[103]) == ("", None, None)
