"""Search, capped selection, components, numbering and crawls against plain second versions."""

import math
import random
from collections import Counter, defaultdict
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from lodestrata.operators import components, ordering, search, select
from lodestrata.sources import crawl

# --- search -----------------------------------------------------------------------------------------


def found(catalogue, asked, k):
    held = {d: set(t.split()) for d, t in catalogue if t.split()}
    df = Counter(w for ws in held.values() for w in ws)
    weight = {w: math.floor(1000 * math.log(1 + len(held) / n)) for w, n in df.items()}
    out = []
    for q, t in asked:
        scores = sorted((-sum(weight[w] for w in set(t.split()) & ws), d) for d, ws in held.items() if set(t.split()) & ws)
        out += [(q, d, -s, n) for n, (s, d) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize(("k", "block", "cell", "opening"), [(3, 4096, 4096, 4096), (3, 7, 5, 0), (12, 11, 1000, 15)])
def test_search(spark, monkeypatch, k, block, cell, opening):
    rng = random.Random(k)
    rare = [f"r{i}" for i in range(60)]
    text = lambda: " ".join(["hot"] * (rng.random() < 0.8) + ["warm"] * (rng.random() < 0.4) + rng.choices(["a1", "b1", "c1"], k=rng.randrange(3)) + rng.choices(rare, k=rng.randrange(4)))
    catalogue = [(i, text()) for i in range(300)] + [(1000, ""), (1001, "alone")]
    asked = [(f"q{i}", text()) for i in range(120)] + [("q", "hot"), ("two", "hot warm"), ("none", "unknown words"), ("mixed", "unknown alone hot"), ("empty", ""), ("again", "hot warm")]
    c = spark.createDataFrame(catalogue, "doc long, t string").repartition(3)
    a = spark.createDataFrame(asked, "query_id string, t string")
    monkeypatch.setattr(components, "HUB_ROWS", 20_000 if block > 4000 else 20)
    got = search.search(a, search.token_index(c, "doc", F.col("t"), k, block), F.col("t"), cell=cell, opening=opening)
    assert sorted(tuple(r) for r in got.select("query_id", "doc", "score", "place").collect()) == found(catalogue, asked, k)


def test_search_odd_rows(spark):
    c = spark.createDataFrame([(1, "Café Noir"), (1, "del Mar"), (None, "cafe"), (2, None), (3, "CAFE & mar")], "doc long, t string")
    a = spark.createDataFrame([("x", "cafe"), (None, "cafe"), ("y", None), ("z", "mar")], "query_id string, t string")
    got = search.search(a, search.token_index(c, "doc", F.col("t"), 5), F.col("t"))
    assert sorted((r.query_id, r.doc) for r in got.collect()) == [("x", 1), ("x", 3), ("z", 1), ("z", 3)]
    assert search.search(a, search.token_index(c.limit(0), "doc", F.col("t"), 5), F.col("t")).collect() == []


def test_searched_tracks_and_users(spark):
    tracks = spark.createDataFrame([(1, "Nova Reyes", "Glass Harbor"), (2, "Aldo Fenn", "Glass Harbor"), (3, "Nova Reyes", "Slow Tide"), (4, "Ida", "Nothing")], "id long, username string, title string")
    records = spark.createDataFrame([(10, "Nova Reyes, Aldo Fenn", "Glass Harbor"), (11, "Ida", "Copper")], "query_id long, artist string, title string")
    got = search.searched_tracks(records, tracks, F.concat_ws(" ", "username", "title"), k=2)
    by = defaultdict(list)
    for r in sorted(got.collect(), key=lambda r: r.pos):
        by[r.query_id].append(r.id)
    assert set(by[10]) == {1, 2} and by[11] == [4]
    users = tracks.select(F.col("id").alias("user_id"), "username")
    assert {(r.query_id, r.user_id) for r in search.searched_users(records, users, F.col("username"), k=1).collect()} == {(10, 1), (10, 2), (11, 4)}


# --- capped selection ---------------------------------------------------------------------------------


def walked(rows, primary, associated):
    a, k, out = Counter(), Counter(), {}
    for rank, note, artist, keys in sorted(rows):
        keys = list(dict.fromkeys(keys or []))
        if note is None:
            if artist and a[artist] >= primary:
                note = f"skipped_artist_cap_{primary}"
            elif full := [x for x in keys if k[x] >= associated]:
                note = f"skipped_associated_artist_cap_{associated}:{full[0]}"
            else:
                a[artist] += 1
                k.update(keys)
        out[rank] = note
    return out


@pytest.mark.parametrize(("seed", "primary", "associated", "names"), [(1, 2, 3, 6), (3, 3, 2, 40), (4, 0, 2, 5)])
def test_greedy_caps_in_rounds_equals_the_walk(spark, seed, primary, associated, names):
    rng = random.Random(seed)
    name = lambda: f"n{int(names * rng.random() ** 2)}"  # noqa: E731  some are far more frequent
    rows = [(i * 3, "vetoed" if rng.random() < 0.1 else None, rng.choice([None, "", name(), name(), name()]), rng.choice([None, [], [name() for _ in range(rng.randrange(4))]])) for i in range(150)]
    df = spark.createDataFrame(rows, "rank long, note string, artist_key string, associated_keys array<string>").repartition(4)
    want = walked(rows, primary, associated)
    for walk in (0, 40, 1000):
        got = select.greedy_caps(df, primary, associated, walk=walk)
        assert {r["rank"]: r["note"] for r in got.collect()} == want
        assert got.columns == df.columns


def test_greedy_caps_long_dependence_and_hot_name(spark, monkeypatch):
    monkeypatch.setattr(components, "HUB_ROWS", 10)
    chain = [(i, None, f"c{i // 2}", [f"k{(i + 1) // 2}"]) for i in range(6)]  # each row waits for the one before
    hot = [(100 + i, None, "hot", [f"x{i % 5}"]) for i in range(300)]
    df = spark.createDataFrame(chain + hot, "rank long, note string, artist_key string, associated_keys array<string>").repartition(3)
    assert {r["rank"]: r["note"] for r in select.greedy_caps(df, 1, 1, walk=0).collect()} == walked(chain + hot, 1, 1)


def test_greedy_caps_empty(spark):
    df = spark.createDataFrame([], "rank long, note string, artist_key string, associated_keys array<string>")
    assert select.greedy_caps(df, 2, 3, walk=-1).collect() == select.greedy_caps(df, 2, 3).collect() == []


def test_numbered(spark):
    rng = random.Random(4)
    values = rng.sample(range(10_000), 500)
    df = spark.createDataFrame([(v % 7, v, "x") for v in values], "a long, b long, c string").repartition(5)
    got = ordering.numbered(df, ["a", "b"], "n", 6)
    assert sorted((r.n, r.a, r.b) for r in got.collect()) == [(n, *k) for n, k in enumerate(sorted((v % 7, v) for v in values), 1)]
    assert ordering.numbered(df.limit(0), ["a"], "n").collect() == []


# --- components ---------------------------------------------------------------------------------------


def reached(edges):
    parent = {}
    root = lambda x: x if parent.setdefault(x, x) == x else root(parent[x])
    for x, y in edges:
        x, y = root(x), root(y)
        parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in parent}


@pytest.mark.parametrize(("hub", "finish"), [(20_000, 0), (5, 0), (5, 20), (20_000, 10_000)])
def test_components_with_hubs(spark, monkeypatch, hub, finish):
    monkeypatch.setattr(components, "HUB_ROWS", hub)
    rng = random.Random(9)
    edges = [(0, i) for i in range(1, 60)] + [(500, i) for i in range(400, 460)] + [(i, i + 1) for i in range(200, 260)] + [(rng.randrange(600, 700), rng.randrange(600, 700)) for _ in range(60)]
    df = spark.createDataFrame([*edges, (None, 3), (7, 7), (8, None)], "a long, b long").repartition(3)
    assert {r.node: r.component for r in components.connected_components(df, finish=finish).collect()} == reached(e for e in edges if e[0] != e[1])


def test_components_of_names(spark):
    df = spark.createDataFrame([("b", "a"), ("c", "b"), ("z", "y")], "a string, b string")
    for finish in (0, 100):
        assert {r.node: r.component for r in components.connected_components(df, finish=finish).collect()} == {"a": "a", "b": "a", "c": "a", "y": "y", "z": "y"}


# --- crawls ---------------------------------------------------------------------------------------------


def walk_links(pages, base, cutoff_day, most):
    """One crawl, page by page. pages: address -> (cards [(slug, day)], next or None)."""
    seen, used, cards, at, n = set(), [], {}, base, 1
    while at in pages and n <= most:
        used.append(at)
        listed, target = pages[at]
        ended = False
        for slug, day in listed:
            if day is not None and day < cutoff_day:
                ended = True
            elif slug not in cards or (cards[slug][1] is None and day is not None):
                cards[slug] = (n, day)
        to = urljoin(base, target) if target else None
        if ended or not to or to in seen:
            break
        seen.add(to)
        at, n = to, n + 1
    return used, cards


def listing(cards, target):
    each = "".join(f"<div><h2><a href='/music-releases/{s}'>A long enough title {s}</a></h2><p>{'' if d is None else f'April {d}, 2026'}</p></div>" for s, d in cards)
    return each + (f"<a data-next='{target}'>load more</a>" if target else "")


def test_crawl_links(spark):
    rng = random.Random(12)
    pages = {}
    for i in range(80):
        cards = [(f"s{rng.randrange(60)}", rng.choice([None, 5, 9, 20, 20, 3 if rng.random() < 0.2 else 12])) for _ in range(rng.randrange(4))]
        cards = list(dict(cards).items())
        pages[f"https://edm.com/l/{i}"] = (cards, rng.choice([None, f"/l/{rng.randrange(90)}", f"/l/{rng.randrange(90)}", f"https://edm.com/l/{(i + 1) % 90}"]))
    recorded = [(u, listing(*p) if i % 2 else '{"html": "' + listing(*p) + '"}') for i, (u, p) in enumerate(pages.items())] + [("https://edm.com/null", None), (None, "x")]
    seeds = [(i, f"https://edm.com/l/{i % 85}") for i in range(100)] + [(200, None), (201, "https://edm.com/null")]
    cards, used = crawl.crawl(spark.createDataFrame(recorded, "url string, html string"), spark.createDataFrame(seeds, "crawl long, url string"), "A", "music", "2026-04-04", 7)
    want = {c: walk_links(pages, u, 4, 7) for c, u in seeds if u in pages}
    assert {r.crawl: (r.pages, r["last"]) for r in used.collect()} == {c: (len(w[0]), w[0][-1]) for c, w in want.items()}
    got = defaultdict(dict)
    for r in cards.collect():
        got[r.crawl][r.url.rpartition("/")[2]] = (r.n, int(r.publish_date[-2:]) if r.publish_date else None)
    assert got == {c: w[1] for c, w in want.items() if w[1]}


def test_crawl_numbers_stop_at_gaps_empty_and_stale_pages(spark):
    title = lambda s: f"<a href='https://weraveyou.com/2026/04/{s}'>Quite a long title {s}</a>"
    site = "https://weraveyou.com/x"
    recorded = [(f"{site}{c}/", title("a")) for c in "abcd"] + [(f"{site}{c}/page/2/", title("b")) for c in "abc"]
    recorded += [(f"{site}a/page/3/", "<p>no card</p>"), (f"{site}a/page/4/", title("z")), (f"{site}b/page/3/", title("a")), (f"{site}b/page/4/", title("z")), (f"{site}c/page/4/", title("z"))]
    seeds = [(c, f"{site}{c}/") for c in "abcde"]
    cards, used = crawl.crawl(spark.createDataFrame(recorded, "url string, html string"), spark.createDataFrame(seeds, "crawl string, url string"), "C", "house")
    assert {r.crawl: r.pages for r in used.collect()} == {"a": 3, "b": 3, "c": 2, "d": 1}
    assert sorted((r.crawl, r.url[-1]) for r in cards.collect()) == [("a", "a"), ("a", "b"), ("b", "a"), ("b", "b"), ("c", "a"), ("c", "b"), ("d", "a")]
