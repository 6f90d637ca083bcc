"""Rules on written cases: headlines, registration codes, dates, feeds."""

from pyspark.sql import functions as F

from lodestrata.functions import dates
from lodestrata.operators import classify, extract, filters
from lodestrata.sources import pages

AS_OF = "2026-02-01"
#: Headlines of our own with what the profile-A rules make of them.
HEADLINES = (
    ("Nova Reyes Drops New Single 'Glass Harbor'", True, 0.6, "Nova Reyes", "Glass Harbor"),
    ("Kite Parade Unveils 'Slow Tide' EP: Listen", True, 0.85, "Kite Parade", "Slow Tide"),
    ("Aldo Fenn - Paper Moons [Night Label]", False, 0.0, "Aldo Fenn", "Paper Moons"),
    ("Marlow Festival Reveals Full Lineup", True, 0.4, None, None),
    ("Watch Nova Reyes Play A Rooftop Set", False, 0.0, None, None),
    ("Ten Fresh Picks For Your Weekend Playlist", False, 0.0, None, None),
    ("Kite Parade Announces Next Single", False, 0.0, None, None),
    ("Ida Brandt Remixes \"Copper Wire\"", False, 0.2, "Ida Brandt", "Copper Wire"),
    ("Ida Brandt Shares Debut Album 'Fields Of Static'", True, 0.6, "Ida Brandt", "Fields Of Static"),
    ("Interview: Ida Brandt On Her Studio", False, 0.0, None, None),
)
CODES = (("GBEFR2309157", 2023), ("USRC12600001", 2026), ("QZABC8012345", 1980), ("short", None), ("XXABCZZ12345", None), (None, None))
WRITTEN = (
    ("2026-04-30", "2026-04-30"), ("2026/04/10 12:00:00 +0000", "2026-04-10"), ("2026-04-10T23:30:00-05:00", "2026-04-10"), ("2026-04-10T00:00:00Z", "2026-04-10"), ("20260410", "2026-04-10"),
    ("2026", None), ("2026-04", None), ("2026-02-30", None), ("soon", None), ("", None),
)
FEED = "<rss><channel><item><title>Nova Reyes Drops 'Glass Harbor'</title><link>https://www.edm.com/music-releases/nova-reyes?utm=1</link><pubDate>Fri, 24 Apr 2026 10:00:00 +0000</pubDate><category>Music Releases</category><description>&lt;p&gt;Out now&lt;/p&gt;</description></item><item><title>About this site</title><link>https://edm.com/about</link></item></channel></rss>"


def test_headlines(spark):
    t = F.col("title")
    df = spark.createDataFrame([(h[0],) for h in HEADLINES], "title string").select("title", classify.classify(t).alias("c"), extract.from_title(t).alias("x"))
    got = {r.title: (r.title, r.c["release_article"], round(r.c["confidence_score"], 3), r.x["artist"] if r.x else None, r.x["title"] if r.x else None) for r in df.collect()}
    assert got == {h[0]: h for h in HEADLINES}


def test_codes_and_dates(spark):
    c = F.col("code")
    codes = spark.createDataFrame([(x,) for x, _ in CODES], "code string").select("code", filters.isrc_year(c).alias("y"), filters.isrc_outside_window(c, AS_OF, 7).alias("o"))
    assert [(r.code, r.y, r.o) for r in codes.collect()] == [(x, y, y is not None and y != 2026) for x, y in CODES]
    days = spark.createDataFrame([(w,) for w, _ in WRITTEN], "w string").select("w", dates.parse_date(F.col("w")).cast("string").alias("d"))
    assert [tuple(r) for r in days.collect()] == list(WRITTEN)


def test_feed(spark):
    feeds = spark.createDataFrame([(FEED,), ("<rss><channel><item><title>broken",)], "xml string")
    got = pages.cards_from_feed(feeds, "A", "music-releases", "2026-04-20").select("title", "url", "publish_date", "snippet", "category").collect()
    assert [tuple(r) for r in got] == [("Nova Reyes Drops 'Glass Harbor'", "https://edm.com/music-releases/nova-reyes", "2026-04-24", "Out now", "Music Releases")]
