"""Crawls over recorded answers: a frontier that follows next-links, or numbered pages, until a stop rule.

Many crawls run at once. A crawl starts at an address; seeds with the same address
are one crawl. Every recorded page is read once for where its next batch comes from;
after that a step of all crawls is one join of the frontier (one slim row a crawl)
with these slim rows, which stay partitioned by address. Cards are made of the pages
that crawls have reached, and stop rules, which only ever cut a crawl's end off, are
applied by aggregation afterwards.

Stop rules: no recorded answer, no next-link, a next-link that the crawl has asked
for before (so cycles end), ``max_pages``; the page with a card before the cutoff is
the last; by site also a page without cards, or without new ones.

Defined results: several answers of one address count as one (the smallest text); a
seed or address that is null, and a null answer, is not there. A repeated seed gives
a result for each time.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.udf import arrow_udf
from ..functions.urls import paginated
from ..operators.components import checkpointed, join_stored
from .pages import anchor_cards, control_of, distinct_cards, next_address, page_anchors, unwrapped

# How each site goes on, and which pages end a crawl besides the cutoff.
FOLLOWS = {"A": "links", "B": "numbers", "C": "numbers"}
ENDS_EMPTY = {"A": False, "B": True, "C": True}
ENDS_STALE = {"A": False, "B": False, "C": True}


@arrow_udf("string")
def _control(text: pd.Series) -> pd.Series:
    """A page's load-more control as JSON, null without one."""
    found = (control_of(t) for t in text)
    return pd.Series([json.dumps(c) if c else None for c in found], dtype=object)


@arrow_udf("string")
def _next(control: pd.Series, base: pd.Series, batch: pd.Series) -> pd.Series:
    return pd.Series([next_address(json.loads(c), b, int(n)) if c else None for c, b, n in zip(control, base, batch, strict=True)], dtype=object)


def answers(recorded: DataFrame) -> DataFrame:
    """(url, html): one answer of each address."""
    return recorded.where("url is not null and html is not null").groupBy("url").agg(F.min("html").alias("html"))


def followed(held: DataFrame, bases: DataFrame, max_pages: int) -> DataFrame:
    """(base, n, address): the pages that crawls from each ``base`` reach by next-links; n counts from 1."""
    controls = held.select(F.col("url").alias("address"), _control(unwrapped(F.col("html"))).alias("control"))
    controls = checkpointed(controls.repartition("address"))  # read in every step, and not shuffled again
    none = F.expr("cast(array() as array<string>)")
    front = bases.select(F.col("base").alias("address"), "base", F.lit(1).alias("n"), none.alias("seen"))
    reached = []
    for n in range(1, max_pages + 1):
        got = checkpointed(front.join(controls, "address"))
        if not got.limit(1).collect():
            break
        reached.append(got.select("base", "n", "address"))
        step = got.where("control is not null").withColumn("_to", _next("control", "base", F.lit(n + 1)))
        step = step.where(F.col("_to").isNotNull() & ~F.array_contains("seen", F.col("_to")))
        front = step.select(F.col("_to").alias("address"), "base", F.lit(n + 1).alias("n"), F.array_append("seen", F.col("_to")).alias("seen"))  # at most max_pages entries
    out = bases.select("base", F.lit(0).alias("n"), F.lit("").alias("address")).limit(0)
    for part in reached:
        out = out.unionByName(part)
    return out


def numbered_pages(held: DataFrame, bases: DataFrame, max_pages: int) -> DataFrame:
    """(base, n, address): the numbered pages of each ``base`` up to the first that is not recorded."""
    asked = bases.select("base", F.explode(F.sequence(F.lit(1), F.lit(max_pages))).alias("n")).withColumn("address", paginated(F.col("base"), F.col("n")))
    there = asked.join(held.select(F.col("url").alias("address")), "address").select("base", "n", "address")
    without_gap = F.size(F.filter(F.array_sort(F.collect_set("n")), lambda n, i: n == i + 1))  # at most max_pages numbers
    last = there.groupBy("base").agg(without_gap.alias("_last"))
    return there.join(last, "base").where(F.col("n") <= F.col("_last")).drop("_last")


def last_pages(visited: DataFrame, cards: DataFrame, site: str) -> DataFrame:
    """(base, last): the page after which each crawl stops, by the site's rules.

    cards: base, n, url, publish_date, old. A card is new on the page where its URL
    first occurs, and again where it first has a date.
    """
    fresh = cards.where("not old").groupBy("base", "url").agg(F.min("n").alias("first"), F.min(F.when(F.col("publish_date").isNotNull(), F.col("n"))).alias("dated"))
    news = fresh.select("base", F.explode(F.array_distinct(F.array_compact(F.array("first", "dated")))).alias("n")).distinct().withColumn("_new", F.lit(True))
    per = cards.groupBy("base", "n").agg(F.max("old").alias("reached"), F.count_if(~F.col("old")).alias("count"))
    pages = visited.select("base", "n").join(per, ["base", "n"], "left").join(news, ["base", "n"], "left")
    ends = F.coalesce("reached", F.lit(False))
    if ENDS_EMPTY[site]:
        ends = ends | (F.coalesce("count", F.lit(0)) == 0)
    if ENDS_STALE[site]:
        ends = ends | F.col("_new").isNull()
    return pages.groupBy("base").agg(F.coalesce(F.min(F.when(ends, F.col("n"))), F.max("n")).alias("last"))


def crawl(recorded: DataFrame, seeds: DataFrame, site: str, category: str, cutoff: str | None = None, max_pages: int = 10, follow: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(cards, pages) of all crawls. recorded: url, html. seeds: crawl, url.

    cards: crawl, n, url, title, source_name, category, publish_date, snippet, of each
    URL of a crawl its first dated card, or its first one. pages: crawl, pages (how
    many were used), last (the address of the last one).
    """
    held = checkpointed(answers(recorded))
    starts = seeds.where("url is not null").select("crawl", F.col("url").alias("base"))
    bases = starts.select("base").distinct()
    visited = checkpointed((followed if (follow or FOLLOWS[site]) == "links" else numbered_pages)(held, bases, max_pages))
    # a page is read once, however many crawls reach it; only its links' addresses depend on the crawl
    reached = held.join(visited.select(F.col("address").alias("url")).distinct(), "url", "left_semi")
    anchors = checkpointed(page_anchors(reached.select(F.col("url").alias("page"), unwrapped(F.col("html")).alias("html")), site).withColumnRenamed("page", "address"))
    seen = join_stored(visited, anchors, "address").withColumns({"page": F.struct("base", "n"), "_base": F.col("base")})
    cards = anchor_cards(seen, site, category, cutoff)
    cards = checkpointed(cards.select(F.col("page.base").alias("base"), F.col("page.n").alias("n"), *[c for c in cards.columns if c != "page"]))
    last = checkpointed(last_pages(visited, cards, site))
    within = cards.join(last, "base").where(F.col("n") <= F.col("last")).drop("last").withColumn("page", F.struct("base", "n"))
    one = distinct_cards(within, site).select(F.col("page.base").alias("base"), F.col("page.n").alias("n"), "url", "title", "source_name", "category", "publish_date", "snippet")
    undated = F.when(F.col("publish_date").isNotNull(), 0).otherwise(1)
    best = one.groupBy("base", "url").agg(F.min_by(F.struct("n", "title", "source_name", "category", "publish_date", "snippet"), F.struct(undated, "n")).alias("r")).select("base", "url", "r.*")
    used = visited.join(last, "base").where(F.col("n") <= F.col("last")).groupBy("base").agg(F.count(F.lit(1)).alias("pages"), F.max_by("address", "n").alias("last"))
    return starts.join(best, "base").drop("base"), starts.join(used, "base").drop("base")
