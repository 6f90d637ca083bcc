"""What recorded web pages hold: metadata, body text, links, article cards, feeds.

Fetching is not the engine's business: pages come as a table (url, html). The
HTML functions are Arrow UDFs over whole batches; everything after them is
built-in columns. A null page gives empty results.
"""

from __future__ import annotations

import html as entities
import json
import re
from urllib.parse import urlencode, urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import DATE_IN_TEXT, date_in_text, human_date
from ..functions.text import clean_text, html_unescape
from ..functions.udf import arrow_udf
from ..functions.urls import canonical, is_music_link, looks_like_article
from ..operators.components import spread
from .dom import HIDDEN, body, parse

_SPACE = re.compile(r"\s+")
#: Without players, which the body text leaves out.
_NOT_TEXT = HIDDEN | {"iframe"}


def _plain(s: str) -> str:
    return _SPACE.sub(" ", s).strip()


def _udf(kind: str, fn):
    @arrow_udf(kind)
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: fn(parse(p or "")))

    return run


def _metas(root) -> dict[str, str]:
    out = {}
    for n in root.walk():
        if n.tag == "meta":
            k, v = n.attrs.get("property") or n.attrs.get("name"), n.attrs.get("content")
            if k and v and k.startswith(("og:", "twitter:")):
                out[k] = _plain(v)  # the last of equal keys wins
    return out


def _container(root):
    return root.first("article") or root.first("main")


def _hrefs(root) -> list[str]:
    box = _container(root) or root
    media = [n for n in box.walk() if n.tag in ("a", "iframe", "embed")]
    return [n.attrs["href"] for n in media if n.attrs.get("href")] + [n.attrs["src"] for n in media if n.tag != "a" and n.attrs.get("src")]


def _ld(root) -> list[str]:
    return [n.text() for n in root.walk() if n.tag == "script" and n.attrs.get("type") == "application/ld+json"]


#: Metadata of a page: og: and twitter: tags.
html_meta = _udf("map<string,string>", _metas)
#: Text of the article, else the main part, else the body.
html_text = _udf("string", lambda root: _plain((_container(root) or body(root)).text(_NOT_TEXT)))
#: First heading.
html_title = _udf("string", lambda root: _plain(n.text()) if (n := root.first("h1")) else "")
#: Link targets of the article: all href, then all src.
html_links = _udf("array<string>", _hrefs)
#: Bodies of JSON-LD scripts.
json_ld = _udf("array<string>", _ld)


def terminated_references(html: Column) -> Column:
    """``html`` for a reader to whom only references that end in a semicolon are references: the ``&`` of any other is written out."""
    return F.regexp_replace(html, r"&(?!#?[A-Za-z0-9]+;)", "&amp;")


def _page(root) -> dict:
    """All of the above, of a page that is parsed once."""
    head, hrefs = root.first("h1"), _hrefs(root)
    return {"meta": _metas(root), "heading": _plain(head.text()) if head else "", "hrefs": hrefs, "text": _plain((_container(root) or body(root)).text(_NOT_TEXT)), "ld": _ld(root)}


_PAGE = "struct<meta:map<string,string>,heading:string,hrefs:array<string>,text:string,ld:array<string>>"


@arrow_udf(_PAGE)
def page_contents(pages: pd.Series) -> pd.DataFrame:
    """Metadata, heading, link targets, text and JSON-LD of pages, as by the functions above."""
    return pd.DataFrame([_page(parse(p or "")) for p in pages], columns=["meta", "heading", "hrefs", "text", "ld"])


@arrow_udf("array<string>")
def absolute(base: pd.Series, links: pd.Series) -> pd.Series:
    """Links made absolute against their page."""
    return pd.Series([[urljoin(b or "", x) for x in (() if k is None else k)] for b, k in zip(base, links, strict=True)])


def music_links(html: Column, url: Column, profile: str = "A") -> Column:
    return music_hrefs(html_links(html), url, profile)


def music_hrefs(hrefs: Column, url: Column, profile: str = "A") -> Column:
    return F.array_distinct(F.filter(absolute(url, hrefs), lambda x: is_music_link(x, profile)))


def json_ld_objects(html: Column) -> Column:
    """array<variant>: objects of the page's JSON-LD; malformed blocks are skipped."""
    return parsed_objects(json_ld(html))


def parsed_objects(blocks: Column) -> Column:
    parsed = F.filter(F.transform(blocks, lambda s: F.try_parse_json(s)), lambda v: v.isNotNull())
    return F.flatten(F.transform(parsed, lambda v: F.when(F.schema_of_variant(v).like("ARRAY%"), F.try_variant_get(v, "$", "array<variant>")).otherwise(F.array(v))))


def enrich(articles: DataFrame, pages: DataFrame, profile: str = "A", parity: bool = False) -> DataFrame:
    """Articles with what their page says; a page that is missing gives empty fields.

    parity: as if the body had been cut out of the page before links and
    JSON-LD were looked for (players and JSON-LD are then never found).
    """
    from ..operators.extract import body_matches

    recorded = pages.select(F.col("url").alias("_u"), "html", F.lit(True).alias("_held"), F.lit(False).alias("_asked"))
    asked = articles.select(F.col("url").alias("_u")).distinct().select("_u", F.lit(None).cast("string").alias("html"), F.lit(False).alias("_held"), F.lit(True).alias("_asked"))
    rows, size = recorded.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("html")), F.lit(0))).first()
    met = spread(recorded.unionByName(asked).where("_u is not null"), "_u", rows=rows, size=size)  # no join of whole pages, which would sort them in fewer tasks
    held = met.groupBy("_u").agg(F.min("html").alias("html"), F.bool_or("_held").alias("_held"), F.bool_or("_asked").alias("_asked")).where("_held and _asked")  # one page of each address
    links = music_hrefs(F.col("p.hrefs"), F.col("_u"), profile)
    if parity:
        links = F.filter(links, lambda x: ~F.contains(x, F.lit("/embed/")))
    read = held.select("_u", page_contents("html").alias("p"))
    read = read.select("_u", F.col("p.meta").alias("open_graph"), F.col("p.text").alias("body_text"), links.alias("embedded_music_links"))
    read = read.withColumn("body_release_matches", body_matches(F.col("body_text"), profile))
    # merged: by the size of the file that pages come from, Spark would take them for few and send all that they say to every task
    return articles.join(read.hint("merge"), articles["url"] == read["_u"], "left").drop("_u")


# --- article cards -----------------------------------------------------------------------

_CARD = "array<struct<href:string,text:string,around:string>>"


def _anchors(headings_only: bool):
    def find(root) -> list[dict]:
        out = []
        for n in root.walk():
            if n.tag == "a" and n.attrs.get("href") and (not headings_only or n.up("h1", "h2", "h3", "article")):
                box = n.up("article", "div", "li", "section")
                out.append({"href": n.attrs["href"], "text": _plain(n.text()), "around": _plain(box.text()) if box else None})
        return out

    return find


_heading_anchors, _all_anchors = _udf(_CARD, _anchors(True)), _udf(_CARD, _anchors(False))

# Link texts that are no titles, by site.
NO_TITLES = {"A": ("read more", "home", "music releases"), "B": ("read more", "home", "music"), "C": ("read more", "home", "music", "house")}
SOURCE_NAMES = {"A": "EDM.com", "B": "EDMTunes", "C": "We Rave You"}
SHORTEST_TITLE = 12


@arrow_udf("string")
def _joined_url(base: pd.Series, href: pd.Series) -> pd.Series:
    return pd.Series([urljoin(b or "", h or "") for b, h in zip(base, href, strict=True)])


def cards_from_pages(pages: DataFrame, site: str, category: str, cutoff: str | None = None) -> DataFrame:
    """Article cards of archive pages (url, html, page); ``old`` marks those before the cutoff.

    Old cards are not returned as cards but tell :func:`crawled` where to stop.
    """
    rows = page_anchors(pages.select(F.struct("page", F.col("url").alias("base")).alias("page"), "html"), site)
    return anchor_cards(rows.select("page.page", F.col("page.base").alias("_base"), *rows.columns[1:]), site, category, cutoff)


def page_anchors(pages: DataFrame, site: str) -> DataFrame:
    """What pages (page, html) say of their links, whatever address they are seen from: page, pos, href, title, publish_date, snippet."""
    anchors = (_all_anchors if site == "C" else _heading_anchors)(F.col("html"))
    rows = pages.select("page", F.posexplode(anchors).alias("pos", "a"))
    text = clean_text(F.col("a.text"))
    bare = html_unescape(text) if site != "C" else text
    if site != "A":
        bare = F.regexp_replace(bare, r"(?i)^Latest news\s+", "")
    bare = F.regexp_replace(bare, r"(?i)\s+Read more\s*$", "")
    rows = rows.withColumns({"_text": text, "_bare": bare}).where((F.col("_text") != "") & ~F.lower("_text").isin(*NO_TITLES[site]))
    own = date_in_text(F.col("_bare"))
    day = own if site == "C" else F.coalesce(own, date_in_text(F.coalesce(F.col("a.around"), F.lit(""))))
    title = clean_text(F.regexp_replace(F.col("_bare"), DATE_IN_TEXT, " "))
    near = clean_text(F.regexp_replace(F.replace(clean_text(F.coalesce(F.col("a.around"), F.lit(""))), F.col("_text"), F.lit(" ")), DATE_IN_TEXT, " "))
    snippet = F.when((near != "") & (F.lower(near) != "read more"), F.substring(near, 1, 300))
    rows = rows.select("page", "pos", F.col("a.href").alias("href"), title.alias("title"), day.cast("string").alias("publish_date"), snippet.alias("snippet"))
    return rows.where(F.length("title") >= SHORTEST_TITLE)


def anchor_cards(rows: DataFrame, site: str, category: str, cutoff: str | None = None) -> DataFrame:
    """The rows of :func:`page_anchors` with ``_base``, the address that each is seen from, as cards."""
    rows = rows.withColumn("_abs", _joined_url("_base", "href"))
    rows = rows.where(looks_like_article(canonical(F.col("_abs"), "edm.com") if site == "A" else F.col("_abs"), site))
    url = canonical(F.col("_abs"), "edm.com") if site == "A" else canonical(F.col("_abs")) if site == "B" else F.col("_abs")
    rows = rows.select("page", "pos", "title", url.alias("url"), F.lit(SOURCE_NAMES[site]).alias("source_name"), F.lit(category).alias("category"), "publish_date", "snippet")
    old = F.lit(False) if cutoff is None else F.coalesce(F.col("publish_date").cast("date") < F.lit(cutoff).cast("date"), F.lit(False))
    return rows.withColumn("old", old)


def distinct_cards(cards: DataFrame, site: str) -> DataFrame:
    """One card for each URL of a page: the last (site A), else the first, or the first dated one if that has no date."""
    dated = F.when(F.col("publish_date").isNotNull(), 0).otherwise(1)
    order = F.struct(-F.col("pos")) if site == "A" else F.struct(dated, F.col("pos"))
    fields = [c for c in cards.columns if c not in ("url", "page")]
    return cards.where(~F.col("old")).groupBy("page", "url").agg(F.min_by(F.struct(*fields), order).alias("r")).select("page", "url", "r.*")


def crawled(cards: DataFrame, stop_without_new: bool = False) -> DataFrame:
    """Cards of the pages up to the first one that reaches the cutoff, has no card, or (optionally) no new card.

    Pages are numbered from 1; a page that is not there counts as one without cards.
    """
    named = cards.where("url is not null and page is not null")
    news = named.groupBy("url").agg(F.min("page").alias("page")).groupBy("page").agg(F.lit(True).alias("_new"))  # pages where a URL occurs first
    per = named.groupBy("page").agg(F.max("old").alias("reached"), F.count_if(~F.col("old")).alias("n"))
    following = per.select((F.col("page") - 1).alias("page"), F.lit(True).alias("_next"))
    numbered = per.join(news, "page", "left").join(following, "page", "left")
    stop = F.when(F.col("reached"), F.col("page")).when((F.col("n") == 0) | (F.lit(stop_without_new) & F.col("_new").isNull()), F.col("page") - 1)
    gap = F.when(F.col("_next").isNull(), F.col("page"))  # a page without a next one
    last = numbered.agg(F.least(F.coalesce(F.min(stop), F.max("page")), F.min(gap)).alias("last"))
    return cards.where(~F.col("old")).join(F.broadcast(last), F.col("page") <= F.col("last")).drop("last")


def control_of(text: str | None) -> tuple[str | None, dict[str, str]] | None:
    """(target, query) of what a page's next batch comes from: a load-more control's target, else a listing's data."""
    root = parse(text or "")
    for n in root.walk():
        if n.tag in ("a", "button") and "load more" in _plain(n.text()).lower():
            for k in ("href", "data-href", "data-url", "data-endpoint", "data-next", "data-next-url"):
                if n.attrs.get(k):
                    return n.attrs[k], {}
    for n in root.walk():
        if {"ajax-load-more-wrap", "alm-listing"} & set(n.classes()):
            return None, {k[5:].replace("-", "_"): v for k, v in n.attrs.items() if k.startswith("data-")}
    return None


def next_address(control: tuple[str | None, dict[str, str]] | None, base: str, batch: int) -> str | None:
    """The address of a batch: the control's target, or the listing's endpoint, as seen from ``base``."""
    if control is None:
        return None
    target, query = control
    return urljoin(base, target if target is not None else "/wp-json/ajaxloadmore/posts?" + urlencode({"page": str(batch), "category": "music-releases"} | query))


@arrow_udf("string")
def load_more_url(page: pd.Series, url: pd.Series, batch: pd.Series) -> pd.Series:
    """Where a page's next batch comes from (see :func:`control_of`)."""
    return pd.Series([next_address(control_of(t), b, n) for t, b, n in zip(page, url, batch, strict=True)])


@arrow_udf("string")
def unwrapped(payload: pd.Series) -> pd.Series:
    """HTML inside a load-more answer, which may be JSON or HTML itself."""

    def one(text: str) -> str:
        text = (text or "").strip()
        if text.startswith("{"):
            try:
                data = json.loads(text)
            except ValueError:
                data = {}
            for k in ("html", "data", "posts", "content"):
                v = data.get(k)
                if isinstance(v, str):
                    return v
                if isinstance(v, list):
                    return "\n".join(str(i.get("html") or i.get("content") or i.get("title", "")) if isinstance(i, dict) else str(i) for i in v)
        return text

    return payload.map(one)


# --- feeds ---------------------------------------------------------------------------------

_ITEM = "title string, link string, pubDate string, category array<string>, description string"


@arrow_udf("string")
def _fragment_text(markup: pd.Series) -> pd.Series:
    return markup.map(lambda m: _plain(parse(entities.unescape(m)).text()), na_action="ignore")


def cards_from_feed(feeds: DataFrame, site: str, category: str, cutoff: str | None = None) -> DataFrame:
    """Cards of RSS documents (column ``xml``); undated items pass, malformed feeds give none."""
    whole = F.col("xml").rlike(r"(?s)<(rss|rdf|feed|channel)\b.*</(rss|rdf|feed|channel)[^>]*>\s*$")
    items = F.regexp_extract_all("xml", F.lit(r"(?s)<item\b.*?</item>"), F.lit(0))
    rows = feeds.where(whole).select(F.posexplode(items).alias("pos", "item"))
    rows = rows.select("pos", F.from_xml("item", _ITEM, {"mode": "PERMISSIVE", "rowTag": "item"}).alias("i")).where("i is not null")
    url = clean_text(F.coalesce("i.link", F.lit("")))
    url = canonical(url, "edm.com") if site == "A" else canonical(url)
    day = human_date(F.col("i.pubDate"))
    kinds = F.array_join(F.filter(F.transform(F.coalesce("i.category", F.expr("cast(array() as array<string>)")), lambda x: F.trim(x)), lambda x: x != ""), ", ")
    rows = rows.select(
        "pos", clean_text(F.coalesce("i.title", F.lit(""))).alias("title"), url.alias("url"), F.lit(SOURCE_NAMES[site]).alias("source_name"),
        F.when(kinds != "", kinds).otherwise(category).alias("category"), day.cast("string").alias("publish_date"), F.nullif(F.substring(_fragment_text("i.description"), 1, 500), F.lit("")).alias("snippet"),
    ).where("title <> '' and url <> ''")
    if site == "A":
        rows = rows.where(looks_like_article(F.col("url"), site))
    return rows if cutoff is None else rows.where(F.coalesce(F.col("publish_date").cast("date") >= F.lit(cutoff).cast("date"), F.lit(True)))
