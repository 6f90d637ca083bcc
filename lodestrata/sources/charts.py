"""Charts from recorded pages and recorded tables, as releases."""

from __future__ import annotations

import re
from itertools import pairwise

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import millis_date
from ..functions.numbers import number_string
from ..functions.text import clean_text
from ..functions.udf import arrow_udf
from ..functions.urls import song_url
from ..operators.extract import rubric, type_from_flags, type_from_title
from ..operators.filters import active_rows, not_in_future
from ..operators.match import last_wins_join
from .dom import HIDDEN, body, parse

# Charts, fallback charts, texts that end a section.
CHART_SOURCE, CHART_ROOT = "1001Tracklists", "https://www.1001tracklists.com"
CHARTS = (
    ("Top {genre} Newcomer Tracks", "nc", "first played in the last 21-30 days", "unique_dj_plays", 0.92),
    ("Most Heard {genre} Tracks", "mh", "track-player opens in the last 7 days", "listener_track_player_opens", 0.84),
)
FALLBACK_CHARTS = (
    ("Daily Newcomer Tracks", "daily newcomer chart", "daily_newcomer_rank", 0.82),
    ("Most Heard Tracks", "recent track-player opens", "most_heard_rank", 0.80),
    ("Weekly DJ Support Tracks", "unique DJ support in the last 4 weeks", "unique_dj_support_rank", 0.78),
)
SECTION_STOPS = ("This chart", "Most Watched", "Last IDed", "Genres", "Hot Shows", "Hot Events", "Most Viewed", "Most Liked")
CHALLENGES = ("challenges.cloudflare.com/turnstile", "please wait, you will be forwarded", 'name="captcha"')
#: Tokens after a rank in which its track has to come.
TRACK_REACH = 8

_EDGES = " \t\r\n,;:-"
_TRACKS = "array<struct<rank:int,artist:string,title:string,label:string,track_href:string,label_href:string,chart_name:string,chart_window:string,chart_metric:string,confidence:double>>"


def _plain(s: str) -> str:
    return re.sub(r"\s+", " ", s.replace(" ", " ")).strip(_EDGES)


def _split(text: str) -> tuple[str, str] | None:
    left, dash, right = _plain(text).partition(" - ")
    return (_plain(left), _plain(right)) if dash and _plain(left) and _plain(right) else None


def _tokens(root) -> list[tuple[str, str | None]]:
    """(text, link) of each visible string; equal neighbours once."""
    out: list[tuple[str, str | None]] = []
    for s, parent in body(root).strings(HIDDEN):
        text = _plain(s)
        if text:
            anchor = parent if parent.tag == "a" else parent.up("a")
            token = (text, (anchor.attrs.get("href") or None) if anchor else None)
            if not out or out[-1] != token:
                out.append(token)
    return out


def _section(tokens: list[tuple[str, str | None]], name: str) -> list[tuple[str, str | None]]:
    """The tokens between a chart's heading and the next section."""
    start = next((i for i, (t, _) in enumerate(tokens) if t.lower() == name.lower()), None)
    if start is None:
        return []
    names = {c[0].format(genre="House") for c in CHARTS}  # headings of other genres do not end a section
    out = []
    for t in tokens[start + 1 :]:
        if t[0] != name and (t[0].startswith(SECTION_STOPS) or t[0] in names):
            break
        out.append(t)
    return out


def sidebar_tracks(html: str, genre: str) -> list[dict]:
    """Tracks of the two sidebar charts: a rank, its track within reach, perhaps a label."""
    tokens, out = _tokens(parse(html or "")), []
    for template, _, window, metric, confidence in CHARTS:
        name = template.format(genre=genre)
        section = _section(tokens, name)
        ranks = [i for i, (t, _) in enumerate(section) if t.isdigit()]
        for i, stop in pairwise([*ranks, len(section)]):
            at = next((k for k in range(i + 1, min(i + 1 + TRACK_REACH, stop)) if _split(section[k][0])), None)
            if at is None:
                continue
            artist, title = _split(section[at][0])
            after = section[at + 1] if at + 1 < stop else None
            label = after if after and after[0] != "Show More" and not _split(after[0]) else None
            out.append(
                {"rank": int(section[i][0]), "artist": artist, "title": title, "label": label[0] if label else None, "track_href": section[at][1], "label_href": label[1] if label else None,
                 "chart_name": name, "chart_window": window, "chart_metric": metric, "confidence": confidence}
            )
    return out


def page_tracks(html: str, name: str, window: str, metric: str, confidence: float) -> list[dict]:
    """Tracks of a chart page's rows, with the row's figure after the metric."""
    out = []
    for row in parse(html or "").with_class("bItm"):
        if row.tag != "div" or "oItm" not in row.classes():
            continue
        held = lambda c: next(row.with_class(c), None)  # noqa: B023, E731
        rank = _plain(held("bRank").text()) if held("bRank") else ""
        link = next((n for n in row.walk() if n.tag == "a" and "/track/" in n.attrs.get("href", "")), None)
        pair = _split(link.text()) if link else None
        if not rank.isdigit() or not pair:
            continue
        label = next((a for b in row.with_class("trackLabel") for a in b.walk() if a.tag == "a" and "href" in a.attrs), None)
        figure = next((_plain(s.text()) for c in ("playC", "badgeSpotify") for b in row.with_class(c) for s in b.walk() if s.tag == "span"), "")
        out.append(
            {"rank": int(rank), "artist": pair[0], "title": pair[1], "label": _plain(label.text()) if label else None, "track_href": link.attrs["href"], "label_href": label.attrs["href"] if label else None,
             "chart_name": name, "chart_window": window, "chart_metric": f"{metric}:{figure}" if figure else metric, "confidence": confidence}
        )
    return out


@arrow_udf(_TRACKS)
def chart_tracks(html: pd.Series, genre: pd.Series) -> pd.Series:
    return pd.Series([sidebar_tracks(h, g) for h, g in zip(html, genre, strict=True)])


@arrow_udf(_TRACKS)
def chart_rows(html: pd.Series, chart: pd.Series) -> pd.Series:
    """Rows of a fallback chart's page; ``chart`` is its place in the list."""
    return pd.Series([page_tracks(h, *FALLBACK_CHARTS[int(n)]) for h, n in zip(html, chart, strict=True)])


def is_challenge(html: Column) -> Column:
    low, out = F.lower(html), F.lit(False)
    for c in CHALLENGES:
        out = out | F.contains(low, F.lit(c))
    return out


def _absolute(href: Column) -> Column:
    return F.when(href.rlike("^https?://"), href).when(F.startswith(href, F.lit("//")), F.concat(F.lit("https:"), href)).otherwise(F.concat(F.lit(CHART_ROOT + "/"), F.ltrim(href, F.lit("/"))))


def charted(pages: DataFrame, fallback: bool = True, max_pages: int = 3) -> DataFrame:
    """Chart tracks of recorded pages (url, html, genre, fallback_chart).

    Where every genre page is a challenge, the first ``max_pages`` fallback
    charts stand in. A challenged page gives no row rather than an error.
    """
    open_ = pages.where(~is_challenge(F.col("html")))
    main = open_.where("fallback_chart is null").select(F.explode(chart_tracks("html", "genre")).alias("t"))
    if not fallback:
        return main.select("t.*")
    other = open_.where(F.col("fallback_chart") < max_pages).select(F.explode(chart_rows("html", "fallback_chart")).alias("t"))
    refused = pages.where("fallback_chart is null").agg(F.coalesce(F.min(is_challenge(F.col("html")).cast("int")), F.lit(1)).alias("all_refused"))
    return main.unionByName(other.join(F.broadcast(refused), F.col("all_refused") == 1).drop("all_refused")).select("t.*")


def chart_releases(tracks: DataFrame) -> DataFrame:
    """Chart tracks as releases; they have no date."""
    blank = lambda c: F.coalesce(c, F.lit(""))
    bag = F.create_map(
        F.lit("chart_name"), F.col("chart_name"), F.lit("chart_rank"), F.col("rank").cast("string"), F.lit("chart_window"), F.col("chart_window"), F.lit("chart_metric"), F.col("chart_metric"),
        F.lit("label"), blank(F.col("label")), F.lit("label_url"), blank(_absolute(F.col("label_href"))),
    )
    return tracks.select(
        "artist", F.col("title").alias("track_or_project_title"), type_from_title(F.col("title")).alias("release_type"), F.col("confidence").alias("confidence_score"),
        F.lit("1001tracklists_sidebar_chart").alias("extraction_method"), F.concat_ws(" - ", "artist", "title").alias("source_article_title"),
        F.coalesce(_absolute(F.col("track_href")), F.lit(CHART_ROOT)).alias("source_article_url"), F.lit(CHART_SOURCE).alias("source_name"), F.lit(None).cast("string").alias("article_date"),
        F.expr("cast(array() as array<string>)").alias("embedded_music_links"), bag.alias("open_graph"), F.lit(True).alias("release_article"),
    )


def updater_params(html: Column, chart_name: str) -> Column:
    """map<string,string>: the object literal of the updater script after a chart's heading."""
    at = F.position(F.lit(chart_name), html)
    section = F.when(at > 0, F.substring(html, at, 6000))
    literal = F.regexp_extract(section, r"(?s)StatisticUpdater\s*\([^,]+,\s*(\{.*?\})\s*\)", 1)
    entry = r"""([A-Za-z_][\w-]*)\s*:\s*(?:'([^']*)'|"([^"]*)"|([^,{}]+))"""
    part = lambda i: F.regexp_extract_all(literal, F.lit(entry), F.lit(i))
    values = F.zip_with(F.zip_with(part(2), part(3), lambda a, b: F.concat(a, b)), part(4), lambda ab, c: F.trim(F.concat(ab, c)))
    found = F.map_from_entries(F.zip_with(part(1), values, lambda k, v: F.struct(k.alias("key"), v.alias("value"))))
    own = next((c[1] for c in CHARTS if c[0].format(genre="House") == chart_name), None)
    defaults = F.create_map(*[F.lit(x) for x in ("mode", "9", *(("params", own) if own else ()))])
    merged = F.map_zip_with(defaults, found, lambda _, d, f: F.coalesce(f, d))
    return F.when(literal != "", merged).otherwise(F.expr("cast(map() as map<string,string>)"))


# --- chart of a submission service ---------------------------------------------------------


def subgenres(genres: DataFrame, parent: str) -> DataFrame:
    """Names of a parent's genres; the parent itself if it has none. One row (names array)."""
    own = genres.where((F.col("parent") == parent) & (F.coalesce("name", F.lit("")) != "")).agg(F.collect_list("name").alias("names"))  # the service's genre list
    return own.select(F.when(F.size("names") > 0, F.col("names")).otherwise(F.array(F.lit(parent))).alias("names"))


def popular(summaries: DataFrame, names: DataFrame, now_ms: int) -> DataFrame:
    """Summaries with two points or more in one of the genres, not hidden, active in the last 192 hours."""
    active = active_rows(summaries, now_ms, 192, "updated", "popular_week").where("points >= 2 and not coalesce(hidden, false)")
    return active.join(F.broadcast(names), F.arrays_overlap("top_3", "names")).drop("names")


def popular_tracks(tracks: DataFrame, now_ms: int) -> DataFrame:
    """Tracks released in the last 720 hours whose week mark is missing or within 192 hours."""
    hour = now_ms - now_ms % 3_600_000
    week = F.col("popular_week").isNull() | (F.col("popular_week") >= hour - 192 * 3_600_000)
    return tracks.where((F.col("released") >= hour - 720 * 3_600_000) & week)


def submission_releases(summaries: DataFrame, tracks: DataFrame, as_of: str, zone: str = "UTC", limit: int | None = None) -> DataFrame:
    """Summaries (rank, tracks, points, approved, rgb, complete, country, tags) joined with their last track.

    Ranks are given before rows without a track are dropped, so gaps are right.
    Sorted by points, equal points by rank.
    """
    known = summaries.where(F.size("tracks") > 0).withColumn("_last", F.element_at("tracks", -1))
    rows = last_wins_join(known, tracks, "_last", "id", "pos")
    day = millis_date(F.col("released"), zone)
    title = F.regexp_replace(clean_text(F.coalesce("title", F.lit(""))), "^[\"'“”‘’]+|[\"'“”‘’]+$", "")
    rows = rows.withColumns({"artist": clean_text(F.coalesce("artist", F.lit(""))), "title": title, "_day": day}).where("artist <> '' and title <> ''").where(not_in_future(F.col("_day"), as_of))
    points = F.coalesce(F.col("points"), F.lit(0.0))
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("string")
    urls = F.array_distinct(F.filter(F.coalesce("source_urls", F.expr("cast(array() as array<string>)")), lambda u: F.coalesce(u, F.lit("")) != ""))
    bag = F.create_map(
        F.lit("chart_rank"), F.col("rank").cast("string"), F.lit("popular_points"), number_string(points), F.lit("hot_or_not_likes"), count("approved"), F.lit("curator_approvals"), count("approved"),
        F.lit("rgb_bonus"), count("rgb"), F.lit("approval_responses"), count("complete"), F.lit("country"), F.coalesce("country", F.lit("")), F.lit("genres"), F.array_join("tags", ", "),
        F.lit("label"), clean_text(F.coalesce("label", F.lit(""))), F.lit("submitHub_track_id"), F.col("_last"),
    )
    sure = rubric(0.65, (points >= 20, 0.15), (F.col("approved") >= 20, 0.10), (F.size("tags") > 0, 0.05))
    out = rows.orderBy(points.desc(), "rank")
    out = out.limit(limit) if limit else out
    return out.select(
        "artist", F.col("title").alias("track_or_project_title"), type_from_flags(F.col("unoriginal")).alias("release_type"), sure.alias("confidence_score"), F.lit("submithub_chart").alias("extraction_method"),
        F.concat_ws(" - ", "artist", "title").alias("source_article_title"), song_url(F.col("slug"), F.col("_last")).alias("source_article_url"), F.lit("SubmitHub").alias("source_name"),
        F.col("_day").cast("string").alias("article_date"), urls.alias("embedded_music_links"), bag.alias("open_graph"), F.lit(True).alias("release_article"),
    )
