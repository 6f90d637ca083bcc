"""Extraction of artist, title, type and evidence from article text by patterns."""

from __future__ import annotations

import re
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text, first_filled
from ..functions.udf import arrow_udf
from .classify import classify

# Title patterns in their order of precedence; group 1 is the artist, group 2 the title.
QUOTE_AB = r"""("[^"]{2,160}"|'(?:[^']|'(?=[A-Za-z])){2,160}'|“[^”]{2,160}”|‘[^‘]{2,160}’(?![A-Za-z]))"""
QUOTE_C = r"""["'‘“]([^"'‘’“”]{2,160})["'’”]"""
LISTEN_TO = rf"^.*?Listen to (.+?)['’]s .+?\b(?:single|track|banger|anthem|release|remix|rework|EP|album).*?{QUOTE_AB}"
OWNED_ALBUM = r"""^(.+?)['’]s\s+[‘“'"]([^’”'"]{2,160})[’”'"]\s+(?:album\b|.+?\balbum\b)"""
TO_NEW_SINGLE = rf"^(.+?)\s+to\s+.+?new\s+single.+?listen\s+to\s+{QUOTE_AB}"
ON_ARTISTS = rf"^.+?\s+on\s+(.+?)['’]s\s+{QUOTE_AB}"
IN_ARTISTS = rf"^.+?\s+in\s+(.+?)['’]s\s+.+?{QUOTE_AB}"
VERB_A = rf"^(.+?)\s+(?:announces?.*?with release of|releases?|drops?|unveils?|reveals?|unleash(?:es)?|delivers?|presents?|shares?|returns? with|returns? .*? with|extends .*? with|starts? .*? with|goes .*? with|gets .*? with|channels|continues .*? with|enlists? .+? for|recruits? .+? for|details .*? and shares?|announces .*? and unveils?|announces .*?,\s*unveils?|joins? .*? with|joins? forces .*? (?:for|on|with)|teams up .*? (?:for|on|with)|collaborates .*? (?:for|on|with)|collides?\s+(?:for|on|with)|collides? .*? (?:for|on|with)|unites?\s+on|reunites?\s+for|lands? .*? with|provides? .*? in|pulls? .*? on|brings? .*? on).+?{QUOTE_AB}"
VERB_B = rf"^(.+?)\s+(?:releases?|drops?|unveils?|reveals?|unleash(?:es)?|delivers?|presents?|shares?|returns with|returns .*? with|extends .*? with|starts? .*? with|goes .*? with|gets .*? with|channels|continues .*? with|enlists? .+? for|details .*? and shares?|announces .*? and unveils?|announces .*?,\s*unveils?|joins? .*? with|joins? forces .*? (?:for|on|with)|teams up .*? (?:for|on|with)|collaborates .*? (?:for|on|with)|collides?\s+(?:for|on|with)|collides? .*? (?:for|on|with)|unites?\s+on|reunites?\s+for|provides? .*? in).+?{QUOTE_AB}"
VERB_C = rf"^(.+?)\s+(?:releases?|drops?|unveils?|delivers?|shares?|returns with|channels|continues .*? with|enlists? .+? for|details .*? and shares?|announces .*? and unveils?|announces .*?,\s*unveils?|joins? forces .*? (?:for|on|with)|teams up .*? (?:for|on|with)|collaborates .*? (?:for|on|with)).*?{QUOTE_C}"
REMIXES = r"^(.+?)\s+(?:re[- ]?imagines|remixes?|flips?|reworks?)\s+(?:.*?\s+)?"
PROJECT = r"^(.+?)\s+.+?\b(?:single|track|ep|album|anthem|release|remix|rework)[,:]?\s+"
DASHED = r"^(.+?)\s+[–-]\s+(.+?)(?:\s+\[.*?\])?(?::\s*Listen)?$"
COLON = rf"^(.+?):\s+{QUOTE_AB}$"
CAPITALS_A = r"^(.+?)\s+(?:returns .*? with|releases?|drops?|unveils?|reveals?)\s+(?:new|latest|newest|debut)?\s*(?:single|track|EP|album)\s+([A-Z0-9][A-Z0-9 &+\-:'.!?]{2,})$"
CAPITALS_B = r"^(.+?)\s+(?:unveils?|releases?|drops?|shares?)\s+(?:new|latest|newest|debut)?\s*(?:single|track|EP|album),?\s+([A-Z0-9][A-Z0-9 &+\-:'.!?]{2,})$"
UNCLOSED = r"""^(.+?)\s+.+?\b(?:EP|album|single|track),?\s+[‘“'"]([^’”'"]{2,160})$"""
DEBUT = rf"^(.+?)\s+(?:makes? .*? debut with|collaborates? on|link up on|links? up on).+?{QUOTE_AB}"
GOES = rf"^(.+?)\s+goes\s+{QUOTE_AB}\s+on\s+new\s+single\b"
TITLE_PATTERNS = {
    "A": (LISTEN_TO, OWNED_ALBUM, TO_NEW_SINGLE, ON_ARTISTS, IN_ARTISTS, VERB_A, REMIXES + QUOTE_AB, PROJECT + QUOTE_AB, DASHED, COLON, CAPITALS_A, CAPITALS_B, UNCLOSED, DEBUT, GOES),
    "B": (VERB_B, REMIXES + QUOTE_AB, PROJECT + QUOTE_AB, DASHED, COLON, CAPITALS_A, CAPITALS_B, DEBUT, GOES),
    "C": (VERB_C, REMIXES + QUOTE_C, PROJECT + QUOTE_C, DASHED),
}
BODY_LEADS = (
    r"\b(?:single|track|song|release)\s+(?:titled|called|entitled)\s+",
    r"\bnew\s+(?:single|track|song|release)\s+",
    r"\breleased\s+",
    r"\bEP\s+(?:titled|called|entitled)?\s*",
    r"\balbum\s+(?:titled|called|entitled)?\s*",
    r"\bremix\s+of\s+",
)
TYPE_PATTERNS = (
    ("remix", r"\bremix(?:es|ed)?\b"),
    ("rework", r"\brework(?:s|ed)?\b|re[- ]?imagines"),
    ("EP", r"\bEP\b"),
    ("album", r"\balbum\b"),
    ("single", r"\bsingle\b"),
    ("track", r"\btrack\b|\bcut\b|\bsong\b"),
)
NEARBY_PATTERNS = (
    ("single", r"""\bnew\s+single\b|\bsingle\s+["'‘“]"""),
    ("track", r"""\bnew\s+track\b|\btrack\s+["'‘“]|\bcut\s+on\b"""),
    ("EP", r"""\bnew\s+EP\b|\bEP\s+["'‘“]|["'‘“][^"'‘’“”]+ EP["'’”]"""),
    ("album", r"""\bnew\s+album\b|\balbum\s+["'‘“]|["'‘“][^"'‘’“”]+ album["'’”]"""),
    ("remix", r"\bnew\s+remix\b|\bremix\b"),
    ("rework", r"\brework\b|re[- ]?imagines"),
)
NOISE_AB = r"(?iU)\s*(?::\s*Listen|\|\s*.*$|\s+-\s+(?:We Rave You|EDMTunes).*$|\s+\[[^\]]+\])\s*$"
NOISE_C = r"(?iU)\s*(?::\s*Listen|\|\s*.*$|\s+-\s+We Rave You.*$|\s+\[[^\]]+\])\s*$"
ANNOUNCED = r"(?iU)^\s*(?:and\s+announces?|announces?)\b"
QUOTE_MARKS = "'\"‘’“”"

NOISE = {"A": NOISE_AB, "B": NOISE_AB, "C": NOISE_C}
QUOTE = {"A": QUOTE_AB, "B": QUOTE_AB, "C": QUOTE_C}


def _ends(c: Column) -> Column:
    """The built-in part of clean_text, for parts of a text that is NFKC already."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", " "), r"^[ \t\r\n,;:-]+|[ \t\r\n,;:-]+$", "")


def clean_article_title(title: Column, profile: str = "A") -> Column:
    if profile == "A":
        title = F.regexp_replace(title, r"(?iU)^Exclusive:\s+", "")
    return clean_text(F.regexp_replace(title, NOISE[profile], ""))


def clean_extracted_title(raw: Column, profile: str = "A") -> Column:
    return _ends(F.regexp_replace(F.regexp_replace(raw, NOISE[profile], ""), f"^[{QUOTE_MARKS}]+|[{QUOTE_MARKS}]+$", ""))


@cache
def _parser(profile: str):
    patterns = [re.compile(p, re.IGNORECASE) for p in TITLE_PATTERNS[profile]]
    noise, announced = re.compile(NOISE[profile].removeprefix("(?iU)"), re.IGNORECASE), re.compile(ANNOUNCED.removeprefix("(?iU)"), re.IGNORECASE)
    ends = lambda s: re.sub(r"\s+", " ", s).strip(" \t\r\n,;:-")

    def one(title: str | None) -> tuple[str, str] | tuple[None, None]:
        for p in patterns if title else ():
            m = p.search(title)
            if m and (profile == "C" or not announced.match(m[2])):  # an announcement is passed over, not fatal
                artist, found = ends(m[1]), ends(noise.sub("", m[2]).strip(QUOTE_MARKS))
                if artist and found:
                    return artist, found
        return None, None

    return one


def _title_udf(profile: str):
    @arrow_udf("artist string, title string")
    def parse(titles: pd.Series) -> pd.DataFrame:
        one = _parser(profile)
        return pd.DataFrame([one(t) for t in titles], columns=["artist", "title"])

    return parse


#: The cascade of lazy patterns runs over Arrow batches: as nested columns it
#: would be copied into every predicate on its result.
_PARSERS = {p: _title_udf(p) for p in TITLE_PATTERNS}


def from_title(title: Column, profile: str = "A") -> Column:
    """struct(artist, title) by the first pattern that gives both; both null without one."""
    return _PARSERS[profile](clean_article_title(F.coalesce(title, F.lit("")), profile))


def title_from_body(body: Column, profile: str = "A") -> Column:
    """The title quoted by the first body pattern that matches; null without one."""
    tries = []
    for lead in BODY_LEADS:
        rx = "(?iU)" + lead + QUOTE[profile]
        tries.append(F.when(body.rlike(rx), clean_extracted_title(F.regexp_extract(body, rx, 1), profile)))
    return F.coalesce(*tries)


def body_matches(body: Column, profile: str = "A", most: int = 10) -> Column:
    """All matches of the body patterns, pattern by pattern, the first ``most``."""
    found = [F.regexp_extract_all(body, F.lit("(?iU)" + lead + QUOTE[profile]), F.lit(0)) for lead in BODY_LEADS]
    return F.slice(F.transform(F.flatten(F.array(*found)), _ends), 1, most)


def release_type(text: Column, title: Column) -> Column:
    """Type by what stands near the title (100 before, 40 after), else anywhere; unknown by default."""

    def first(c: Column, patterns, default: Column) -> Column:
        out = default
        for name, p in reversed(patterns):
            out = F.when(c.rlike("(?iU)" + p), F.lit(name)).otherwise(out)
        return out

    unknown = F.lit("unknown")
    at = F.when(F.coalesce(title, F.lit("")) != "", F.position(F.lower(title), F.lower(text))).otherwise(0)
    begin = F.greatest(at - 1 - 100, F.lit(0))
    near = F.substring(text, begin + 1, at - 1 + F.length(title) + 40 - begin)
    return F.when(at > 0, first(near, NEARBY_PATTERNS, first(near, TYPE_PATTERNS, unknown))).otherwise(first(text, TYPE_PATTERNS, unknown))


def type_from_title(title: Column) -> Column:
    low = F.lower(title)
    return F.when(F.contains(low, F.lit("remix")), "remix").when(F.contains(low, F.lit("rework")), "rework").otherwise("track")


def type_from_album(album_type: Column, total_tracks: Column) -> Column:
    kind, n = F.lower(F.coalesce(album_type, F.lit(""))), F.coalesce(total_tracks.try_cast("int"), F.lit(0))
    return F.when(kind == "single", F.when(n <= 3, "single").otherwise("EP")).when(kind == "album", F.when(n > 6, "album").otherwise("EP")).otherwise("track")


def type_from_album_track(album_type: Column, total_tracks: Column, title: Column) -> Column:
    """A remix or rework by its title, else by the album."""
    own = type_from_title(title)
    return F.when(own != "track", own).otherwise(type_from_album(album_type, total_tracks))


def type_from_flags(flags: Column) -> Column:
    return F.when(F.coalesce(F.array_contains(flags, "remix"), F.lit(False)), "remix").otherwise("track")


def rubric(base: float, *parts: tuple[Column, float]) -> Column:
    """An additive confidence, 1 at most; null conditions add nothing."""
    out = F.lit(base)
    for condition, points in parts:
        out = out + F.when(condition, points).otherwise(0.0)
    return F.least(out, F.lit(1.0))


def filled(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("")) != ""


def article_score(base: Column, links: Column, matches: Column) -> Column:
    more = F.when(F.coalesce(F.size(links), F.lit(0)) > 0, 0.20).otherwise(0.0) + F.when(F.coalesce(F.size(matches), F.lit(0)) > 0, 0.10).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(base + more, F.lit(1.0)))


def parse_articles(articles: DataFrame, profile: str = "A") -> DataFrame:
    """Cards with enrichment to releases; what is no release or yields no title gives no row.

    Expects title, url, source_name, publish_date, snippet, body_text,
    embedded_music_links, open_graph and body_release_matches; other columns
    are handed through.
    """
    kept = articles.withColumn("_class", classify(F.col("title"), F.col("snippet"), profile)).where("_class.release_article")
    og, tw = F.try_element_at("open_graph", F.lit("og:title")), F.try_element_at("open_graph", F.lit("twitter:title"))
    rows = kept.withColumns({"_t": from_title(F.col("title"), profile), "_og": from_title(og, profile), "_tw": from_title(tw, profile), "_body": title_from_body(F.coalesce("body_text", F.lit("")), profile)})
    site_artist = F.when(first_filled(og).isNotNull(), F.col("_og.artist")).otherwise(F.col("_tw.artist"))
    if profile == "C":
        artist = F.coalesce(F.col("_t.artist"), site_artist, clean_text(F.element_at(F.split("title", " ", 2), 1)))
        title = F.coalesce(F.col("_t.title"), F.col("_body"))
        method = F.when(F.col("_t.title").isNotNull(), "regex").when(site_artist.isNotNull(), "article_metadata").otherwise("llm_fallback")
    else:
        meta = F.when(F.col("_og.title").isNotNull(), F.col("_og")).otherwise(F.col("_tw"))
        artist = F.coalesce(F.col("_t.artist"), meta["artist"], site_artist)
        title = F.coalesce(F.col("_t.title"), meta["title"], F.when(site_artist.isNotNull(), F.col("_body")))
        method = F.when(F.col("_t.title").isNotNull(), "regex").when(meta["title"].isNotNull(), "article_metadata").otherwise("article_body")
    rows = rows.withColumns({"_artist": artist, "_title": title, "_method": method}).where("_artist <> '' and _title <> ''")
    if profile != "C":
        rows = rows.where(~F.col("_title").rlike(ANNOUNCED))
    evidence = F.concat_ws(" ", F.nullif("title", F.lit("")), F.nullif("snippet", F.lit("")), F.nullif("body_text", F.lit("")))
    player = (F.col("_method") == "regex") & (F.coalesce(F.size("embedded_music_links"), F.lit(0)) > 0)
    used = {"title", "url", "publish_date", "snippet", "body_text", "body_release_matches", "_class", "_t", "_og", "_tw", "_body", "_artist", "_title", "_method", "source_name", "embedded_music_links", "open_graph"}
    return rows.select(
        F.col("_artist").alias("artist"),
        F.col("_title").alias("track_or_project_title"),
        release_type(evidence, F.col("_title")).alias("release_type"),
        article_score(F.col("_class.confidence_score"), F.col("embedded_music_links"), F.col("body_release_matches")).alias("confidence_score"),
        F.when(player, "regex+embedded_player").otherwise(F.col("_method")).alias("extraction_method"),
        F.col("title").alias("source_article_title"),
        F.col("url").alias("source_article_url"),
        "source_name",
        F.col("publish_date").alias("article_date"),
        F.coalesce("embedded_music_links", F.expr("cast(array() as array<string>)")).alias("embedded_music_links"),
        F.coalesce("open_graph", F.expr("cast(map() as map<string,string>)")).alias("open_graph"),
        F.lit(True).alias("release_article"),
        *[c for c in rows.columns if c not in used],
    )
