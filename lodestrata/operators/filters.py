"""Row predicates: date windows, release checks, vetoes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_prefix, in_window, parse_date
from ..functions.text import clean

# Words that veto a version, an upload or a user.
VARIANTS = r"(?iU)\b(slowed|slow(?:er)?|super\s+slowed|ultra\s+slowed|sped\s*up|speed\s*up|fast(?:er)?\s+version|nightcore|rework|remaster(?:ed)?|remastered\s+version|anniversary\s+mix|cover)\b"
EXTENDED = r"(?iU)\b(extended|extended\s+mix|radio\s+edit|club\s+mix|original\s+mix|edit)\b"
SET_TERMS = ("live @", "live at", "dj set", "full set", "festival set", "radio show", "podcast", "essential mix", "boiler room")
GENRE_TERMS = (
    "edm", "electronic", "electronica", "dance", "house", "tech house", "deep house", "afro house", "melodic house", "progressive house", "bass house", "future house",
    "disco house", "techno", "trance", "dubstep", "drum and bass", "dnb", "garage", "ukg", "breaks", "trap", "bass", "club",
)
LONGEST_TRACK_MS = 15 * 60 * 1000


def lookback(df: DataFrame, as_of: str, days: int, column: str = "article_date") -> DataFrame:
    """Dated rows of the window that ends at ``as_of``; no filter for ``days`` below 1."""
    return df.where(in_window(parse_date(F.col(column)), as_of, days, False)) if days > 0 else df


def lower_bound(df: DataFrame, as_of: str, days: int, column: str = "article_date") -> DataFrame:
    """Rows dated at the window's start or later, the future included; no filter for ``days`` below 1."""
    return df.where(date_prefix(F.col(column)) >= F.date_sub(F.lit(as_of).cast("date"), days)) if days > 0 else df


def looks_like_release(title: Column, isrc: Column, release_title: Column, duration_ms: Column, after_party: bool = False) -> Column:
    """Release metadata decides for, great length against, then words in the title against."""
    filled = lambda c: F.coalesce(c, F.lit("")) != ""
    low, stopped = F.lower(clean(title)), F.lit(False)
    for t in (*SET_TERMS, *(("after party",) if after_party else ())):
        stopped = stopped | F.contains(low, F.lit(t))
    return F.when(filled(isrc) | filled(release_title), True).when(F.coalesce(duration_ms, F.lit(0)) > LONGEST_TRACK_MS, False).otherwise(~stopped)


def genre_terms(username: Column, description: Column, genres: Column) -> Column:
    """The genre terms found anywhere in a user's text, sorted."""
    text = F.lower(F.concat_ws(" ", F.coalesce(username, F.lit("")), F.coalesce(description, F.lit("")), F.array_join(genres, " ")))
    return F.array_compact(F.array(*[F.when(F.contains(text, F.lit(t)), F.lit(t)) for t in sorted(GENRE_TERMS)]))


def joined(*columns: Column) -> Column:
    """The filled columns, squeezed, joined by a space."""
    return F.concat_ws(" ", *[F.nullif(clean(c), F.lit("")) for c in columns])


def unwanted_variant(*columns: Column) -> Column:
    return joined(*columns).rlike(VARIANTS)


def extended_version(*columns: Column) -> Column:
    return joined(*columns).rlike(EXTENDED)


def isrc_year(isrc: Column) -> Column:
    """Year of registration: digits 6 and 7; up to 79 this century."""
    code = F.substring(F.upper(clean(isrc)), 6, 2)
    year = F.when(code.rlike(r"^\d\d$"), code.try_cast("int"))
    return F.when(year <= 79, year + 2000).otherwise(year + 1900)


def isrc_outside_window(isrc: Column, as_of: str, days: int) -> Column:
    """A known year that is neither this one nor, within the first days of a year, the last one."""
    day = F.lit(as_of).cast("date")
    year, now = isrc_year(isrc), F.year(day)
    ok = (year == now) | ((F.dayofyear(day) <= max(days, 1)) & (year == now - 1))
    return F.coalesce(~ok, F.lit(False))


def has_platform_link(*columns: Column) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | (F.coalesce(c, F.lit("")) != "")
    return out


def not_in_future(released: Column, as_of: str) -> Column:
    return F.coalesce(released <= F.lit(as_of).cast("date"), F.lit(True))


def chosen(df: DataFrame, name: str, only: list[str] | None = None, skip: list[str] | None = None, api: bool = True, api_col: str = "api_source") -> DataFrame:
    """Configured sources: only these, not those, without those that need an interface."""
    if only:
        df = df.where(F.col(name).isin(*only))
    if skip:
        df = df.where(~F.col(name).isin(*skip))
    return df if api else df.where(~F.col(api_col))


def active_rows(df: DataFrame, now_ms: int, hours: int, updated: str, week: str) -> DataFrame:
    """Rows updated within ``hours`` of the hour of ``now_ms`` whose week mark is missing or as recent."""
    start = now_ms - now_ms % 3_600_000 - hours * 3_600_000
    return df.where((F.col(updated) >= start) & (F.col(week).isNull() | (F.col(week) >= start)))
