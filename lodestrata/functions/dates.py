"""Dates from text: the date as written, never shifted by a time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names.
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
DATE_IN_TEXT = rf"(?i)\b(?:{MONTHS})\s+\d{{1,2}},\s+\d{{4}}\b"

_CLOCK = r"\d{1,2}:\d{1,2}:\d{1,2}"
_ISO = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d{1,9})?)?)?(?:Z|[+-]\d{2}:?\d{2}(?::?\d{2})?)?)?$"


def _ymd(c: Column, pattern: str) -> Column:
    """The date in the three groups of ``pattern``, or null."""
    part = [F.regexp_extract(c, pattern, i) for i in (1, 2, 3)]
    return F.when(part[0] != "", F.concat_ws("-", part[0], F.lpad(part[1], 2, "0"), F.lpad(part[2], 2, "0")).try_cast("date"))


def parse_date(c: Column) -> Column:
    """Plain, slashed with clock and offset, or ISO 8601; anything else is null."""
    t = F.trim(c.cast("string"))
    return F.coalesce(
        _ymd(t, r"^(\d{4})-(\d{1,2})-(\d{1,2})$"),
        _ymd(t, rf"^(\d{{4}})/(\d{{1,2}})/(\d{{1,2}}) {_CLOCK} (?:Z|[+-]\d{{2}}:?\d{{2}})$"),
        F.when(t.rlike(_ISO), F.substring(t, 1, 10).try_cast("date")),
        _ymd(t, r"^(\d{4})(\d{2})(\d{2})$"),
    )


def date_prefix(c: Column) -> Column:
    """The first ten characters as a date."""
    t = F.substring(c.cast("string"), 1, 10)
    return F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), t.try_cast("date"))


def _written(c: Column) -> Column:
    """yyyy-MM-dd or yyyy/MM/dd at the start, as text with hyphens; empty if there is none."""
    return F.translate(F.regexp_extract(c, r"^(\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2})", 1), "/", "-")


def release_date_text(*columns: Column) -> Column:
    """The first date written in the columns, as text, whether it exists or not."""
    return F.coalesce(*[F.when(_written(F.trim(c)) != "", _written(F.trim(c))) for c in columns])


def release_date(*columns: Column) -> Column:
    """As :func:`release_date_text`, as a date: one that does not exist ends the search with null."""
    return release_date_text(*columns).try_cast("date")


def structured_date(year: Column, month: Column, day: Column) -> Column:
    """Month and day default to 1 (also for 0); a missing or zero year or an impossible date is null."""
    one = lambda c: F.coalesce(F.nullif(c, F.lit(0)), F.lit(1))
    made = F.format_string("%04d-%02d-%02d", year, one(month), one(day)).try_cast("date")
    return F.when(F.coalesce(year, F.lit(0)) > 0, made)


def track_date(year: Column, month: Column, day: Column, *columns: Column) -> Column:
    """The structured date, else the written one."""
    return F.coalesce(structured_date(year, month, day), release_date(*columns))


def human_date(c: Column) -> Column:
    """ISO, ``April 24, 2026``, ``Apr 24, 2026`` or RFC 2822."""
    t = F.regexp_replace(F.trim(c), r"^[A-Za-z]{3,9},\s*", "")
    name = r"^([A-Za-z]{3})[a-z]*\s+(\d{1,2}),\s+(\d{4})$"
    rfc = r"^(\d{1,2})\s+([A-Za-z]{3})[a-z]*\s+(\d{4})\b"
    number = lambda m: F.lpad(((F.instr(F.lit("janfebmaraprmayjunjulaugsepoctnovdec"), F.lower(m)) + 2) / 3).cast("int").cast("string"), 2, "0")
    month = lambda p, i: F.regexp_extract(t, p, i)
    made = lambda y, m, d: F.concat_ws("-", y, number(m), F.lpad(d, 2, "0")).try_cast("date")
    return F.coalesce(
        F.when(F.trim(c).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.trim(c).try_cast("date")),
        F.when(t.rlike(name), made(month(name, 3), month(name, 1), month(name, 2))),
        F.when(t.rlike(rfc), made(month(rfc, 3), month(rfc, 2), month(rfc, 1))),
    )


def date_in_text(c: Column) -> Column:
    """The first ``Month d, yyyy`` in a text."""
    return human_date(F.regexp_replace(F.regexp_extract(c, DATE_IN_TEXT, 0), r"\s+", " "))


def day_precision_date(value: Column, precision: Column) -> Column:
    """The date if its precision is ``day``."""
    return F.when(precision == "day", F.when(value.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), _ymd(value, r"^(\d{4})-(\d{1,2})-(\d{1,2})$")))


def millis_date(ms: Column, zone: str = "UTC") -> Column:
    """Milliseconds since 1970 to the date in ``zone``."""
    return F.to_date(F.from_utc_timestamp(F.timestamp_millis(ms), zone))


def in_window(d: Column, as_of: str, days: int, unknown: bool) -> Column:
    """``as_of - days <= d <= as_of``; ``unknown`` for no date."""
    end = F.lit(as_of).cast("date")
    return F.coalesce(d.between(F.date_sub(end, days), end), F.lit(unknown))
