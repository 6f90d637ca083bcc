"""Null-aware numbers and bounded scores. Only ``try_`` casts: bad values become null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_float(c: Column) -> Column:
    return F.replace(F.trim(c.cast("string")), F.lit(","), F.lit("")).try_cast("double")


def parse_int(c: Column) -> Column:
    """Through a float, truncated."""
    return parse_float(c).try_cast("bigint")


def strict_int(c: Column) -> Column:
    """Digits only (a fraction or a comma gives null)."""
    t = F.trim(c.cast("string"))
    return F.when(t.rlike(r"^[+-]?\d+$"), t.try_cast("bigint"))


def _positive(v: Column, score: Column) -> Column:
    return F.when(v.isNull() | (v <= 0), 0.0).otherwise(score)


def bounded(v: Column, ceiling: float) -> Column:
    return _positive(v, F.least(v / F.lit(float(ceiling)), F.lit(1.0)))


def log_score(v: Column, ceiling: float) -> Column:
    return _positive(v, F.least(F.log10(v + 1) / F.log10(F.lit(float(ceiling) + 1)), F.lit(1.0)))


def rank_score(v: Column, max_rank: int) -> Column:
    return _positive(v, F.greatest(1.0 - (v - 1) / F.lit(float(max_rank)), F.lit(0.0)))


def recency_score(age_days: Column, lookback_days: int, unknown: float | None = 0.35) -> Column:
    """1 today, 0 at the lookback's end; without a lookback always 1; ``unknown`` for no age."""
    if lookback_days <= 0:
        known = F.lit(1.0)
    else:
        known = F.greatest(1.0 - age_days / F.lit(float(lookback_days)), F.lit(0.0))
    return F.when(age_days.isNull(), F.lit(unknown)).otherwise(known) if unknown is not None else known


def rank_or_last(v: Column) -> Column:
    return F.coalesce(v, F.lit(999999))


def number_string(v: Column) -> Column:
    """Whole numbers without a fraction, others with two digits."""
    return F.when(v == F.floor(v), v.cast("bigint").cast("string")).otherwise(F.format_string("%.2f", v))
