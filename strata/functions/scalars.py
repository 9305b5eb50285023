"""Scalar feature functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS_PER_YEAR = 365.25


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _days_between(start, end) -> Column:
    """Whole days from ``start`` to ``end`` (floor, like a timedelta's .days).

    Computed on naive wall-clock values (TIMESTAMP_NTZ), so a daylight-saving
    hour in a non-UTC session cannot shift a day count.
    """
    micros = F.timestamp_diff("MICROSECOND", _c(start).cast("timestamp_ntz"),
                              _c(end).cast("timestamp_ntz"))
    return F.floor(micros / F.lit(86_400_000_000))


def age_years(birth, ref) -> Column:
    """Canonical age: days / 365.25 rounded to one decimal."""
    return F.round(_days_between(birth, ref) / F.lit(DAYS_PER_YEAR), 1)


def age_floor_years(birth, ref) -> Column:
    """Variant age: floor(days / 365) -- floor, not truncation, for negatives."""
    return F.floor(_days_between(birth, ref) / F.lit(365)).cast("bigint")


def deceased_flag(death) -> Column:
    return _c(death).isNotNull().cast("int")


def sanitize_name(c) -> Column:
    """Non [A-Za-z0-9_] -> '_', then strip '_' at both ends."""
    return F.btrim(F.regexp_replace(_c(c), r"[^a-zA-Z0-9_]", "_"), F.lit("_"))


def sanitize_name_truncated(c, width: int = 40) -> Column:
    """Variant sanitiser: non [A-Za-z0-9] -> '_', first ``width`` characters."""
    return F.substring(F.regexp_replace(_c(c), r"[^a-zA-Z0-9]", "_"), 1, width)


def matches_flag(c, pattern: str) -> Column:
    """Regex search; NULL text counts as no match."""
    return F.coalesce(_c(c).rlike(pattern), F.lit(False))


def percent(part, whole) -> Column:
    return F.try_divide(_c(part).cast("double"), _c(whole).cast("double")) * F.lit(100.0)


def delta_pct(new, base) -> Column:
    """(new - base) / base * 100 with base = 0 -> NULL."""
    return F.try_divide(_c(new) - _c(base), _c(base)) * F.lit(100.0)


def clip_upper(c, cap) -> Column:
    """least(value, cap) keeping NULL values NULL."""
    c = _c(c)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.least(c, _c(cap)))
