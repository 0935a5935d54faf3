"""Date helpers.  ``as_of`` is always a parameter: no operator reads the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeward.functions.cleanse import as_col, blank_to_null

__all__ = ["as_date_lit", "month_start", "month_key", "month_end", "days_between",
           "parse_dmy", "as_utc", "ts_text"]


def as_date_lit(d: dt.date | str) -> Column:
    return F.lit(d if isinstance(d, dt.date) else dt.date.fromisoformat(d)).cast("date")


def month_start(c: Column | str) -> Column:
    """``date_trunc('month', x)`` as a date."""
    return F.trunc(as_col(c).cast("date"), "MM")


def month_key(c: Column | str) -> Column:
    """``to_char(x, 'YYYY-MM')``."""
    return F.date_format(as_col(c), "yyyy-MM")


def month_end(c: Column | str) -> Column:
    """``month_start + interval '1 month - 1 day'``."""
    return F.last_day(as_col(c).cast("date"))


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """``date - date`` in days (an integer, as in the source SQL)."""
    return F.datediff(as_col(later).cast("date"), as_col(earlier).cast("date"))


def strict_dmy(c: str) -> Column:
    """DD/MM/YYYY text -> date, blank -> null; other text fails the job."""
    text = F.nullif(F.trim(F.col(c)), F.lit(""))
    parsed = parse_dmy(text)
    return F.when(text.isNotNull() & parsed.isNull(), F.raise_error(F.concat(F.lit(f"{c} is no date: "), text)).cast("date")
                  ).otherwise(parsed)


def parse_dmy(c: Column | str) -> Column:
    """``to_date(x, 'DD/MM/YYYY')`` accepting one- or two-digit day/month;
    unparseable text -> null."""
    return F.try_to_date(blank_to_null(c), "d/M/yyyy")


def as_utc(c: Column | str, tz: str = "UTC") -> Column:
    """``x at time zone 'UTC'`` for a zone-less wall-clock value."""
    return F.to_utc_timestamp(as_col(c).cast("timestamp"), tz)


def ts_text(c: Column | str) -> Column:
    """Timestamp rendered with fixed microsecond precision (stable text form)."""
    return F.date_format(as_col(c), "yyyy-MM-dd HH:mm:ss.SSSSSS")
