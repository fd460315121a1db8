"""Malformed dates as column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

#: The shapes of dates.
YEAR = r"^(\d{4}).*$"
MONTH = r"^\w{2,4}[- /.](0*[1-9]|1[0-2])(?:[- /.].*)?$"
MONTH_PRESENT = r"^\w{2,4}[- /.](0*\w{1,2}).*$"
DAY = r"^\d{4}([- /.])(0*(?:[1-9]|1[0-2]))\1(0*(?:3[0-1]|[1-2][0-9]|[1-9]))$"
FLAT = r"^(\d{4})(\d{2})(\d{2})$"


def _group(c: Column, pattern: str, i: int) -> Column:
    """A group as int; null without a match or if it isn't a number. No group of a match is empty."""
    return F.nullif(F.regexp_extract(c, pattern, i), F.lit("")).try_cast("int")


def _in(c: Column, low: int, high: int) -> Column:
    return F.when((c >= low) & (c <= high), c)


def _parts(c: Column, as_of: int) -> Column:
    """Year, month and day as far as each is valid, as a struct y, m, d of what can be told from the text alone."""
    year = _in(F.coalesce(_group(c, FLAT, 1), _group(c, YEAR, 1)), 1001, as_of)
    month = F.coalesce(_in(_group(c, FLAT, 2), 1, 12), _in(_group(c, MONTH_PRESENT, 1), 1, 12))
    return F.struct(year.alias("y"), month.alias("m"), F.coalesce(_group(c, FLAT, 3), _group(c, DAY, 3)).alias("d"))


def _day(p: Column) -> Column:
    last = F.day(F.last_day(F.make_date(p["y"], p["m"], F.lit(1))))
    return F.when((p["d"] >= 1) & (p["d"] <= last), p["d"])


def is_year_valid(c: Column) -> Column:
    return F.coalesce(c.rlike(YEAR), F.lit(False))


def is_month_valid(c: Column) -> Column:
    return F.coalesce(c.rlike(MONTH), F.lit(False))


def is_day_valid(c: Column, as_of: int | None = None) -> Column:
    return let(_parts(c, as_of or dt.date.today().year), lambda p: _day(p).isNotNull())


def parse_malformed(c: Column, as_of: int | None = None) -> Column:
    """The date that a malformed text means: odd characters count as 0; a year from 1001 to as_of is needed, a missing
    or impossible month or day is the first. A month in which an underscore stands isn't one."""
    as_of = as_of or dt.date.today().year

    def date(p: Column) -> Column:
        day = F.when(p["m"].isNotNull(), F.coalesce(_day(p), F.lit(1))).otherwise(1)
        return F.make_date(p["y"], F.coalesce(p["m"], F.lit(1)), day)

    plain = lambda s: F.when(F.length(F.btrim(s)) > 0, let(_parts(s, as_of), date))
    return let(F.regexp_replace(c, r"[^\d._/ -]", "0"), plain)


def path_date(path: Column) -> Column:
    """The date in a path like data/2026/x_20260701_artists.xml.gz; null without one."""
    return F.try_to_timestamp(F.nullif(F.regexp_extract(path, r"_(\d{8})_", 1), F.lit("")), F.lit("yyyyMMdd")).cast("date")


def month_window(month: str) -> tuple[dt.date, dt.date]:
    """The half-open window of a month like 2026-07."""
    first = dt.date.fromisoformat(f"{month}-01")
    return first, (first.replace(day=28) + dt.timedelta(days=4)).replace(day=1)


def horizon(day: Column) -> Column:
    """The first day of the next month."""
    return F.add_months(F.trunc(day, "MM"), 1)


def utc_timestamp(c: Column) -> Column:
    """An offset timestamp as local time in UTC; null if malformed."""
    return F.to_utc_timestamp(F.try_to_timestamp(c), F.current_timezone()).cast("timestamp_ntz")
