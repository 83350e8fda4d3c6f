"""Calendar helpers on zone-free dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def report_date(ts) -> Column:
    return F.to_date(_c(ts))


def weekday_number(d) -> Column:
    """Day of week, 0 = Sunday … 6 = Saturday (SQL ``EXTRACT(DOW …)``)."""
    return F.dayofweek(_c(d)) - F.lit(1)


def weekday_name(d) -> Column:
    """English weekday name without padding ('Monday')."""
    return F.date_format(_c(d), "EEEE")


def iso_week(d) -> Column:
    """ISO-8601 week number (1..53)."""
    return F.weekofyear(_c(d))


def iso_year(d) -> Column:
    """ISO-8601 week-numbering year, for an optional ISO (year, week) pairing."""
    return F.extract(F.lit("YEAROFWEEK"), _c(d))
