"""Calendar expressions used by the reports (explicit clock, no ``now``)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, functions as F


def as_date(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, (_dt.date, _dt.datetime)):
        value = value.isoformat()[:10]
    return F.to_date(F.lit(str(value)[:10]))


def as_timestamp(value) -> Column:
    """A ``timestamp_ntz`` literal (no session time zone involved)."""
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    return F.to_timestamp_ntz(F.lit(str(value)))


def month_label(d) -> Column:
    return F.date_format(d, "yyyy-MM")


def days_in_month(d) -> Column:
    """Length of the calendar month of ``d`` as a double."""
    return F.dayofmonth(F.last_day(d)).cast("double")


def days_in_prev_month(d) -> Column:
    return F.dayofmonth(F.last_day(F.add_months(F.trunc(d, "MM"), -1))).cast("double")


def yesterday_day(as_of) -> Column:
    """Day of month of the day before ``as_of``."""
    return F.dayofmonth(F.date_sub(as_date(as_of), 1))


def end_of_month(as_of) -> Column:
    return F.last_day(as_date(as_of))
