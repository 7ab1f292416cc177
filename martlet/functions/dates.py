"""Date arithmetic on explicit as-of dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

OPEN_END = dt.date(9999, 12, 31)


def day(value: dt.date) -> Column:
    return F.lit(value).cast("date")


def in_last_days(date: Column, as_of: dt.date, days: int) -> Column:
    """Inclusive lower bound, no upper bound; the bound is a constant so it reaches the scan."""
    return date >= day(as_of - dt.timedelta(days=days))


def order_time_parts(ts: Column) -> dict[str, Column]:
    return {
        "order_date": F.to_date(ts),
        "order_time": F.date_format(ts, "HH:mm:ss"),
        "order_hour": F.hour(ts),
        **weekday_parts(ts, "order_day_of_week", "is_weekend"),
    }


def weekday_parts(date: Column, name: str, weekend: str) -> dict[str, Column]:
    return {name: F.date_format(date, "EEEE"), weekend: F.weekday(date) >= 5}
