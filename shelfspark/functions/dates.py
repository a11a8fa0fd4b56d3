"""Date arithmetic with warehouse semantics: differences count unit *boundaries* crossed,
not whole elapsed units (Jan 31 -> Feb 1 is one month; 0.9 s -> 2.1 s is two seconds).
All are native expressions, time-zone free on TIMESTAMP_NTZ and DATE inputs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ts_lit(value: dt.date | dt.datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal (no session-zone shift)."""
    if isinstance(value, dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, dt.date):
        text = value.strftime("%Y-%m-%d 00:00:00")
    else:
        text = value
    return F.to_timestamp_ntz(F.lit(text))


def date_lit(value: dt.date | str) -> Column:
    text = value.strftime("%Y-%m-%d") if isinstance(value, dt.date) else value
    return F.to_date(F.lit(text))


def day_boundaries(start, end) -> Column:
    """DATEDIFF(day, start, end): calendar days between the dates of the two values."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start)))


def week_boundaries(start, end) -> Column:
    """DATEDIFF(week, start, end) with weeks starting on Monday."""
    return F.floor(F.datediff(F.to_date(F.date_trunc("week", _c(end))),
                              F.to_date(F.date_trunc("week", _c(start)))) / 7).cast("int")


def month_boundaries(start, end) -> Column:
    """DATEDIFF(month, start, end): (year diff) * 12 + month diff."""
    s, e = _c(start), _c(end)
    return ((F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))).cast("int")


def second_boundaries(start, end) -> Column:
    """DATEDIFF(second, start, end): whole seconds between the values truncated to seconds."""
    return F.timestamp_diff("SECOND", F.date_trunc("second", _c(start)),
                            F.date_trunc("second", _c(end)))


def add_months(ts, months) -> Column:
    """DATEADD(month, n, ts) keeping the time of day; clamps to the month's last day."""
    n = months if isinstance(months, Column) else F.lit(months)
    return F.timestamp_add("MONTH", n, _c(ts))


def add_days(ts, days) -> Column:
    n = days if isinstance(days, Column) else F.lit(days)
    return F.timestamp_add("DAY", n, _c(ts))
