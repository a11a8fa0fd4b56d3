"""Sets of days as 64-bit words: day numbers from 1970-01-01, 64 days a word.

Words are or-ed by ``bit_or``, whose buffer is one long: it combines map-side, hash-aggregates and
merges over periods, where a distinct count needs an expanded second aggregation.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS = 64
_EPOCH = dt.date(1970, 1, 1)


def day_number(date: Column) -> Column:
    return F.unix_date(date.cast("date"))


def word_of(date: Column) -> Column:
    """Number of the word that holds a day."""
    return F.floor(day_number(date) / DAYS).cast("int")


def bit_of(date: Column) -> Column:
    """The day's bit in its word."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(day_number(date), F.lit(DAYS)).cast("int"))


def distinct_days(date: Column, first: dt.date, last: dt.date) -> Column:
    """Aggregate: number of distinct days of rows whose days lie in [first, last]."""
    words = range((first - _EPOCH).days // DAYS, (last - _EPOCH).days // DAYS + 1)
    counts = [F.coalesce(F.bit_count(F.bit_or(F.when(word_of(date) == w, bit_of(date)))), F.lit(0)) for w in words]
    return sum(counts[1:], counts[0]).cast("long")
