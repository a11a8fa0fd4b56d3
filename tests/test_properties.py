"""Property test: boundary date differences against plain Python on many random pairs,
evaluated in one Spark job."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfspark.functions.dates import (add_months, day_boundaries, month_boundaries,
                                        second_boundaries, week_boundaries)

stamps = st.datetimes(min_value=dt.datetime(2000, 1, 1), max_value=dt.datetime(2040, 12, 31))


def _monday(d: dt.date) -> dt.date:
    return d - dt.timedelta(days=d.weekday())


def _add_months(t: dt.datetime, n: int) -> dt.datetime:
    y, m = divmod(t.month - 1 + n, 12)
    y, m = t.year + y, m + 1
    last = (dt.date(y + (m == 12), m % 12 + 1, 1) - dt.timedelta(days=1)).day
    return t.replace(year=y, month=m, day=min(t.day, last))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(stamps, stamps, st.integers(-30, 30)), min_size=1, max_size=200))
def test_boundaries_match_python(spark, pairs):
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz, n int")
    got = df.select(month_boundaries("a", "b").alias("m"), day_boundaries("a", "b").alias("d"),
                    week_boundaries("a", "b").alias("w"), second_boundaries("a", "b").alias("s"),
                    add_months(F.col("a"), F.col("n")).alias("am")).collect()
    for (a, b, n), r in zip(pairs, got):
        assert r["m"] == (b.year - a.year) * 12 + b.month - a.month
        assert r["d"] == (b.date() - a.date()).days
        assert r["w"] == (_monday(b.date()) - _monday(a.date())).days // 7
        whole = lambda t: t.replace(microsecond=0)
        assert r["s"] == int((whole(b) - whole(a)).total_seconds())
        assert r["am"] == _add_months(a, n)
