"""Counters of running jobs, and day sets as words."""

import datetime as dt
import random

from pyspark.sql import functions as F

from shelfspark.functions.counters import Counters
from shelfspark.functions.days import distinct_days
from shelfspark.operators import google_views, register as funnel, rfi
from shelfspark.params import FixtureParams, Period, RfiWindow
from shelfspark.plans.inspect import plan_text
from tests.helpers import df, ts

P = FixtureParams()


def test_google_view_counters(spark):
    def view(i, visitor, props, when="2024-01-02 10:00:00"):
        return {"event_id": i, "unique_id": visitor, "record_date": ts(when), "event_name": "page view",
                "referrer_url": "https://google.com", "current_url": "https://x/book/1", "event_properties": props, "geo_location": "GB"}

    events = df(spark, "event_tracking", [
        view(1, "a", '{"content_ids": "[5]"}'), view(2, "b", '{"content_ids": "[1,2]"}'), view(3, "c", '{"content_ids": "[x]"}'),
        view(4, "d", '{"content_ids": "[5]"} junk'), view(5, "e", None), view(6, "f", '{"other": 1}'), view(7, "g", '{"content_ids": ""}'),
        view(8, None, '{"content_ids": "[5]"}'), view(9, "", '{"content_ids": "[5]"}'), view(10, "h", '{"content_ids": "[5]"}', "2025-01-01 00:00:00")])
    period = Period(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 31), dt.date(2024, 1, 1))
    want = {"page_views": 9, "views_without_visitor": 2, "views_with_invalid_json": 2, "views_without_book_id": 2,
            "visitors": 3, "visitors_with_unreadable_book": 2}
    for job in (google_views.google_first_views_by_period, google_views.google_first_views_by_day_geo):
        counters = Counters()
        rows = job(events, period, counters)
        out = rows.collect()                       # one action fills rows and counters
        assert sum(r["unique_first_views"] for r in out) == 3
        assert counters.values() == want
        assert sorted(map(str, out)) == sorted(map(str, job(events, period).collect()))


def test_register_counters(spark):
    hit = P.urls.register_prefix
    events = df(spark, "event_tracking", [
        {"event_id": i, "unique_id": v, "record_date": ts("2024-01-02 10:00:00"), "event_name": "page view", "current_url": u}
        for i, (v, u) in enumerate([("a", f"{hit}abc"), ("b", f"{hit}unknown"), (None, f"{hit}abc"), ("c", hit)])])
    hashes = df(spark, "org_hashes", [{"organisation_id": 7, "hash": "abc"}])
    counters = Counters()
    funnel.register_funnel_backfill(events, df(spark, "user_registrations", []), hashes, P.urls, counters)
    assert counters.values() == {"register_visitors": 4, "register_without_visitor": 1, "register_without_code": 1, "unreadable_codes": 1}


def test_distinct_days_equal_a_distinct_count(spark):
    rnd = random.Random(4)
    first, last = dt.date(1969, 11, 20), dt.date(1970, 6, 10)
    rows = [(rnd.randrange(6), first + dt.timedelta(days=rnd.randrange((last - first).days + 1))) for _ in range(500)] + [(9, None)]
    frame = spark.createDataFrame(rows, "u int, d date")
    out = frame.groupBy("u").agg(distinct_days(F.col("d"), first, last).alias("n"), F.count_distinct("d").alias("want"))
    assert all(r["n"] == r["want"] for r in out.collect()) and out.count() == 7


def test_reading_days_need_no_expanded_aggregation_and_no_range_join_of_rows(spark):
    subs = df(spark, "subscriptions", [])
    reading = df(spark, "reading_activity_daily", [])
    monthly = plan_text(rfi.rfi_reading_days(reading, rfi.rfi_subscribers(subs, RfiWindow()), RfiWindow()))
    assert "Expand" not in monthly and "HashAggregate" in monthly
    lives = spark.createDataFrame([], "user_id bigint, combined_start_date timestamp_ntz, reporting_end_date timestamp_ntz, reporting_months int")
    average = plan_text(rfi.rfi_average_reading(reading, lives))
    assert "Expand" not in average
    join = average.index("Join")
    assert "reading_date" not in average[join:average.index("\n", join)]


def test_average_reading_over_lives_that_overlap(spark):
    """Brute force: days are a set over a user's lives of equal length, seconds count per life."""
    rnd = random.Random(8)
    base = dt.date(2022, 1, 1)
    reading = [(rnd.randrange(8), base + dt.timedelta(days=rnd.randrange(900)), rnd.choice([0, 30, 61, 600])) for _ in range(3000)]
    lives = []
    for _ in range(40):
        start = dt.datetime.combine(base + dt.timedelta(days=rnd.randrange(500)), dt.time(rnd.randrange(24)))
        lives.append((rnd.randrange(10), start, start + dt.timedelta(days=rnd.randrange(10, 400)), rnd.randrange(1, 4)))
    lives += lives[:3]
    days, seconds = {}, {}
    for u, s, e, m in lives:
        for v, d, n in reading:
            if u == v and n > 0 and s <= dt.datetime.combine(d, dt.time()) <= e:
                days.setdefault((u, m), set()).add(d)
                seconds[u, m] = seconds.get((u, m), 0) + n
    frame = spark.createDataFrame(lives, "user_id bigint, combined_start_date timestamp_ntz, reporting_end_date timestamp_ntz, reporting_months int")
    rows = df(spark, "reading_activity_daily", [{"user_id": u, "reading_date": d, "reading_duration_seconds": n} for u, d, n in reading])
    got = {(r["user_id"], r["reporting_months"]): r for r in rfi.rfi_average_reading(rows, frame).collect()}
    assert {k: r["total_reading_days"] for k, r in got.items()} == {k: len(v) for k, v in days.items()}
    for (u, m), r in got.items():
        assert float(r["avg_month_mins_read"]) == (20 * seconds[u, m] + 60 * m) // (120 * m) / 10
