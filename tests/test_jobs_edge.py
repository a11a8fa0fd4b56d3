"""Hand-made edge rows for the quirks of SURVEY §2.14 (literal expected rows)."""

import datetime as dt
from decimal import Decimal

import pytest

from shelfspark.operators import churn, google_views, groups, pricing, rfi, sessions
from shelfspark.params import DlpRates, Period, RfiAverageParams, RfiWindow
from tests.helpers import df, rows, ts

D = dt.date


def sub(user, start, end=None, cancel=None, paid_start=None, paid_end=None, channel="direct",
        kind="subscribed", total="10.00", months=1):
    return dict(user_id=user, start_timestamp=ts(start), end_timestamp=ts(end) if end else None,
                subscription_canceled_at=ts(cancel) if cancel else None,
                paid_start_timestamp=ts(paid_start) if paid_start else None,
                paid_end_timestamp=ts(paid_end) if paid_end else None,
                total_paid_gbp=Decimal(total), paid_months=months, payment_channel=channel,
                subscription_type=kind)


def test_session_counts_nulls_and_empty_sessions(spark):
    tracking = df(spark, "user_tracking_events", [
        dict(user_id=1, session_id="a", event_name="x", event_timestamp=ts("2024-01-01 00:00:00")),
        dict(user_id=1, session_id="a", event_name="x", event_timestamp=ts("2024-01-01 00:01:00")),
        dict(user_id=1, session_id="", event_name="x", event_timestamp=ts("2024-01-01 00:02:00")),
        dict(user_id=2, session_id=None, event_name="x", event_timestamp=ts("2024-01-01 00:00:00")),
        dict(user_id=3, session_id="b", event_name="x", event_timestamp=ts("2024-01-01 00:00:00")),
        dict(user_id=None, session_id="c", event_name="x", event_timestamp=ts("2024-01-01 00:00:00")),
    ])
    subs = df(spark, "subscriptions", [sub(1, "2020-01-01 00:00:00"), sub(2, "2020-01-01 00:00:00"),
                                       sub(None, "2020-01-01 00:00:00")])
    out = sessions.session_counts(tracking, subs)
    assert rows(out, "user_id", "session_count") == [(1, 2), (2, 0)]


def test_book_dlp_euro_branch(spark):
    books = df(spark, "book_meta", [
        dict(id=1, gbp_price_exvat_float=10.0, usd_price_exvat_float=99.0),
        dict(id=2, usd_price_exvat_float=12.5),
        dict(id=3, eur_price_exvat_float=11.5),       # only a euro price (Q6)
        dict(id=4)])                                   # no price
    literal = dict(rows(pricing.book_dlp(books), "book_id", "dlp"))
    assert literal == {1: 10.0, 2: 10.0, 3: None, 4: None}
    fixed = dict(rows(pricing.book_dlp(books, DlpRates(fix_eur=True)), "book_id", "dlp"))
    assert fixed[3] == pytest.approx(10.0)


def test_user_group_info_filters_and_names(spark):
    users = df(spark, "users", [dict(id=1, group_id=2, organisation_id=5), dict(id=2, group_id=0),
                                dict(id=3, group_id=None), dict(id=4, group_id=9, organisation_id=6)])
    grp = df(spark, "groups", [dict(id=2, group_name="Two", group_code="TWO")])
    org = df(spark, "organisations", [dict(id=5, organisation_name="Org5")])
    out = groups.user_group_info(users, grp, org)
    assert rows(out, "user_id", "group_id", "group_name", "group_code", "organisation_name") == [
        (1, 2, "Two", "TWO", "Org5"), (4, 9, None, None, None)]


def test_churn_quirks(spark):
    subs = df(spark, "subscriptions", [
        # churn date NULL -> not active, differences NULL (Q12)
        dict(user_id=1, start_timestamp=ts("2023-01-01 00:00:00"), total_paid_gbp=Decimal("1.00"),
             paid_months=1, payment_channel="direct", subscription_type="subscribed"),
        # churn date exactly as_of -> active, 99999
        sub(2, "2023-01-02 10:00:00", end="2024-02-15 00:00:00"),
        # cancellation first; Sunday start -> Monday after is one week boundary
        sub(3, "2024-01-07 23:00:00", end="2024-06-01 00:00:00", cancel="2024-01-08 01:00:00",
            paid_end="2024-05-01 00:00:00"),
        # three subscriptions -> excluded; indirect only -> excluded
        sub(4, "2023-01-01 00:00:00", end="2023-02-01 00:00:00"),
        sub(4, "2023-03-01 00:00:00", end="2023-04-01 00:00:00"),
        sub(4, "2023-05-01 00:00:00", end="2023-06-01 00:00:00"),
        sub(5, "2023-01-01 00:00:00", end="2023-02-01 00:00:00", channel="indirect"),
        # two subscriptions, one indirect: counts all channels, aggregates direct only
        sub(6, "2023-01-01 00:00:00", end="2023-01-31 00:00:00", total="5.00", months=2),
        sub(6, "2022-01-01 00:00:00", end="2022-02-01 00:00:00", channel="indirect", total="7.00"),
    ])
    out = churn.b2c_churn(subs, dt.datetime(2024, 2, 15))
    got = rows(out, "user_id", "subscriber_churned_date", "days_till_churned", "weeks_till_churned",
               "subscriber_active", "subscription_total_paid", "subscription_paid_months")
    assert got == [
        (1, None, None, None, "N", Decimal("1.00"), 1),
        (2, dt.datetime(2024, 2, 15), 99999, 99999, "Y", Decimal("10.00"), 1),
        (3, dt.datetime(2024, 1, 8, 1), 1, 1, "N", Decimal("10.00"), 1),
        (6, dt.datetime(2023, 1, 31), 30, 5, "N", Decimal("5.00"), 2),   # Sun -> Tue: 5 Mondays
    ]


def _page_view(i, uid, when, book, geo="GB", props=None):
    return dict(event_id=i, unique_id=uid, user_id=None, event_name="page view",
                record_date=ts(when), current_url=f"https://www.example.com/book/{book}",
                referrer_url="https://www.google.com/", geo_location=geo,
                event_properties=props if props is not None else '{"content_ids":[%s]}' % book,
                user_agent=None, environment_name="web")


def test_google_views_first_book_and_day_geo(spark):
    events = df(spark, "event_tracking", [
        # one visitor, two books on two days in two locations (Q13)
        _page_view(1, "v1", "2024-01-02 10:00:00", 7, "GB"),
        _page_view(2, "v1", "2024-01-03 10:00:00", 8, "US"),
        _page_view(3, "v2", "2024-01-02 11:00:00", 8, "GB"),
        # multi-id value: NULL id, still counted (Q14); odd values
        _page_view(4, "v3", "2024-01-02 12:00:00", 0, props='{"content_ids":[1,2]}'),
        _page_view(5, "v4", "2024-01-02 12:00:00", 0, props='{"content_ids":["7"]}'),
        _page_view(6, "v5", "2024-01-02 12:00:00", 0, props='{"content_ids":[]}'),
        _page_view(7, "v6", "2024-01-02 12:00:00", 0, props='{"content_ids":{}}'),
        _page_view(8, "v7", "2024-01-02 12:00:00", 0, props='{"content_ids":[5]} junk'),
        _page_view(9, "", "2024-01-02 12:00:00", 5),                        # empty visitor
        _page_view(10, "v8", "2023-12-31 23:59:59", 5),                     # outside the period
    ])
    period = Period(D(2024, 1, 1), D(2024, 1, 31))
    by_period = rows(google_views.google_first_views_by_period(events, period),
                     "book_id", "reporting_period_start", "unique_first_views")
    # '1,2', '"7"', '' and '{}' are four book texts with no integer id: four NULL rows
    assert by_period == [(7, D(2024, 1, 1), 1), (8, D(2024, 1, 1), 1), (None, D(2024, 1, 1), 1),
                         (None, D(2024, 1, 1), 1), (None, D(2024, 1, 1), 1), (None, D(2024, 1, 1), 1)]
    by_day = rows(google_views.google_first_views_by_day_geo(events, period),
                  "book_id", "reporting_period_start", "geo_location", "unique_first_views")
    assert (7, D(2024, 1, 2), "GB", 1) in by_day and (7, D(2024, 1, 3), "US", 1) in by_day
    assert (8, D(2024, 1, 2), "GB", 1) in by_day
    assert (None, D(2024, 1, 2), "GB", 4) in by_day


def _tracking(user, when, session="s", name="page view"):
    return dict(user_id=user, session_id=session, event_name=name, event_timestamp=ts(when))


def test_rfi_monthly_zero_days_and_cutoff_day(spark):
    w = RfiWindow(start=D(2024, 1, 1), cut_off=D(2024, 1, 31))
    subs = df(spark, "subscriptions", [
        sub(1, "2023-06-01 00:00:00", end="2024-12-01 00:00:00"),
        sub(2, "2023-06-01 00:00:00", end="2024-12-01 00:00:00", channel="indirect"),
        sub(3, "2024-01-15 00:00:00", end="2024-12-01 00:00:00")])   # too young
    tracking = df(spark, "user_tracking_events", [
        _tracking(1, "2024-01-31 00:00:00"),              # counts (cut-off is midnight)
        _tracking(1, "2024-01-31 10:00:00"),              # later that day: outside (Q11)
        _tracking(1, "2024-01-20 10:00:00.9", "t"), _tracking(1, "2024-01-20 10:10:02.1", "t"),
        _tracking(2, "2024-01-10 00:00:00", name="page close")])
    reading = df(spark, "reading_activity_daily", [
        dict(user_id=1, reading_date=D(2024, 1, 5), reading_duration_seconds=0),
        dict(user_id=1, reading_date=D(2024, 1, 6), reading_duration_seconds=10)])
    regs = df(spark, "user_registrations", [dict(user_id=2, organisation_id=3)])
    out = rfi.rfi_monthly(subs, tracking, reading, regs, w)
    got = rows(out, "user_id", "days_since_login", "active_reading_days", "session_total_minutes",
               "combined_score", "user_group", "combined_cohort")
    # user 1: last active 01-31 -> 0 days (A/4); 2 reading days (B/3, zero duration kept, Q9);
    # sessions: "s" 0 s (only the midnight event), "t" 602 s -> 10 minutes (B/3)
    # user 2: never active -> days from start; 0 reading days -> NULL level (Q7), score 1
    assert got == [(1, 0, 2, 10, 10, "B2C", "ABB"), (2, 244, 0, 0, 3, "B2B", None)]


def test_rfi_average_fan_out(spark):
    p = RfiAverageParams(cut_off=D(2024, 1, 31), active_from=D(2024, 1, 1), as_of=dt.datetime(2024, 2, 15))
    subs = df(spark, "subscriptions", [
        sub(1, "2023-10-15 00:00:00", end="2025-01-01 00:00:00"),      # 3 months
        sub(1, "2023-07-31 08:00:00", end="2025-01-01 00:00:00"),      # 6 months, end clamps
        sub(2, "2023-07-01 00:00:00", end="2024-02-10 00:00:00")])     # ends in the as-of month
    tracking = df(spark, "user_tracking_events", [_tracking(1, "2024-01-10 00:00:00")])
    reading = df(spark, "reading_activity_daily", [
        dict(user_id=1, reading_date=D(2023, 11, 1), reading_duration_seconds=600),
        dict(user_id=1, reading_date=D(2023, 8, 1), reading_duration_seconds=150)])
    regs = df(spark, "user_registrations", [
        dict(user_id=1, registration_time=ts("2023-01-01 00:00:00")),
        dict(user_id=2, registration_time=ts("2023-01-01 00:00:00"), organisation_id=1)])
    summary = df(spark, "user_summary", [dict(user_id=1, internal_user="N"), dict(user_id=2, internal_user="N")])
    out = rfi.rfi_average(subs, tracking, reading, regs, summary, p)
    got = rows(out, "user_id", "reporting_end_date", "avg_month_reading_days", "avg_month_mins_read",
               "reporting_history_date")
    # user 1: two subscriptions x two month-groups = 4 rows (Q10)
    assert len([g for g in got if g[0] == 1]) == 4
    ends = {g[1] for g in got if g[0] == 1}
    assert ends == {dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 31, 8)}
    avgs = {(g[2], g[3]) for g in got if g[0] == 1}
    assert avgs == {(Decimal("0.3"), Decimal("3.3")), (Decimal("0.3"), Decimal("2.1"))}
    assert {g[4] for g in got} == {dt.datetime(2024, 1, 1)}   # min over the result
    assert [g for g in got if g[0] == 2][0][1] == dt.datetime(2024, 1, 1)
