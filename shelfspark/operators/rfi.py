"""J10 rfi_monthly and J11 rfi_average: recency / frequency / intensity scores per
subscription, for one month or averaged over the subscription's life.

Scale notes. The event table is read once per job: last-active dates and session
durations come from one filtered scan, reduced by ``groupBy(user_id, session_id)`` with
map-side partial aggregation before any shuffle (a single heavy user or session is
combined inside each task). Subscriber sets are joined as one-row-per-user tables, so no
join multiplies events; the per-user measures all arrive hash-partitioned by ``user_id``
and the final left joins reuse that partitioning.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bands import activity, cohort, described, recency
from ..functions.dates import (add_months, date_lit, day_boundaries, month_boundaries,
                               second_boundaries, ts_lit)
from ..functions.days import bit_of, distinct_days, word_of
from ..functions.membership import may_hold
from ..params import LEVEL_TEXTS, BACKEND_EVENTS, RfiAverageParams, RfiBands, RfiWindow
from ..schemas import RFI_AVERAGE_COLUMNS, RFI_MONTHLY_COLUMNS
from ..session import materialize


def _live_subscribed(subscriptions: DataFrame, subscribed_from) -> DataFrame:
    return subscriptions.filter(
        (F.col("subscription_type") == "subscribed")
        & (F.col("start_timestamp") >= ts_lit(subscribed_from))
        & F.col("subscription_canceled_at").isNull())


def _direct() -> Column:
    return F.col("payment_channel") == "direct"


def _not_backend(tracking: DataFrame) -> DataFrame:
    """``event_name NOT IN (...)``: NULL names drop too."""
    return tracking.filter(~F.col("event_name").isin(*BACKEND_EVENTS))


# --- J10 -----------------------------------------------------------------------------
def rfi_subscribers(subscriptions: DataFrame, w: RfiWindow) -> DataFrame:
    """Subscriptions alive at the cut-off and at least ``min_days`` old by then, with
    their effective start and end (paid dates for direct users)."""
    cut = ts_lit(w.cut_off)
    start = (F.when(_direct() & F.col("paid_start_timestamp").isNotNull(), F.col("paid_start_timestamp"))
             .otherwise(F.col("start_timestamp")))
    end = (F.when(_direct() & F.col("subscription_canceled_at").isNotNull(), F.col("subscription_canceled_at"))
           .when(F.col("subscription_canceled_at").isNull() & F.col("paid_end_timestamp").isNotNull(),
                 F.col("paid_end_timestamp"))
           .otherwise(F.col("end_timestamp")))
    age = day_boundaries(F.col("combined_start_date"), date_lit(w.cut_off))
    return (_live_subscribed(subscriptions, w.subscribed_from)
            .withColumn("combined_start_date", start)
            .withColumn("combined_end_date", end)
            .filter((F.col("combined_end_date") >= cut) & (age >= w.min_days))
            .withColumn("reporting_start_date", date_lit(w.start))
            .withColumn("subscribed_after_date", date_lit(w.cut_off))
            .withColumn("subscribed_days_from_cutoff", age))


def rfi_activity(tracking: DataFrame, subscribers: DataFrame, w: RfiWindow) -> DataFrame:
    """user_id, last_active_date (events up to the cut-off), total_seconds_all_sessions
    (sum over the window's sessions of last - first event, in second boundaries).

    Events are reduced to one row per (user, session) before anything meets the
    subscriber set: the aggregation is partial per task and shuffles on both keys, so a
    user with a huge share of events is spread over tasks; only the reduced rows are
    joined to subscribers. A bounded filter of the subscriber ids drops most other users'
    events in the scan, before that shuffle.
    """
    cut, start = ts_lit(w.cut_off), ts_lit(w.start)
    ts, sid = F.col("event_timestamp"), F.col("session_id")
    users = subscribers.select("user_id").distinct()
    in_session = sid.isNotNull() & (sid != "") & (ts >= start)
    sessions = (_not_backend(tracking).filter((ts <= cut) & F.col("user_id").isNotNull())
                .filter(may_hold(users, "user_id"))
                .groupBy("user_id", "session_id")
                .agg(F.max(ts).alias("_last_any"),
                     F.min(F.when(in_session, ts)).alias("_first"),
                     F.max(F.when(in_session, ts)).alias("_last"))
                .join(users, "user_id"))   # inner join on distinct ids: stays after the reduction
    return (sessions.groupBy("user_id")
            .agg(F.max(F.to_date("_last_any")).alias("last_active_date"),
                 F.sum(second_boundaries("_first", "_last")).alias("total_seconds_all_sessions")))


def rfi_reading_days(reading: DataFrame, subscribers: DataFrame, w: RfiWindow) -> DataFrame:
    """user_id, active_reading_days: distinct reading dates in [start, cut-off], as bits of one
    or a few longs per user."""
    rd = F.col("reading_date")
    users = subscribers.select("user_id").distinct()
    return (reading.filter((rd >= ts_lit(w.start)) & (rd <= ts_lit(w.cut_off)))
            .filter(may_hold(users, "user_id"))
            .join(users, "user_id", "left_semi")
            .groupBy("user_id")
            .agg(distinct_days(rd, w.start, w.cut_off).alias("active_reading_days")))


def rfi_monthly(subscriptions: DataFrame, tracking: DataFrame, reading: DataFrame,
                registrations: DataFrame, w: RfiWindow = RfiWindow(),
                bands: RfiBands = RfiBands()) -> DataFrame:
    """One row per qualifying subscription (a user may have several)."""
    subs = rfi_subscribers(subscriptions, w)
    act = rfi_activity(tracking, subs, w)
    days = rfi_reading_days(reading, subs, w)
    reg = registrations.select("user_id", "organisation_id")
    cut = date_lit(w.cut_off)
    j = (subs.join(reg, "user_id", "left").join(act, "user_id", "left")
         .join(days, "user_id", "left"))
    j = j.select(
        "*",
        F.coalesce(F.col("active_reading_days").cast("int"), F.lit(0)).alias("_days"),
        F.when(F.col("total_seconds_all_sessions").isNull(), F.lit(0))
         .otherwise(F.expr("total_seconds_all_sessions div 60").cast("int")).alias("session_total_minutes"),
        F.when(F.col("last_active_date").isNull(), day_boundaries("combined_start_date", cut))
         .otherwise(day_boundaries("last_active_date", cut)).cast("int").alias("days_since_login"),
        F.when(F.col("organisation_id").isNotNull(), "B2B").otherwise("B2C").alias("user_group"),
    ).drop("active_reading_days").withColumnRenamed("_days", "active_reading_days")
    r_level, r_score = recency(F.col("days_since_login"), bands.recency_edges)
    f_level, f_score = activity(F.col("active_reading_days"), bands.frequency_edges,
                                bands.monthly_zero_frequency_label)
    i_level, i_score = activity(F.col("session_total_minutes"), bands.intensity_edges, "D")
    return j.select(
        *[c for c in RFI_MONTHLY_COLUMNS if c not in ("combined_score", "combined_cohort")],
        (r_score + f_score + i_score).cast("int").alias("combined_score"),
        cohort(r_level, f_level, i_level).alias("combined_cohort"),
    ).select(*RFI_MONTHLY_COLUMNS)


# --- J11 -----------------------------------------------------------------------------
def rfi_average_subscribers(subscriptions: DataFrame, p: RfiAverageParams) -> DataFrame:
    """Subscriptions with a reporting end (last whole-month anniversary by the cut-off
    when still running, or ending in the as-of month), at least one month long and
    reporting within a month of the cut-off."""
    cut_ts, now = ts_lit(p.cut_off), ts_lit(p.as_of)
    start = (F.when(_direct() & F.col("paid_start_timestamp").isNotNull(), F.col("paid_start_timestamp"))
             .otherwise(F.col("start_timestamp")))
    end = (F.when(_direct() & F.col("paid_end_timestamp").isNotNull(), F.col("paid_end_timestamp"))
           .otherwise(F.col("end_timestamp")))
    cs, ce = F.col("combined_start_date"), F.col("combined_end_date")
    this_month = (F.month(ce) == F.month(now)) & (F.year(ce) == F.year(now))
    reporting_end = (F.when((ce >= cut_ts) | this_month,
                            add_months(cs, month_boundaries(cs, date_lit(p.cut_off))))
                     .otherwise(ce))
    return (_live_subscribed(subscriptions, p.subscribed_from)
            .withColumn("combined_start_date", start)
            .withColumn("combined_end_date", end)
            .withColumn("cut_off_date", date_lit(p.cut_off))
            .withColumn("reporting_end_date", reporting_end)
            .withColumn("reporting_months", month_boundaries(cs, F.col("reporting_end_date")))
            .filter((F.col("reporting_months") > 0)
                    & (F.col("reporting_end_date") >= add_months(cut_ts, -1))))


def _round_ratio(num: Column, den: Column) -> Column:
    """ROUND(num / den, 1) on exact decimals (half up)."""
    return F.round(num.cast("decimal(38,0)") / den, 1)


def rfi_average_reading(reading: DataFrame, subscribers: DataFrame) -> DataFrame:
    """Reading days and minutes over each subscription's life (duration > 0), grouped by
    user and month count (a user's subscriptions with equal month counts merge), and the
    per-month averages rounded to one decimal.

    Reading is reduced to one row per user and day, then to one per user and word of 64 days
    (at most 64 days with their seconds) before it meets the subscriptions, so a subscription
    fans out over its life's words, not over reading rows; of the words at the ends of a life
    the days outside are left out. Days that several lives share are or-ed, seconds add up.
    """
    rd = F.col("reading_date")
    words = (reading.filter(F.col("reading_duration_seconds") > 0)
             .groupBy("user_id", F.to_date(rd).alias("day")).agg(F.sum("reading_duration_seconds").alias("seconds"))
             .groupBy("user_id", word_of(F.col("day")).alias("word"))
             .agg(F.collect_list(F.struct("day", bit_of(F.col("day")).alias("bit"), "seconds")).alias("days")))
    start, end = F.col("combined_start_date"), F.col("reporting_end_date")
    lives = subscribers.select("user_id", "reporting_months", start, end, word_of(start).alias("first_word"), word_of(end).alias("last_word"))
    zero = F.lit(0).cast("long")
    inside = F.filter("days", lambda d: (d["day"] >= start) & (d["day"] <= end))
    met = (lives.join(words, "user_id").filter(F.col("word").between(F.col("first_word"), F.col("last_word")))
           .select("user_id", "reporting_months", "word", inside.alias("days")).filter(F.size("days") > 0))
    per = (met.select("user_id", "reporting_months", "word",
                      F.aggregate("days", zero, lambda a, d: a.bitwiseOR(d["bit"])).alias("bits"),
                      F.aggregate("days", zero, lambda a, d: a + d["seconds"]).alias("seconds"))
           .groupBy("user_id", "reporting_months", "word").agg(F.bit_or("bits").alias("bits"), F.sum("seconds").alias("seconds"))
           .groupBy("user_id", "reporting_months").agg(F.sum(F.bit_count("bits")).cast("long").alias("total_reading_days"),
                                                       F.sum("seconds").alias("_seconds")))
    months = F.col("reporting_months")
    return per.select(
        "user_id", "reporting_months", "total_reading_days",
        _round_ratio(F.col("total_reading_days"), months).alias("avg_month_reading_days"),
        _round_ratio(F.col("_seconds"), months * 60).alias("avg_month_mins_read"))


def rfi_average(subscriptions: DataFrame, tracking: DataFrame, reading: DataFrame,
                registrations: DataFrame, user_summary: DataFrame,
                p: RfiAverageParams | None = None, bands: RfiBands = RfiBands(),
                describe: bool = False) -> DataFrame:
    """One row per (qualifying subscription x reading-average row) of each non-internal
    user; ``reporting_history_date`` is the earliest reporting end of the result. ``describe``
    adds what the three levels stand for as text columns. Runs its stored stages when called."""
    p = p or RfiAverageParams()
    # Stored: read for the activity limits, the reading join and the result.
    subs = materialize(rfi_average_subscribers(subscriptions, p), "rfi-subscribers")
    # IN (subscribers WHERE ts <= reporting_end) == ts <= the user's latest reporting end.
    # Events are first reduced to one row per (user, day) with the day's earliest time:
    # a day counts as active iff that time is <= the user's reporting end.
    ends = subs.groupBy("user_id").agg(F.max("reporting_end_date").alias("_until"))
    # Every reporting end lies before the month after the cut-off: the scan is bounded.
    next_month = (p.cut_off.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
    days = (_not_backend(tracking).filter(F.col("user_id").isNotNull()
                                          & (F.col("event_timestamp") < ts_lit(next_month)))
            .filter(may_hold(ends, "user_id"))
            .groupBy("user_id", F.to_date("event_timestamp").alias("_day"))
            .agg(F.min("event_timestamp").alias("_earliest")))
    last = (days.join(ends, "user_id")
            .filter(F.col("_earliest") <= F.col("_until"))
            .groupBy("user_id")
            .agg(F.max("_day").alias("last_active_date")))
    avg = (rfi_average_reading(reading, subs)
           .select("user_id", "avg_month_reading_days", "avg_month_mins_read"))
    reg = registrations.select("user_id", "organisation_id", "registration_time")
    summary = user_summary.select("user_id", "internal_user")
    j = (subs.select("user_id", "combined_start_date", "combined_end_date",
                     "reporting_end_date", "reporting_months")
         .filter(F.col("combined_end_date") >= ts_lit(p.active_from))
         .join(reg, "user_id")
         .join(summary.filter(F.col("internal_user") == "N"), "user_id")
         .join(last, "user_id", "left")
         .join(avg, "user_id", "left"))
    last_time = F.coalesce(F.col("last_active_date").cast("timestamp_ntz"), F.col("registration_time"))
    zero = F.lit(0).cast("decimal(38,1)")
    j = j.select(
        "user_id", "combined_start_date", "reporting_end_date",
        day_boundaries(last_time, F.col("reporting_end_date")).alias("days_since_login"),
        F.coalesce("avg_month_reading_days", zero).alias("avg_month_reading_days"),
        F.coalesce("avg_month_mins_read", zero).alias("avg_month_mins_read"),
        F.when(F.col("organisation_id").isNull(), "B2C").otherwise("B2B").alias("user_group"))
    r_level, r_score = recency(F.col("days_since_login"), bands.recency_edges)
    f_level, f_score = activity(F.col("avg_month_reading_days"), bands.frequency_edges, "D")
    i_level, i_score = activity(F.col("avg_month_mins_read"), bands.intensity_edges, "D")
    # Stored once: the result is read by the one-row minimum and by the final select, which
    # would otherwise plan and run the whole pipeline twice.
    scored = materialize(j.select("*", (r_score + f_score + i_score).alias("combined_score"),
                                  cohort(r_level, f_level, i_level).alias("combined_cohort"),
                                  r_level.alias("recency_level"), f_level.alias("frequency_level"),
                                  i_level.alias("intensity_level")),
                         "rfi-average")
    history = scored.select(F.min("reporting_end_date")).scalar()
    out = scored.withColumn("reporting_history_date", history)
    if not describe:
        return out.select(*RFI_AVERAGE_COLUMNS)
    return out.select(*RFI_AVERAGE_COLUMNS, *[
        described(F.col(f"{name}_level"), texts).alias(f"{name}_description") for name, texts in LEVEL_TEXTS.items()])
