"""J5 b2c_churn: days and weeks from first subscription to churn for direct (B2C) users
with at most two subscriptions on any channel."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day_boundaries, ts_lit, week_boundaries
from ..schemas import CHURN_COLUMNS

NOT_CHURNED = 99999


def b2c_churn(subscriptions: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """One row per user; ``as_of`` replaces GETDATE() (default: current timestamp).

    The HAVING subquery (rows on all channels <= 2) and the direct-only aggregate are one
    ``groupBy(user_id)`` with conditional aggregates: a single shuffle with map-side
    partial aggregation, instead of two aggregates and a semi join.
    """
    direct = F.col("payment_channel") == "direct"

    def on_direct(c: str):
        return F.when(direct, F.col(c))

    base = (subscriptions.filter(F.col("user_id").isNotNull())
            .groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("_rows"),
                 F.count(F.when(direct, F.lit(1))).alias("_direct_rows"),
                 F.min(on_direct("start_timestamp")).alias("first_subscription_start_date"),
                 F.min(on_direct("end_timestamp")).alias("first_subscription_end_date"),
                 F.min(on_direct("subscription_canceled_at")).alias("first_subscription_cancelled_date"),
                 F.min(on_direct("paid_start_timestamp")).alias("first_paid_start_date"),
                 F.min(on_direct("paid_end_timestamp")).alias("first_paid_end_date"),
                 F.sum(on_direct("total_paid_gbp")).alias("subscription_total_paid"),
                 F.sum(on_direct("paid_months")).alias("subscription_paid_months"))
            .filter((F.col("_rows") <= 2) & (F.col("_direct_rows") > 0)))
    now = ts_lit(as_of) if as_of is not None else F.current_timestamp().cast("timestamp_ntz")
    churned = F.coalesce("first_subscription_cancelled_date", "first_paid_end_date",
                         "first_subscription_end_date")
    start = F.col("first_subscription_start_date")
    active = F.col("subscriber_churned_date") >= now
    return (base.withColumn("subscriber_churned_date", churned)
            .withColumn("days_till_churned",
                        F.when(active, F.lit(NOT_CHURNED))
                        .otherwise(day_boundaries(start, "subscriber_churned_date")))
            .withColumn("weeks_till_churned",
                        F.when(active, F.lit(NOT_CHURNED))
                        .otherwise(week_boundaries(start, "subscriber_churned_date")))
            .withColumn("subscriber_active", F.when(active, "Y").otherwise("N"))
            .select(*CHURN_COLUMNS))
