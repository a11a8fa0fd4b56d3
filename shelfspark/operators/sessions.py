"""J1 session_counts: distinct sessions per user who has any subscription."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def session_counts(tracking: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """user_id, session_count = COUNT(DISTINCT session_id) for users IN subscriptions.

    Plan: (user, session) pairs are de-duplicated first (map-side partial aggregation,
    exchange on both keys, so a user with a huge share of events is spread over many
    tasks), then restricted to subscribers by a semi join on the already small pair set,
    and counted per user (non-NULL sessions only; a user with only NULL sessions keeps 0).
    """
    pairs = (tracking.filter(F.col("user_id").isNotNull())
             .select("user_id", "session_id").distinct())
    subscribers = subscriptions.select("user_id").distinct()
    # An inner join with the distinct subscriber ids is the IN test; unlike a semi join,
    # Catalyst does not push it below the de-duplication, so raw events are never
    # shuffled by user.
    return (pairs.join(subscribers, "user_id")
            .groupBy("user_id")
            .agg(F.count("session_id").alias("session_count")))
