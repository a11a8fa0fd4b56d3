"""The daily register-summary load (J8) driven by new event files.

The reference runs the incremental funnel by hand once a day. Here a file stream over the
event folder notices new Parquet files and, per micro-batch, appends the increment to the
stored summary (``foreachBatch``). ``trigger(availableNow=True)`` processes whatever has
arrived and stops, so a scheduler can start it daily; the stream checkpoint records which
files were handled.

The batch's events go into a ``VisitorState`` (``operators.visitor_state``): the event store, kept by
day and visitor bucket, and the merged first hits and account creations. The increment is found
in that state, and history is read only for the buckets of the visitors it reports. Every write
of a batch is a run with the batch's id, and the increment is computed against the summary
*without* the batch's own partition, so a batch retried after a failure gives the same rows once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.register import register_funnel_backfill
from ..operators.visitor_state import VisitorState
from ..params import SiteUrls
from ..schemas import EVENT_TRACKING, REGISTER_SUMMARY_COLUMNS
from ..sources import sinks

BATCH_COLUMN = "load_batch"
BACKFILL_BATCH = -1


def _write_batch(rows: DataFrame, summary_path: str, batch_id: int) -> None:
    sinks.replace_period(rows.withColumn(BATCH_COLUMN, F.lit(batch_id).cast("long")), summary_path,
                         [*REGISTER_SUMMARY_COLUMNS, BATCH_COLUMN], BATCH_COLUMN, [batch_id], run_id=f"batch{batch_id}")


def read_summary(spark: SparkSession, summary_path: str, exclude_batch: int | None = None) -> DataFrame:
    summary = spark.read.parquet(summary_path)
    if exclude_batch is not None:
        summary = summary.filter(F.col(BATCH_COLUMN) != exclude_batch)
    return summary.select(*REGISTER_SUMMARY_COLUMNS)


def backfill(spark: SparkSession, events_path: str, registrations: DataFrame, hashes: DataFrame,
             summary_path: str, urls: SiteUrls = SiteUrls()) -> None:
    """Initial full-history summary (J7), stored as batch -1."""
    events = spark.read.schema(EVENT_TRACKING).parquet(events_path)
    _write_batch(register_funnel_backfill(events, registrations, hashes, urls), summary_path,
                 BACKFILL_BATCH)


def start_daily_register(spark: SparkSession, events_path: str, registrations: DataFrame,
                         hashes: DataFrame, summary_path: str, checkpoint_location: str,
                         urls: SiteUrls = SiteUrls(), null_aware: bool = False,
                         available_now: bool = True, state_path: str | None = None):
    """Start the stream; returns the ``StreamingQuery``. Its first batch takes in all files of the
    folder, later ones the new files; the state lies beside the checkpoint unless it is named."""
    state = VisitorState(spark, state_path or f"{checkpoint_location.rstrip('/')}-state", urls)

    def load(new_events: DataFrame, batch_id: int) -> None:
        state.add(new_events, f"batch{batch_id}")
        summary = read_summary(spark, summary_path, exclude_batch=batch_id)
        _write_batch(state.increment(registrations, hashes, summary, null_aware), summary_path, batch_id)

    writer = (spark.readStream.schema(EVENT_TRACKING).parquet(events_path)
              .writeStream.foreachBatch(load)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 day")
    return writer.start()
