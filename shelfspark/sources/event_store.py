"""Event history stored by day and by visitor bucket.

Folders are ``event_date=.../visitor_bucket=...``: the period jobs (J3, J4) open the days of their
period, the daily register load (J8) the buckets of the visitors it is about, whatever their days.
A bucket is a hash of the visitor; events without a visitor have the bucket of ``''``. Rows are
dealt out by day, bucket and event id in ranges, so a visitor with a large share of the events is
written by many tasks, and sorted by visitor within a file, so row groups hold narrow ranges.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import EVENT_TRACKING
from . import sinks

BUCKETS = 256
DAY, BUCKET = "event_date", "visitor_bucket"
COLUMNS = EVENT_TRACKING.fieldNames()


def bucket_of(visitor: str | Column, buckets: int = BUCKETS) -> Column:
    """Bucket of a visitor id."""
    return F.pmod(F.xxhash64(F.coalesce(F.col(visitor) if isinstance(visitor, str) else visitor, F.lit(""))), F.lit(buckets)).cast("int")


def add(events: DataFrame, path: str, run_id: str | None = None, buckets: int = BUCKETS) -> bool:
    """Append events, late ones included; a run id that is stored already is left out."""
    rows = (events.select(*COLUMNS, F.to_date("record_date").alias(DAY), bucket_of("unique_id", buckets).alias(BUCKET))
            .repartitionByRange(DAY, BUCKET, "event_id").sortWithinPartitions(DAY, BUCKET, "unique_id"))
    return sinks.append(rows, path, [*COLUMNS, DAY, BUCKET], run_id=run_id, partitions=[DAY, BUCKET])


def _day(at: dt.date) -> dt.date:
    return at.date() if isinstance(at, dt.datetime) else at


def read(spark: SparkSession, path: str, start: dt.date | None = None, end: dt.date | None = None,
         buckets: list[int] | None = None) -> DataFrame:
    """Stored events of the days from ``start`` up to ``end`` (both may be inside a day, so the jobs
    keep their own time filters) and of the given buckets; other folders are not opened."""
    schema = T.StructType([*EVENT_TRACKING.fields, T.StructField(DAY, T.DateType()), T.StructField(BUCKET, T.IntegerType())])
    events = spark.read.schema(schema).parquet(path)
    if start is not None:
        events = events.filter(F.col(DAY) >= F.lit(_day(start)))
    if end is not None:
        events = events.filter(F.col(DAY) <= F.lit(_day(end)))
    if buckets is not None:
        events = events.filter(F.col(BUCKET).isin(*buckets)) if buckets else events.filter(F.lit(False))
    return events.select(*COLUMNS)
