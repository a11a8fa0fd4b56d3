"""The daily register load (J8) from stored state, without reading the event history.

``VisitorState`` keeps beside the event store (``sources.event_store``) what the load needs to know
of all earlier events, as tables that grow by merging:

* ``codes``: per visitor and organisation code, the first hit on the register page (a minimum),
  stored by visitor bucket; a load rewrites the buckets in which it has register hits;
* ``creators``: user ids with an account creation (a set), one partition per load.

A load adds its events to the store, merges its register hits and creations into the state, and
finds the visitors to report: in no earlier summary, with a code first seen at or after the
high-water mark that leads to an organisation. The history is read for these alone, and only the
buckets they are in are opened; their numbers (at most ``buckets``) are the one thing that passes
through the driver. Late events merge like others, since minima and sets do not depend on order.

The rows equal those of ``register_funnel_incremental`` over all stored events. Every step is a run
with the load's id (``sources.sinks``), so a load that failed is repeated as a whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.joins import not_in
from ..params import SiteUrls
from ..session import materialize
from ..sources import event_store, sinks
from . import register as funnel

CODE_COLUMNS = ["unique_id", "position_find", "first_recorded_date", "organisation_code"]
CODES = "unique_id string, position_find int, first_recorded_date timestamp_ntz, organisation_code string, visitor_bucket int"
CREATORS = "user_id bigint, load string"


@dataclass
class VisitorState:
    spark: SparkSession
    path: str
    urls: SiteUrls = SiteUrls()
    buckets: int = event_store.BUCKETS

    @property
    def events_path(self) -> str:
        return f"{self.path.rstrip('/')}/events"

    def _read(self, name: str, schema: str) -> DataFrame:
        """A state table; one that no load has written yet is empty."""
        folder = sinks._Folder(self.spark, f"{self.path.rstrip('/')}/{name}")
        if not folder.files(""):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(folder.top)

    def codes(self, buckets: list[int] | None = None) -> DataFrame:
        codes = self._read("codes", CODES)
        if buckets is not None:
            codes = codes.filter(F.col(event_store.BUCKET).isin(*buckets))
        return codes

    def creators(self) -> DataFrame:
        return self._read("creators", CREATORS).select("user_id").distinct()

    def add(self, events: DataFrame, load: str) -> None:
        """Store the events of a load and merge their register hits and account creations."""
        event_store.add(events, self.events_path, load, self.buckets)
        marks = funnel.event_marks(events, self.urls)
        bucket = event_store.bucket_of("unique_id", self.buckets).alias(event_store.BUCKET)
        new = materialize(funnel.register_codes(marks, self.urls).select(*CODE_COLUMNS, bucket), "new-codes")
        touched = sorted(r[0] for r in new.select(event_store.BUCKET).distinct().collect())  # at most ``buckets`` numbers
        if touched:
            merged = (self.codes(touched).unionByName(new)
                      .groupBy("unique_id", "position_find", "organisation_code", event_store.BUCKET)
                      .agg(F.min("first_recorded_date").alias("first_recorded_date")))
            sinks.replace_period(merged, f"{self.path.rstrip('/')}/codes", [*CODE_COLUMNS, event_store.BUCKET],
                                 event_store.BUCKET, touched, run_id=load)
        created = (marks.filter((F.col("event_name") == funnel.ACCOUNT_CREATION) & F.col("user_id").isNotNull())
                   .select("user_id").distinct().withColumn("load", F.lit(load)))
        sinks.replace_period(created, f"{self.path.rstrip('/')}/creators", ["user_id", "load"], "load", [load], run_id=load)

    def candidates(self, hashes: DataFrame, summary: DataFrame, null_aware: bool = False) -> DataFrame:
        """First codes of the visitors to report: not in ``summary``, first seen from its high-water
        mark on, with an organisation (others are never exported)."""
        codes = not_in(self.codes().drop(event_store.BUCKET), "unique_id", summary, "unique_id", null_aware)
        codes = codes.filter(F.col("first_recorded_date") >= funnel.high_water_mark(summary))
        return (funnel.with_organisation(funnel.first_code_per_visitor(codes), hashes, trim_hash=True)
                .filter(F.col("calculated_organisationid").isNotNull()))

    def affected(self, candidates: DataFrame) -> list[int]:
        """Buckets of the candidates (at most ``buckets`` numbers)."""
        bucket = event_store.bucket_of("unique_id", self.buckets).alias("b")
        return sorted(r[0] for r in candidates.filter("unique_id IS NOT NULL").select(bucket).distinct().collect())

    def increment(self, registrations: DataFrame, hashes: DataFrame, summary: DataFrame, null_aware: bool = False) -> DataFrame:
        """The rows to append to ``summary``."""
        combined = materialize(self.candidates(hashes, summary, null_aware), "codes")
        history = event_store.read(self.spark, self.events_path, buckets=self.affected(combined))
        slice_ = funnel.visitor_events(history, combined)
        main = funnel.register_rejoined(slice_, combined, self.urls, since=funnel.high_water_mark(summary))
        transfers = funnel.b2c_transfers(registrations, self.creators().withColumn("event_name", F.lit(funnel.ACCOUNT_CREATION)),
                                         summary, null_aware)
        return funnel._export(funnel._union_distinct(main, transfers), slice_)
