"""Event store and visitor state: the folders a job opens, and the daily load against J7 and J8."""

import datetime as dt
import os
import re
import tempfile
from collections import Counter

from pyspark.sql import functions as F

from shelfspark.functions.dates import ts_lit
from shelfspark.operators import google_views, register as funnel
from shelfspark.operators.visitor_state import VisitorState
from shelfspark.params import FixtureParams
from shelfspark.plans.inspect import cartesian_products, plan_text
from shelfspark.sources import event_store
from shelfspark.sources.adapters import Tables
from tests.conftest import SF001
from tests.helpers import df, ts
from tests.oracle_compare import norm

P = FixtureParams()
REGISTER = f"{P.urls.base}/group-register"


def folder(name):
    return tempfile.mkdtemp(prefix=f"{name}-", dir=os.environ.get("TMPDIR", "/tmp"))


def bag(frame):
    cols = sorted(frame.columns)
    return Counter(tuple(norm(r[c]) for c in cols) for r in frame.collect())


def opened(frame, column):
    """Values of a partition column among the files that rows of a stored frame are read from."""
    files = [r[0] for r in frame.select(F.input_file_name()).distinct().collect()]
    return {int(v) if v.isdigit() else v for f in files for v in re.findall(rf"{column}=([^/]+)", f)}


def test_store_keeps_all_events_and_prunes_days_and_buckets(spark):
    events, path = Tables(spark, SF001).event_tracking, folder("store")
    event_store.add(events, path, "first", buckets=8)
    assert not event_store.add(events, path, "first", buckets=8)      # a load that is done adds nothing
    assert bag(event_store.read(spark, path)) == bag(events)
    period = P.period()
    for job in (google_views.google_first_views_by_period, google_views.google_first_views_by_day_geo):
        stored = job(event_store.read(spark, path, period.start, period.end), period)
        assert bag(stored) == bag(job(events, period))
        text = plan_text(stored)
        assert re.search(r"PartitionFilters: \[[^\]]*event_date", text) and cartesian_products(text) == []
        days = opened(event_store.read(spark, path, period.start, period.end), event_store.DAY)
        assert days and all(period.start <= dt.date.fromisoformat(d) <= period.end for d in days)
    some = event_store.read(spark, path, buckets=[2, 5])
    assert opened(some, event_store.BUCKET) <= {2, 5}
    assert bag(some) == bag(events.filter(event_store.bucket_of("unique_id", 8).isin(2, 5)))
    assert event_store.read(spark, path, buckets=[]).count() == 0


def test_a_visitor_with_most_events_is_written_by_several_tasks(spark):
    rows = [{"event_id": i, "unique_id": "" if i % 3 else f"v{i}", "record_date": ts("2024-01-02 10:00:00")} for i in range(6000)]
    path = folder("hot")
    merge = "spark.sql.adaptive.coalescePartitions.enabled"     # at this size one task would do
    spark.conf.set(merge, "false")
    try:
        event_store.add(df(spark, "event_tracking", rows).repartition(4), path, "x", buckets=4)
    finally:
        spark.conf.set(merge, "true")
    hot = spark.range(1).select(event_store.bucket_of(F.lit(""), 4)).first()[0]
    stored = event_store.read(spark, path, buckets=[hot])
    assert stored.select(F.input_file_name()).distinct().count() > 1 and stored.count() >= 4000


def test_daily_loads_equal_the_jobs_over_all_events(spark):
    """Three loads, each with some late events: every increment equals J8 over all events so far."""
    t = Tables(spark, SF001)
    regs, hashes, events = t.user_registrations, t.org_hashes, t.event_tracking
    rd, late = F.col("record_date"), F.col("event_id") % 17 == 3
    cut = [dt.datetime(2024, 1, 12), dt.datetime(2024, 1, 18), dt.datetime(2024, 1, 24)]
    part = (F.when(rd < ts_lit(cut[0]), 0).when(rd < ts_lit(cut[1]), 1).when(rd < ts_lit(cut[2]), 2).otherwise(3)
            + F.when(late, 1).otherwise(0))
    state = VisitorState(spark, folder("state"), P.urls, buckets=32)
    loaded = events.filter(part == 0)
    state.add(loaded, "history")
    summary = funnel.register_funnel_backfill(loaded, regs, hashes, P.urls)
    grew = 0
    for day in (1, 2, 3):
        new = events.filter(part == day)
        loaded = loaded.unionByName(new)
        state.add(new, f"day{day}")
        increment = state.increment(regs, hashes, summary)
        want = funnel.register_funnel_incremental(loaded, regs, hashes, summary, P.urls)
        assert bag(increment) == bag(want)
        grew += increment.filter("unique_id IS NOT NULL").count()
        summary = _kept(spark, summary.unionByName(want))
    assert grew > 0


def _kept(spark, frame):
    path = folder("summary")
    frame.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _event(i, visitor, when, url="https://x/other", **more):
    return {"event_id": i, "unique_id": visitor, "record_date": ts(when), "event_name": "page view", "current_url": url, **more}


def test_a_load_opens_only_the_buckets_of_its_new_visitors(spark):
    state = VisitorState(spark, folder("state"), P.urls, buckets=64)
    org = df(spark, "org_hashes", [{"organisation_id": 7, "hash": "abc"}])
    regs = df(spark, "user_registrations", [])
    hit = f"{REGISTER}?orgt1=abc"
    history = [_event(i, f"old{i % 200}", "2024-01-01 10:00:00", hit if i % 5 == 0 else "https://x/other") for i in range(1000)]
    state.add(df(spark, "event_tracking", history), "history")
    summary = _kept(spark, funnel.register_funnel_backfill(event_store.read(spark, state.events_path), regs, org, P.urls))
    state.add(df(spark, "event_tracking", [
        _event(5001, "fresh", "2024-01-03 09:00:00"), _event(5002, "fresh", "2024-01-03 10:00:00", hit),
        _event(5003, "old3", "2024-01-03 10:00:00")]), "day")
    candidates = state.candidates(org, summary)
    assert [r["unique_id"] for r in candidates.collect()] == ["fresh"]
    buckets = state.affected(candidates)
    assert len(buckets) == 1
    history = event_store.read(spark, state.events_path, buckets=buckets)
    assert opened(history, event_store.BUCKET) == set(buckets)
    assert re.search(r"PartitionFilters: \[[^\]]*visitor_bucket", plan_text(history))
    rows = state.increment(regs, org, summary).collect()
    assert [(r["unique_id"], r["events_pre_register"], r["calculated_organisationid"]) for r in rows] == [("fresh", 1, 7)]
    # The same load again changes nothing.
    state.add(df(spark, "event_tracking", [_event(5002, "fresh", "2024-01-03 10:00:00", hit)]), "day")
    assert state.codes().filter("unique_id = 'fresh'").count() == 1
    assert event_store.read(spark, state.events_path).filter("unique_id = 'fresh'").count() == 2


def test_a_late_first_hit_replaces_the_stored_one(spark):
    state = VisitorState(spark, folder("state"), P.urls, buckets=4)
    hit = f"{REGISTER}?orgt1=abc"
    state.add(df(spark, "event_tracking", [_event(1, "v", "2024-01-05 10:00:00", hit), _event(2, None, "2024-01-05 10:00:00", hit)]), "a")
    state.add(df(spark, "event_tracking", [_event(3, "v", "2024-01-02 10:00:00", hit), _event(4, None, "2024-01-07 10:00:00", hit)]), "b")
    state.add(df(spark, "event_tracking", []), "c")
    assert {(r["unique_id"], r["first_recorded_date"]) for r in state.codes().collect()} == {
        ("v", ts("2024-01-02 10:00:00")), (None, ts("2024-01-05 10:00:00"))}


def test_creators_are_a_set(spark):
    state = VisitorState(spark, folder("state"), P.urls, buckets=4)
    for load in ("a", "b", "b"):
        state.add(df(spark, "event_tracking", [_event(1, "v", "2024-01-05 10:00:00", user_id=9) | {"event_name": "account creation"}]), load)
    assert [r["user_id"] for r in state.creators().collect()] == [9]
