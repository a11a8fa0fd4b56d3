"""Invariants of SURVEY §5 on the driver tables (sf0.01)."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from shelfspark.functions.dates import ts_lit
from shelfspark.operators import register as funnel
from shelfspark.params import FixtureParams
from shelfspark.sources import sinks
from shelfspark.sources.adapters import Tables
from tests.conftest import SF001, SF01

P = FixtureParams()


def test_scores_are_sums_of_parts(spark):
    for name in ("rfi_monthly", "rfi_average"):
        out = E.queries()[name](spark, SF01)
        bad = out.filter(F.col("combined_score").isNotNull()
                         & ~F.col("combined_score").between(3, 12)).count()
        assert bad == 0
        cohorts = {r[0] for r in out.select("combined_cohort").distinct().collect()}
        assert all(c is None or (len(c) == 3 and set(c) <= set("ABCD")) for c in cohorts)


def test_incremental_equals_full_for_new_visitors(spark):
    """J8 over all events exports the same visitors as J7 over all events, among visitors
    whose first register hit is at or after the split."""
    t = Tables(spark, SF01)
    ev = t.event_tracking
    full = funnel.register_funnel_backfill(ev, t.user_registrations, t.org_hashes)
    incr = E.queries()["register_funnel_incremental"](spark, SF01)
    late = (funnel.register_codes(ev, P.urls).groupBy("unique_id")
            .agg(F.min("first_recorded_date").alias("d"))
            .filter(F.col("d") >= ts_lit(P.summary_split)).select("unique_id"))

    def ids(df):
        return {r[0] for r in df.join(late, "unique_id", "left_semi").select("unique_id").distinct().collect()}

    assert ids(incr) == ids(full)
    assert len(ids(full)) > 0


def test_daily_rerun_adds_no_visitor(spark):
    """J8 on its own appended result adds no register visitor (Q25 aside: none here)."""
    t = Tables(spark, SF01)
    ev, regs, hashes = t.event_tracking, t.user_registrations, t.org_hashes
    root = tempfile.mkdtemp(prefix="rerun-", dir=os.environ.get("TMPDIR", "/tmp"))
    before = ev.filter(F.col("record_date") < ts_lit(P.summary_split))
    cols = E.queries()["register_funnel_backfill"](spark, SF01).columns
    sinks.append(funnel.register_funnel_backfill(before, regs, hashes), f"{root}/s", cols)
    summary = spark.read.parquet(f"{root}/s")
    sinks.append(funnel.register_funnel_incremental(ev, regs, hashes, summary), f"{root}/s", cols)
    again = funnel.register_funnel_incremental(ev, regs, hashes, spark.read.parquet(f"{root}/s"))
    assert again.filter(F.col("unique_id").isNotNull()).count() == 0


def test_period_overwrite_is_idempotent(spark):
    root = tempfile.mkdtemp(prefix="sink-", dir=os.environ.get("TMPDIR", "/tmp"))
    out = E.queries()["google_first_views_by_day_geo"](spark, SF01)
    cols = out.columns
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(30)]
    sinks.replace_period(out, f"{root}/v", cols, "reporting_period_start", days)
    n = spark.read.parquet(f"{root}/v").count()
    sinks.replace_period(out, f"{root}/v", cols, "reporting_period_start", days)
    assert spark.read.parquet(f"{root}/v").count() == n == out.count()


def test_period_without_rows_loses_its_old_rows(spark):
    root = tempfile.mkdtemp(prefix="sink-", dir=os.environ.get("TMPDIR", "/tmp"))
    rows = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-09")], "n int, day string")
    sinks.replace_period(rows, f"{root}/v", ["n", "day"], "day", ["2024-01-01", "2024-01-02", "2024-01-09"])
    sinks.replace_period(rows.filter("n = 1"), f"{root}/v", ["n", "day"], "day", ["2024-01-01", "2024-01-02"])
    assert sorted(r["n"] for r in spark.read.parquet(f"{root}/v").collect()) == [1, 3]


def test_book_views_table_schema_growth(spark):
    """The by-period output (3 columns) and the by-day output (one more, geo_location) go
    to the same reporting table; reads merge the schemas."""
    root = tempfile.mkdtemp(prefix="growth-", dir=os.environ.get("TMPDIR", "/tmp"))
    v2 = E.queries()["google_first_views_by_period"](spark, SF01)
    v4 = E.queries()["google_first_views_by_day_geo"](spark, SF01)
    sinks.append(v2, f"{root}/book_views", v2.columns)
    sinks.append(v4, f"{root}/book_views", v4.columns)
    merged = sinks.read_table(spark, f"{root}/book_views")
    assert sorted(merged.columns) == sorted(v4.columns)
    assert merged.count() == v2.count() + v4.count()
    assert merged.filter(F.col("geo_location").isNull()).count() >= v2.count()


def test_cli_runs_a_job(spark):
    from shelfspark.__main__ import parser, run
    root = tempfile.mkdtemp(prefix="cli-", dir=os.environ.get("TMPDIR", "/tmp"))
    args = parser().parse_args(["b2c_churn", "--driver-dir", SF01, "--out", f"{root}/churn",
                                "--as-of", "2024-02-15T00:00:00"])
    run(spark, args)
    assert spark.read.parquet(f"{root}/churn").count() == E.queries()["b2c_churn"](spark, SF01).count()
    args = parser().parse_args(["google_first_views_by_day_geo", "--driver-dir", SF01, "--out",
                                f"{root}/views", "--start", "2024-01-01", "--end", "2024-01-31"])
    run(spark, args)
    run(spark, args)    # the period is replaced, not duplicated
    assert spark.read.parquet(f"{root}/views").count() == \
        E.queries()["google_first_views_by_day_geo"](spark, SF01).count()


def test_cli_rfi_rerun_and_missing_options(spark):
    from shelfspark.__main__ import parser, run
    root = tempfile.mkdtemp(prefix="cli-", dir=os.environ.get("TMPDIR", "/tmp"))
    args = parser().parse_args(["rfi_monthly", "--driver-dir", SF001, "--out", f"{root}/rfi",
                                "--start", "2024-01-01", "--cut-off", "2024-01-31"])
    run(spark, args)
    run(spark, args)    # replaced, not doubled
    assert spark.read.parquet(f"{root}/rfi").count() == 514
    with pytest.raises(SystemExit, match="--cut-off"):
        run(spark, parser().parse_args(["rfi_average", "--driver-dir", SF001, "--out", f"{root}/a",
                                        "--active-from", "2024-01-01"]))


def test_cli_opens_only_the_tables_of_the_job(spark):
    from shelfspark.__main__ import parser, run
    from shelfspark.sources.adapters import Tables
    root = tempfile.mkdtemp(prefix="cli-", dir=os.environ.get("TMPDIR", "/tmp"))
    t = Tables(spark, SF001)
    t.user_tracking_events.write.parquet(f"{root}/tables/user_tracking_events")
    t.subscriptions.write.parquet(f"{root}/tables/subscriptions")
    run(spark, parser().parse_args(["session_counts", "--tables", f"{root}/tables", "--out", f"{root}/out"]))
    assert spark.read.parquet(f"{root}/out").count() == 15


def test_checkpoint_folder_is_required_off_local(spark, monkeypatch):
    from shelfspark import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
