"""Run one reporting job on stored domain tables and write its table.

    python -m shelfspark <job> --tables DIR --out PATH [options]

``DIR`` holds one folder per domain table (``event_tracking``, ``subscriptions``, ...; see
``schemas.DOMAIN``), read with the fixed schemas. With ``--driver-dir`` the adapter views
over the driver-generated tables are used instead. Outputs are appended in the table's
column order; the Google views and the RFI histories are stored by period, and a run replaces
the periods it covers. Only the tables a job uses are opened, and a job's dates are required.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import functions as F

from .operators import churn, google_views, groups, org_hashes, pricing, register, rfi, sessions
from .params import EXCLUDED_ORGANISATIONS, DlpRates, Period, RfiAverageParams, RfiWindow, SiteUrls
from .session import apply_job_conf, build_session
from .sources import sinks
from .sources.adapters import Tables
from .sources.org_hashes import load_org_hashes
from .sources.tables import read_domain


def _date(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def _ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


JOBS = ("session_counts", "book_dlp", "google_first_views_by_period",
        "google_first_views_by_day_geo", "b2c_churn", "user_group_info",
        "register_funnel_backfill", "register_funnel_incremental", "register_funnel_by_date",
        "rfi_monthly", "rfi_average", "org_hash_quality")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m shelfspark", description=__doc__.split("\n")[0])
    p.add_argument("job", choices=JOBS)
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--tables", help="folder with one sub-folder per domain table")
    src.add_argument("--driver-dir", help="driver-generated tables (adapter views)")
    p.add_argument("--out", required=True, help="output table folder")
    p.add_argument("--master", default=None, help="local master for a stand-alone run")
    p.add_argument("--site", default=SiteUrls().base)
    p.add_argument("--hashes", help="organisation hash file (CSV or Parquet)")
    p.add_argument("--summary", help="stored register summary (incremental, by-date)")
    p.add_argument("--start", type=_date, help="period / window start")
    p.add_argument("--end", type=_date, help="period end (exclusive)")
    p.add_argument("--label", type=_date, help="period label of google_first_views_by_period (default: start)")
    p.add_argument("--cut-off", type=_date)
    p.add_argument("--active-from", type=_date)
    p.add_argument("--as-of", type=_ts, help="moment that counts as now (default: now)")
    p.add_argument("--min-days", type=int, default=RfiWindow().min_days, help="rfi_monthly: days subscribed at the cut-off")
    p.add_argument("--subscribed-from", type=_date, default=RfiWindow().subscribed_from)
    p.add_argument("--exclude-organisations", type=lambda x: tuple(int(i) for i in x.split(",")),
                   default=EXCLUDED_ORGANISATIONS, help="register_funnel_by_date: comma-separated ids")
    p.add_argument("--null-aware", action="store_true")
    p.add_argument("--run-id", help="name of the load: a load that failed is repeated under the same name, one that is done adds nothing")
    p.add_argument("--fix-eur", action="store_true")
    return p


# Options that a job cannot run without.
REQUIRED = {"google_first_views_by_period": ("start", "end"), "google_first_views_by_day_geo": ("start", "end"),
            "register_funnel_incremental": ("summary",), "register_funnel_by_date": ("summary",),
            "rfi_monthly": ("start", "cut_off"), "rfi_average": ("cut_off", "active_from")}


def _check(args) -> None:
    missing = [f"--{o.replace('_', '-')}" for o in REQUIRED.get(args.job, ()) if getattr(args, o) is None]
    if missing:
        raise SystemExit(f"{args.job} needs {', '.join(missing)}")


def run(spark, args) -> None:
    _check(args)
    urls = SiteUrls(args.site)
    if args.driver_dir:
        t = Tables(spark, args.driver_dir, urls)

        def table(name):
            return getattr(t, name)
    else:
        def table(name):
            return read_domain(spark, name, f"{args.tables.rstrip('/')}/{name}")

    def hashes():
        return load_org_hashes(spark, args.hashes) if args.hashes else table("org_hashes")

    now = args.as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    summary = spark.read.parquet(args.summary) if args.summary else None
    j = args.job
    if j == "session_counts":
        out = sessions.session_counts(table("user_tracking_events"), table("subscriptions"))
    elif j == "book_dlp":
        out = pricing.book_dlp(table("book_meta"), DlpRates(fix_eur=args.fix_eur))
    elif j in ("google_first_views_by_period", "google_first_views_by_day_geo"):
        fn = getattr(google_views, j)
        period = Period(args.start, args.end, args.label)
        out = fn(table("event_tracking"), period)
        days = [args.start + dt.timedelta(days=i) for i in range((args.end - args.start).days)]
        covered = days if j == "google_first_views_by_day_geo" else [period.period_start]
        sinks.replace_period(out, args.out, out.columns, "reporting_period_start", covered, run_id=args.run_id)
        return
    elif j == "b2c_churn":
        out = churn.b2c_churn(table("subscriptions"), now)
    elif j == "user_group_info":
        out = groups.user_group_info(table("users"), table("groups"), table("organisations"))
    elif j == "register_funnel_backfill":
        out = register.register_funnel_backfill(table("event_tracking"), table("user_registrations"),
                                                hashes(), urls)
    elif j == "register_funnel_incremental":
        out = register.register_funnel_incremental(table("event_tracking"), table("user_registrations"),
                                                   hashes(), summary, urls, args.null_aware)
    elif j == "register_funnel_by_date":
        out = register.register_funnel_by_date(table("event_tracking"), table("user_registrations"),
                                               hashes(), summary, urls, args.exclude_organisations,
                                               args.null_aware)
    elif j == "rfi_monthly":
        out = rfi.rfi_monthly(table("subscriptions"), table("user_tracking_events"),
                              table("reading_activity_daily"), table("user_registrations"),
                              RfiWindow(start=args.start, cut_off=args.cut_off, min_days=args.min_days,
                                        subscribed_from=args.subscribed_from))
        sinks.replace_period(out, args.out, out.columns, "reporting_start_date", [args.start], run_id=args.run_id)
        return
    elif j == "rfi_average":
        out = rfi.rfi_average(table("subscriptions"), table("user_tracking_events"),
                              table("reading_activity_daily"), table("user_registrations"),
                              table("user_summary"),
                              RfiAverageParams(cut_off=args.cut_off, active_from=args.active_from,
                                               as_of=now, subscribed_from=args.subscribed_from))
        # The history date is the same for all rows of a run; the run is stored by its cut-off.
        out = out.withColumn("cut_off_date", F.lit(args.cut_off))
        sinks.replace_period(out, args.out, out.columns, "cut_off_date", [args.cut_off], run_id=args.run_id)
        return
    else:
        out = org_hashes.org_hash_quality(hashes())
    sinks.append(out, args.out, out.columns, run_id=args.run_id)


def main(argv=None) -> None:
    args = parser().parse_args(argv)
    if args.master:
        spark = build_session(args.master)
    else:
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.getOrCreate()
    apply_job_conf(spark)
    run(spark, args)


if __name__ == "__main__":
    main()
