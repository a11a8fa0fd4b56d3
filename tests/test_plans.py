"""Plan checks: no cartesian/nested-loop joins or unpartitioned windows, predicates and
column pruning reach the Parquet scan."""

import pytest

import __spark_entry__ as E
from shelfspark.plans import catalog
from shelfspark.plans.inspect import (cartesian_products, plan_text, pushed_filters,
                                      read_schemas, unpartitioned_windows)
from tests.conftest import SF001

# Queries with stored intermediate tables build those eagerly; their final plans are
# checked here (the stored stages are checked by the fixture tests).
NAMES = sorted(catalog.CATALOG)


@pytest.mark.parametrize("name", NAMES)
def test_no_cartesian_or_global_window(spark, name):
    text = plan_text(E.queries()[name](spark, SF001))
    assert cartesian_products(text) == []
    assert unpartitioned_windows(text) == []
    assert " Window " not in text and "Window (" not in text   # no job needs a window


def test_google_views_push_down_and_prune(spark):
    text = plan_text(E.queries()["google_page_views"](spark, SF001))
    filters = " ".join(pushed_filters(text))
    assert "GreaterThanOrEqual(ts" in filters and "LessThan(ts" in filters
    schemas = read_schemas(text)
    assert schemas and all("props" not in s or "event_type" in s for s in schemas)
    assert all("value" not in s for s in schemas)          # unused column never read


def test_session_counts_reads_only_needed_columns(spark):
    text = plan_text(E.queries()["session_counts"](spark, SF001))
    assert any(s == "struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" for s in read_schemas(text))


def test_stored_stages_have_no_cartesian_or_window(spark, monkeypatch):
    """The stored intermediate tables (materialize) are checked the same way."""
    import shelfspark.operators.register as register
    import shelfspark.operators.rfi as rfi
    import shelfspark.plans.catalog as catalog
    from shelfspark.session import materialize as store
    texts = []

    def checked(df, name="stage"):
        texts.append(plan_text(df))
        return store(df, name)

    for module in (register, rfi, catalog):
        monkeypatch.setattr(module, "materialize", checked)
    monkeypatch.setattr(catalog, "_SUMMARIES", {})
    for name in ("register_funnel_incremental", "register_funnel_by_date", "rfi_average"):
        E.queries()[name](spark, SF001)
    assert len(texts) >= 8
    for text in texts:
        assert "BROADCAST" not in text                     # no forced broadcast hint
        assert cartesian_products(text) == []
        assert " Window " not in text and "Window (" not in text


def _scans(text: str, table: str) -> int:
    return sum(1 for line in text.splitlines() if line.startswith("Location:") and f"/{table}.parquet" in line)


@pytest.mark.parametrize("name", ["register_funnel_backfill", "register_funnel_incremental",
                                  "register_funnel_by_date", "register_first_identified",
                                  "register_pre_post_flags"])
def test_funnel_scans_the_events_at_most_twice(spark, monkeypatch, name):
    import shelfspark.operators.register as register
    from shelfspark.session import materialize as store
    catalog.prior_summary(spark, SF001)                    # a stored table before a daily run
    texts = []

    def checked(df, label="stage"):
        texts.append(plan_text(df))
        return store(df, label)

    monkeypatch.setattr(register, "materialize", checked)
    monkeypatch.setattr(catalog, "materialize", checked)
    texts.append(plan_text(E.queries()[name](spark, SF001)))
    assert 1 <= sum(_scans(t, "events") for t in texts) <= 2
    assert any("StringStartsWith" in t or "startswith" in t.lower() for t in texts)


def test_stored_domain_tables_get_the_filters(spark, tmp_path, monkeypatch):
    """On stored domain tables the jobs' predicates and columns reach the Parquet scan."""
    import shelfspark.operators.register as register
    import shelfspark.operators.rfi as rfi
    from shelfspark.operators.google_views import google_page_views
    from shelfspark.params import FixtureParams
    from shelfspark.session import materialize as store
    from shelfspark.sources.adapters import Tables
    from shelfspark.sources.tables import read_domain
    t, p = Tables(spark, SF001), FixtureParams()
    tables = {}
    for name in ("event_tracking", "user_tracking_events", "subscriptions", "reading_activity_daily",
                 "user_registrations", "user_summary"):
        getattr(t, name).write.parquet(f"{tmp_path}/{name}")
        tables[name] = read_domain(spark, name, f"{tmp_path}/{name}")
    views = plan_text(google_page_views(tables["event_tracking"], p.period()))
    filters = " ".join(pushed_filters(views))
    assert "GreaterThanOrEqual(record_date" in filters and "LessThan(record_date" in filters
    assert all("user_agent" not in s for s in read_schemas(views))
    texts = []

    def checked(df, label="stage"):
        texts.append(plan_text(df))
        return store(df, label)

    for module in (register, rfi):
        monkeypatch.setattr(module, "materialize", checked)
    register.event_marks(tables["event_tracking"], p.urls)
    assert "StringStartsWith(current_url" in " ".join(pushed_filters(texts[-1]))
    assert all("environment_name" not in s for s in read_schemas(texts[-1]))
    rfi.rfi_average(tables["subscriptions"], tables["user_tracking_events"], tables["reading_activity_daily"],
                    tables["user_registrations"], tables["user_summary"], p.rfi_average())
    scans = [line for text in texts for line in text.splitlines()
             if line.startswith("PushedFilters") and "event_timestamp" in line]
    assert scans and all("LessThan(event_timestamp,2024-02-01" in line for line in scans)
