import __spark_entry__ as E


def test_entry_smoke(spark):
    out = E.entry(spark)
    assert out.columns == ["user_id", "session_count"]
    assert out.count() > 0


def test_fixture_counts_at_sf0001(spark):
    """Row counts stated for the adapter views (FIXTURES.md §2)."""
    q = E.queries()
    sf = "/root/testdata/sf0.001"
    assert q["session_counts"](spark, sf).count() == 15
    assert q["b2c_churn"](spark, sf).count() == 365
    assert q["user_group_info"](spark, sf).count() == 129
    assert q["google_page_views"](spark, sf).count() == 12
