"""The run-time filter of the semi joins: never drops a key, drops most others, sits before the shuffle."""

import pytest
from pyspark.sql import functions as F

from shelfspark.functions.membership import may_hold
from shelfspark.plans import catalog
from shelfspark.plans.inspect import plan_text

from .conftest import SF001


def test_filter_keeps_every_key(spark):
    keys = spark.createDataFrame([(3 * i,) for i in range(1000)] + [(3,), (None,)], "user_id long")
    rows = spark.createDataFrame([(i,) for i in range(3000)] + [(-1,), (None,)], "user_id long")
    want = {r[0] for r in keys.collect()}
    for bits, most in ((64, 3002), (1 << 12, 1700), (1 << 20, 1010)):
        got = [r[0] for r in rows.filter(may_hold(keys, "user_id", bits)).collect()]
        assert want <= set(got) and len(got) <= most
    assert rows.filter(may_hold(keys.limit(0), "user_id")).count() == 0
    assert rows.limit(0).filter(may_hold(keys, "user_id")).count() == 0
    for bits in (0, 32, 100):
        with pytest.raises(ValueError):
            may_hold(keys, "user_id", bits)


def test_filter_of_text_keys(spark):
    keys = spark.createDataFrame([("a",), ("",)], "k string")
    rows = spark.createDataFrame([("a", 1), ("", 2), (None, 3)] + [(f"x{i}", i) for i in range(500)], "k string, _word int")
    got = {r["k"] for r in rows.filter(may_hold(keys, "k")).collect()}
    assert {"a", ""} <= got and len(got) < 10


@pytest.mark.parametrize("name", ["rfi_last_active", "rfi_reading_days"])
def test_filter_sits_in_the_scan(spark, name):
    """Every scan of activity is filtered below its first exchange."""
    lines = plan_text(catalog.build(spark, SF001, name), "simple").splitlines()
    filters = [i for i, x in enumerate(lines) if "Filter" in x and "getbit" in x]
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    first = filters[0]
    below = [x for x, d in zip(lines[first + 1:], depth[first + 1:]) if d > depth[first]]
    assert filters and any("Exchange" in x for x in lines[:first])
    main = [x for x in below if "Subquery" not in x]
    assert main and any("FileScan" in x for x in below)


def test_fewer_rows_are_shuffled(spark):
    events = spark.range(100_000).select((F.col("id") % 10_000).alias("user_id"), F.col("id").alias("n"))
    for share in (100, 10):
        subscribers = spark.range(0, 10_000, share).select(F.col("id").alias("user_id"))
        passed = events.filter(may_hold(subscribers, "user_id")).count()
        assert 100_000 // share <= passed <= 100_000 // share + 2_000
