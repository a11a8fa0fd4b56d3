"""The file-triggered daily load appends the same rows as the batch incremental job, and a
run with no new files adds nothing."""

import os
import tempfile
from collections import Counter

from pyspark.sql import functions as F

from shelfspark.functions.dates import ts_lit
from shelfspark.operators.register import register_funnel_backfill, register_funnel_incremental
from shelfspark.params import FixtureParams
from shelfspark.sources.adapters import Tables
from shelfspark.streaming.daily_register import backfill, read_summary, start_daily_register
from tests.conftest import SF001
from tests.oracle_compare import norm

P = FixtureParams()


def _bag(df):
    cols = sorted(df.columns)
    return Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())


def test_daily_stream_matches_batch_increment(spark):
    root = tempfile.mkdtemp(prefix="stream-", dir=os.environ.get("TMPDIR", "/tmp"))
    t = Tables(spark, SF001)
    events = t.event_tracking
    split = F.col("record_date") < ts_lit(P.summary_split)
    events.filter(split).write.parquet(f"{root}/events/part=a")
    regs, hashes = t.user_registrations, t.org_hashes
    backfill(spark, f"{root}/events/part=a", regs, hashes, f"{root}/summary")
    before = read_summary(spark, f"{root}/summary")
    n_before = before.count()

    events.filter(~split | F.col("record_date").isNull()).write.parquet(f"{root}/events/part=b")
    q = start_daily_register(spark, f"{root}/events", regs, hashes, f"{root}/summary", f"{root}/ckpt")
    q.awaitTermination(600)
    after = read_summary(spark, f"{root}/summary")

    stored_events = spark.read.parquet(f"{root}/events").drop("part")
    expected = register_funnel_incremental(stored_events, regs, hashes,
                                           register_funnel_backfill(stored_events.filter(split), regs, hashes))
    assert after.count() == n_before + expected.count()
    new_rows = read_summary(spark, f"{root}/summary").exceptAll(before)
    assert _bag(new_rows) == _bag(expected)

    # no new files: the stream finds nothing and the summary stays as it is
    q2 = start_daily_register(spark, f"{root}/events", regs, hashes, f"{root}/summary", f"{root}/ckpt")
    q2.awaitTermination(600)
    assert read_summary(spark, f"{root}/summary").count() == after.count()
