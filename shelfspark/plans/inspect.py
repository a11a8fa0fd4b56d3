"""Physical-plan checks used by the tests and by anyone tuning a job.

They read ``DataFrame.explain``-style text of the executed plan, so they work on any
session, local or cluster.
"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """Text of ``df.explain(mode)`` (captured, not printed)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def unpartitioned_windows(text: str) -> list[str]:
    """Window operators without PARTITION BY (they would run in a single task)."""
    return [line for line in text.splitlines()
            if re.search(r"\bWindow\b", line) and "partitionBy" not in line
            and re.search(r"Window \[.*\], \[\]", line)]


def cartesian_products(text: str) -> list[str]:
    """Cartesian products and nested-loop joins (none of the jobs needs one)."""
    return [line for line in text.splitlines()
            if "CartesianProduct" in line or "BroadcastNestedLoopJoin" in line]


def pushed_filters(text: str) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\]]*)\]", text)


def read_schemas(text: str) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^>]*>)", text)
