"""Counters that a running job fills on the way (``DataFrame.observe``), without a second pass."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Counters:
    """Counters of one run of a job. ``values`` waits for the job's first action and returns them."""

    def __init__(self) -> None:
        self._observed: list[Observation] = []

    def on(self, df: DataFrame, **counted: Column) -> DataFrame:
        """``df``, counting the rows that pass here for which each condition holds."""
        seen = Observation(f"counters-{uuid.uuid4().hex}")
        self._observed.append(seen)
        return df.observe(seen, *[F.count(F.when(c, F.lit(1))).alias(name) for name, c in counted.items()])

    def values(self) -> dict[str, int]:
        return {k: v for seen in self._observed for k, v in seen.get.items()}


def counted(counters: Counters | None, df: DataFrame, **conditions: Column) -> DataFrame:
    """``df`` with counters, or as it is where none are asked for."""
    return df if counters is None else counters.on(df, **conditions)
