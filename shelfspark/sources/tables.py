"""Readers for the domain tables stored as files (Parquet by default), with the fixed
schemas of ``shelfspark.schemas`` instead of inference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import DOMAIN


def read_domain(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Read domain table ``name`` (e.g. ``event_tracking``) from ``path``.

    The schema is fixed, so a missing column reads as NULL and a type drift fails the read
    instead of silently changing the jobs' semantics. Partitioned folders (for example by
    event date) are pruned by the jobs' date predicates.
    """
    return spark.read.schema(DOMAIN[name]).format(fmt).load(path)
