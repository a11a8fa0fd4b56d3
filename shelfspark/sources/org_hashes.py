"""J12 source: the organisation hash lookup, loaded from a file with a fixed schema
(the reference inlines ~3,100 literal tuples; the data belongs in a file)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import ORG_HASHES


def load_org_hashes(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Read ``organisation_id, hash`` from CSV (with header) or Parquet.

    Hashes are kept as written (spaces included): the funnels decide whether to TRIM.
    Malformed CSV rows fail the read rather than turning into NULL ids.
    """
    fmt = fmt or ("parquet" if path.rstrip("/").endswith(".parquet") else "csv")
    reader = spark.read.schema(ORG_HASHES)
    if fmt == "csv":
        return reader.option("header", True).option("mode", "FAILFAST").csv(path)
    return reader.parquet(path)
