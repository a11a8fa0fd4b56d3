"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def not_in(df: DataFrame, key: str, values: DataFrame, value_col: str,
           null_aware: bool = False, cast: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``key`` is NOT IN ``values.value_col``.

    ``null_aware=False`` (intent): NULL keys on either side are ignored and the rest is a
    plain ``left_anti`` join; a NULL key on the left is dropped as ``NOT IN`` drops it.
    ``null_aware=True`` (SQL literal): if ``values`` holds a NULL nothing survives; if
    ``values`` is empty everything survives, NULL keys included.
    """
    left_key = F.col(key).cast(cast) if cast else F.col(key)
    vals = values.select(F.col(value_col).cast(cast).alias("_v") if cast else F.col(value_col).alias("_v"))
    probe = df.withColumn("_k", left_key)
    anti = probe.join(vals.filter(F.col("_v").isNotNull()).distinct(),
                      probe["_k"] == F.col("_v"), "left_anti")
    if not null_aware:
        return anti.filter(F.col("_k").isNotNull()).drop("_k")
    n_values = vals.select(F.count(F.lit(1))).scalar()
    n_null = vals.filter(F.col("_v").isNull()).select(F.count(F.lit(1))).scalar()
    keep = (n_values == 0) | (F.col("_k").isNotNull() & (n_null == 0))
    return anti.filter(keep).drop("_k")
