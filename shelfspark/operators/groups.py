"""J6 user_group_info: users in a group, with group and organisation names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def user_group_info(users: DataFrame, groups: DataFrame, organisations: DataFrame) -> DataFrame:
    """Users with ``group_id > 0``, left-joined to groups and organisations.

    The filter is applied to users before the joins (pushed into the scan); the two
    lookups carry no hint: Spark broadcasts them when their stored size is below its threshold. Duplicate lookup ids multiply rows, as the SQL join does.
    """
    u = users.filter(F.col("group_id").isNotNull() & (F.col("group_id") > 0))
    g = groups.select(F.col("id").alias("_gid"), "group_name", "group_code")
    o = organisations.select(F.col("id").alias("_oid"), "organisation_name")
    return (u.join(g, u["group_id"] == g["_gid"], "left")
            .join(o, u["organisation_id"] == o["_oid"], "left")
            .select(F.col("id").alias("user_id"), "group_id", "group_name", "group_code",
                    "organisation_name"))
