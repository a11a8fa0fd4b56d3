"""J12 report: quality of the organisation hash lookup used by the register funnels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed patterns: a lookup hash is a 22-character base64 token followed by "==", either
# alone or with "regcode=<code>"; codes turned into scientific notation by a spreadsheet
# ("regcode=8.12E+37") are "mangled"; anything else is "other".
TOKEN = r"[A-Za-z0-9+/]{22}"
PLAIN = rf"^{TOKEN}==$"
REGCODE = rf"^{TOKEN}==regcode=[A-Za-z0-9]+$"
MANGLED = r"regcode=[0-9]+(\.[0-9]+)?E\+[0-9]+$"
TOKEN_PREFIX = rf"^({TOKEN})"


def classify(hash_col) -> F.Column:
    return (F.when(hash_col.rlike(MANGLED), "mangled")
            .when(hash_col.rlike(PLAIN), "plain")
            .when(hash_col.rlike(REGCODE), "regcode")
            .otherwise("other"))


def org_hash_quality(hashes: DataFrame) -> DataFrame:
    """Per organisation_id: hash count, distinct hashes, counts per format (a plain hash
    listed more than once is a duplicate id), hashes duplicated across rows, and the
    number of its tokens that also belong to another organisation (conflicting ids)."""
    h = hashes.select("organisation_id", F.trim("hash").alias("hash"))
    h = h.select("*", classify(F.col("hash")).alias("kind"),
                 F.regexp_extract("hash", TOKEN_PREFIX, 1).alias("token"))
    shared = (h.filter(F.col("token") != "")
              .groupBy("token").agg(F.count_distinct("organisation_id").alias("_n_orgs"))
              .filter(F.col("_n_orgs") > 1).select("token"))
    # Rows without a token would meet in one join key: their own hash, which is no token, spreads them.
    marked = (h.withColumn("_key", F.when(F.col("token") != "", F.col("token")).otherwise(F.col("hash")))
              .join(shared.select(F.col("token").alias("_key"), F.lit(True).alias("_shared")), "_key", "left"))
    kind = F.col("kind")
    return marked.groupBy("organisation_id").agg(
        F.count(F.lit(1)).alias("n_hashes"),
        F.count_distinct("hash").alias("n_distinct_hashes"),
        F.count(F.when(kind == "plain", 1)).alias("n_plain"),
        F.count(F.when(kind == "regcode", 1)).alias("n_regcode"),
        F.count(F.when(kind == "mangled", 1)).alias("n_mangled"),
        F.count(F.when(kind == "other", 1)).alias("n_other"),
        F.count_distinct(F.when(F.col("_shared"), F.col("token"))).alias("n_shared_tokens"))
