"""Domain views derived from the driver-generated tables (definitions in FIXTURES.md §2).

Integer arithmetic only, so the DuckDB oracle (``shelfspark.oracle``) builds the very same
rows. Each view is a lazy projection of one driver table: Catalyst prunes the columns a job
does not use and pushes its filters into the Parquet scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import add_days, ts_lit
from ..params import SiteUrls

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _event_name(event_type: Column) -> Column:
    return (F.when(event_type.isin("view", "click"), "page view")
            .when(event_type == "signup", "account creation")
            .when(event_type == "purchase", "payment recieved")
            .otherwise("page close"))


def event_tracking(events: DataFrame, urls: SiteUrls = SiteUrls()) -> DataFrame:
    eid, uid, b = F.col("event_id"), F.col("user_id"), urls.base
    visitor = F.concat(F.lit("u"), _s(uid), F.lit("-"), _s(F.expr("dayofmonth(ts) div 3")))
    code = (F.when(uid % 4 == 0, F.concat(F.lit("orghash"), _s(uid % 40)))
            .when(uid % 4 == 1, _s(uid % 50))
            .when(uid % 4 == 2, F.lit("abc"))
            .otherwise(F.lit("unknownhash")))
    url = (F.when(eid % 7 == 0, F.concat(F.lit(urls.register_prefix), code))
           .when(eid % 7 == 1, F.lit(f"{b}/"))
           .when(eid % 14 == 2, F.lit(f"{b}/home"))
           .when(eid % 14 == 9, F.lit(f"{b}/mission"))
           .when(eid % 7 == 3, F.lit(f"{b}/pricing"))
           .when(eid % 7 == 4, F.lit(f"{b}/login"))
           .when(eid % 7 == 5, F.concat(F.lit(f"{b}/book/"), _s(eid % 40)))
           .when(eid % 14 == 6, F.lit(f"{b}/search"))
           .otherwise(F.lit(f"{b}/sign-up")))
    # At-least-once delivery: some events arrive twice.
    copies = F.when(eid % 41 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return events.withColumn("_copy", F.explode(copies)).select(
        eid.alias("event_id"),
        F.when(eid % 59 == 0, F.lit(None).cast("string"))
         .when(eid % 53 == 0, F.lit("")).otherwise(visitor).alias("unique_id"),
        F.when((uid % 3 == 0) & F.col("event_type").isin("signup", "purchase"), uid)
         .alias("user_id"),
        _event_name(F.col("event_type")).alias("event_name"),
        F.col("ts").alias("record_date"),
        url.alias("current_url"),
        F.when(eid % 3 == 0, F.lit("https://www.google.com/"))
         .when(eid % 3 == 1, F.lit("https://example.org/")).alias("referrer_url"),
        F.when(eid % 13 == 0, F.lit('{"k":'))
         .when(eid % 13 == 1, F.lit('{"other":1}'))
         .otherwise(F.concat(F.lit('{"content_ids":['), _s(eid % 40), F.lit("]}")))
         .alias("event_properties"),
        F.when(eid % 4 == 0, "GB").when(eid % 4 == 1, "US").when(eid % 4 == 2, "DE")
         .alias("geo_location"),
        F.when(eid % 6 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("agent"), _s((uid + eid) % 5))).alias("user_agent"),
        F.when(eid % 5 == 0, F.lit(None).cast("string")).when(eid % 5 == 1, "app")
         .otherwise("web").alias("environment_name"),
    )


def _earlier(ts: Column, user_id: Column) -> Column:
    """Spread activity: by user, 0 to 28 days earlier, one user in nine 100 days earlier."""
    days = F.when(user_id % 9 == 8, 100).otherwise((user_id % 9) * 4).cast("int")
    return add_days(ts, -days)


def user_tracking_events(events: DataFrame) -> DataFrame:
    uid = F.col("user_id")
    ts = _earlier(F.col("ts"), uid)
    return events.select(
        uid.alias("user_id"),
        F.when(F.col("event_id") % 31 == 0, F.lit(""))
         .otherwise(F.concat(_s(uid), F.lit("-"), _s(F.dayofmonth(ts)))).alias("session_id"),
        _event_name(F.col("event_type")).alias("event_name"),
        ts.alias("event_timestamp"),
    )


def subscriptions(orders: DataFrame) -> DataFrame:
    """Every order is a subscription; consecutive orders share a user, so a user holds two
    or three subscriptions (seven orders make three users)."""
    n = F.col("o_orderkey")
    start = F.timestamp_add("YEAR", F.lit(22), F.col("o_orderdate"))
    end = add_days(start, ((n * 37) % 2500 + 30).cast("int"))
    paid = n % 3 != 0
    return (orders
            .select(
                F.expr("(o_orderkey * 3) div 7").alias("user_id"),
                start.alias("start_timestamp"),
                end.alias("end_timestamp"),
                F.when(n % 5 == 0, add_days(start, 90)).alias("subscription_canceled_at"),
                F.when(paid, add_days(start, 14)).alias("paid_start_timestamp"),
                F.when(paid, add_days(end, -1)).alias("paid_end_timestamp"),
                F.col("o_totalprice").cast("decimal(18,2)").alias("total_paid_gbp"),
                (n % 24).cast("int").alias("paid_months"),
                F.when(F.left(F.col("o_orderpriority"), F.lit(1)).isin("1", "2", "3"), "direct")
                 .otherwise("indirect").alias("payment_channel"),
                F.when(n % 17 == 0, "trial").otherwise("subscribed").alias("subscription_type"),
            ))


def reading_activity_daily(events: DataFrame) -> DataFrame:
    return (events.filter(F.col("event_type").isin("view", "click"))
            .groupBy(F.col("user_id"), F.to_date(_earlier(F.col("ts"), F.col("user_id"))).alias("reading_date"))
            .agg(F.sum(F.floor("value").cast("long") * 30).alias("reading_duration_seconds")))


def user_registrations(customer: DataFrame) -> DataFrame:
    org = F.col("c_nationkey") + 1
    return customer.select(
        F.col("c_custkey").alias("user_id"),
        F.when(org < 13, org).cast("int").alias("organisation_id"),
        add_days(ts_lit(dt.date(2023, 12, 1)), (F.col("c_custkey") % 60).cast("int"))
         .alias("registration_time"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD"), "indirect")
         .otherwise("direct").alias("payment_channel_crude"),
    )


def user_summary(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("user_id"),
        F.when(F.col("c_custkey") % 11 == 0, "Y").otherwise("N").alias("internal_user"))


def users(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_custkey") % 9 == 0, F.lit(None)).otherwise(F.col("c_nationkey"))
         .cast("int").alias("group_id"),
        (F.col("c_custkey") % 100).cast("int").alias("organisation_id"))


def groups(nation: DataFrame) -> DataFrame:
    return nation.select(F.col("n_nationkey").cast("int").alias("id"),
                         F.col("n_name").alias("group_name"),
                         F.left(F.col("n_name"), F.lit(3)).alias("group_code"))


def organisations(supplier: DataFrame) -> DataFrame:
    return supplier.select(F.col("s_suppkey").cast("int").alias("id"),
                           F.col("s_name").alias("organisation_name"))


def book_meta(part: DataFrame) -> DataFrame:
    k, p = F.col("p_partkey"), F.col("p_retailprice")
    return part.select(k.alias("id"),
                       F.when(k % 3 == 0, p).alias("gbp_price_exvat_float"),
                       F.when(k % 3 == 1, p).alias("usd_price_exvat_float"),
                       F.when(k % 6 == 2, p).alias("eur_price_exvat_float"))


def org_hashes(supplier: DataFrame) -> DataFrame:
    """Organisation lookup: a padded plain code per organisation (needs TRIM), and one hash of a
    kind that varies: plain token, token with a code, code mangled to scientific notation, other.
    Two organisations share a token."""
    k = F.col("s_suppkey")
    token = F.concat(F.left(F.md5(_s(F.expr("s_suppkey div 2"))), F.lit(22)), F.lit("=="))
    second = (F.when(k % 4 == 0, token)
              .when(k % 4 == 1, F.concat(token, F.lit("regcode=K"), _s(k)))
              .when(k % 4 == 2, F.concat(token, F.lit("regcode=1."), _s(k), F.lit("E+10")))
              .otherwise(F.concat(F.lit("odd-"), _s(k))))
    hashes = F.array(F.concat(F.lit("  orghash"), _s(k), F.lit(" ")), second)
    return supplier.select(k.cast("int").alias("organisation_id"), F.explode(hashes).alias("hash"))


class Tables:
    """Lazily built domain views over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, urls: SiteUrls = SiteUrls()):
        self.spark, self.sf_dir, self.urls = spark, sf_dir, urls

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @property
    def event_tracking(self) -> DataFrame:
        return event_tracking(self.raw("events"), self.urls)

    @property
    def user_tracking_events(self) -> DataFrame:
        return user_tracking_events(self.raw("events"))

    @property
    def subscriptions(self) -> DataFrame:
        return subscriptions(self.raw("orders"))

    @property
    def reading_activity_daily(self) -> DataFrame:
        return reading_activity_daily(self.raw("events"))

    @property
    def user_registrations(self) -> DataFrame:
        return user_registrations(self.raw("customer"))

    @property
    def user_summary(self) -> DataFrame:
        return user_summary(self.raw("customer"))

    @property
    def users(self) -> DataFrame:
        return users(self.raw("customer"))

    @property
    def groups(self) -> DataFrame:
        return groups(self.raw("nation"))

    @property
    def organisations(self) -> DataFrame:
        return organisations(self.raw("supplier"))

    @property
    def book_meta(self) -> DataFrame:
        return book_meta(self.raw("part"))

    @property
    def org_hashes(self) -> DataFrame:
        return org_hashes(self.raw("supplier"))
