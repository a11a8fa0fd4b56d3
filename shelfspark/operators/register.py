"""J7 / J8 / J9: visitor funnel around the organisation register page.

J7 ``register_funnel_backfill`` builds the summary over the full history, J8
``register_funnel_incremental`` the rows to append for visitors not yet in the summary
(from its high-water mark on), J9 ``register_funnel_by_date`` the earlier variant that
splits events by time and excludes some organisations.

Scale design. The event table is scanned twice, whatever the job: once for the register
hits and account creations (``event_marks``), once for all events of the visitors found there
(``visitor_events``); both results are narrow and stored, and everything else reads them. No
stage numbers a visitor's events with a window, which would put one visitor's events into one
task (the ``''`` cookie can hold a large share of them). Every per-visitor quantity is an
aggregate: minima of ordered structs, and row numbers as conditional counts, of which only a
bounded set is needed per visitor (``funnel_flags``). An event that was delivered twice is two
events of equal order, as in a numbered list. Joins carry no hints: the stored tables have real
sizes, so Spark broadcasts the small ones and splits skewed partitions of the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.counters import Counters, counted
from ..functions.joins import not_in
from ..functions.urls import code_as_org_id, is_register_page, org_code, position_find
from ..params import EXCLUDED_ORGANISATIONS, SiteUrls
from ..schemas import REGISTER_SUMMARY_COLUMNS
from ..session import materialize

PAGES = ("homepage", "search", "pricing", "login", "signup", "mission")
FLAG_COLUMNS = [f"{p}_pre" for p in PAGES] + [f"{p}_post" for p in PAGES]

# Output texts of the user status (fixed values).
STATUS_ACCOUNT = "Register Page - Account"
STATUS_B2B = "Register Page - B2B Signup"
STATUS_NO_SIGNUP = "Register Page - No Signup"
STATUS_B2C = "Register Page - B2C Transfered To B2B"
ACCOUNT_CREATION = "account creation"

def _order_key() -> Column:
    """Event order within a visitor: record_date ascending with NULLs last, then event_id."""
    d = F.col("record_date")
    return F.struct(d.isNull().alias("n"), d.alias("d"), F.col("event_id").alias("e"))


def _first(order: Column, **values: Column) -> Column:
    return F.min(F.struct(order.alias("o"), *[v.alias(k) for k, v in values.items()]))


# --- the two scans of the event table ------------------------------------------------------
def event_marks(events: DataFrame, urls: SiteUrls) -> DataFrame:
    """Register hits and identified account creations, stored (first scan)."""
    creation = (F.col("event_name") == ACCOUNT_CREATION) & F.col("user_id").isNotNull()
    return materialize(events.filter(F.col("current_url").startswith(urls.register_prefix) | creation)
                       .select("unique_id", "record_date", "current_url", "user_id", "event_name"), "marks")


def visitor_events(events: DataFrame, visitors: DataFrame) -> DataFrame:
    """All events of the given (non-NULL) visitors, stored (second scan)."""
    return materialize(events.select(
        "unique_id", "event_id", "record_date", "user_id", "event_name", "current_url", "user_agent",
        "environment_name").join(_visitor_ids(visitors), "unique_id", "left_semi"), "visitor-events")


def _visitor_ids(visitors: DataFrame) -> DataFrame:
    return visitors.select("unique_id").filter(F.col("unique_id").isNotNull()).distinct()


# --- shared stages ----------------------------------------------------------------------
def register_codes(events: DataFrame, urls: SiteUrls) -> DataFrame:
    """Group_Register: first hit per visitor x organisation code on the register URL."""
    url = F.col("current_url")
    return (events.filter(url.startswith(urls.register_prefix))
            .groupBy("unique_id", position_find(url).alias("position_find"),
                     org_code(url).alias("organisation_code"))
            .agg(F.min("record_date").alias("first_recorded_date"))
            .select("unique_id", "position_find", "first_recorded_date", "organisation_code"))


def first_code_per_visitor(codes: DataFrame) -> DataFrame:
    """Mark_first_record + rank 1: the code first seen (NULL dates last, ties by code)."""
    d = F.col("first_recorded_date")
    best = F.min(F.struct(d.isNull().alias("n"), d.alias("d"),
                          F.col("organisation_code").alias("c"), F.col("position_find").alias("p")))
    return (codes.groupBy("unique_id").agg(best.alias("_b"))
            .select("unique_id", F.col("_b.p").alias("position_find"),
                    F.col("_b.d").alias("first_recorded_date"),
                    F.col("_b.c").alias("organisation_code"),
                    F.lit(1).alias("unique_id_row_number")))


def with_organisation(codes: DataFrame, hashes: DataFrame, trim_hash: bool = True) -> DataFrame:
    """Combined_Table: code -> organisation id by hash; else a short numeric code is the id."""
    h = hashes.select((F.trim("hash") if trim_hash else F.col("hash")).alias("_hash"),
                      F.col("organisation_id").alias("_hash_org"))
    joined = codes.join(h, codes["organisation_code"] == F.col("_hash"), "left")
    calc = F.coalesce(F.col("_hash_org"), code_as_org_id(F.col("organisation_code")))
    return joined.withColumn("calculated_organisationid", calc).drop("_hash", "_hash_org")


def first_identified(events: DataFrame, visitors: DataFrame, since: Column | None = None,
                     with_agent: bool = True) -> DataFrame:
    """First_User_Actions(_grouped): event name (and agent) of each visitor's first event
    carrying a user id. Partial aggregation comes before the shuffle by visitor."""
    ev = events.filter(F.col("user_id").isNotNull() & F.col("unique_id").isNotNull())
    if since is not None:
        ev = ev.filter(F.col("record_date") >= since)
    vals = {"event": F.col("event_name")}
    if with_agent:
        vals["agent"] = F.col("user_agent")
    out = (ev.join(_visitor_ids(visitors), "unique_id", "left_semi")
           .groupBy("unique_id").agg(_first(_order_key(), **vals).alias("_f")))
    cols = [F.col("_f.event").alias("first_user_event")]
    if with_agent:
        cols.append(F.col("_f.agent").alias("first_user_agent"))
    return out.select("unique_id", *cols)


def page_flags(urls: SiteUrls) -> dict[str, Column]:
    url = F.col("current_url")
    return {p: url.isin(*targets).cast("int") for p, targets in urls.pages().items()}


# Event classes by whether the event has an agent / an environment: the funnel groups by
# (first agent if the event has one, first environment if it has one), so a visitor has at
# most four groups, fixed by these two flags and the visitor's first agent/environment.
_CLASSES = [(a, e) for a in (True, False) for e in (True, False)]


def funnel_flags(events: DataFrame, visitors: DataFrame, urls: SiteUrls) -> DataFrame:
    """Case_Statements_List for visitors without an identified event.

    Let the visitor's events be listed by order key and F be the first register-page event,
    with key T. Events before F in the list are "pre", events behind it "post", and F with the
    post events is "from". Only one event at T is F: further events at T (a hit delivered
    twice, or another event of the same time and id) are post events. Per class (see
    ``_CLASSES``) the flags, the last place of the pre and of the post events, and the number
    and first place of the from events follow from three aggregations over the stored events:

    1. the first event's agent and environment, T and the class of F;
    2. per class and side of T: number, extreme keys and page flags;
    3. places: how many events have a key below (or at) each of at most 12 extreme keys.

    Classes then merge into the groups (two classes share a group when the visitor's first
    agent or environment is NULL). Pre and post rows join the from rows on the visitor only,
    so groups multiply as in the reference.
    """
    flags = page_flags(urls)
    ev = (events.join(_visitor_ids(visitors), "unique_id", "left_semi")
          .select("unique_id", _order_key().alias("k"), "user_agent", "environment_name",
                  F.when(F.col("user_agent").isNotNull(), F.when(F.col("environment_name").isNotNull(), 0).otherwise(1))
                  .otherwise(F.when(F.col("environment_name").isNotNull(), 2).otherwise(3)).alias("cls"),
                  is_register_page(F.col("current_url")).alias("register"),
                  *[f.alias(p) for p, f in flags.items()]))
    k = F.col("k")
    heads = materialize(
        ev.groupBy("unique_id")
        .agg(F.min(F.struct("k", F.col("user_agent").alias("a"), F.col("environment_name").alias("e"))).alias("f"),
             F.min(F.when(F.col("register"), F.struct("k", "cls"))).alias("t"))
        .filter(F.col("t").isNotNull())
        .select("unique_id", F.col("f.a").alias("a0"), F.col("f.e").alias("e0"),
                F.col("t.k").alias("t"), F.col("t.cls").alias("t_cls")), "funnel-heads")
    side = F.when(k < F.col("t"), 0).when(k == F.col("t"), 1).otherwise(2)
    sides = (ev.join(heads, "unique_id").withColumn("side", side)
             .groupBy("unique_id", "cls", "side")
             .agg(F.min("k").alias("k_min"), F.max("k").alias("k_max"), F.count(F.lit(1)).alias("n"),
                  *[F.max(p).alias(p) for p in flags]))
    # One row per visitor and class (at most 3 sides each).
    at = {name: (lambda v, i=i: F.max(F.when(F.col("side") == i, v))) for i, name in enumerate(("pre", "at", "post"))}
    classes = (sides.groupBy("unique_id", "cls")
               .agg(at["pre"](F.col("k_max")).alias("pre_last"), at["post"](F.col("k_max")).alias("post_last"),
                    at["post"](F.col("k_min")).alias("post_first"),
                    *[F.coalesce(at[x](F.col("n")), F.lit(0)).alias(f"n_{x}") for x in at],
                    *[at["pre"](F.col(p)).alias(f"{p}_pre") for p in flags],
                    *[F.max(F.when(F.col("side") >= 1, F.col(p))).alias(f"{p}_from") for p in flags])
               .join(heads, "unique_id"))
    is_f = F.col("cls") == F.col("t_cls")
    more_at = (F.col("n_at") - F.when(is_f, 1).otherwise(0)) > 0
    classes = materialize(classes.select(
        "unique_id", "a0", "e0", "cls", "pre_last",
        F.coalesce("post_last", F.when(more_at, F.col("t"))).alias("post_last"),
        F.when(F.col("n_at") > 0, F.col("t")).otherwise(F.col("post_first")).alias("from_first"),
        # An event at T of another class than F stands behind F.
        F.when((F.col("n_at") > 0) & ~is_f, 1).otherwise(0).alias("behind"),
        (F.col("n_at") + F.col("n_post")).alias("actions"),
        *[f"{p}_pre" for p in flags],
        *[F.when((F.col("n_post") > 0) | more_at, F.col(f"{p}_from")).alias(f"{p}_post") for p in flags]),
        "funnel-classes")
    # Places: counts over the visitor's events against the classes' extreme keys.
    names = ("pre_last", "post_last", "from_first")
    wide = classes.groupBy("unique_id").agg(*[
        F.max(F.when(F.col("cls") == c, F.col(n))).alias(f"{n}{c}") for n in names for c in range(len(_CLASSES))])

    def place(n: str, c: int) -> Column:
        key = F.col(f"{n}{c}")
        return F.count(F.when(k < key if n == "from_first" else k <= key, F.lit(1))).alias(f"{n}{c}_place")

    places = (ev.select("unique_id", "k").join(wide, "unique_id").groupBy("unique_id")
              .agg(*[place(n, c) for n in names for c in range(len(_CLASSES))]))

    def placed(n: str) -> Column:
        value = F.lit(None).cast("long")
        for c in range(len(_CLASSES)):
            value = F.when(F.col("cls") == c, F.col(f"{n}{c}_place")).otherwise(value)
        return F.when(F.col(n).isNotNull(), value)

    groups = (classes.join(places, "unique_id")
              .select("unique_id", F.when(F.col("cls") < 2, F.col("a0")).alias("visit_agent"),
                      F.when(F.col("cls") % 2 == 0, F.col("e0")).alias("visit_environment"), "actions",
                      placed("pre_last").cast("int").alias("pre_place"),
                      placed("post_last").cast("int").alias("post_place"),
                      (placed("from_first") + 1 + F.col("behind")).cast("int").alias("from_place"), *FLAG_COLUMNS)
              .groupBy("unique_id", "visit_agent", "visit_environment")
              .agg(F.sum("actions").alias("actions"), F.max("pre_place").alias("events_pre_register"),
                   F.max("post_place").alias("events_post_register"), F.min("from_place").alias("from_place"),
                   *[F.max(c).alias(c) for c in FLAG_COLUMNS]))
    g = materialize(groups, "funnel-groups")
    pre = (g.filter(F.col("events_pre_register").isNotNull())
           .select("unique_id", "events_pre_register", *[f"{p}_pre" for p in PAGES]))
    post = (g.filter(F.col("events_post_register").isNotNull())
            .select("unique_id", "events_post_register", *[f"{p}_post" for p in PAGES]))
    actions, first_place = F.col("actions"), F.col("from_place")
    return (g.filter(actions > 0)
            .select("unique_id", "visit_agent", "visit_environment", "actions", "from_place")
            .join(pre, "unique_id", "left").join(post, "unique_id", "left")
            .select("unique_id", "visit_agent", "visit_environment",
                    *FLAG_COLUMNS, "events_pre_register", "events_post_register",
                    F.when(actions == 1, 1).otherwise(0).alias("left_at_once"),
                    F.when(actions > 1, 1).otherwise(0).alias("clicked_around"),
                    F.when(first_place == 1, 1).otherwise(0).alias("register_first"),
                    F.when(first_place > 1, 1).otherwise(0).alias("other_first")))


def b2c_transfers(registrations: DataFrame, events: DataFrame,
                  summary: DataFrame | None = None, null_aware: bool = False) -> DataFrame:
    """B2c_Sign_Up_First: users now on the indirect channel who created an account on the
    site (optionally not yet reported in ``summary``): calculated_organisationid, user_id."""
    creators = (events.filter(F.col("event_name") == ACCOUNT_CREATION)
                .select("user_id").filter(F.col("user_id").isNotNull()).distinct())
    regs = (registrations.filter(F.col("payment_channel_crude") == "indirect")
            .join(creators, "user_id", "left_semi"))
    if summary is not None:
        regs = not_in(regs, "user_id", summary, "main_reporting_id", null_aware, cast="string")
    return regs.select(F.col("organisation_id").alias("calculated_organisationid"), "user_id")


# Columns of the register branch of the UNION, positional order of the reference.
_MAIN_COLUMNS = ["unique_id", "position_find", "first_recorded_date", "organisation_code",
                 "unique_id_row_number", "calculated_organisationid", "first_user_event",
                 "first_user_agent", "visit_agent", "visit_environment",
                 *FLAG_COLUMNS, "events_pre_register", "events_post_register",
                 "left_at_once", "clicked_around", "register_first", "other_first", "user_id"]


def _union_distinct(main: DataFrame, b2c: DataFrame) -> DataFrame:
    """Joined_Tables: positional distinct UNION; the B2C branch is typed NULLs plus its
    organisation and user ids."""
    types = dict(main.dtypes)
    b2c_cols = [F.col(c).cast(types[c]) if c in ("calculated_organisationid", "user_id")
                else F.lit(None).cast(types[c]) for c in main.columns]
    return main.union(b2c.select(*[c.alias(n) for c, n in zip(b2c_cols, main.columns)])).distinct()


def _export(joined: DataFrame, events: DataFrame) -> DataFrame:
    """Final_Export_Table, register_count and the final select (23 columns)."""
    uid, user = F.col("unique_id"), F.col("user_id")
    event = F.col("first_user_event")
    status = (F.when(event == ACCOUNT_CREATION, STATUS_ACCOUNT)
              .when(event != ACCOUNT_CREATION, STATUS_B2B)
              .when(event.isNull() & user.isNull(), STATUS_NO_SIGNUP)
              .when(user.isNotNull(), STATUS_B2C))
    final = (joined.filter(F.col("calculated_organisationid").isNotNull())
             .select(uid, F.when(uid.isNotNull(), uid.cast("string"))
                     .otherwise(user.cast("string")).alias("main_reporting_id"),
                     "first_recorded_date", "organisation_code", "calculated_organisationid",
                     status.alias("user_status"),
                     F.col("left_at_once").alias("nosignup_left_registration_page"),
                     F.col("clicked_around").alias("nosignup_another_page"),
                     *FLAG_COLUMNS,
                     F.col("events_pre_register").cast("int").alias("events_pre_register"),
                     F.col("events_post_register").cast("int").alias("events_post_register")))
    # register_count: register-page views per visitor over all time, reduced per visitor
    # before the join; the left join keeps exactly the exported visitors. ``events`` holds all
    # events of the visitors that can be exported.
    counts = (events.filter(is_register_page(F.col("current_url")) & uid.isNotNull())
              .groupBy("unique_id").agg(F.count(F.lit(1)).alias("group_register_page_count")))
    return final.join(counts, "unique_id", "left").select(*REGISTER_SUMMARY_COLUMNS)


# --- J7 / J8 ----------------------------------------------------------------------------
def register_org_codes(events: DataFrame, hashes: DataFrame, urls: SiteUrls = SiteUrls(),
                       summary: DataFrame | None = None, null_aware: bool = False,
                       counters: Counters | None = None) -> DataFrame:
    """Combined_Table: first code per visitor with its organisation id. With ``summary``
    (J8): visitors already reported are dropped and only first hits at or after the
    summary's latest first date are ranked. ``counters`` counts visitors without an id, without
    a code, and with a code that leads to no organisation (these are not exported)."""
    codes = register_codes(events, urls)
    if summary is not None:
        codes = not_in(codes, "unique_id", summary, "unique_id", null_aware)
        codes = codes.filter(F.col("first_recorded_date") >= high_water_mark(summary))
    found = with_organisation(first_code_per_visitor(codes), hashes, trim_hash=True)
    code = F.col("organisation_code")
    return counted(counters, found, register_visitors=F.lit(True), register_without_visitor=F.col("unique_id").isNull(),
                   register_without_code=code.isNull() | (code == ""),
                   unreadable_codes=(code != "") & F.col("calculated_organisationid").isNull())


def high_water_mark(summary: DataFrame) -> Column:
    """Scalar MAX(first_recorded_date) of the summary (NULL when it is empty)."""
    return summary.select(F.max("first_recorded_date")).scalar()


def register_rejoined(slice_: DataFrame, combined: DataFrame, urls: SiteUrls,
                      since: Column | None = None) -> DataFrame:
    """Full_Table + Case_Statements_List -> Rejoined_Main_Table. ``slice_`` and ``combined``
    are stored tables (``visitor_events``, codes)."""
    full = materialize(combined.join(first_identified(slice_, combined, since), "unique_id", "left"), "visitors")
    flags = funnel_flags(slice_, full.filter(F.col("first_user_event").isNull()), urls)
    return (full.join(flags, "unique_id", "left")
            .withColumn("user_id", F.lit(None).cast("long"))
            .select(*_MAIN_COLUMNS))


def register_funnel_backfill(events: DataFrame, registrations: DataFrame, hashes: DataFrame,
                             urls: SiteUrls = SiteUrls(), counters: Counters | None = None) -> DataFrame:
    """J7: the 23-column register summary over the whole event history. Runs its stored stages
    when called; the returned DataFrame reads them."""
    marks = event_marks(events, urls)
    combined = materialize(register_org_codes(marks, hashes, urls, counters=counters), "codes")
    slice_ = visitor_events(events, combined)
    main = register_rejoined(slice_, combined, urls)
    return _export(_union_distinct(main, b2c_transfers(registrations, marks)), slice_)


def register_funnel_incremental(events: DataFrame, registrations: DataFrame, hashes: DataFrame,
                                summary: DataFrame, urls: SiteUrls = SiteUrls(),
                                null_aware: bool = False) -> DataFrame:
    """J8: rows to append to ``summary``: visitors not yet in it, first seen at or after its
    high-water mark (an empty summary yields no register rows; run J7 first), plus B2C
    transfers whose user id is not yet a reporting id.

    ``null_aware=False`` ignores NULL ids in the NOT IN tests; ``True`` keeps the SQL
    meaning, where one NULL id in the summary blocks every row of that branch.
    """
    marks = event_marks(events, urls)
    combined = materialize(register_org_codes(marks, hashes, urls, summary, null_aware), "codes")
    slice_ = visitor_events(events, combined)
    main = register_rejoined(slice_, combined, urls, since=high_water_mark(summary))
    return _export(_union_distinct(main, b2c_transfers(registrations, marks, summary, null_aware)), slice_)


# --- J9 ---------------------------------------------------------------------------------
def by_date_flags(events: DataFrame, visitors: DataFrame, urls: SiteUrls) -> DataFrame:
    """Case_Statements_List of the by-date variant, one row per visitor: events strictly
    before / after the first register-page time are flagged and counted (two passes over
    the stored events, each partially aggregated before the shuffle)."""
    ev = (events.join(_visitor_ids(visitors), "unique_id", "left_semi")
          .select("unique_id", "current_url", "record_date"))
    first = materialize(ev.groupBy("unique_id").agg(
        F.min(F.when(is_register_page(F.col("current_url")), F.col("record_date"))).alias("_first")), "first-register")
    rd = F.col("record_date")
    pre, post = rd < F.col("_first"), rd > F.col("_first")
    flags = page_flags(urls)
    agg = (ev.join(first, "unique_id").groupBy("unique_id").agg(
        F.count(F.when(pre, F.lit(1))).alias("_n_pre"),
        F.count(F.when(post, F.lit(1))).alias("_n_post"),
        *[F.max(F.when(pre, f)).alias(f"{p}_pre") for p, f in flags.items()],
        *[F.max(F.when(post, f)).alias(f"{p}_post") for p, f in flags.items()]))
    n_pre = F.when(F.col("_n_pre") > 0, F.col("_n_pre"))
    n_post = F.when(F.col("_n_post") > 0, F.col("_n_post"))
    return agg.select("unique_id", *FLAG_COLUMNS,
                      n_pre.alias("events_pre_register"), n_post.alias("events_post_register"),
                      F.when(n_post.isNull(), 1).otherwise(0).alias("left_at_once"),
                      F.when(n_post > 0, 1).otherwise(0).alias("clicked_around"),
                      F.when(n_pre.isNull(), 1).otherwise(0).alias("register_first"),
                      F.when(n_pre > 0, 1).otherwise(0).alias("other_first"))


_BY_DATE_COLUMNS = ["unique_id", "first_recorded_date", "organisation_code",
                    "calculated_organisationid", "first_user_event", *FLAG_COLUMNS,
                    "events_pre_register", "events_post_register", "left_at_once",
                    "clicked_around", "register_first", "other_first", "user_id"]


def register_funnel_by_date(events: DataFrame, registrations: DataFrame, hashes: DataFrame,
                            summary: DataFrame, urls: SiteUrls = SiteUrls(),
                            excluded_orgs=EXCLUDED_ORGANISATIONS,
                            null_aware: bool = False) -> DataFrame:
    """J9: visitors not in ``summary``; every code of the visitor's earliest first-hit time
    is kept (ties too) after dropping excluded organisations; the hash join does not trim."""
    marks = event_marks(events, urls)
    codes = not_in(register_codes(marks, urls), "unique_id", summary, "unique_id", null_aware)
    combined = with_organisation(codes, hashes, trim_hash=False)
    kept = materialize(combined.filter(~F.col("calculated_organisationid").isin(*excluded_orgs)), "kept")
    # MIN() OVER (PARTITION BY unique_id) as an aggregate joined back (NULL ids form one
    # group, hence the null-safe join): no visitor's rows have to meet in one window task.
    earliest = (kept.groupBy(F.col("unique_id").alias("_u"))
                .agg(F.min("first_recorded_date").alias("_d0")))
    firsts = materialize(kept.join(earliest, F.col("unique_id").eqNullSafe(F.col("_u")))
                         .filter(F.col("first_recorded_date") == F.col("_d0"))
                         .select("unique_id", "position_find", "first_recorded_date",
                                 "organisation_code", "calculated_organisationid"), "codes")
    slice_ = visitor_events(events, firsts)
    full = materialize(firsts.join(first_identified(slice_, firsts, with_agent=False),
                                   "unique_id", "left"), "visitors")
    flags = by_date_flags(slice_, full.filter(F.col("first_user_event").isNull()), urls)
    main = (full.join(flags, "unique_id", "left")
            .withColumn("user_id", F.lit(None).cast("long"))
            .select(*_BY_DATE_COLUMNS))
    return _export(_union_distinct(main, b2c_transfers(registrations, marks)), slice_)
