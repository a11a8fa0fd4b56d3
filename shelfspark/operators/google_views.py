"""J3 / J4: anonymous Google-referred visitors counted against the first book they viewed.

Both jobs read the event table once for a half-open period. Date, equality and NULL
predicates are pushed into the Parquet scan; JSON is parsed only for surviving rows.
The "first book per visitor" steps are aggregates (``min`` of an ordered struct) rather
than windows, so no visitor's events need to sit in one task: map-side partial
aggregation collapses a visitor with millions of page views before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.counters import Counters, counted
from ..functions.dates import ts_lit
from ..functions.json import is_valid_json, json_path_text
from ..params import Period
from ..schemas import BOOK_VIEWS_COLUMNS, BOOK_VIEWS_GEO_COLUMNS


def google_page_views(events: DataFrame, period: Period, counters: Counters | None = None) -> DataFrame:
    """Page views in [start, end) referred by Google to a book URL, by visitors with a
    cookie and no user id, whose properties are valid JSON with a non-empty
    ``content_ids`` (text such as ``[123]``).

    ``counters`` counts what is left out: views without a visitor, with invalid JSON, without a
    book id. Conditions behind a counter are not pushed into the scan; the others are.
    """
    rd, uid, valid = F.col("record_date"), F.col("unique_id"), is_valid_json(F.col("event_properties"))
    views = events.filter(
        (rd >= ts_lit(period.start)) & (rd < ts_lit(period.end))
        & (F.col("event_name") == "page view")
        & F.col("referrer_url").contains("google")
        & F.col("current_url").contains("book")
        & F.col("user_id").isNull())
    has_visitor = uid.isNotNull() & (uid != "")
    views = counted(counters, views, page_views=F.lit(True), views_without_visitor=~has_visitor)
    views = counted(counters, views.filter(has_visitor), views_with_invalid_json=~F.coalesce(valid, F.lit(False)))
    book = json_path_text(F.col("event_properties"), "content_ids")
    named = (views.filter(valid)
             .select("unique_id", "event_id", "record_date",
                     F.to_date(rd).alias("recorded_date"), "geo_location",
                     book.alias("book_id")))
    has_book = F.coalesce(F.col("book_id") != "", F.lit(False))
    return counted(counters, named, views_without_book_id=~has_book).filter(has_book)


def _first_of(order: list, value: str) -> F.Column:
    """Value of the row with the smallest ``order`` tuple; NULL order keys sort last."""
    return F.min(F.struct(*order, F.col(value).alias("v")))["v"]


def google_first_views_by_period(events: DataFrame, period: Period, counters: Counters | None = None) -> DataFrame:
    """book_id, reporting_period_start, unique_first_views.

    Each visitor's first book is the book of their earliest view (ties: smallest book
    text), equal to numbering (visitor, book) first dates and keeping number 1. Visitors
    are counted per cleaned book text; the id is that text read as an int (NULL for
    values such as ``[1,2]``, which are still counted).
    """
    rd = F.col("record_date")
    first = (google_page_views(events, period, counters).filter(F.col("book_id").isNotNull())
             .groupBy("unique_id")
             .agg(_first_of([rd.isNull(), rd, F.col("book_id")], "book_id").alias("first_book")))
    clean = F.replace(F.replace(F.col("first_book"), F.lit("["), F.lit("")), F.lit("]"), F.lit(""))
    first = counted(counters, first, visitors=F.lit(True), visitors_with_unreadable_book=clean.try_cast("int").isNull())
    return (first.groupBy(clean.alias("_book_text"))
            .agg(F.count(F.lit(1)).alias("unique_first_views"))
            .select(F.col("_book_text").try_cast("int").alias("book_id"),
                    F.lit(period.period_start).alias("reporting_period_start"),
                    "unique_first_views")
            .select(*BOOK_VIEWS_COLUMNS))


def google_first_views_by_day_geo(events: DataFrame, period: Period, counters: Counters | None = None) -> DataFrame:
    """book_id, reporting_period_start (day), unique_first_views, geo_location.

    The first book is taken over the visitor's whole period (earliest view, ties by
    event id); the visitor is then counted on every day and location they viewed.
    Plan: distinct (visitor, day, location) triples and one first-book row per visitor,
    both partially aggregated; joined on the visitor; counted per (book, day, location).
    """
    views = google_page_views(events, period)
    # Of the two readings of the views one is counted.
    first_views = views if counters is None else google_page_views(events, period, counters)
    inner = F.col("book_id").substr(F.lit(2), F.length("book_id") - 2)
    rd = F.col("record_date")
    first = (first_views.withColumn("_clean", inner.try_cast("int"))
             .groupBy("unique_id")
             .agg(_first_of([rd.isNull(), rd, F.col("event_id")], "_clean").alias("first_book")))
    first = counted(counters, first, visitors=F.lit(True), visitors_with_unreadable_book=F.col("first_book").isNull())
    visits = views.select("unique_id", "recorded_date", "geo_location").distinct()
    return (visits.join(first, "unique_id")
            .groupBy("first_book", "recorded_date", "geo_location")
            .agg(F.count(F.lit(1)).alias("unique_first_views"))
            .select(F.col("first_book").alias("book_id"),
                    F.col("recorded_date").alias("reporting_period_start"),
                    "unique_first_views", "geo_location")
            .select(*BOOK_VIEWS_GEO_COLUMNS))
