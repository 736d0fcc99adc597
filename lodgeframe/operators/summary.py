"""Neighbourhood summaries (the SQL summary and the CLI summary).

Scale notes
-----------
* The calendar is the big table.  It is aggregated to one row per listing
  *before* any join (eager aggregation), and both calendar measures -- the
  first-30-day rate and the whole-calendar rate -- come from **one** scan
  by conditional aggregation instead of two scans.
* The 30-day bound is a scalar subquery (``min(date)``) evaluated once,
  not a cross join.
* The per-listing children are unique per key, so the left joins cannot
  fan out; the neighbourhood dimension is fixed-size and broadcast.
* The exact median is Spark's ``percentile`` aggregate: its buffer is a
  value -> count map, and prices carry cents, so a group's buffer is
  bounded by the price range x 100 distinct values, not by the number of
  listings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import exact_avg, pseudonymize, round_half_up, sort_small

SUMMARY_COLUMNS = ["neighbourhood", "num_listings", "avg_price", "median_price",
                   "avg_minimum_nights", "total_reviews", "reviews_per_listing",
                   "availability_30_rate", "availability_365_rate"]

BASIC_SUMMARY_COLUMNS = ["neighbourhood", "num_listings", "avg_price", "median_price",
                         "avg_minimum_nights", "availability_365_avg", "total_reviews",
                         "reviews_per_listing", "tourism_segment", "priority_level"]

LISTINGS_REQUIRED = {"listing_id", "neighbourhood", "price", "minimum_nights",
                     "availability_365", "number_of_reviews", "host_id", "host_name"}


def _avail_as_unit(col: str = "available"):
    # null `available` counts as unavailable in the summary
    return F.when(F.col(col), F.lit(1)).otherwise(F.lit(0))


def calendar_start(calendar: DataFrame):
    """``min(date)`` of the calendar as a scalar-subquery column."""
    return calendar.select(F.min("date")).scalar()


def calendar_rates(calendar: DataFrame, days: int = 30) -> DataFrame:
    """AG3+AG4 fused: one calendar scan, one row per listing.

    availability_30_rate  -- share of available days among days in
                              ``[start, start + days)``; null `available` = 0
    avg_calendar_price_30 -- mean non-null price in the same range
    availability_365_rate -- same share over the whole calendar
    """
    start = calendar_start(calendar)
    # the bound is evaluated once (one scalar subquery) and the flag is
    # projected once, so every conditional aggregate reuses it
    flagged = calendar.select(
        "listing_id", "available", "price",
        ((F.col("date") >= start) & (F.col("date") < F.date_add(start, days))).alias("_in30"))
    in30 = F.col("_in30")
    return (flagged.groupBy("listing_id").agg(
        F.try_divide(F.sum(F.when(in30, _avail_as_unit())).cast("double"),
                     F.count(F.when(in30, F.lit(1))).cast("double")).alias("availability_30_rate"),
        F.try_divide(F.sum(F.when(in30, F.col("price"))).cast("double"),
                     F.count(F.when(in30, F.col("price"))).cast("double")).alias("avg_calendar_price_30"),
        F.try_divide(F.sum(_avail_as_unit()).cast("double"),
                     F.count(F.lit(1)).cast("double")).alias("availability_365_rate"),
    ))


def calendar_30(calendar: DataFrame, days: int = 30) -> DataFrame:
    """AG3 on its own: only listings with a day in the first ``days`` days."""
    start = calendar_start(calendar)
    c = calendar.where((F.col("date") >= start) & (F.col("date") < F.date_add(start, days)))
    return c.groupBy("listing_id").agg(
        exact_avg("price").alias("avg_calendar_price_30"),
        F.try_divide(F.sum(_avail_as_unit()).cast("double"),
                     F.count(F.lit(1)).cast("double")).alias("availability_30_rate"))


def calendar_365(calendar: DataFrame) -> DataFrame:
    """AG4: the rate over the whole calendar (no date filter, as in the source)."""
    return calendar.groupBy("listing_id").agg(
        F.try_divide(F.sum(_avail_as_unit()).cast("double"),
                     F.count(F.lit(1)).cast("double")).alias("availability_365_rate"))


def review_counts(review: DataFrame) -> DataFrame:
    """AG5: reviews per listing (map-side partial count before the shuffle)."""
    return review.groupBy("listing_id").agg(F.count(F.lit(1)).alias("total_reviews"))


def priced_listings(listing: DataFrame) -> DataFrame:
    """PF4: price not null and > 0 (null already fails the comparison)."""
    return listing.where(F.col("listing_price") > 0)


def listings_with_neighbourhood(listing: DataFrame, neighbourhood: DataFrame) -> DataFrame:
    """JN2: inner join to the (fixed-size, broadcast) neighbourhood dimension."""
    n = neighbourhood.select("neighbourhood_id", F.col("name").alias("neighbourhood"))
    return listing.join(F.broadcast(n), "neighbourhood_id", "inner")


def neighbourhood_summary(listing: DataFrame, neighbourhood: DataFrame,
                          calendar: DataFrame, review: DataFrame,
                          days: int = 30) -> DataFrame:
    """AG2, the flagship summary: one row per neighbourhood name."""
    rates = calendar_rates(calendar, days).select(
        "listing_id", "availability_30_rate", "availability_365_rate")
    rc = review_counts(review)
    base = listings_with_neighbourhood(
        priced_listings(listing).select("listing_id", "neighbourhood_id",
                                        "listing_price", "minimum_nights"),
        neighbourhood)
    j = (base.join(rates, "listing_id", "left")
             .join(rc, "listing_id", "left"))
    out = j.groupBy("neighbourhood").agg(
        F.count(F.lit(1)).alias("num_listings"),
        round_half_up(exact_avg("listing_price"), 2).alias("avg_price"),
        round_half_up(F.percentile(F.col("listing_price").cast("double"), F.lit(0.5)), 2)
        .alias("median_price"),
        round_half_up(exact_avg("minimum_nights"), 2).alias("avg_minimum_nights"),
        F.coalesce(F.sum("total_reviews"), F.lit(0)).cast("bigint").alias("total_reviews"),
        round_half_up(exact_avg(F.coalesce(F.col("total_reviews"), F.lit(0))), 2)
        .alias("reviews_per_listing"),
        round_half_up(F.avg("availability_30_rate"), 4).alias("availability_30_rate"),
        round_half_up(F.avg("availability_365_rate"), 4).alias("availability_365_rate"))
    # one row per neighbourhood name: a bounded result
    return sort_small(out, F.desc("num_listings"), F.asc("neighbourhood"))


def median_price(listing: DataFrame, neighbourhood: DataFrame) -> DataFrame:
    """AG6: exact interpolated median of price per neighbourhood."""
    base = listings_with_neighbourhood(priced_listings(listing), neighbourhood)
    return base.groupBy("neighbourhood").agg(
        round_half_up(F.percentile(F.col("listing_price").cast("double"), F.lit(0.5)), 2)
        .alias("median_price"))


def join_left_preagg(listing: DataFrame, calendar: DataFrame, review: DataFrame,
                     days: int = 30) -> DataFrame:
    """JN3: listing left-joined to its three per-listing aggregates."""
    c30 = calendar_30(calendar, days)
    c365 = calendar_365(calendar)
    rc = review_counts(review)
    return (listing.select("listing_id", "neighbourhood_id")
            .join(c30, "listing_id", "left")
            .join(c365, "listing_id", "left")
            .join(rc, "listing_id", "left"))


# -- CLI (flat file) summary ---------------------------------------------------

def require_columns(df: DataFrame, required) -> DataFrame:
    """PF1: fail before any job runs when a required column is missing."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns in listings: {missing}")
    return df


def handle_pii(df: DataFrame, salt: str | None = None) -> DataFrame:
    """FN2: add ``host_key`` = pseudonym of host_id; drop host_name and host_id.

    Absent columns are tolerated (``drop`` ignores them).
    """
    out = df
    if "host_id" in df.columns:
        out = out.withColumn("host_key", pseudonymize("host_id") if salt is None
                             else pseudonymize("host_id", salt))
    return out.drop("host_name", "host_id")


def neighbourhood_summary_basic(listings: DataFrame, segments: DataFrame) -> DataFrame:
    """AG1 + JN1: per-neighbourhood summary of the flat listings file.

    Null neighbourhoods are dropped (pandas groupby semantics); segments are
    joined after aggregation and missing segments become ``unknown``.
    """
    require_columns(listings, LISTINGS_REQUIRED)
    clean = handle_pii(listings).where(F.col("neighbourhood").isNotNull())
    agg = clean.groupBy("neighbourhood").agg(
        F.count("listing_id").alias("num_listings"),
        exact_avg("price").alias("avg_price"),
        F.percentile(F.col("price").cast("double"), F.lit(0.5)).alias("median_price"),
        exact_avg("minimum_nights").alias("avg_minimum_nights"),
        exact_avg("availability_365").alias("availability_365_avg"),
        F.sum("number_of_reviews").cast("bigint").alias("total_reviews"),
    ).withColumn("reviews_per_listing",
                 F.col("total_reviews").cast("double") / F.col("num_listings").cast("double"))
    seg = segments.select("neighbourhood", "tourism_segment", "priority_level")
    # segments are one row per neighbourhood in the source; the summary is
    # small (one row per neighbourhood), so the join is cheap either way.
    out = agg.join(seg, "neighbourhood", "left").fillna(
        {"tourism_segment": "unknown", "priority_level": "unknown"})
    return out.select(*BASIC_SUMMARY_COLUMNS)
