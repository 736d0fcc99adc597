"""Data-quality checks on summaries: every rule is one conditional count
inside a single aggregation, so a check costs one pass over its input and
reports *all* failing rules, not just the first."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# The summary contract of the CLI summary.
REQUIRED_SUMMARY_COLUMNS = ("neighbourhood", "num_listings", "avg_price", "median_price",
                            "avg_minimum_nights", "availability_365_avg", "total_reviews",
                            "reviews_per_listing", "tourism_segment", "priority_level")
PII_COLUMNS = ("host_name", "host_id", "reviewer_name", "reviewer_id", "listing_url", "host_url")


def observed(watched: dict[str, tuple[DataFrame, list[Column]]], job) -> dict[str, dict]:
    """Aggregates of some DataFrames gathered while ``job`` runs them.

    ``watched`` names DataFrames with their aggregate columns; ``job`` gets
    them, observed, by name, and runs one action that reads them. What the job's
    plan did not run to its end (a side that an empty one made needless) is
    aggregated afterwards.
    """
    watches = {name: Observation() for name in watched}
    job({name: df.observe(watches[name], *columns) for name, (df, columns) in watched.items()})
    out = {}
    for name, (df, columns) in watched.items():
        try:
            done = watches[name]._jo.getOrEmpty().size() > 0
        except Py4JJavaError:                       # completed without the node's row
            done = False
        out[name] = watches[name].get if done else df.agg(*columns).first().asDict()
    return out


class ValidationError(ValueError):
    """Raised by a gate after the report row has been produced."""


def _count_if(cond):
    return F.count(F.when(cond, F.lit(1))).cast("bigint")


def validate_summary_basic(summary: DataFrame) -> DataFrame:
    """VA1: CLI summary rules as (check, failures, passed) rows.

    Schema rules (required columns, PII columns) are evaluated on the driver
    from the schema; value rules are one aggregation.
    """
    cols = set(summary.columns)
    missing = len(set(REQUIRED_SUMMARY_COLUMNS) - cols)
    leaked = len(set(PII_COLUMNS) & cols)
    one = summary.agg(
        F.count(F.lit(1)).alias("rows"),
        _count_if(F.col("neighbourhood").isNull()).alias("null_neighbourhood"),
        _count_if(F.col("num_listings") <= 0).alias("bad_num_listings"),
        _count_if(F.col("avg_price") < 0).alias("bad_avg_price"),
        _count_if((F.col("availability_365_avg") < 0) | (F.col("availability_365_avg") > 365))
        .alias("bad_availability"))
    checks = [
        ("not_empty", F.when(F.col("rows") == 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint")),
        ("required_columns", F.lit(missing).cast("bigint")),
        ("no_pii_columns", F.lit(leaked).cast("bigint")),
        ("neighbourhood_not_null", F.col("null_neighbourhood")),
        ("num_listings_positive", F.col("bad_num_listings")),
        ("avg_price_non_negative", F.col("bad_avg_price")),
        ("availability_365_in_range", F.col("bad_availability")),
    ]
    rows = [F.struct(F.lit(n).alias("check"), v.alias("failures"), (v == 0).alias("passed"))
            for n, v in checks]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def summary_checks() -> list[Column]:
    """VA2: the aggregates that a refresh is judged by."""
    bad_price = (F.col("avg_price").isNull() | F.col("median_price").isNull() |
                 (F.col("avg_price") <= 0) | (F.col("median_price") <= 0))
    bad_avail = (F.col("availability_30_rate").isNull() | F.col("availability_365_rate").isNull() |
                 (F.col("availability_30_rate") < 0) | (F.col("availability_30_rate") > 1) |
                 (F.col("availability_365_rate") < 0) | (F.col("availability_365_rate") > 1))
    return [F.count(F.lit(1)).cast("int").alias("row_count"),
            F.count(F.when(F.col("neighbourhood").isNull() | (F.col("neighbourhood") == ""), F.lit(1)))
            .cast("int").alias("null_neighbourhoods"),
            F.count(F.when(bad_price, F.lit(1))).cast("int").alias("bad_prices"),
            F.count(F.when(bad_avail, F.lit(1))).cast("int").alias("bad_availability")]


def judged(checks: DataFrame) -> DataFrame:
    """The row of ``summary_checks`` with ``passed``."""
    return checks.withColumn("passed", (F.col("row_count") > 0) & (F.col("null_neighbourhoods") == 0) &
                             (F.col("bad_prices") == 0) & (F.col("bad_availability") == 0))


def validate_summary(summary: DataFrame) -> DataFrame:
    """VA2: refresh checks of the materialised summary, one row + ``passed``."""
    return judged(summary.agg(*summary_checks()))


def gate(report_row) -> None:
    """VA3: raise after the report when a check failed."""
    if not report_row["passed"]:
        raise ValidationError(f"Validation failed: {report_row.asDict()}")


def run_report(listings: DataFrame, segments: DataFrame, summarize, write) -> DataFrame:
    """SK6/AG16: the run report's counts as one row, gathered by the job that
    writes the summary (``write(summarize(listings, segments))``), so both inputs
    are read once."""
    rows, n_columns = F.count(F.lit(1)).alias("n"), []

    def job(by_name):
        summary = summarize(by_name["listings"], by_name["segments"])
        n_columns.append(len(summary.columns))
        found.update(observed({"summary": (summary, [rows])}, lambda s: write(s["summary"])))

    found: dict = {}
    found |= observed({"listings": (listings, [rows, F.count_if(F.col("number_of_reviews") > 0).alias("reviewed")]),
                       "segments": (segments, [rows])}, job)
    counts = (found["listings"]["n"], found["segments"]["n"], found["summary"]["n"], found["listings"]["reviewed"], n_columns[0])
    return listings.sparkSession.createDataFrame([counts], "input_listings long, input_segments long, output_neighbourhoods long, "
                                                           "listings_with_reviews long, output_columns long")
