"""Point-in-time feature set: cutoff window, static/review/calendar features,
label, assembly, data-driven column drop and validation.

Scale notes
-----------
* The window dates are resolved once from a one-row aggregate and then
  used as **literals**, so the date predicates reach the Parquet scan of a
  real ``calendar_day``/``review`` table (and partition pruning applies
  when the table is partitioned by date or month).
* Each big table is scanned once: all calendar history measures for every
  window come from one conditional aggregation; the quality profile, the
  missing-rate report and the constant-column check are one aggregation
  over all columns (one job, one output row).
* Every per-listing child is one row per key before it is joined, so the
  joins cannot fan out; AQE picks broadcast from runtime sizes and splits
  skewed partitions (host_id can be very hot).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import (coerce_boolean, coerce_numeric, exact_avg, parse_bathrooms,
                                round_half_up, sort_small)

# Fixed values of the feature contract.
PAST_WINDOW_DAYS = 90
FUTURE_WINDOW_DAYS = 30
HISTORY_WINDOWS = (90, 30)
HIGH_DEMAND_AVAILABLE_RATE_THRESHOLD = 0.30
HIGH_MISSING_DROP_THRESHOLD = 0.95
DATASET_VERSION = "v1_audit_cleaned"
TARGET = "high_demand_proxy"
PROTECTED_COLUMNS = ("listing_id", "cutoff_date", "dataset_version",
                     "future_calendar_days_observed_30d", "future_available_days_30d",
                     "future_available_rate_30d", "high_demand_proxy")
LABEL_ONLY_COLUMNS = ("future_calendar_days_observed_30d", "future_available_days_30d",
                      "future_available_rate_30d", "high_demand_proxy")
AUDIT_COLUMNS = ("listing_id", "cutoff_date", "dataset_version")
FORBIDDEN_COLUMNS = ("host_id", "host_pseudo_id", "reviewer_id", "reviewer_pseudo_id",
                     "review_id", "license", "bathrooms_text")
STATIC_FEATURE_COLUMNS = ("listing_id", "room_type", "property_type", "neighbourhood_name",
                          "accommodates", "bedrooms", "beds", "bathrooms", "listing_price",
                          "minimum_nights", "maximum_nights", "instant_bookable",
                          "host_is_superhost", "host_listing_count")
REVIEW_COUNT_COLUMNS = ("total_reviews_before_cutoff", "unique_reviewers_before_cutoff")


@dataclass(frozen=True)
class CutoffWindow:
    calendar_min_date: _dt.date
    calendar_max_date: _dt.date
    cutoff_date: _dt.date
    history_start_date: _dt.date
    label_end_date: _dt.date

    def check(self) -> "CutoffWindow":
        """VA6: the windows must lie inside the calendar and be ordered."""
        if self.history_start_date < self.calendar_min_date:
            raise ValueError("history window starts before the calendar")
        if self.label_end_date > self.calendar_max_date:
            raise ValueError("label window ends after the calendar")
        if not (self.history_start_date < self.cutoff_date < self.label_end_date):
            raise ValueError("window dates are not ordered")
        return self


def cutoff_window_df(calendar: DataFrame, past: int = PAST_WINDOW_DAYS,
                     future: int = FUTURE_WINDOW_DAYS) -> DataFrame:
    """FE1 as a one-row DataFrame: cutoff = max - future, history = cutoff - past."""
    b = calendar.agg(F.min("date").alias("calendar_min_date"),
                     F.max("date").alias("calendar_max_date"))
    return b.select(
        "calendar_min_date", "calendar_max_date",
        F.date_add("calendar_min_date", past).alias("earliest_cutoff"),
        F.date_sub("calendar_max_date", future).alias("latest_cutoff"),
        F.date_sub("calendar_max_date", future).alias("cutoff_date"),
        F.date_sub(F.date_sub("calendar_max_date", future), past).alias("history_start_date"),
        F.date_add(F.date_sub("calendar_max_date", future), future).alias("label_end_date"),
    )


def resolve_window(calendar: DataFrame, past: int = PAST_WINDOW_DAYS,
                   future: int = FUTURE_WINDOW_DAYS) -> CutoffWindow:
    """Collect the one-row window (a global min/max) and check it."""
    r = cutoff_window_df(calendar, past, future).first()
    if r is None or r["calendar_min_date"] is None:
        raise ValueError("calendar is empty")
    if r["earliest_cutoff"] > r["latest_cutoff"]:
        raise ValueError("calendar does not cover the configured windows")
    return CutoffWindow(r["calendar_min_date"], r["calendar_max_date"], r["cutoff_date"],
                        r["history_start_date"], r["label_end_date"]).check()


# -- static features -------------------------------------------------------------

def clean_listing(listing: DataFrame) -> DataFrame:
    """PF9/PF10/FN3: typed numeric and boolean columns, parsed bathrooms."""
    out = listing
    for c in ("accommodates", "minimum_nights", "maximum_nights"):
        out = out.withColumn(c, coerce_numeric(c, "bigint"))
    for c in ("bedrooms", "beds", "listing_price"):
        out = out.withColumn(c, coerce_numeric(c, "double"))
    return (out.withColumn("instant_bookable", coerce_boolean("instant_bookable"))
               .withColumn("bathrooms", parse_bathrooms("bathrooms_text")))


def host_projection(host: DataFrame) -> DataFrame:
    """PF2: host columns with the feature name."""
    return host.select("host_id", coerce_boolean("is_superhost").alias("host_is_superhost"))


def neighbourhood_projection(neighbourhood: DataFrame) -> DataFrame:
    return neighbourhood.select("neighbourhood_id", F.col("name").alias("neighbourhood_name"))


def host_listing_count(listing: DataFrame) -> DataFrame:
    """AG7: distinct listings per host."""
    return listing.groupBy("host_id").agg(
        F.count_distinct("listing_id").alias("host_listing_count"))


def static_features(listing: DataFrame, host: DataFrame, neighbourhood: DataFrame) -> DataFrame:
    """FE2/JN5: listing ⟕ host ⟕ host counts ⟕ neighbourhood, 14 safe columns."""
    lst = clean_listing(listing)
    hc = host_listing_count(listing)
    base = (lst.join(host_projection(host), "host_id", "left")
               .join(hc, "host_id", "left")
               .join(F.broadcast(neighbourhood_projection(neighbourhood)), "neighbourhood_id", "left"))
    return base.select(*STATIC_FEATURE_COLUMNS)


# -- review / calendar features -------------------------------------------------------

def review_features(review: DataFrame, cutoff: _dt.date) -> DataFrame:
    """FE3/AG8: review aggregates over reviews on or before the cutoff."""
    r = review.where(F.col("review_date") <= F.lit(cutoff))
    return r.groupBy("listing_id").agg(
        F.count(F.lit(1)).alias("total_reviews_before_cutoff"),
        F.count_distinct("reviewer_id").alias("unique_reviewers_before_cutoff"),
        exact_avg("comment_len").alias("avg_comment_len_before_cutoff"),
        F.max("comment_len").alias("max_comment_len_before_cutoff"),
        F.datediff(F.lit(cutoff), F.max("review_date")).alias("days_since_last_review"),
    )


def _avail_int() -> Column:
    return F.col("available").cast("int")


def calendar_features(calendar: DataFrame, window: CutoffWindow,
                      windows=HISTORY_WINDOWS) -> DataFrame:
    """FE4/AG9: 5 measures per history window, one scan, conditional aggregation.

    The scan covers ``[history_start, cutoff]`` (91 days for 90); measures
    use ``cutoff - w < date <= cutoff`` (w days), as in the source.
    """
    cut = F.lit(window.cutoff_date)
    c = calendar.where((F.col("date") >= F.lit(window.history_start_date)) & (F.col("date") <= cut))
    aggs = []
    for w in windows:
        inw = (F.col("date") > F.date_sub(cut, w)) & (F.col("date") <= cut)
        aggs += [
            F.count(F.when(inw, F.lit(1))).alias(f"calendar_days_observed_last_{w}d"),
            F.count(F.when(inw & (F.col("available") == F.lit(True)), F.lit(1)))
             .alias(f"available_days_last_{w}d"),
            exact_avg(F.when(inw, _avail_int())).alias(f"available_rate_last_{w}d"),
            exact_avg(F.when(inw, F.col("minimum_nights"))).alias(f"avg_minimum_nights_calendar_last_{w}d"),
            exact_avg(F.when(inw, F.col("maximum_nights"))).alias(f"avg_maximum_nights_calendar_last_{w}d"),
        ]
    return c.groupBy("listing_id").agg(*aggs)


def future_label(calendar: DataFrame, window: CutoffWindow,
                 threshold: float = HIGH_DEMAND_AVAILABLE_RATE_THRESHOLD) -> DataFrame:
    """FE5/AG10: label from ``cutoff < date <= label_end``; null `available` ignored."""
    c = calendar.where((F.col("date") > F.lit(window.cutoff_date)) &
                       (F.col("date") <= F.lit(window.label_end_date)))
    g = c.groupBy("listing_id").agg(
        F.count(F.lit(1)).alias("future_calendar_days_observed_30d"),
        F.count(F.when(F.col("available") == F.lit(True), F.lit(1))).alias("future_available_days_30d"),
        exact_avg(_avail_int()).alias("future_available_rate_30d"))
    return g.withColumn(TARGET, (F.col("future_available_rate_30d") <= F.lit(threshold)).cast("int"))


def calendar_features_and_label(calendar: DataFrame, window: CutoffWindow,
                                windows=HISTORY_WINDOWS,
                                threshold: float = HIGH_DEMAND_AVAILABLE_RATE_THRESHOLD) -> DataFrame:
    """FE4 + FE5 fused: ONE calendar scan over ``[history_start, label_end]``.

    Returns one row per listing that has label-window days (the label is an
    inner join), with the history measures set to null when the listing has
    no day in ``[history_start, cutoff]`` -- exactly the result of the
    separate left-joined history aggregate.
    """
    cut = F.lit(window.cutoff_date)
    c = calendar.where((F.col("date") >= F.lit(window.history_start_date)) &
                       (F.col("date") <= F.lit(window.label_end_date)))
    hist = (F.col("date") <= cut)
    fut = (F.col("date") > cut)
    aggs = [F.count(F.when(hist, F.lit(1))).alias("_hist_rows")]
    names = []
    for w in windows:
        inw = (F.col("date") > F.date_sub(cut, w)) & hist
        aggs += [
            F.count(F.when(inw, F.lit(1))).alias(f"calendar_days_observed_last_{w}d"),
            F.count(F.when(inw & (F.col("available") == F.lit(True)), F.lit(1)))
             .alias(f"available_days_last_{w}d"),
            exact_avg(F.when(inw, _avail_int())).alias(f"available_rate_last_{w}d"),
            exact_avg(F.when(inw, F.col("minimum_nights"))).alias(f"avg_minimum_nights_calendar_last_{w}d"),
            exact_avg(F.when(inw, F.col("maximum_nights"))).alias(f"avg_maximum_nights_calendar_last_{w}d"),
        ]
        names += [f"calendar_days_observed_last_{w}d", f"available_days_last_{w}d",
                  f"available_rate_last_{w}d", f"avg_minimum_nights_calendar_last_{w}d",
                  f"avg_maximum_nights_calendar_last_{w}d"]
    aggs += [
        F.count(F.when(fut, F.lit(1))).alias("future_calendar_days_observed_30d"),
        F.count(F.when(fut & (F.col("available") == F.lit(True)), F.lit(1))).alias("future_available_days_30d"),
        exact_avg(F.when(fut, _avail_int())).alias("future_available_rate_30d"),
    ]
    g = c.groupBy("listing_id").agg(*aggs).where(F.col("future_calendar_days_observed_30d") > 0)
    has_hist = F.col("_hist_rows") > 0
    return g.select(
        "listing_id",
        *[F.when(has_hist, F.col(n)).alias(n) for n in names],
        "future_calendar_days_observed_30d", "future_available_days_30d", "future_available_rate_30d",
        (F.col("future_available_rate_30d") <= F.lit(threshold)).cast("int").alias(TARGET))


def label_distribution(label: DataFrame) -> DataFrame:
    """AG13: value counts of the target incl. null, share rounded to 4."""
    g = label.groupBy(TARGET).agg(F.count(F.lit(1)).alias("count"))
    total = label.select(F.count(F.lit(1))).scalar()
    return g.withColumn("percentage", round_half_up(
        F.col("count").cast("double") / total.cast("double"), 4))


# -- assembly -------------------------------------------------------------------------

def fill_review_defaults(df: DataFrame, past: int = PAST_WINDOW_DAYS,
                         future: int = FUTURE_WINDOW_DAYS) -> DataFrame:
    """PF8: review counts -> 0, days_since_last_review -> past + future."""
    return (df.fillna(0, subset=list(REVIEW_COUNT_COLUMNS))
              .fillna(past + future, subset=["days_since_last_review"]))


def build_feature_set(listing, host, neighbourhood, review, calendar,
                      window: CutoffWindow | None = None,
                      dataset_version: str = DATASET_VERSION) -> DataFrame:
    """FE1-FE6 up to the assembled (pre-drop) table.

    Same rows as joining the four separate parts, with
    the calendar read once for history and label (fused aggregate).
    """
    window = window or resolve_window(calendar)
    cal = calendar_features_and_label(calendar, window)
    j = (static_features(listing, host, neighbourhood)
         .join(review_features(review, window.cutoff_date), "listing_id", "left")
         .join(cal, "listing_id", "inner"))
    j = (j.withColumn("cutoff_date", F.lit(window.cutoff_date.isoformat()))
          .withColumn("dataset_version", F.lit(dataset_version)))
    return fill_review_defaults(j)


# -- profile, drop, reports ---------------------------------------------------------------

def _is_missing(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType
    m = F.col(c).isNull()
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        m = m | F.isnan(F.col(c))
    return m


def profile_columns(df: DataFrame) -> list[Column]:
    """The aggregates behind ``column_profile``."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(df.columns):
        aggs += [F.count(F.when(_is_missing(df, c), F.lit(1))).alias(f"m{i}"),
                 (F.min(c) == F.max(c)).alias(f"e{i}")]
    return aggs


def profile_rows(one: DataFrame, columns: list[str]) -> DataFrame:
    rows = [F.struct(F.lit(c).alias("column"),
                     (F.col(f"m{i}").cast("double") / F.col("__n").cast("double")).alias("missing_rate"),
                     ((F.col(f"m{i}") == F.col("__n")) |
                      ((F.col(f"m{i}") == 0) & F.coalesce(F.col(f"e{i}"), F.lit(False))))
                     .alias("is_constant"))
            for i, c in enumerate(columns)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def column_profile(df: DataFrame) -> DataFrame:
    """One aggregation over all columns -> one row per column.

    missing_rate = share of null/NaN; ``is_constant`` = pandas
    ``nunique(dropna=False) <= 1`` computed as "all missing, or no missing
    and min = max" (no distinct count needed).
    """
    return profile_rows(df.agg(*profile_columns(df)), df.columns)


def drop_profile(df: DataFrame, protected=PROTECTED_COLUMNS,
                 threshold: float = HIGH_MISSING_DROP_THRESHOLD, profile: DataFrame | None = None) -> DataFrame:
    """PF12 profile rows: which columns the drop rule removes and why."""
    p = column_profile(df) if profile is None else profile
    prot = F.col("column").isin(*protected)
    return p.select(
        "column", "missing_rate", "is_constant",
        ((~prot) & (F.col("missing_rate") > threshold)).alias("high_missing"),
        ((~prot) & ((F.col("missing_rate") > threshold) | F.col("is_constant"))).alias("dropped"))


def staged_clean(df: DataFrame, path: str, protected=PROTECTED_COLUMNS, threshold: float = HIGH_MISSING_DROP_THRESHOLD):
    """PF12 in the pass that stores the features: ``df`` is written to ``path`` and
    profiled meanwhile; (stored DataFrame without the unusable columns, their names)."""
    from .quality import observed

    spark, aggs = df.sparkSession, profile_columns(df)
    found = observed({"features": (df, aggs)}, lambda f: f["features"].write.parquet(path))["features"]
    kinds = ", ".join(f"`{c}` {'boolean' if c.startswith('e') else 'long'}" for c in found)
    one = spark.createDataFrame([tuple(found.values())], kinds)
    rows = drop_profile(df, protected, threshold, profile_rows(one, df.columns))
    dropped = sorted(r["column"] for r in rows.where("dropped").collect())
    return spark.read.schema(df.schema).parquet(path).drop(*dropped), dropped


def drop_unusable_columns(df: DataFrame, protected=PROTECTED_COLUMNS,
                          threshold: float = HIGH_MISSING_DROP_THRESHOLD):
    """Apply PF12; returns (clean DataFrame, sorted dropped names).

    Only the one-row-per-column profile reaches the driver.
    """
    dropped = sorted(r["column"] for r in
                     drop_profile(df, protected, threshold).where("dropped").collect())
    return df.drop(*dropped), dropped


def missing_report(df: DataFrame) -> DataFrame:
    """AG14: missing rate per column, highest first, ties by name."""
    return sort_small(column_profile(df).select("column", "missing_rate"),
                      F.desc("missing_rate"), F.asc("column"))


def describe_column(df: DataFrame, c: str) -> DataFrame:
    """AG15: pandas ``describe()`` of one numeric column as (statistic, value) rows."""
    x = F.col(c).cast("double")
    one = df.agg(F.count(x).cast("double").alias("count"), F.avg(x).alias("mean"),
                 F.stddev_samp(x).alias("std"), F.min(x).alias("min"),
                 F.percentile(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"),
                 F.max(x).alias("max"))
    stats = [("count", F.col("count")), ("mean", F.col("mean")), ("std", F.col("std")),
             ("min", F.col("min")), ("25%", F.col("q")[0]), ("50%", F.col("q")[1]),
             ("75%", F.col("q")[2]), ("max", F.col("max"))]
    rows = [F.struct(F.lit(name).alias("statistic"), round_half_up(v, 6).alias("value"))
            for name, v in stats]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def model_input_columns(columns) -> list[str]:
    """PF13: inputs = all - label-only - audit columns."""
    return [c for c in columns if c not in LABEL_ONLY_COLUMNS and c not in AUDIT_COLUMNS]


def validate_feature_set(df: DataFrame) -> DataFrame:
    """VA4 as one aggregation; schema rules are evaluated on the driver.

    Returns one row per check: (check, value, passed).
    """
    inputs = model_input_columns(df.columns)
    forbidden = sorted(set(FORBIDDEN_COLUMNS) & set(df.columns))
    leakage = [c for c in inputs if c.startswith("future_")]
    # One job: aggregate per key first (the duplicate count needs the key
    # groups), then over the per-key rows.  Only key columns and a few
    # flags are shuffled.
    per_key = df.groupBy("listing_id", "cutoff_date").agg(
        F.count(F.lit(1)).alias("c"),
        F.count(F.when(F.col(TARGET).isNull(), F.lit(1))).alias("mt"),
        F.count(F.when(~F.col(TARGET).isin(0, 1), F.lit(1))).alias("nb"),
        F.min("future_calendar_days_observed_30d").alias("mf"))
    j = per_key.agg(
        F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("v"),
        F.coalesce(F.sum("mt"), F.lit(0)).alias("missing_target"),
        F.coalesce(F.sum("nb"), F.lit(0)).alias("non_binary_target"),
        F.min("mf").alias("min_future_days"))
    checks = [
        ("duplicate_count", F.col("v").cast("bigint"), F.col("v") == 0),
        ("missing_target_count", F.col("missing_target"), F.col("missing_target") == 0),
        ("non_binary_target_count", F.col("non_binary_target"), F.col("non_binary_target") == 0),
        ("forbidden_column_count", F.lit(len(forbidden)).cast("bigint"), F.lit(not forbidden)),
        ("future_leakage_column_count", F.lit(len(leakage)).cast("bigint"), F.lit(not leakage)),
        ("model_input_column_count", F.lit(len(inputs)).cast("bigint"), F.lit(len(inputs) > 0)),
        ("min_future_calendar_days", F.col("min_future_days").cast("bigint"),
         F.coalesce(F.col("min_future_days") > 0, F.lit(False))),
    ]
    rows = [F.struct(F.lit(n).alias("check"), v.alias("value"), p.alias("passed"))
            for n, v, p in checks]
    return j.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """VA5: keys that occur more than once, with their multiplicity."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def table_quality(df: DataFrame, null_cols, date_col: str, prefix: str) -> DataFrame:
    """AG11: rows, null counts per column and the date range, one agg."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(f"null_{c}") for c in null_cols]
    aggs += [F.min(date_col).alias(f"min_{prefix}_date"), F.max(date_col).alias(f"max_{prefix}_date")]
    return df.agg(*aggs)
