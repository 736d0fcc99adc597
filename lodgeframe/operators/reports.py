"""Sidecar reports of the feature set: metadata, validation report, PII audit,
and per-run evaluation artefacts.  Every report is a small DataFrame
(one row, nested structs / arrays) built from aggregates of the data and
written as JSON next to the data -- never assembled from collected rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import sanitize_run_name
from . import features as FE

# The declared PII policy (table, column, type, decision, reason).
PII_POLICY = [
    ("listing", "listing_id", "entity identifier", "keep as entity key only",
     "needed to define one row per listing; not a model input"),
    ("listing", "host_id", "entity identifier", "exclude from final model inputs",
     "links listings to the same host and could identify an account"),
    ("host", "host_pseudo_id", "pseudonymous identifier", "exclude",
     "stable host-level identifier with no modeling value beyond identity"),
    ("listing", "license", "regulatory identifier", "exclude",
     "can be identifying and is not required for demand prediction"),
    ("review", "review_id", "event identifier", "exclude raw id; aggregate only",
     "review-level key is not a listing feature"),
    ("review", "reviewer_id", "person identifier", "exclude raw id; aggregate only",
     "direct reviewer identifier must not be exposed to the model"),
    ("review", "reviewer_pseudo_id", "pseudonymous person identifier", "exclude",
     "stable reviewer identifier is privacy-sensitive"),
]
SOURCE_TABLES = ["core.listing", "core.host", "core.neighbourhood", "core.review", "core.calendar_day"]
TARGET_DESCRIPTION = ("1 when future 30-day availability rate is at or below the configured "
                      "threshold; otherwise 0.")


def dataset_metadata(features: DataFrame, window: FE.CutoffWindow,
                     dataset_version: str = FE.DATASET_VERSION) -> DataFrame:
    """SK3: one-row metadata frame (schema facts + window), ready for ``.write.json``."""
    inputs = FE.model_input_columns(features.columns)
    excluded = sorted(set(FE.PROTECTED_COLUMNS) | set(FE.FORBIDDEN_COLUMNS))
    spark = features.sparkSession
    return spark.range(1).select(
        F.lit(dataset_version).alias("dataset_version"),
        F.lit("listing_id").alias("entity_column"),
        F.lit(window.cutoff_date.isoformat()).alias("cutoff_date"),
        F.lit(window.history_start_date.isoformat()).alias("history_start_date"),
        F.lit(window.label_end_date.isoformat()).alias("label_end_date"),
        F.lit(FE.PAST_WINDOW_DAYS).alias("past_window_days"),
        F.lit(FE.FUTURE_WINDOW_DAYS).alias("future_window_days"),
        F.array(*[F.lit(t) for t in SOURCE_TABLES]).alias("source_tables"),
        F.struct(F.lit(FE.TARGET).alias("name"), F.lit(TARGET_DESCRIPTION).alias("description"),
                 F.lit(FE.HIGH_DEMAND_AVAILABLE_RATE_THRESHOLD).alias("availability_rate_threshold"))
        .alias("target_definition"),
        F.array(*[F.lit(c) for c in excluded]).alias("excluded_from_model_inputs"),
        F.array(*[F.lit(c) for c in inputs]).alias("model_input_columns"))


def validation_report(features: DataFrame, dropped: list[str]) -> DataFrame:
    """SK4: one row with scalar checks and nested record lists.

    Each list is an aggregate over the data (``collect_list`` of bounded
    report rows: one per column / label value / statistic).
    """
    checks = FE.validate_feature_set(features)
    c = {r: checks.where(F.col("check") == r).select("value").scalar()
         for r in ("duplicate_count", "missing_target_count")}
    miss = FE.missing_report(features).agg(
        F.collect_list(F.struct("column", "missing_rate")).alias("l")).select("l").scalar()
    lab = FE.label_distribution(features.select(FE.TARGET)).agg(
        F.collect_list(F.struct(FE.TARGET, "count", "percentage")).alias("l")).select("l").scalar()
    cov = FE.describe_column(features, "future_calendar_days_observed_30d").agg(
        F.collect_list(F.struct("statistic", "value")).alias("l")).select("l").scalar()
    targets = features.agg(F.sort_array(F.collect_set(FE.TARGET)).alias("t")).select("t").scalar()
    inputs = FE.model_input_columns(features.columns)
    forbidden = sorted(set(FE.FORBIDDEN_COLUMNS) & set(features.columns))
    leakage = [x for x in inputs if x.startswith("future_")]
    return features.agg(F.count(F.lit(1)).alias("row_count")).select(
        c["duplicate_count"].alias("duplicate_listing_cutoff_rows"),
        c["missing_target_count"].alias("missing_target_count"),
        targets.alias("target_values"),
        F.array(*[F.lit(x) for x in forbidden]).cast("array<string>").alias("present_forbidden_columns"),
        F.array(*[F.lit(x) for x in leakage]).cast("array<string>")
        .alias("future_leakage_columns_in_model_inputs"),
        miss.alias("missing_report"), lab.alias("label_distribution"),
        cov.alias("calendar_coverage_summary"),
        F.array(*[F.lit(x) for x in dropped]).cast("array<string>").alias("columns_to_drop"),
        "row_count", F.lit(len(features.columns)).alias("column_count"))


def pii_policy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PII_POLICY, "table string, column string, pii_type string, "
                                             "decision string, reason string")


def pii_audit(spark: SparkSession, sources: dict, outputs: dict) -> DataFrame:
    """VA7: the declared policy joined to the columns actually present.

    ``sources`` / ``outputs`` map table names to DataFrames; only their
    schemas are read.  ``in_output`` flags a policy column that leaked into
    an output table.
    """
    src = [(t, c) for t, df in sources.items() for c in df.columns]
    out = [(t, c) for t, df in outputs.items() for c in df.columns]
    s = spark.createDataFrame(src, "table string, column string").withColumn("in_source", F.lit(True))
    o = (spark.createDataFrame(out, "output string, column string")
         .groupBy("column").agg(F.sort_array(F.collect_set("output")).alias("found_in_outputs")))
    return (pii_policy(spark).join(s, ["table", "column"], "left").join(o, "column", "left")
            .select("table", "column", "pii_type", "decision", "reason",
                    F.coalesce("in_source", F.lit(False)).alias("in_source"),
                    F.coalesce(F.size("found_in_outputs") > 0, F.lit(False)).alias("in_output")))


def run_artifacts(report: DataFrame, confusion: DataFrame, run_name: str, features: list[str]) -> DataFrame:
    """SK9: one row per run with its report, confusion counts and feature list,
    under a file-safe artefact name."""
    rep = report.agg(F.collect_list(F.struct(*report.columns)).alias("classification_report"))
    cm = confusion.agg(F.collect_list(F.struct(*confusion.columns)).alias("confusion_matrix"))
    return rep.select(
        F.lit(run_name).alias("run_name"),
        sanitize_run_name(F.lit(run_name)).alias("artifact_name"),
        "classification_report",
        cm.select("confusion_matrix").scalar().alias("confusion_matrix"),
        F.array(*[F.lit(f) for f in features]).alias("feature_columns"))
