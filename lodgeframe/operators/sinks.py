"""Sinks: CSV/Parquet/JSON writers and the staged refresh of a summary table.

Everything is written below a shared folder (the session's
``spark.checkpoint.dir`` unless a path is given), never a machine-local
temp folder, so a lost executor or a restarted driver sees the same files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import sort_small
from ..session import path_exists, scratch_path
from . import keyed
from . import quality as Q
from . import versions as V


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """SK1/SK5: header CSV.  ``single_file`` only for bounded outputs
    (a ~22-row summary); large outputs keep their partitioning."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_feature_set(df: DataFrame, base: str, version_col: str = "dataset_version") -> dict:
    """SK2: feature set to Parquet (partitioned by version) and CSV."""
    pq, csv = f"{base}/parquet", f"{base}/csv"
    df.write.mode("overwrite").partitionBy(version_col).parquet(pq)
    df.write.mode("overwrite").option("header", True).csv(csv)
    return {"parquet": pq, "csv": csv}


def write_json_rows(df: DataFrame, path: str) -> str:
    """SK3/SK4: one-row (or small) report frames as JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def read_feature_set(spark: SparkSession, base: str, schema=None) -> DataFrame:
    """SC2: Parquet preferred, CSV fallback, error when neither exists."""
    pq, csv = f"{base}/parquet", f"{base}/csv"
    if path_exists(spark, pq):
        return spark.read.parquet(pq)
    if path_exists(spark, csv):
        r = spark.read.option("header", True)
        return (r.schema(schema) if schema is not None else r.option("inferSchema", True)).csv(csv)
    raise FileNotFoundError(f"no feature set at {base} (parquet or csv)")


def read_json_sidecar(spark: SparkSession, path: str, schema) -> DataFrame:
    """SC5: JSON sidecar, or an empty frame with the schema when absent."""
    if path_exists(spark, path):
        return spark.read.schema(schema).option("multiLine", True).json(path)
    return spark.createDataFrame([], schema)


def refresh_summary(spark: SparkSession, summary: DataFrame, table_path: str | None = None):
    """SK7 + VA2 + VA3: stage -> validate the staged version -> commit its name.

    The summary is written as a version folder of its own, and judged by what was
    observed in the writing pass; only when the validation row passes does a log entry make it the table, so a failing
    refresh never replaces a good table -- the source replaced the view first
    and validated after -- and a reader (``versions.read_published``) sees one
    version to its end.  No data is renamed or overwritten.  Either way a report
    row is appended to ``<table>__reports`` before a failed refresh raises; a
    refused version is deleted.  Returns ``(published DataFrame, report row)``.
    """
    table_path = table_path or scratch_path(spark, "neighbourhood_summary")
    folders = []
    found = Q.observed({"summary": (summary, Q.summary_checks())}, lambda s: folders.append(V.stage_version(s["summary"], table_path)))
    folder, checks = folders[0], found["summary"]
    checks = Q.judged(spark.createDataFrame([tuple(checks.values())], ", ".join(f"{c} int" for c in checks)))
    report = checks.first()
    refresh_report(spark, checks, table_path, report["passed"]).write.mode("append").json(f"{table_path}__reports")
    if not report["passed"]:
        V.delete_folder(spark, f"{table_path}/{folder}")
    Q.gate(report)
    V.publish(spark, table_path, folder, summary.schema)
    return V.read_published(spark, table_path), report


def refresh_report(spark: SparkSession, report_row: DataFrame, target: str, passed: bool) -> DataFrame:
    """VA3: one row with the outcome of a refresh and the numbers it was judged by."""
    checks = report_row.drop("passed")
    return checks.select(F.lit(target).alias("target"), F.lit("published" if passed else "refused").alias("outcome"), *checks.columns)


def dashboard_read(summary_table: DataFrame) -> DataFrame:
    """WS3: the dashboard's eight columns, largest neighbourhoods first."""
    return summary_table.select(
        "neighbourhood", "num_listings", "avg_price", "median_price", "total_reviews",
        "reviews_per_listing", "availability_30_rate", "availability_365_rate",
    ).transform(lambda d: sort_small(d, F.desc("num_listings"), F.asc("neighbourhood")))


def dashboard_cards(summary_table: DataFrame, top_n: int = 10) -> DataFrame:
    """WS4: the five cards as long rows (card, neighbourhood, value).

    listings, average price, review activity, availability per
    neighbourhood, and the top-N table (by listings, ties by name).
    """
    s = summary_table
    cards = [
        s.select(F.lit("listings_by_neighbourhood").alias("card"), "neighbourhood",
                 F.col("num_listings").cast("double").alias("value")),
        s.select(F.lit("avg_price_by_neighbourhood").alias("card"), "neighbourhood",
                 F.col("avg_price").alias("value")),
        s.select(F.lit("reviews_by_neighbourhood").alias("card"), "neighbourhood",
                 F.col("total_reviews").cast("double").alias("value")),
        s.select(F.lit("availability_by_neighbourhood").alias("card"), "neighbourhood",
                 F.col("availability_30_rate").alias("value")),
        s.orderBy(F.desc("num_listings"), F.asc("neighbourhood")).limit(top_n)
         .select(F.lit("top_neighbourhoods").alias("card"), "neighbourhood",
                 F.col("num_listings").cast("double").alias("value")),
    ]
    out = cards[0]
    for c in cards[1:]:
        out = out.unionByName(c)
    return out


def upsert_table(spark: SparkSession, new: DataFrame, path: str, key: str = "id", order: str | None = None,
                 rows_per_bucket: int = keyed.ROWS_PER_BUCKET, limit: int | None = None, dry_run: bool = False,
                 batch: tuple[str, int] | None = None) -> int:
    """SK8 / ST1: replace rows by ``key``, keep all others (``operators/keyed.py``)."""
    return keyed.upsert(spark, new, path, key, order, rows_per_bucket, limit, dry_run, batch)


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    return keyed.read(spark, path)
