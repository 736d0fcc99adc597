"""The stored runs table (ML17) and the choices made from it (WS5, WS6).

One row per run: id, experiment, name, start time, metrics, parameters, tags,
feature columns and the folder of its artefacts. ``append`` adds runs as one
commit of a keyed table, so writers at the same time both take effect, a run
logged twice stays one row, and readers see whole commits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import sanitize_run_name
from . import keyed

SCHEMA = ("run_id string, experiment string, run_name string, start_time timestamp, metrics map<string,double>, "
          "params map<string,string>, tags map<string,string>, features array<string>, artifact_path string")
METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc")


def run_id(experiment: Column, run_name: Column, start_time: Column) -> Column:
    """An id that a repeated log of the same run gives again."""
    return F.sha2(F.concat_ws("\n", experiment, run_name, start_time.cast("string")), 256).substr(1, 32)


def append(spark: SparkSession, table: str, runs: DataFrame) -> int:
    """Log runs (the columns of ``SCHEMA``; absent ones are null, ``run_id`` is
    derived); the number of rows of the commit."""
    fields = [f.split() for f in SCHEMA.split(", ")]
    given = {c.lower() for c in runs.columns}
    made = runs.select(*(F.col(n).cast(kind).alias(n) if n in given else F.lit(None).cast(kind).alias(n) for n, kind in fields))
    made = made.withColumn("run_id", F.coalesce("run_id", run_id(F.col("experiment"), F.col("run_name"), F.col("start_time"))))
    return keyed.upsert(spark, made, table, key="run_id")


def read(spark: SparkSession, table: str) -> DataFrame:
    return keyed.read(spark, table)


def is_clean(tags: Column) -> Column:
    """No leakage, and not marked as no candidate (absent tags count for the run)."""
    return (F.coalesce(tags["uses_leakage"], F.lit("false")) != "true") & (F.coalesce(tags["clean_candidate"], F.lit("true")) == "true")


def compare(runs: DataFrame) -> DataFrame:
    """ML17: the comparison, one column per metric, tag and parameter of interest."""
    tags, params, metrics = F.col("tags"), F.col("params"), F.col("metrics")
    return runs.select("run_id", "experiment", "run_name", "start_time", tags["uses_leakage"].alias("uses_leakage"),
                       tags["clean_candidate"].alias("clean_candidate"), *(metrics[m].alias(m) for m in METRICS),
                       params["threshold"].alias("threshold"), params["model_type"].alias("model_type"),
                       F.coalesce(params["feature_count"], F.size("features").cast("string")).alias("feature_count"))


def best(runs: DataFrame) -> DataFrame:
    """WS5: per experiment the clean candidate of best F1 (ties: the first name);
    experiments without a clean run have no row."""
    f1 = F.col("metrics")["f1"]
    order = Window.partitionBy("experiment").orderBy(F.desc_nulls_last(f1), F.asc("run_name"), F.asc("run_id"))
    clean = runs.where(is_clean(F.col("tags")))
    return clean.withColumn("place", F.row_number().over(order)).where("place = 1").select("experiment", "run_id", "run_name", f1.alias("f1"))


def serving(runs: DataFrame) -> DataFrame:
    """WS6: per experiment the run to serve, from the first tier that has one:
    1 runs tagged as selected, by F1; 2 runs without leakage, by F1; 3 any run,
    the most recent first."""
    tags, f1 = F.col("tags"), F.col("metrics")["f1"]
    selected = F.coalesce(tags["selected_for_serving"], tags["selected"], F.lit("false")) == "true"
    tier = F.when(selected, 1).when(F.coalesce(tags["uses_leakage"], F.lit("false")) != "true", 2).otherwise(3)
    order = Window.partitionBy("experiment").orderBy(
        "tier", F.desc_nulls_last(F.when(F.col("tier") < 3, f1)),
        F.desc_nulls_last(F.when(F.col("tier") == 3, F.col("start_time"))), F.asc("run_name"), F.asc("run_id"))
    ranked = runs.withColumn("tier", tier).withColumn("place", F.row_number().over(order))
    return ranked.where("place = 1").select("experiment", "run_id", "run_name", "tier", f1.alias("f1"))


def write_artifacts(report: DataFrame, confusion: DataFrame, features: list[str], metadata: DataFrame, run_name: str, base: str) -> str:
    """SK9: classification report, confusion matrix, feature columns and dataset
    metadata of one run, as JSON below a folder with a file-safe name; the folder.
    All four are bounded tables (classes, cells, columns, one row)."""
    spark = report.sparkSession
    safe = spark.range(1).select(sanitize_run_name(F.lit(run_name))).first()[0]
    folder = f"{base.rstrip('/')}/{safe}"
    columns = spark.createDataFrame([(features,)], "feature_columns array<string>")
    for name, part in (("classification_report", report), ("confusion_matrix", confusion), ("feature_columns", columns),
                       ("dataset_metadata_snapshot", metadata)):
        part.coalesce(1).write.mode("overwrite").json(f"{folder}/{name}.json")
    return folder
