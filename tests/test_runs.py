"""The stored runs table: repeated logs, writers at the same time, all tiers of the choice, artefacts."""

import threading

from pyspark.sql import functions as F

from lodgeframe.operators import evaluate as EV
from lodgeframe.operators import runs as R
from lodgeframe.session import scratch_path

COLUMNS = "experiment string, run_name string, start_time timestamp, metrics map<string,double>, tags map<string,string>"


def logged(spark, rows):
    table = scratch_path(spark, "runs_test")
    df = spark.createDataFrame(rows, "experiment string, run_name string, day int, metrics map<string,double>, tags map<string,string>")
    R.append(spark, table, df.withColumn("start_time", F.timestamp_add("DAY", F.col("day"), F.lit("2024-01-01").cast("timestamp"))).drop("day"))
    return table


def test_tiers_and_clean_candidates(spark):
    table = logged(spark, [
        ("a", "picked", 1, {"f1": 0.2}, {"selected_for_serving": "true", "uses_leakage": "true"}),
        ("a", "picked less", 1, {"f1": 0.1}, {"selected_for_serving": "true"}), ("a", "clean", 1, {"f1": 0.9}, {}),
        ("b", "leaky", 1, {"f1": 1.0}, {"uses_leakage": "true"}), ("b", "withdrawn", 1, {"f1": 0.8}, {"clean_candidate": "false"}),
        ("b", "good", 1, {"f1": 0.7}, {"uses_leakage": "false"}), ("b", "no f1", 1, {}, None),
        ("c", "old", 1, {"f1": 0.9}, {"uses_leakage": "true"}), ("c", "new", 5, {"f1": 0.1}, {"uses_leakage": "true"})])
    runs = R.read(spark, table)
    assert {r.experiment: (r.run_name, r.tier) for r in R.serving(runs).collect()} == {"a": ("picked", 1), "b": ("withdrawn", 2), "c": ("new", 3)}
    assert {r.experiment: r.run_name for r in R.best(runs).collect()} == {"a": "clean", "b": "good"}
    assert R.compare(runs).count() == 9 and {"roc_auc", "feature_count", "model_type"} <= set(R.compare(runs).columns)


def test_a_run_logged_twice_is_one_row(spark):
    row = [("a", "one", 1, {"f1": 0.5}, {})]
    table = logged(spark, row)
    again = R.read(spark, table)
    R.append(spark, table, again)
    R.append(spark, table, again.drop("run_id"))
    assert R.read(spark, table).count() == 1


def test_writers_at_the_same_time(spark):
    table, errors = logged(spark, [("a", "first", 1, {"f1": 0.5}, {})]), []

    def write(k):
        try:
            rows = spark.createDataFrame([("a", f"run {k}", {"f1": k / 10})], "experiment string, run_name string, metrics map<string,double>")
            R.append(spark, table, rows)
        except Exception as e:
            errors.append(e)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(5)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors and R.read(spark, table).count() == 6


def test_artifacts_are_written(spark):
    scores = spark.createDataFrame([(1, 0.9), (0, 0.2), (1, 0.3)], "label int, score double")
    folder = R.write_artifacts(EV.classification_report(scores), EV.confusion_matrix(scores), ["a", "b"],
                               spark.createDataFrame([("v1", 3)], "dataset_version string, rows int"), "v4 run/1", scratch_path(spark, "artifacts"))
    assert folder.endswith("/v4_run_1")
    assert spark.read.json(f"{folder}/feature_columns.json").first().feature_columns == ["a", "b"]
    assert spark.read.json(f"{folder}/confusion_matrix.json").agg(F.sum("n")).first()[0] == 3
    assert spark.read.json(f"{folder}/classification_report.json").count() == 5
    assert spark.read.json(f"{folder}/dataset_metadata_snapshot.json").first().rows == 3
