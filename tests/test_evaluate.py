"""Golden metrics from published confusion counts, plus brute-force checks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgeframe.operators import evaluate as EV
from lodgeframe.operators.ranking import exclusive_prefix_sums, rank_within_groups

# Confusion counts (TN, FP, FN, TP) and published class-1 metrics
# (accuracy, precision, recall, f1), rounded to 4 places.
GOLDEN = {
    "v0_leaky_logistic_regression": ((497, 0, 0, 1599), (1.0, 1.0, 1.0, 1.0)),
    "v1_dummy_baseline": ((0, 497, 0, 1599), (0.7629, 0.7629, 1.0, 0.8655)),
    "v2_clean_logistic_regression": ((458, 39, 11, 1588), (0.9761, 0.9760, 0.9931, 0.9845)),
    "v3_balanced_logistic_regression": ((467, 30, 18, 1581), (0.9771, 0.9814, 0.9887, 0.9850)),
    "v4_balanced_logistic_threshold_0.30": ((461, 36, 12, 1587), (0.9771, 0.9778, 0.9925, 0.9851)),
    "v4_balanced_logistic_threshold_0.40": ((465, 32, 14, 1585), (0.9781, 0.9802, 0.9912, 0.9857)),
    "v4_balanced_logistic_threshold_0.60": ((469, 28, 20, 1579), (0.9771, 0.9826, 0.9875, 0.9850)),
    "v4_balanced_logistic_threshold_0.70": ((473, 24, 20, 1579), (0.9790, 0.9850, 0.9875, 0.9863)),
    "v5_random_forest": ((475, 22, 13, 1586), (0.9833, 0.9863, 0.9919, 0.9891)),
}


def scored_from_counts(spark, tn, fp, fn, tp):
    parts = [(tn, 0, 0.0), (fp, 0, 1.0), (fn, 1, 0.0), (tp, 1, 1.0)]
    df = None
    for n, y, s in parts:
        p = spark.range(n).select(F.lit(y).alias("label"), F.lit(s).alias("score"))
        df = p if df is None else df.unionByName(p)
    return df


@pytest.mark.parametrize("run", sorted(GOLDEN))
def test_golden_metrics(spark, run):
    counts, expected = GOLDEN[run]
    r = EV.binary_metrics(scored_from_counts(spark, *counts)).first()
    got = tuple(round(r[k], 4) for k in ("accuracy", "precision", "recall", "f1"))
    assert got == expected


def test_zero_division_class0_of_dummy(spark):
    rep = {r["class"]: r for r in EV.classification_report(scored_from_counts(spark, 0, 497, 0, 1599)).collect()}
    assert rep["0"]["precision"] == 0.0 and rep["0"]["recall"] == 0.0 and rep["0"]["f1_score"] == 0.0
    assert rep["0"]["support"] == 497 and rep["1"]["support"] == 1599
    assert round(rep["weighted avg"]["f1_score"], 4) == round(0.8655 * 1599 / 2096, 4)


def _auc_brute(y, s):
    pos, neg = s[y == 1], s[y == 0]
    cmp = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return cmp / (len(pos) * len(neg))


def test_auc_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.random(400), 2)          # many ties
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    got = EV.roc_auc(df, n_partitions=7).first()["roc_auc"]
    assert abs(got - _auc_brute(y, s)) < 1e-12


def test_rank_within_groups_matches_sort(spark):
    rng = np.random.default_rng(5)
    rows = [(int(g), float(v), i) for i, (g, v) in enumerate(zip(rng.integers(0, 3, 300), rng.random(300)))]
    rows += [(9, 0.5, 1000 + i) for i in range(200)]      # one hot group, all ties
    df = spark.createDataFrame(rows, "g int, v double, id int")
    got = {r["id"]: r["rank"] for r in rank_within_groups(df, ["g"], ["v", "id"], 6).collect()}
    for g in {r[0] for r in rows}:
        members = sorted((v, i) for gg, v, i in rows if gg == g)
        assert [got[i] for _, i in members] == list(range(1, len(members) + 1))


def test_prefix_sums_match_cumsum(spark):
    rng = np.random.default_rng(7)
    rows = [(int(g), i, float(w)) for i, (g, w) in enumerate(zip(rng.integers(0, 4, 500), rng.random(500)))]
    df = spark.createDataFrame(rows, "g int, o int, w double")
    got = {r["o"]: r["w_before"] for r in exclusive_prefix_sums(df, ["g"], ["o"], ["w"], 5).collect()}
    acc = {}
    for g, o, w in sorted(rows, key=lambda r: (r[0], r[1])):
        assert abs(got[o] - acc.get(g, 0.0)) < 1e-9
        acc[g] = acc.get(g, 0.0) + w


def test_threshold_sweep_single_pass_equals_per_threshold(spark):
    df = spark.range(1000).select((F.col("id") % 2).cast("int").alias("label"),
                                  ((F.col("id") * 7919 % 1000) / 1000.0).alias("score"))
    sweep = {r["threshold"]: r for r in EV.threshold_sweep(df).collect()}
    for t in EV.SWEEP_THRESHOLDS:
        one = EV.binary_metrics(df, threshold=t).first()
        assert sweep[t]["f1"] == one["f1"] and sweep[t]["tp"] == one["tp"]


def test_latency_percentiles_upper_nearest_rank(spark):
    vals = list(range(1, 101))
    df = spark.createDataFrame([("a", float(v)) for v in vals], "g string, v double")
    r = EV.latency_summary(df, "g", "v").first()
    assert (r["p50"], r["p95"], r["p99"]) == (51.0, 96.0, 100.0)   # sorted[int(n*q)]


def test_select_runs(spark):
    runs = spark.createDataFrame(
        [("leaky", {"f1": 1.0}, {"uses_leakage": "true"}), ("a", {"f1": 0.9}, {"uses_leakage": "false"}),
         ("b", {"f1": 0.95}, {"uses_leakage": "false"})],
        "run_name string, metrics map<string,double>, tags map<string,string>")
    assert EV.select_best_run(runs).first()["run_name"] == "b"
    assert EV.select_best_run(runs.where("run_name = 'leaky'")).count() == 0
    assert EV.select_serving_run(runs).first()["run_name"] == "b"


def test_rank_hot_group_with_one_repeated_value_spreads(spark):
    # a third of the rows share one group AND one value
    from pyspark.sql import functions as F
    hot = spark.range(3000).select(F.lit(7).alias("g"), F.lit(1.0).alias("v"), F.col("id"))
    cold = spark.range(6000).select((F.col("id") % 5).cast("int").alias("g"),
                                    (F.col("id") / 7.0).alias("v"), (F.col("id") + 10_000).alias("id"))
    df = hot.unionByName(cold)
    r = rank_within_groups(df, ["g"], ["v"], n_partitions=6)
    got = r.where("g = 7").select("rank").collect()
    assert sorted(x["rank"] for x in got) == list(range(1, 3001))
    # the repeated value is spread over several range partitions (tie-break id)
    from lodgeframe.operators import ranking
    probe = df.withColumn("_tb", F.monotonically_increasing_id())
    parts = (ranking._range_partition(probe, 6, ["g", "v", "_tb"])
             .where("g = 7").select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts > 1
