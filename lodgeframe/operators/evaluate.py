"""Model evaluation over scored tables: confusion counts, metrics, threshold
sweep, ROC AUC, classification report, runs table and run choice.

All metrics come from a handful of conditional counts computed in **one**
aggregation (map-side partial aggregation, one tiny shuffle), so they
scale with the scored table.  The threshold sweep adds one set of counts
per threshold to the same aggregation instead of crossing the scores
with a thresholds table.  The AUC uses the rank formula with average
ranks for ties over distinct scores, with distributed prefix sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import sort_small
from .ranking import exclusive_prefix_sums

# The sweep grid and the serving threshold of the source.
SWEEP_THRESHOLDS = (0.30, 0.40, 0.50, 0.60, 0.70)
DEFAULT_THRESHOLD = 0.5


def _cnt(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def _safe_div(a: Column, b: Column) -> Column:
    """zero_division = 0"""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _count_cols(label: str, score: str, t: float, sfx: str = "") -> list[Column]:
    y, p = F.col(label) == 1, F.col(score) >= F.lit(t)
    return [_cnt(~y & ~p).alias(f"tn{sfx}"), _cnt(~y & p).alias(f"fp{sfx}"),
            _cnt(y & ~p).alias(f"fn{sfx}"), _cnt(y & p).alias(f"tp{sfx}")]


def _metrics_from_counts(tn, fp, fn, tp) -> list[Column]:
    n = tn + fp + fn + tp
    return [
        _safe_div(tp + tn, n).alias("accuracy"),
        _safe_div(tp, tp + fp).alias("precision"),
        _safe_div(tp, tp + fn).alias("recall"),
        _safe_div(F.lit(2) * tp, F.lit(2) * tp + fp + fn).alias("f1"),
    ]


def confusion_counts(scored: DataFrame, label: str = "label", score: str = "score",
                     threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """One row: tn, fp, fn, tp at ``score >= threshold``."""
    return scored.agg(*_count_cols(label, score, threshold))


def confusion_matrix(scored: DataFrame, label: str = "label", score: str = "score",
                     threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """ML16: the 2x2 counts as rows (y, yhat, n), zero cells included."""
    c = confusion_counts(scored, label, score, threshold)
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    arr = F.array(*[F.struct(F.lit(y).alias("y"), F.lit(h).alias("yhat"), F.col(k).alias("n"))
                    for y, h, k in cells])
    return c.select(F.explode(arr).alias("r")).select("r.*")


def binary_metrics(scored: DataFrame, label: str = "label", score: str = "score",
                   threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """ML13: accuracy, precision, recall, F1 (zero_division=0) as one row."""
    c = confusion_counts(scored, label, score, threshold)
    return c.select(F.lit(threshold).alias("threshold"), "tn", "fp", "fn", "tp",
                    *_metrics_from_counts(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")))


def threshold_sweep(scored: DataFrame, thresholds=SWEEP_THRESHOLDS, label: str = "label",
                    score: str = "score") -> DataFrame:
    """ML12/WS8: metrics at every threshold from ONE aggregation, sorted by F1."""
    cols = []
    for i, t in enumerate(thresholds):
        cols += _count_cols(label, score, t, f"_{i}")
    one = scored.agg(*cols)
    rows = []
    for i, t in enumerate(thresholds):
        tn, fp, fn, tp = (F.col(f"{k}_{i}") for k in ("tn", "fp", "fn", "tp"))
        rows.append(F.struct(F.lit(float(t)).alias("threshold"), tn.alias("tn"), fp.alias("fp"),
                             fn.alias("fn"), tp.alias("tp"), *_metrics_from_counts(tn, fp, fn, tp)))
    return sort_small(one.select(F.explode(F.array(*rows)).alias("r")).select("r.*"),
                      F.desc("f1"), F.asc("threshold"))


def classification_report(scored: DataFrame, label: str = "label", score: str = "score",
                          threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """ML15: per class, macro avg, weighted avg and accuracy rows.

    Columns: class, precision, recall, f1_score, support (sklearn layout;
    the accuracy row carries accuracy in precision/recall/f1 like
    sklearn's single value, support = all rows).
    """
    c = confusion_counts(scored, label, score, threshold)
    tn, fp, fn, tp = (F.col(k) for k in ("tn", "fp", "fn", "tp"))
    s0, s1 = tn + fp, fn + tp
    p1, r1 = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
    f1_1 = _safe_div(F.lit(2) * tp, F.lit(2) * tp + fp + fn)
    p0, r0 = _safe_div(tn, tn + fn), _safe_div(tn, tn + fp)
    f1_0 = _safe_div(F.lit(2) * tn, F.lit(2) * tn + fn + fp)
    n = s0 + s1
    acc = _safe_div(tp + tn, n)

    def w(a, b):
        return _safe_div(a * s0.cast("double") + b * s1.cast("double"), n)

    rows = [("0", p0, r0, f1_0, s0), ("1", p1, r1, f1_1, s1),
            ("accuracy", acc, acc, acc, n),
            ("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, n),
            ("weighted avg", w(p0, p1), w(r0, r1), w(f1_0, f1_1), n)]
    arr = F.array(*[F.struct(F.lit(k).alias("class"), p.alias("precision"), r.alias("recall"),
                             f.alias("f1_score"), s.cast("bigint").alias("support"))
                    for k, p, r, f, s in rows])
    return c.select(F.explode(arr).alias("r")).select("r.*")


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score",
            n_partitions: int | None = None) -> DataFrame:
    """ML14: rank-based ROC AUC with average ranks for ties (exact).

    AUC = sum_s pos(s) * (neg_below(s) + neg(s)/2) / (P * N) over distinct
    scores s.  Scores are first aggregated per distinct value; the running
    negative count is a distributed prefix sum (no single-task window).
    """
    d = scored.groupBy(score).agg(
        F.count(F.when(F.col(label) == 1, F.lit(1))).cast("double").alias("pos"),
        F.count(F.when(F.col(label) != 1, F.lit(1))).cast("double").alias("neg"))
    pre = exclusive_prefix_sums(d, [], [score], ["neg"], n_partitions)
    u = pre.agg(F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") * 0.5)).alias("u"),
                F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    return u.select(F.try_divide(F.col("u"), F.col("n_pos") * F.col("n_neg")).alias("roc_auc"),
                    F.col("n_pos").cast("bigint").alias("n_pos"),
                    F.col("n_neg").cast("bigint").alias("n_neg"))


def class_weights(labels: DataFrame, label: str = "label") -> DataFrame:
    """ML9: balanced weights n / (k * n_c) per class."""
    g = labels.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    tot = labels.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(label).alias("k"))
    n, k = tot.select("n").scalar(), tot.select("k").scalar()
    return g.select(label, "n_c",
                    (n.cast("double") / (k.cast("double") * F.col("n_c").cast("double"))).alias("weight"))


def majority_class(train: DataFrame, label: str = "label") -> DataFrame:
    """ML10: most frequent class of the training split (ties -> smallest)."""
    return (train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
                 .orderBy(F.desc("n"), F.asc(label)).limit(1)
                 .select(F.col(label).alias("majority_class"), "n"))


def dummy_scores(test: DataFrame, train: DataFrame, label: str = "label",
                 key: str = "key") -> DataFrame:
    """ML10: score every test row with the majority class (one-hot probability)."""
    maj = majority_class(train, label).select("majority_class").scalar()
    return test.select(key, label, maj.cast("double").alias("score"))


def agreement(predicted: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """VA8: rows, predictions equal to the label, and their share, as one row."""
    same = F.count_if(F.col(prediction) == F.col(label))
    return predicted.agg(F.count(F.lit(1)).alias("rows"), same.alias("matches"),
                         F.try_divide(same.cast("double"), F.count(F.lit(1)).cast("double")).alias("agreement"))


def threshold_labels(scored: DataFrame, threshold: float = DEFAULT_THRESHOLD,
                     score: str = "score") -> DataFrame:
    """FN8: decision and label text at ``score >= threshold``."""
    from ..functions.scalar import threshold_label
    return scored.withColumn("prediction", (F.col(score) >= F.lit(threshold)).cast("int")) \
                 .withColumn("prediction_label", threshold_label(score, threshold))


# -- runs table -------------------------------------------------------------------------

def runs_from_sweep(sweep: DataFrame, base_name: str = "v4_balanced_logistic_threshold",
                    uses_leakage: bool = False) -> DataFrame:
    """ML17: one run row per swept threshold (metrics/params/tags as maps)."""
    name = F.concat(F.lit(base_name + "_"), F.format_number(F.col("threshold"), 2))
    return sweep.select(
        F.sha2(name, 256).substr(1, 32).alias("run_id"),
        name.alias("run_name"),
        F.map_from_arrays(F.array(*[F.lit(k) for k in ("accuracy", "precision", "recall", "f1")]),
                          F.array("accuracy", "precision", "recall", "f1")).alias("metrics"),
        F.create_map(F.lit("threshold"), F.format_number(F.col("threshold"), 2)).alias("params"),
        F.create_map(F.lit("uses_leakage"), F.lit(str(uses_leakage).lower()),
                     F.lit("selected"), F.lit("false")).alias("tags"))


def runs_compare(runs: DataFrame) -> DataFrame:
    """ML17 comparison projection: one column per metric and the tags."""
    return runs.select(
        "run_name",
        F.col("metrics")["accuracy"].alias("accuracy"),
        F.col("metrics")["precision"].alias("precision"),
        F.col("metrics")["recall"].alias("recall"),
        F.col("metrics")["f1"].alias("f1"),
        F.col("tags")["uses_leakage"].alias("uses_leakage"))


def select_best_run(runs: DataFrame) -> DataFrame:
    """WS5: the best clean run by F1 (nulls last), run name as tie-break."""
    return (runs.where(F.coalesce(F.col("tags")["uses_leakage"], F.lit("false")) != "true")
                .orderBy(F.desc_nulls_last(F.col("metrics")["f1"]), F.asc("run_name"))
                .limit(1).select("run_name", F.col("metrics")["f1"].alias("f1")))


def select_serving_run(runs: DataFrame) -> DataFrame:
    """WS6: tier 1 = tagged selected, tier 2 = not leaky (best F1), tier 3 = most recent."""
    tags = F.col("tags")
    tier = (F.when(tags["selected"] == "true", F.lit(1))
             .when(F.coalesce(tags["uses_leakage"], F.lit("false")) != "true", F.lit(2))
             .otherwise(F.lit(3)))
    f1 = F.col("metrics")["f1"]
    return (runs.withColumn("tier", tier)
                .orderBy(F.asc("tier"), F.desc_nulls_last(F.when(F.col("tier") < 3, f1)),
                         F.desc_nulls_last("start_time") if "start_time" in runs.columns else F.asc("run_name"),
                         F.asc("run_name"))
                .limit(1).select("run_name", "tier", f1.alias("f1")))


def latency_summary(events: DataFrame, group: str, value: str,
                    quantiles=(0.5, 0.95, 0.99), n_partitions: int | None = None,
                    ts: str | None = None) -> DataFrame:
    """AG19: count, total, elapsed time and rate, and upper-nearest-rank
    percentiles ``sorted[int(n*q)]`` per group.

    ``elapsed_s`` is the span of ``ts`` (first to last event) and
    ``rate_per_s`` = n / elapsed, the load test's requests per second.

    The percentile rows are found with distributed exact ranks; a hot
    group is split across range partitions rather than sorted in one task.
    """
    from .ranking import rank_within_groups
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")]
    if ts is not None:
        aggs.append((F.timestamp_diff("MICROSECOND", F.min(ts), F.max(ts)) / 1e6).alias("elapsed_s"))
    counts = events.groupBy(group).agg(*aggs)
    if ts is not None:
        counts = counts.withColumn("rate_per_s", F.try_divide(F.col("n").cast("double"),
                                                              F.col("elapsed_s")))
    ranked = rank_within_groups(events.select(group, value), [group], [value], n_partitions)
    targets = [F.struct(F.lit(f"p{int(round(q * 100))}").alias("q"),
                        (F.least(F.floor(F.col("n") * F.lit(q)), F.col("n") - 1) + 1).cast("bigint")
                        .alias("rank")) for q in quantiles]
    want = counts.select(group, F.explode(F.array(*targets)).alias("t")).select(group, "t.q", "t.rank")
    hits = want.join(ranked, [group, "rank"], "inner")
    piv = hits.groupBy(group).pivot("q", [f"p{int(round(q * 100))}" for q in quantiles]).agg(F.first(value))
    return counts.join(piv, group, "left")
