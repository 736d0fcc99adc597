"""Registered evaluation queries over the ``scores`` stand-in, with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import round_half_up, sigmoid, threshold_label
from ..operators import evaluate as EV
from ..operators import runs as R
from ..session import scratch_path
from ..sources.standin import StandIn
from .oracle_sql import rnd, with_views


def _scores(spark, sf_dir):
    return StandIn(spark, sf_dir).scores()


def q_confusion_matrix(spark, sf_dir):
    return EV.confusion_matrix(_scores(spark, sf_dir))


def q_binary_metrics(spark, sf_dir):
    return EV.binary_metrics(_scores(spark, sf_dir))


def q_classification_report(spark, sf_dir):
    return EV.classification_report(_scores(spark, sf_dir))


def q_roc_auc(spark, sf_dir):
    return EV.roc_auc(_scores(spark, sf_dir)).select(
        round_half_up("roc_auc", 8).alias("roc_auc"), "n_pos", "n_neg")


def q_threshold_sweep(spark, sf_dir):
    return EV.threshold_sweep(_scores(spark, sf_dir))


def q_sigmoid_scores(spark, sf_dir):
    s = _scores(spark, sf_dir)
    return s.select("key", round_half_up(sigmoid((F.col("score") - 0.5) * 10), 6).alias("probability"))


def q_threshold_label(spark, sf_dir):
    s = _scores(spark, sf_dir)
    return s.select("key", (F.col("score") >= 0.5).cast("int").alias("prediction"),
                    threshold_label("score", 0.5).alias("prediction_label"))


def q_class_weights(spark, sf_dir):
    return EV.class_weights(_scores(spark, sf_dir))


def q_runs_compare(spark, sf_dir):
    return EV.runs_compare(EV.runs_from_sweep(EV.threshold_sweep(_scores(spark, sf_dir))))


def q_select_best_run(spark, sf_dir):
    return EV.select_best_run(EV.runs_from_sweep(EV.threshold_sweep(_scores(spark, sf_dir))))


def q_select_serving_run(spark, sf_dir):
    return EV.select_serving_run(EV.runs_from_sweep(EV.threshold_sweep(_scores(spark, sf_dir))))


def _logged(spark, sf_dir):
    """Three experiments in a stored runs table, one append (and writer) each: all
    thresholds with one selected; clean, leaky and withdrawn runs; leaky runs only."""
    scores = _scores(spark, sf_dir)
    sweep = EV.threshold_sweep(scores)
    auc = EV.roc_auc(scores).select("roc_auc").first()[0]
    table = scratch_path(spark, "runs_table")
    step = F.round(F.col("threshold") * 100).cast("int")
    leaky, withdrawn, chosen = step >= 50, step % 20 == 0, step == 30
    for number, (name, tags) in enumerate((
            ("selected", {"uses_leakage": F.lit(False), "clean_candidate": F.lit(True), "selected_for_serving": chosen}),
            ("unselected", {"uses_leakage": leaky, "clean_candidate": ~withdrawn}),
            ("leaky", {"uses_leakage": F.lit(True)}))):
        text = lambda flag: F.when(flag, F.lit("true")).otherwise(F.lit("false"))
        R.append(spark, table, sweep.select(
            F.lit(name).alias("experiment"), F.concat(F.lit(f"v{number}_threshold_"), F.format_number("threshold", 2)).alias("run_name"),
            F.timestamp_add("MINUTE", (step * 37) % 101, F.lit("2024-05-01 00:00:00").cast("timestamp")).alias("start_time"),
            F.map_from_arrays(F.array(*map(F.lit, R.METRICS)), F.array("accuracy", "precision", "recall", "f1", F.lit(auc))).alias("metrics"),
            F.create_map(F.lit("threshold"), F.format_number("threshold", 2), F.lit("model_type"), F.lit("event_score")).alias("params"),
            F.create_map(*(x for k, flag in tags.items() for x in (F.lit(k), text(flag)))).alias("tags"),
            F.array(F.lit("score")).alias("features")))
    return R.read(spark, table)


def q_runs_table(spark, sf_dir):
    """ML17: the stored runs, compared."""
    return R.compare(_logged(spark, sf_dir)).drop("run_id").withColumn("roc_auc", round_half_up("roc_auc", 8))


def q_runs_best(spark, sf_dir):
    """WS5: the best clean candidate of each experiment."""
    return R.best(_logged(spark, sf_dir)).drop("run_id")


def q_runs_serving(spark, sf_dir):
    """WS6: the run to serve of each experiment; the three experiments end in the three tiers."""
    return R.serving(_logged(spark, sf_dir)).drop("run_id")


def q_latency_percentiles(spark, sf_dir):
    ev = StandIn(spark, sf_dir).raw.events
    out = EV.latency_summary(ev, "event_type", "value", ts="ts")
    return (out.withColumn("total", round_half_up("total", 4))
               .withColumn("rate_per_s", round_half_up("rate_per_s", 6)))


QUERIES = {
    "confusion_matrix": q_confusion_matrix,
    "binary_metrics": q_binary_metrics,
    "classification_report": q_classification_report,
    "roc_auc": q_roc_auc,
    "threshold_sweep": q_threshold_sweep,
    "sigmoid_scores": q_sigmoid_scores,
    "threshold_label": q_threshold_label,
    "class_weights": q_class_weights,
    "runs_compare": q_runs_compare,
    "select_best_run": q_select_best_run,
    "select_serving_run": q_select_serving_run,
    "runs_table": q_runs_table,
    "runs_best": q_runs_best,
    "runs_serving": q_runs_serving,
    "latency_percentiles": q_latency_percentiles,
}

_CNT = ("cnt", """
    SELECT count(*) FILTER (WHERE label <> 1 AND NOT score >= {t}) AS tn,
           count(*) FILTER (WHERE label <> 1 AND score >= {t}) AS fp,
           count(*) FILTER (WHERE label = 1 AND NOT score >= {t}) AS fn,
           count(*) FILTER (WHERE label = 1 AND score >= {t}) AS tp
    FROM scores""")


def _sd(a, b):
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0.0)"


_MET = (f"{_sd('tp + tn', 'tn + fp + fn + tp')} AS accuracy, {_sd('tp', 'tp + fp')} AS precision, "
        f"{_sd('tp', 'tp + fn')} AS recall, {_sd('2 * tp', '2 * tp + fp + fn')} AS f1")


def _cnt(t):
    return (_CNT[0], _CNT[1].format(t=t))


def _sweep_sql():
    parts = [f"SELECT CAST({t} AS DOUBLE) AS threshold, tn, fp, fn, tp, {_MET} FROM ({_CNT[1].format(t=t)}) c"
             for t in EV.SWEEP_THRESHOLDS]
    return " UNION ALL ".join(parts)


_SWEEP = ("sweep", _sweep_sql())
_RUNS = ("runs", """
    SELECT 'v4_balanced_logistic_threshold_' || printf('%.2f', threshold) AS run_name,
           accuracy, precision, recall, f1, 'false' AS uses_leakage FROM sweep""")

_AUC = f"""
        SELECT {rnd('u / (n_pos * n_neg)', 8)} AS roc_auc
        FROM (SELECT sum(pos * (coalesce(neg_before, 0) + neg * 0.5)) AS u, sum(pos) AS n_pos, sum(neg) AS n_neg
              FROM (SELECT pos, neg, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS neg_before
                    FROM (SELECT score, CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS pos,
                                 CAST(count(*) FILTER (WHERE label <> 1) AS DOUBLE) AS neg
                          FROM scores GROUP BY score) d) p) a"""
_LOGGED = ("logged", f"""
    SELECT e.experiment, 'v' || e.number || '_threshold_' || printf('%.2f', threshold) AS run_name,
           TIMESTAMP '2024-05-01 00:00:00' + to_minutes(CAST((CAST(round(threshold * 100) AS INTEGER) * 37) % 101 AS INTEGER)) AS start_time,
           CASE e.experiment WHEN 'selected' THEN 'false' WHEN 'leaky' THEN 'true'
                             ELSE CASE WHEN round(threshold * 100) >= 50 THEN 'true' ELSE 'false' END END AS uses_leakage,
           CASE e.experiment WHEN 'selected' THEN 'true'
                             WHEN 'unselected' THEN CASE WHEN round(threshold * 100) % 20 = 0 THEN 'false' ELSE 'true' END END AS clean_candidate,
           e.experiment = 'selected' AND round(threshold * 100) = 30 AS chosen,
           accuracy, precision, recall, f1, (SELECT roc_auc FROM auc) AS roc_auc,
           printf('%.2f', threshold) AS threshold, 'event_score' AS model_type, '1' AS feature_count
    FROM sweep, (VALUES (0, 'selected'), (1, 'unselected'), (2, 'leaky')) e(number, experiment)""")

ORACLES = {
    "runs_table": with_views("SELECT * EXCLUDE (chosen) FROM logged", ("scores",), (_SWEEP, ("auc", _AUC), _LOGGED)),
    "runs_best": with_views("""
        SELECT experiment, run_name, f1 FROM logged WHERE uses_leakage = 'false' AND clean_candidate = 'true'
        QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY f1 DESC NULLS LAST, run_name) = 1""",
        ("scores",), (_SWEEP, ("auc", _AUC), _LOGGED)),
    "runs_serving": with_views("""
        SELECT experiment, run_name, tier, f1 FROM (
          SELECT 'selected' AS experiment, run_name, 1 AS tier, f1 FROM logged WHERE chosen
          UNION ALL (SELECT experiment, run_name, 2, f1 FROM logged WHERE experiment = 'unselected' AND uses_leakage = 'false'
                     ORDER BY f1 DESC NULLS LAST, run_name LIMIT 1)
          UNION ALL (SELECT experiment, run_name, 3, f1 FROM logged WHERE experiment = 'leaky' ORDER BY start_time DESC, run_name LIMIT 1)) t""",
        ("scores",), (_SWEEP, ("auc", _AUC), _LOGGED)),
    "confusion_matrix": with_views("""
        SELECT 0 AS y, 0 AS yhat, tn AS n FROM cnt UNION ALL SELECT 0, 1, fp FROM cnt
        UNION ALL SELECT 1, 0, fn FROM cnt UNION ALL SELECT 1, 1, tp FROM cnt""",
        ("scores",), (_cnt(0.5),)),
    "binary_metrics": with_views(f"SELECT CAST(0.5 AS DOUBLE) AS threshold, tn, fp, fn, tp, {_MET} FROM cnt",
                                 ("scores",), (_cnt(0.5),)),
    "classification_report": with_views(f"""
        SELECT * FROM (
          SELECT '0' AS class, {_sd('tn', 'tn + fn')} AS precision, {_sd('tn', 'tn + fp')} AS recall,
                 {_sd('2 * tn', '2 * tn + fn + fp')} AS f1_score, tn + fp AS support FROM cnt
          UNION ALL
          SELECT '1', {_sd('tp', 'tp + fp')}, {_sd('tp', 'tp + fn')}, {_sd('2 * tp', '2 * tp + fp + fn')},
                 fn + tp FROM cnt
          UNION ALL
          SELECT 'accuracy', {_sd('tp + tn', 'tn + fp + fn + tp')}, {_sd('tp + tn', 'tn + fp + fn + tp')},
                 {_sd('tp + tn', 'tn + fp + fn + tp')}, tn + fp + fn + tp FROM cnt
          UNION ALL
          SELECT 'macro avg', ({_sd('tn', 'tn + fn')} + {_sd('tp', 'tp + fp')}) / 2,
                 ({_sd('tn', 'tn + fp')} + {_sd('tp', 'tp + fn')}) / 2,
                 ({_sd('2 * tn', '2 * tn + fn + fp')} + {_sd('2 * tp', '2 * tp + fp + fn')}) / 2,
                 tn + fp + fn + tp FROM cnt
          UNION ALL
          SELECT 'weighted avg',
                 {_sd(f"{_sd('tn', 'tn + fn')} * CAST(tn + fp AS DOUBLE) + {_sd('tp', 'tp + fp')} * CAST(fn + tp AS DOUBLE)", 'tn + fp + fn + tp')},
                 {_sd(f"{_sd('tn', 'tn + fp')} * CAST(tn + fp AS DOUBLE) + {_sd('tp', 'tp + fn')} * CAST(fn + tp AS DOUBLE)", 'tn + fp + fn + tp')},
                 {_sd(f"{_sd('2 * tn', '2 * tn + fn + fp')} * CAST(tn + fp AS DOUBLE) + {_sd('2 * tp', '2 * tp + fp + fn')} * CAST(fn + tp AS DOUBLE)", 'tn + fp + fn + tp')},
                 tn + fp + fn + tp FROM cnt) t""", ("scores",), (_cnt(0.5),)),
    "roc_auc": with_views(f"""
        SELECT {rnd('u / (n_pos * n_neg)', 8)} AS roc_auc,
               CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg
        FROM (SELECT sum(pos * (coalesce(neg_before, 0) + neg * 0.5)) AS u,
                     sum(pos) AS n_pos, sum(neg) AS n_neg
              FROM (SELECT pos, neg, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING
                                                     AND 1 PRECEDING) AS neg_before
                    FROM (SELECT score, CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS pos,
                                 CAST(count(*) FILTER (WHERE label <> 1) AS DOUBLE) AS neg
                          FROM scores GROUP BY score) d) p) a""", ("scores",)),
    "threshold_sweep": with_views("SELECT * FROM sweep ORDER BY f1 DESC, threshold", ("scores",), (_SWEEP,)),
    "sigmoid_scores": with_views(
        f"SELECT key, {rnd('1.0 / (1.0 + exp(-((score - 0.5) * 10)))', 6)} AS probability FROM scores",
        ("scores",)),
    "threshold_label": with_views("""
        SELECT key, CAST(score >= 0.5 AS INTEGER) AS prediction,
               CASE WHEN score >= 0.5 THEN 'high_demand_proxy'
                    WHEN score IS NOT NULL THEN 'not_high_demand_proxy' END AS prediction_label
        FROM scores""", ("scores",)),
    "class_weights": with_views("""
        SELECT label, count(*) AS n_c,
               CAST((SELECT count(*) FROM scores) AS DOUBLE)
                 / (CAST((SELECT count(DISTINCT label) FROM scores) AS DOUBLE) * CAST(count(*) AS DOUBLE)) AS weight
        FROM scores GROUP BY label""", ("scores",)),
    "runs_compare": with_views("SELECT * FROM runs", ("scores",), (_SWEEP, _RUNS)),
    "select_best_run": with_views(
        "SELECT run_name, f1 FROM runs WHERE uses_leakage <> 'true' ORDER BY f1 DESC NULLS LAST, run_name LIMIT 1",
        ("scores",), (_SWEEP, _RUNS)),
    "select_serving_run": with_views(
        "SELECT run_name, 2 AS tier, f1 FROM runs ORDER BY f1 DESC NULLS LAST, run_name LIMIT 1",
        ("scores",), (_SWEEP, _RUNS)),
    "latency_percentiles": """
        WITH r AS (SELECT event_type, value, ts,
                          row_number() OVER (PARTITION BY event_type ORDER BY value) AS rk,
                          count(*) OVER (PARTITION BY event_type) AS n FROM events)
        SELECT event_type, any_value(n) AS n,
               CAST(round(CAST(sum(value) AS DECIMAL(18,8)), 4) AS DOUBLE) AS total,
               date_diff('microsecond', min(ts), max(ts)) / 1e6 AS elapsed_s,
               CAST(round(CAST(count(*) / (date_diff('microsecond', min(ts), max(ts)) / 1e6)
                               AS DECIMAL(18,8)), 6) AS DOUBLE) AS rate_per_s,
               max(CASE WHEN rk = least(floor(n * 0.5), n - 1) + 1 THEN value END) AS p50,
               max(CASE WHEN rk = least(floor(n * 0.95), n - 1) + 1 THEN value END) AS p95,
               max(CASE WHEN rk = least(floor(n * 0.99), n - 1) + 1 THEN value END) AS p99
        FROM r GROUP BY event_type""",
}
