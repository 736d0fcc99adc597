"""Registered ML queries (split, preprocessing, training, contract, scoring)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import round_half_up, threshold_label
from ..operators import contract as CT
from ..operators import evaluate as EV
from ..operators import ml as ML
from ..session import ensure_checkpoint_dir
from .feature_plans import FEATURE_COLUMNS, _Ctx, _fs
from .oracle_sql import rnd

LABEL, KEY = "high_demand_proxy", "listing_id"


def _labelled(spark, sf_dir):
    fs = _Ctx(spark, sf_dir).features()
    return fs.where(F.col(LABEL).isNotNull()).withColumn(LABEL, F.col(LABEL).cast("int"))


def _split(spark, sf_dir):
    return ML.stratified_split(_labelled(spark, sf_dir), LABEL, KEY)


def _train_cols(df):
    return ML.split_column_types(df, ML.clean_feature_columns(df))


def payloads(features):
    """JSON request rows built from feature rows (deterministic defects by key).

    key % 10 == 0 adds a leakage field, 1 sends accommodates as text,
    2 omits listing_price, 3 adds an unknown field, 4 sends an out-of-range
    rate; other rows are sent as they are (nulls kept as JSON null).
    """
    f = [F.col(c) for c in CT.MODEL_FEATURES]
    m = F.col(KEY) % 10

    def js(cols):
        return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})

    def repl(name, value):
        return [value.alias(name) if c == name else F.col(c) for c in CT.MODEL_FEATURES]

    payload = (F.when(m == 0, js(f + [F.col(LABEL)]))
                .when(m == 1, js(repl("accommodates", F.lit("large"))))
                .when(m == 2, js([F.col(c) for c in CT.MODEL_FEATURES if c != "listing_price"]))
                .when(m == 3, js(f + [F.lit("x").alias("extra_note")]))
                .when(m == 4, js(repl("available_rate_last_90d", F.lit(1.5))))
                .otherwise(js(f)))
    return CT.clean_for_json(features).select(KEY, payload.alias("payload"))


def q_stratified_split(spark, sf_dir):
    return _split(spark, sf_dir).select(KEY, LABEL, "split")


def q_impute_median(spark, sf_dir):
    sp = _split(spark, sf_dir)
    num, _ = _train_cols(sp)
    return ML.fit_medians(sp.where(F.col("split") == "train"), num)


def q_impute_mode(spark, sf_dir):
    sp = _split(spark, sf_dir)
    _, cat = _train_cols(sp)
    return ML.fit_modes(sp.where(F.col("split") == "train"), cat)


def q_standard_scale(spark, sf_dir):
    sp = _split(spark, sf_dir)
    num, cat = _train_cols(sp)
    train = sp.where(F.col("split") == "train")
    med = {r["column"]: r["median"] for r in ML.fit_medians(train, num).collect()}
    imputed = ML.Preprocessor(num, cat, med, {}).transform(train)
    return ML.fit_scaler(imputed, num).select(
        "column", round_half_up("mean", 6).alias("mean"), round_half_up("std", 6).alias("std"))


def q_dummy_baseline(spark, sf_dir):
    sp = _split(spark, sf_dir)
    train, test = sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test")
    return EV.binary_metrics(EV.dummy_scores(test, train, LABEL, KEY), LABEL, "score")


def q_one_hot(spark, sf_dir):
    sp = _split(spark, sf_dir)
    num, cat = _train_cols(sp)
    train = sp.where(F.col("split") == "train")
    from pyspark.ml import Pipeline
    pm = Pipeline(stages=ML.one_hot_stages(cat)).fit(train)
    from pyspark.ml.functions import vector_to_array
    out = pm.transform(sp)
    return out.select(KEY, *[F.array_position(vector_to_array(f"{c}__oh"), 1.0).alias(f"{c}_slot")
                             for c in cat])


def _train_report(spark, sf_dir, kind, balanced, run_name, leaky=False):
    model, pre, scored = ML.train_and_score(_labelled(spark, sf_dir), LABEL, KEY, kind, balanced, leaky)
    scored = scored.checkpoint(eager=True)      # read by the counts and by the curve
    m = EV.binary_metrics(scored, LABEL, "score")
    auc = EV.roc_auc(scored, LABEL, "score").select("roc_auc").scalar()
    return m.select(F.lit(run_name).alias("run_name"), "tn", "fp", "fn", "tp",
                    "accuracy", "precision", "recall", "f1", auc.alias("roc_auc"))


def q_train_logreg(spark, sf_dir):
    return _train_report(spark, sf_dir, "logreg", True, "v3_balanced_logistic_regression")


def q_train_logreg_leaky(spark, sf_dir):
    return _train_report(spark, sf_dir, "logreg", False, "v0_leaky_logistic_regression", leaky=True)


def q_train_forest(spark, sf_dir):
    return _train_report(spark, sf_dir, "forest", True, "v5_random_forest")


def q_contract_split(spark, sf_dir):
    v = CT.with_violations(payloads(_Ctx(spark, sf_dir, once=True).features()))
    return v.select(KEY, F.size("violations").alias("n_violations"),
                    F.concat_ws(";", "violations").alias("violations"))


def q_contract_split_w3(spark, sf_dir):
    fs = _Ctx(spark, sf_dir, once=True).features().withColumnRenamed("host_is_superhost", "is_superhost")
    cols = [r.name for r in CT.W3_RULES]
    p = fs.select(KEY, F.to_json(F.struct(*cols)).alias("payload"))  # nulls omitted
    v = CT.with_violations(p, rules=CT.W3_RULES)
    return v.select(KEY, F.size("violations").alias("n_violations"),
                    F.concat_ws(";", "violations").alias("violations"))


def q_valid_scoring_sample(spark, sf_dir):
    acc, _ = CT.contract_split(payloads(_Ctx(spark, sf_dir, once=True).features()))
    return acc.orderBy(KEY).limit(100).select(KEY)


def q_query_bounds(spark, sf_dir):
    from ..sources.standin import StandIn
    d = StandIn(spark, sf_dir).raw.documents
    q = d.select(F.col("doc_id").alias("request_id"), F.col("text").alias("query"),
                 (F.col("doc_id") % 120 + 1).cast("int").alias("top_k"), "lang")
    v = CT.query_bound_violations(q)
    return v.select("request_id", F.size("violations").alias("n_violations"),
                    F.concat_ws(";", "violations").alias("violations"))


def q_batch_bounds(spark, sf_dir):
    """PF21: every conversation as one embedding request of its turns' texts."""
    from ..sources.standin import StandIn
    turns = StandIn(spark, sf_dir).raw.conversations
    sizes = turns.groupBy(F.col("conv_id").alias("request_id")).agg(F.count("text").alias("n_texts"))
    return CT.batch_bound_violations(sizes).select("request_id", "n_texts", F.concat_ws(";", "violations").alias("violations"))


def _serving(spark, sf_dir):
    """Model trained on the contract's inputs + typed accepted requests (checkpointed)."""
    fs = _Ctx(spark, sf_dir).features()
    model, pre, _ = ML.train_and_score(
        fs.where(F.col(LABEL).isNotNull()).withColumn(LABEL, F.col(LABEL).cast("int")),
        LABEL, KEY, "logreg", True, columns=CT.MODEL_FEATURES)
    acc, _ = CT.contract_split(payloads(fs))
    typed = CT.parse_accepted(acc).checkpoint(eager=True)
    return model, pre, typed


def _score(model, pre, typed):
    scored = ML.positive_probability(model.transform(pre.transform(typed)))
    return scored.select(KEY, F.col("score").alias("probability"),
                         (F.col("score") >= 0.5).cast("int").alias("prediction"),
                         threshold_label("score", 0.5).alias("prediction_label"))


def q_score_batch(spark, sf_dir):
    """ML18: contract -> model probability -> threshold -> label text, per accepted row."""
    return _score(*_serving(spark, sf_dir))


def q_repro_check(spark, sf_dir):
    """VA8: scoring the same rows twice gives identical results."""
    model, pre, typed = _serving(spark, sf_dir)
    a, b = _score(model, pre, typed), _score(model, pre, typed)
    diff = a.exceptAll(b).union(b.exceptAll(a)).agg(F.count(F.lit(1)).alias("d"))
    return a.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", diff.select("d").scalar().alias("differences")).withColumn(
        "reproducible", F.col("differences") == 0)


def q_prediction_agreement(spark, sf_dir):
    """VA8: predictions of the accepted requests against their known labels."""
    model, pre, typed = _serving(spark, sf_dir)
    known = _Ctx(spark, sf_dir).features().where(F.col(LABEL).isNotNull()).select(KEY, F.col(LABEL).cast("int").alias("label"))
    return EV.agreement(_score(model, pre, typed).checkpoint(eager=True).join(known.checkpoint(eager=True), KEY))


def q_feature_lists(spark, sf_dir):
    """ML1/PF14: clean vs leaky model-input lists from the feature schema."""
    df = _labelled(spark, sf_dir)
    clean = ML.clean_feature_columns(df)
    leaky = ML.clean_feature_columns(df, leaky=True)
    num, cat = ML.split_column_types(df, leaky)
    rows = [(c, c in clean, True, "numeric" if c in num else "categorical") for c in leaky]
    return spark.createDataFrame(rows, "column string, in_clean boolean, in_leaky boolean, kind string")


def q_class_weights_features(spark, sf_dir):
    """ML9 on the training split of the feature set."""
    sp = _split(spark, sf_dir)
    return EV.class_weights(sp.where(F.col("split") == "train"), LABEL)


def q_experiment_runs(spark, sf_dir):
    """ML8-ML17 + WS5: train the run variants, log them in a runs table, pick the best.

    Runs: leaky logreg, dummy, clean logreg, balanced logreg, threshold
    sweep of the balanced model (scores do not depend on the threshold, so
    the model is fitted once), random forest.
    """
    ensure_checkpoint_dir(spark)
    data = _labelled(spark, sf_dir).checkpoint(eager=True)     # read by every run
    rows = []

    def area(scored):
        return EV.roc_auc(scored, LABEL, "score").first()["roc_auc"]

    def log(name, scored, leaky, threshold=0.5, params=None, auc=None):
        m = EV.binary_metrics(scored, LABEL, "score", threshold).first()
        auc = area(scored) if auc is None else auc
        rows.append((name, {"accuracy": m["accuracy"], "precision": m["precision"],
                            "recall": m["recall"], "f1": m["f1"], "roc_auc": auc},
                     {k: str(v) for k, v in (params or {}).items()},
                     {"uses_leakage": str(leaky).lower()}))

    columns = ML.clean_feature_columns(data, leaky=True)        # of every run, and the leak
    sp = ML.split_rows(data, LABEL, KEY, columns)
    tr, te = sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test")
    shared = {"split": sp, "fitted": ML.fit_preprocessor(tr, columns)}
    _, _, s0 = ML.train_and_score(data, LABEL, KEY, "logreg", False, leaky=True, **shared)
    log("v0_leaky_logistic_regression", s0.checkpoint(eager=True), True, params={"max_iter": ML.LOGREG_MAX_ITER})
    log("v1_dummy_baseline", EV.dummy_scores(te, tr, LABEL, KEY), False, params={"strategy": "most_frequent"})
    _, _, s2 = ML.train_and_score(data, LABEL, KEY, "logreg", False, **shared)
    log("v2_clean_logistic_regression", s2.checkpoint(eager=True), False, params={"max_iter": ML.LOGREG_MAX_ITER})
    _, _, s3 = ML.train_and_score(data, LABEL, KEY, "logreg", True, **shared)
    s3 = s3.checkpoint(eager=True)
    auc = area(s3)                              # of the scores, whatever the threshold
    log("v3_balanced_logistic_regression", s3, False, params={"class_weight": "balanced"}, auc=auc)
    for t in EV.SWEEP_THRESHOLDS:
        log(f"v4_balanced_logistic_threshold_{t:.2f}", s3, False, t, {"threshold": f"{t:.2f}"}, auc)
    _, _, s5 = ML.train_and_score(data, LABEL, KEY, "forest", True, **shared)
    log("v5_random_forest", s5.checkpoint(eager=True), False,
        params={"n_estimators": ML.FOREST_TREES, "min_samples_leaf": ML.FOREST_MIN_LEAF})
    runs = spark.createDataFrame(rows, "run_name string, metrics map<string,double>, "
                                       "params map<string,string>, tags map<string,string>")
    best = EV.select_best_run(runs).select("run_name").first()
    best_name = best["run_name"] if best else None
    return EV.runs_compare(runs).withColumn("selected", F.col("run_name") == F.lit(best_name))



QUERIES = {
    "stratified_split": q_stratified_split,
    "impute_median": q_impute_median,
    "impute_mode": q_impute_mode,
    "standard_scale": q_standard_scale,
    "dummy_baseline": q_dummy_baseline,
    "one_hot": q_one_hot,
    "train_logreg": q_train_logreg,
    "train_logreg_leaky": q_train_logreg_leaky,
    "train_forest": q_train_forest,
    "contract_split": q_contract_split,
    "contract_split_w3": q_contract_split_w3,
    "valid_scoring_sample": q_valid_scoring_sample,
    "query_bounds": q_query_bounds,
    "score_batch": q_score_batch,
    "repro_check": q_repro_check,
    "prediction_agreement": q_prediction_agreement,
    "batch_bounds": q_batch_bounds,
    "class_weights_features": q_class_weights_features,
    "experiment_runs": q_experiment_runs,
}

# ---------------------------------------------------------------------------------------
# Oracle SQL
# ---------------------------------------------------------------------------------------

_SPLIT = ("fsplit", """
    SELECT f.*, CASE WHEN row_number() OVER (PARTITION BY high_demand_proxy
                       ORDER BY sha256(CAST(listing_id AS VARCHAR) || '42'), listing_id)
                     <= round(count(*) OVER (PARTITION BY high_demand_proxy) * 0.2)
                THEN 'test' ELSE 'train' END AS split
    FROM feat f WHERE high_demand_proxy IS NOT NULL""")
_FORBIDDEN = set(ML.FORBIDDEN_MODEL_COLUMNS)
_CATEGORICAL = ("room_type", "property_type", "neighbourhood_name", "cutoff_date", "dataset_version")
_NUMERIC = [c for c, _ in FEATURE_COLUMNS if c not in _FORBIDDEN and c not in _CATEGORICAL]
_CATS = [c for c in ("room_type", "property_type", "neighbourhood_name")]


def _long_sql(cols, typ):
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS {typ}) AS value FROM fsplit "
                              f"WHERE split = 'train'" for c in cols)


_NAMES = ("names", " UNION ALL ".join(f"SELECT '{c}' AS \"column\"" for c in _NUMERIC))
_LONG = ("lng", f"SELECT * FROM ({_long_sql(_NUMERIC, 'DOUBLE')}) t WHERE value IS NOT NULL AND NOT isnan(value)")
_MED = ("med", """
    SELECT n."column", m.median FROM names n LEFT JOIN (
      SELECT "column", (max(CASE WHEN rk = floor((cnt - 1) / 2.0) + 1 THEN value END)
                      + max(CASE WHEN rk = ceil((cnt - 1) / 2.0) + 1 THEN value END)) / 2 AS median
      FROM (SELECT "column", value, row_number() OVER (PARTITION BY "column" ORDER BY value) AS rk,
                   count(*) OVER (PARTITION BY "column") AS cnt FROM lng) r
      GROUP BY "column") m ON n."column" = m."column" """)


def _expected_violations_sql():
    """Independent statement of which rule each generated payload breaks."""
    parts = ["CASE WHEN listing_id % 10 = 0 THEN 'forbidden:high_demand_proxy' END",
             "CASE WHEN listing_id % 10 = 3 THEN 'unknown:extra_note' END"]
    for r in CT.W2_RULES:
        c = r.name
        if c == "accommodates":
            parts.append("CASE WHEN listing_id % 10 = 1 THEN 'type:accommodates' "
                         "WHEN accommodates IS NULL THEN 'null:accommodates' "
                         "WHEN accommodates < 0 THEN 'range:accommodates' END")
            continue
        if c == "listing_price":
            parts.append("CASE WHEN listing_id % 10 = 2 THEN 'missing:listing_price' "
                         "WHEN listing_price < 0 THEN 'range:listing_price' END")
            continue
        if c == "available_rate_last_90d":
            parts.append("CASE WHEN listing_id % 10 = 4 THEN 'range:available_rate_last_90d' "
                         "WHEN available_rate_last_90d IS NULL THEN 'null:available_rate_last_90d' "
                         "WHEN available_rate_last_90d < 0 OR available_rate_last_90d > 1 "
                         "THEN 'range:available_rate_last_90d' END")
            continue
        conds = []
        if not r.nullable:
            conds.append(f"WHEN {c} IS NULL THEN 'null:{c}'")
        rng = []
        if r.ge is not None:
            rng.append(f"{c} < {r.ge}")
        if r.le is not None:
            rng.append(f"{c} > {r.le}")
        if rng:
            conds.append(f"WHEN {' OR '.join(rng)} THEN 'range:{c}'")
        if conds:
            parts.append("CASE " + " ".join(conds) + " END")
    return "list_filter([" + ", ".join(parts) + "], lambda x: x IS NOT NULL)"


_VIOL = ("viol", f"SELECT listing_id, list_sort({_expected_violations_sql()}) AS v FROM feat")


def _w3_expected_sql():
    parts = []
    for r in CT.W3_RULES:
        src = "host_is_superhost" if r.name == "is_superhost" else r.name
        if r.required:
            parts.append(f"CASE WHEN {src} IS NULL THEN 'missing:{r.name}' END")
    return "list_filter([" + ", ".join(parts) + "], lambda x: x IS NOT NULL)"


ORACLES = {
    "batch_bounds": """
        SELECT conv_id AS request_id, count(text) AS n_texts,
               CASE WHEN count(text) < 1 THEN 'texts:too_few' WHEN count(text) > 256 THEN 'texts:too_many' ELSE '' END AS violations
        FROM conversations GROUP BY conv_id""",
    "stratified_split": _fs("SELECT listing_id, high_demand_proxy, split FROM fsplit", (_SPLIT,)),
    "impute_median": _fs("SELECT * FROM med", (_SPLIT, _NAMES, _LONG, _MED)),
    "impute_mode": _fs(f"""
        SELECT "column", arg_min(value, (-n, value)) AS mode FROM (
          SELECT "column", value, count(*) AS n FROM ({_long_sql(_CATS, 'VARCHAR')}) t
          WHERE value IS NOT NULL GROUP BY "column", value) c GROUP BY "column" """, (_SPLIT,)),
    "standard_scale": _fs(f"""
        SELECT i."column", {rnd('avg(v)', 6)} AS mean,
               {rnd('CASE WHEN stddev_pop(v) = 0 THEN 1.0 ELSE stddev_pop(v) END', 6)} AS std
        FROM (SELECT l."column", coalesce(l.value, m.median) AS v
              FROM ({_long_sql(_NUMERIC, 'DOUBLE')}) l JOIN med m ON l."column" = m."column") i
        GROUP BY i."column" """, (_SPLIT, _NAMES, _LONG, _MED)),
    "dummy_baseline": _fs("""
        SELECT CAST(0.5 AS DOUBLE) AS threshold, tn, fp, fn, tp,
               coalesce(CAST(tp + tn AS DOUBLE) / nullif(CAST(tn + fp + fn + tp AS DOUBLE), 0), 0.0) AS accuracy,
               coalesce(CAST(tp AS DOUBLE) / nullif(CAST(tp + fp AS DOUBLE), 0), 0.0) AS precision,
               coalesce(CAST(tp AS DOUBLE) / nullif(CAST(tp + fn AS DOUBLE), 0), 0.0) AS recall,
               coalesce(CAST(2 * tp AS DOUBLE) / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0.0) AS f1
        FROM (SELECT count(*) FILTER (WHERE y <> 1 AND NOT s >= 0.5) AS tn,
                     count(*) FILTER (WHERE y <> 1 AND s >= 0.5) AS fp,
                     count(*) FILTER (WHERE y = 1 AND NOT s >= 0.5) AS fn,
                     count(*) FILTER (WHERE y = 1 AND s >= 0.5) AS tp
              FROM (SELECT high_demand_proxy AS y,
                           CAST((SELECT high_demand_proxy FROM fsplit WHERE split = 'train'
                                 GROUP BY high_demand_proxy ORDER BY count(*) DESC, high_demand_proxy
                                 LIMIT 1) AS DOUBLE) AS s
                    FROM fsplit WHERE split = 'test') t) c""", (_SPLIT,)),
    "contract_split": _fs("""
        SELECT listing_id, CAST(len(v) AS INTEGER) AS n_violations, array_to_string(v, ';') AS violations
        FROM viol""", (_VIOL,)),
    "contract_split_w3": _fs(f"""
        SELECT listing_id, CAST(len(v) AS INTEGER) AS n_violations, array_to_string(v, ';') AS violations
        FROM (SELECT listing_id, list_sort({_w3_expected_sql()}) AS v FROM feat) t"""),
    "class_weights_features": _fs("""
        SELECT high_demand_proxy, count(*) AS n_c,
               CAST((SELECT count(*) FROM fsplit WHERE split = 'train') AS DOUBLE)
                 / (CAST((SELECT count(DISTINCT high_demand_proxy) FROM fsplit WHERE split = 'train') AS DOUBLE)
                    * CAST(count(*) AS DOUBLE)) AS weight
        FROM fsplit WHERE split = 'train' GROUP BY high_demand_proxy""", (_SPLIT,)),
    "repro_check": _fs("""
        SELECT count(*) AS rows, CAST(0 AS BIGINT) AS differences, true AS reproducible
        FROM viol WHERE len(v) = 0""", (_VIOL,)),
    "valid_scoring_sample": _fs("SELECT listing_id FROM viol WHERE len(v) = 0 ORDER BY listing_id LIMIT 100",
                                (_VIOL,)),
    "query_bounds": """
        SELECT request_id, CAST(len(v) AS INTEGER) AS n_violations, array_to_string(v, ';') AS violations
        FROM (SELECT doc_id AS request_id, list_filter([
                CASE WHEN text IS NULL OR length(text) < 1 THEN 'query:empty' END,
                CASE WHEN length(text) > 4096 THEN 'query:too_long' END,
                CASE WHEN doc_id % 120 + 1 > 100 THEN 'top_k:out_of_range' END,
                CASE WHEN lang IS NOT NULL AND lang <> 'en' THEN 'lang:unsupported' END],
                lambda x: x IS NOT NULL) AS v FROM documents) t""",
}
