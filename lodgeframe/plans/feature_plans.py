"""Registered feature-pipeline queries (W2 ETL) and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import coerce_boolean, coerce_numeric, parse_bathrooms
from ..operators import features as FE
from ..session import scratch_path
from ..sources.standin import StandIn
from .oracle_sql import rnd, with_views


# Resolved windows per stored warehouse (keyed by the inputs' fingerprint,
# so a changed input resolves again).
_WINDOWS: dict = {}


class _Ctx:
    """Per-query stand-in views plus the resolved cutoff window."""

    def __init__(self, spark, sf_dir, once=False):
        self.v = StandIn(spark, sf_dir, once=once)
        self.cal = self.v.calendar_day()
        self._w = None

    @property
    def window(self):
        if self._w is None:
            key = self.v.cache_key("cutoff_window")
            self._w = _WINDOWS.get(key) if key else None
            if self._w is None:
                self._w = FE.resolve_window(self.cal)
                if key:
                    _WINDOWS[key] = self._w
        return self._w

    def static(self):
        return FE.static_features(self.v.listing(), self.v.host(), self.v.neighbourhood())

    def features(self):
        return FE.build_feature_set(self.v.listing(), self.v.host(), self.v.neighbourhood(),
                                    self.v.review(), self.cal, self.window)

    def staged_features(self):
        """The assembled feature set written once to the shared checkpoint
        folder, for pipelines that read it several times (profile, drop,
        validation, sidecars, save) -- one computation instead of one per pass."""
        if getattr(self, "_staged", None) is None:
            from ..session import ensure_checkpoint_dir
            ensure_checkpoint_dir(self.v.spark)
            self._staged = self.features().checkpoint(eager=True)
        return self._staged


def q_cutoff_window(spark, sf_dir):
    c = _Ctx(spark, sf_dir)
    return FE.cutoff_window_df(c.cal).select(
        "calendar_min_date", "calendar_max_date", "cutoff_date", "history_start_date",
        "label_end_date",
        F.date_format("cutoff_date", "yyyy-MM-dd").alias("cutoff_date_text"))


def q_static_features(spark, sf_dir):
    return _Ctx(spark, sf_dir).static()


def q_host_listing_count(spark, sf_dir):
    return FE.host_listing_count(StandIn(spark, sf_dir).listing())


def q_review_features(spark, sf_dir):
    c = _Ctx(spark, sf_dir)
    return FE.review_features(c.v.review(), c.window.cutoff_date)


def q_calendar_features(spark, sf_dir):
    c = _Ctx(spark, sf_dir)
    return FE.calendar_features(c.cal, c.window)


def q_future_label(spark, sf_dir):
    c = _Ctx(spark, sf_dir)
    return FE.future_label(c.cal, c.window)


def q_label_distribution(spark, sf_dir):
    c = _Ctx(spark, sf_dir)
    return FE.label_distribution(FE.future_label(c.cal, c.window))


def q_feature_set(spark, sf_dir):
    return _Ctx(spark, sf_dir).features()


def q_fill_review_defaults(spark, sf_dir):
    c = _Ctx(spark, sf_dir)
    j = c.v.listing().select("listing_id").join(
        FE.review_features(c.v.review(), c.window.cutoff_date), "listing_id", "left")
    return FE.fill_review_defaults(j).select(
        "listing_id", "total_reviews_before_cutoff", "unique_reviewers_before_cutoff",
        "days_since_last_review")


def q_drop_unusable_columns(spark, sf_dir):
    return FE.drop_profile(_Ctx(spark, sf_dir).features())


def q_missing_report(spark, sf_dir):
    return FE.missing_report(_Ctx(spark, sf_dir).features())


def q_coverage_describe(spark, sf_dir):
    return FE.describe_column(_Ctx(spark, sf_dir).features(), "future_calendar_days_observed_30d")


def q_validate_feature_set(spark, sf_dir):
    """VA4: the features are computed once; their profile is gathered while they are stored."""
    df, _ = FE.staged_clean(_Ctx(spark, sf_dir).features(), scratch_path(spark, "validated_features"))
    return FE.validate_feature_set(df)


def q_duplicate_keys(spark, sf_dir):
    li = StandIn(spark, sf_dir).raw.lineitem
    return FE.duplicate_keys(li, ["l_orderkey", "l_linenumber"])


def q_calendar_quality(spark, sf_dir):
    cal = StandIn(spark, sf_dir).calendar_day()
    return FE.table_quality(cal, ["price", "adjusted_price", "available"], "date", "calendar")


def q_review_quality(spark, sf_dir):
    r = StandIn(spark, sf_dir).review()
    return FE.table_quality(r, ["comment_len"], "review_date", "review")


def q_date_ranges(spark, sf_dir):
    v = StandIn(spark, sf_dir)
    cal, rev = v.calendar_day(), v.review()
    # four scalar subqueries over two tables, as one row
    one = cal.agg(F.min("date").alias("calendar_min_date"), F.max("date").alias("calendar_max_date"))
    return one.select("*",
                      rev.select(F.min("review_date")).scalar().alias("review_min_date"),
                      rev.select(F.max("review_date")).scalar().alias("review_max_date"))


def q_parse_bathrooms(spark, sf_dir):
    lst = StandIn(spark, sf_dir).listing()
    return lst.select("listing_id", "bathrooms_text", parse_bathrooms("bathrooms_text").alias("bathrooms"))


def q_coerce_numeric(spark, sf_dir):
    lst = StandIn(spark, sf_dir).listing()
    return lst.select(
        "listing_id",
        coerce_numeric(F.col("bathrooms_text"), "double").alias("bathrooms_num"),
        coerce_numeric(F.col("accommodates").cast("string"), "bigint").alias("accommodates"),
        coerce_numeric(F.col("bedrooms").cast("string"), "double").alias("bedrooms"),
        coerce_numeric(F.regexp_extract(F.col("room_type"), "([0-9]+)", 1), "int").alias("segment_no"))


def q_coerce_boolean(spark, sf_dir):
    h = StandIn(spark, sf_dir).host()
    return h.select("host_id", coerce_boolean(F.col("is_superhost").cast("string")).alias("is_superhost"),
                    coerce_boolean(F.col("host_pseudo_id")).alias("pseudo_as_bool"))


def q_project_rename(spark, sf_dir):
    v = StandIn(spark, sf_dir)
    h = FE.host_projection(v.host())
    return h


def q_sql_params(spark, sf_dir):
    """SC3: a named-parameter Spark SQL read (``:cutoff_date``)."""
    c = _Ctx(spark, sf_dir)
    c.v.review().createOrReplaceTempView("review")
    return spark.sql(
        """SELECT listing_id, count(*) AS total_reviews_before_cutoff,
                  max(review_date) AS last_review_date
           FROM review WHERE review_date <= CAST(:cutoff_date AS DATE)
           GROUP BY listing_id""",
        args={"cutoff_date": c.window.cutoff_date.isoformat()})


def q_table_sample(spark, sf_dir):
    """SC10: a small deterministic sample (first 10 listings by key)."""
    return StandIn(spark, sf_dir).listing().orderBy("listing_id").limit(10).select(
        "listing_id", "host_id", "neighbourhood_id", "room_type",
        F.col("listing_price").cast("double").alias("listing_price"))


def q_row_counts(spark, sf_dir):
    """SO1: row counts of the five source tables by UNION ALL."""
    v = StandIn(spark, sf_dir)
    parts = [(n, getattr(v, n)()) for n in ("listing", "host", "neighbourhood", "review", "calendar_day")]
    out = None
    for n, df in parts:
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out.orderBy("table_name")


def q_model_inputs(spark, sf_dir):
    """PF13 after PF12: surviving model inputs and their leakage flag."""
    p = FE.drop_profile(_Ctx(spark, sf_dir).features())
    excluded = list(FE.LABEL_ONLY_COLUMNS) + list(FE.AUDIT_COLUMNS)
    return (p.where(~F.col("dropped") & ~F.col("column").isin(*excluded))
             .select("column", F.col("column").startswith("future_").alias("is_leakage")))


QUERIES = {
    "cutoff_window": q_cutoff_window,
    "static_features": q_static_features,
    "host_listing_count": q_host_listing_count,
    "review_features": q_review_features,
    "calendar_features": q_calendar_features,
    "future_label": q_future_label,
    "label_distribution": q_label_distribution,
    "feature_set": q_feature_set,
    "fill_review_defaults": q_fill_review_defaults,
    "drop_unusable_columns": q_drop_unusable_columns,
    "missing_report": q_missing_report,
    "coverage_describe": q_coverage_describe,
    "validate_feature_set": q_validate_feature_set,
    "duplicate_keys": q_duplicate_keys,
    "calendar_quality": q_calendar_quality,
    "review_quality": q_review_quality,
    "date_ranges": q_date_ranges,
    "parse_bathrooms": q_parse_bathrooms,
    "coerce_numeric": q_coerce_numeric,
    "coerce_boolean": q_coerce_boolean,
    "project_rename": q_project_rename,
    "sql_params": q_sql_params,
    "table_sample": q_table_sample,
    "row_counts": q_row_counts,
    "model_inputs": q_model_inputs,
}

# ---------------------------------------------------------------------------------
# Oracle SQL
# ---------------------------------------------------------------------------------

_WIN = ("win", """
    SELECT min(date) AS calendar_min_date, max(date) AS calendar_max_date,
           CAST(max(date) - INTERVAL 30 DAY AS DATE) AS cutoff_date,
           CAST(max(date) - INTERVAL 120 DAY AS DATE) AS history_start_date,
           max(date) AS label_end_date
    FROM calendar_day""")

_BATH = """CASE WHEN trim({x}) IS NULL OR trim({x}) = '' THEN NULL
     WHEN contains(lower(trim({x})), 'half') THEN 0.5
     ELSE TRY_CAST(nullif(regexp_extract(lower(trim({x})), '([0-9]+(\\.[0-9]+)?)', 1), '') AS DOUBLE) END"""

_HC = ("hc", "SELECT host_id, count(DISTINCT listing_id) AS host_listing_count FROM listing GROUP BY host_id")
_STATIC = ("static", f"""
    SELECT l.listing_id, l.room_type, l.property_type, n.name AS neighbourhood_name,
           CAST(l.accommodates AS BIGINT) AS accommodates, l.bedrooms, l.beds,
           {_BATH.format(x='l.bathrooms_text')} AS bathrooms,
           CAST(l.listing_price AS DOUBLE) AS listing_price,
           CAST(l.minimum_nights AS BIGINT) AS minimum_nights,
           CAST(l.maximum_nights AS BIGINT) AS maximum_nights,
           l.instant_bookable, h.is_superhost AS host_is_superhost, hc.host_listing_count
    FROM listing l
    LEFT JOIN host h ON l.host_id = h.host_id
    LEFT JOIN hc ON l.host_id = hc.host_id
    LEFT JOIN neighbourhood n ON l.neighbourhood_id = n.neighbourhood_id""")
_REV = ("rev", """
    SELECT listing_id, count(*) AS total_reviews_before_cutoff,
           count(DISTINCT reviewer_id) AS unique_reviewers_before_cutoff,
           CAST(sum(comment_len) AS DOUBLE) / CAST(count(comment_len) AS DOUBLE) AS avg_comment_len_before_cutoff,
           max(comment_len) AS max_comment_len_before_cutoff,
           CAST(date_diff('day', max(review_date), any_value(cutoff_date)) AS INTEGER) AS days_since_last_review
    FROM review, win WHERE review_date <= cutoff_date GROUP BY listing_id""")


def _avg(x):
    return f"CAST(sum({x}) AS DOUBLE) / CAST(count({x}) AS DOUBLE)"


def _cal_sql(windows=FE.HISTORY_WINDOWS):
    cols = []
    for w in windows:
        inw = f"(date > CAST(cutoff_date - INTERVAL {w} DAY AS DATE) AND date <= cutoff_date)"
        cols += [
            f"count(CASE WHEN {inw} THEN 1 END) AS calendar_days_observed_last_{w}d",
            f"count(CASE WHEN available IS TRUE AND {inw} THEN 1 END) AS available_days_last_{w}d",
            f"{_avg(f'CASE WHEN {inw} THEN CAST(available AS INTEGER) END')} AS available_rate_last_{w}d",
            f"{_avg(f'CASE WHEN {inw} THEN minimum_nights END')} AS avg_minimum_nights_calendar_last_{w}d",
            f"{_avg(f'CASE WHEN {inw} THEN maximum_nights END')} AS avg_maximum_nights_calendar_last_{w}d",
        ]
    return ("calf", "SELECT listing_id, " + ",\n ".join(cols) +
            " FROM calendar_day, win WHERE date >= history_start_date AND date <= cutoff_date"
            " GROUP BY listing_id")


_CALF = _cal_sql()
_LABEL = ("lab", f"""
    SELECT listing_id, count(*) AS future_calendar_days_observed_30d,
           count(CASE WHEN available IS TRUE THEN 1 END) AS future_available_days_30d,
           {_avg('CAST(available AS INTEGER)')} AS future_available_rate_30d,
           CAST({_avg('CAST(available AS INTEGER)')} <= 0.3 AS INTEGER) AS high_demand_proxy
    FROM calendar_day, win WHERE date > cutoff_date AND date <= label_end_date
    GROUP BY listing_id""")
_FEAT = ("feat", """
    SELECT s.*,
           coalesce(r.total_reviews_before_cutoff, 0) AS total_reviews_before_cutoff,
           coalesce(r.unique_reviewers_before_cutoff, 0) AS unique_reviewers_before_cutoff,
           r.avg_comment_len_before_cutoff, r.max_comment_len_before_cutoff,
           coalesce(r.days_since_last_review, 120) AS days_since_last_review,
           c.* EXCLUDE (listing_id), lab.* EXCLUDE (listing_id),
           strftime((SELECT cutoff_date FROM win), '%Y-%m-%d') AS cutoff_date,
           'v1_audit_cleaned' AS dataset_version
    FROM static s LEFT JOIN rev r ON s.listing_id = r.listing_id
    LEFT JOIN calf c ON s.listing_id = c.listing_id
    JOIN lab ON s.listing_id = lab.listing_id""")

_FEATURE_VIEWS = ("listing", "host", "neighbourhood", "review", "calendar_day")
_FEATURE_CTES = (_WIN, _HC, _STATIC, _REV, _CALF, _LABEL, _FEAT)

# (column, is_floating) of the assembled feature table, in order
FEATURE_COLUMNS = [
    ("listing_id", 0), ("room_type", 0), ("property_type", 0), ("neighbourhood_name", 0),
    ("accommodates", 0), ("bedrooms", 1), ("beds", 1), ("bathrooms", 1), ("listing_price", 1),
    ("minimum_nights", 0), ("maximum_nights", 0), ("instant_bookable", 0), ("host_is_superhost", 0),
    ("host_listing_count", 0), ("total_reviews_before_cutoff", 0), ("unique_reviewers_before_cutoff", 0),
    ("avg_comment_len_before_cutoff", 1), ("max_comment_len_before_cutoff", 0),
    ("days_since_last_review", 0),
] + [(f"{m}_last_{w}d", f in ("r", "a"))
     for w in FE.HISTORY_WINDOWS
     for m, f in (("calendar_days_observed", "c"), ("available_days", "c"), ("available_rate", "r"),
                  ("avg_minimum_nights_calendar", "a"), ("avg_maximum_nights_calendar", "a"))] + [
    ("future_calendar_days_observed_30d", 0), ("future_available_days_30d", 0),
    ("future_available_rate_30d", 1), ("high_demand_proxy", 0), ("cutoff_date", 0),
    ("dataset_version", 0)]


def _profile_sql():
    aggs = ["count(*) AS n"]
    for i, (c, fl) in enumerate(FEATURE_COLUMNS):
        miss = f"({c} IS NULL OR isnan({c}))" if fl else f"{c} IS NULL"
        aggs.append(f"count(CASE WHEN {miss} THEN 1 END) AS m{i}")
        aggs.append(f"(min({c}) = max({c})) AS e{i}")
    prof = ("prof1", "SELECT " + ", ".join(aggs) + " FROM feat")
    rows = [f"SELECT '{c}' AS \"column\", CAST(m{i} AS DOUBLE) / CAST(n AS DOUBLE) AS missing_rate, "
            f"(m{i} = n OR (m{i} = 0 AND coalesce(e{i}, false))) AS is_constant FROM prof1"
            for i, (c, _) in enumerate(FEATURE_COLUMNS)]
    return prof, ("prof", " UNION ALL ".join(rows))


_PROF1, _PROF = _profile_sql()
_PROTECTED = ", ".join(f"'{c}'" for c in FE.PROTECTED_COLUMNS)


def _fs(body, extra=()):
    return with_views(body, _FEATURE_VIEWS, _FEATURE_CTES + tuple(extra))


_N_INPUTS = len([c for c, _ in FEATURE_COLUMNS]) - len(FE.LABEL_ONLY_COLUMNS) - len(FE.AUDIT_COLUMNS)

ORACLES = {
    "cutoff_window": with_views(
        "SELECT calendar_min_date, calendar_max_date, cutoff_date, history_start_date, label_end_date, "
        "strftime(cutoff_date, '%Y-%m-%d') AS cutoff_date_text FROM win", ("calendar_day",), (_WIN,)),
    "static_features": with_views("SELECT * FROM static", ("listing", "host", "neighbourhood"),
                                  (_HC, _STATIC)),
    "host_listing_count": with_views("SELECT * FROM hc", ("listing",), (_HC,)),
    "review_features": with_views("SELECT * FROM rev", ("review", "calendar_day"), (_WIN, _REV)),
    "calendar_features": with_views("SELECT * FROM calf", ("calendar_day",), (_WIN, _CALF)),
    "future_label": with_views("SELECT * FROM lab", ("calendar_day",), (_WIN, _LABEL)),
    "label_distribution": with_views(f"""
        SELECT high_demand_proxy, count(*) AS count,
               {rnd('CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM lab) AS DOUBLE)', 4)} AS percentage
        FROM lab GROUP BY high_demand_proxy""", ("calendar_day",), (_WIN, _LABEL)),
    "feature_set": _fs("SELECT * FROM feat"),
    "fill_review_defaults": with_views("""
        SELECT l.listing_id, coalesce(r.total_reviews_before_cutoff, 0) AS total_reviews_before_cutoff,
               coalesce(r.unique_reviewers_before_cutoff, 0) AS unique_reviewers_before_cutoff,
               coalesce(r.days_since_last_review, 120) AS days_since_last_review
        FROM listing l LEFT JOIN rev r ON l.listing_id = r.listing_id""",
        ("listing", "review", "calendar_day"), (_WIN, _REV)),
    "drop_unusable_columns": _fs(f"""
        SELECT "column", missing_rate, is_constant,
               ("column" NOT IN ({_PROTECTED}) AND missing_rate > 0.95) AS high_missing,
               ("column" NOT IN ({_PROTECTED}) AND (missing_rate > 0.95 OR is_constant)) AS dropped
        FROM prof""", (_PROF1, _PROF)),
    "missing_report": _fs('SELECT "column", missing_rate FROM prof ORDER BY missing_rate DESC, "column"',
                          (_PROF1, _PROF)),
    "coverage_describe": _fs(f"""
        SELECT statistic, {rnd('value', 6)} AS value FROM (
          SELECT 'count' AS statistic, CAST(count(x) AS DOUBLE) AS value FROM cov
          UNION ALL SELECT 'mean', avg(x) FROM cov
          UNION ALL SELECT 'std', stddev_samp(x) FROM cov
          UNION ALL SELECT 'min', min(x) FROM cov
          UNION ALL SELECT '25%', quantile_cont(x, 0.25) FROM cov
          UNION ALL SELECT '50%', quantile_cont(x, 0.5) FROM cov
          UNION ALL SELECT '75%', quantile_cont(x, 0.75) FROM cov
          UNION ALL SELECT 'max', max(x) FROM cov) t""",
        (("cov", "SELECT CAST(future_calendar_days_observed_30d AS DOUBLE) AS x FROM feat"),)),
    "validate_feature_set": _fs(f"""
        SELECT * FROM (VALUES
          ('duplicate_count', (SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) FROM
              (SELECT count(*) AS c FROM feat GROUP BY listing_id, cutoff_date) d)),
          ('missing_target_count', (SELECT count(*) FILTER (WHERE high_demand_proxy IS NULL) FROM feat)),
          ('non_binary_target_count', (SELECT count(*) FILTER (WHERE high_demand_proxy NOT IN (0, 1)) FROM feat)),
          ('forbidden_column_count', CAST(0 AS BIGINT)),
          ('future_leakage_column_count', CAST(0 AS BIGINT)),
          ('model_input_column_count', CAST({_N_INPUTS} - (SELECT count(*) FROM prof
              WHERE "column" NOT IN ({_PROTECTED}) AND (missing_rate > 0.95 OR is_constant)) AS BIGINT)),
          ('min_future_calendar_days', (SELECT CAST(min(future_calendar_days_observed_30d) AS BIGINT) FROM feat))
        ) t("check", value)
        """.replace("SELECT * FROM (VALUES", "SELECT \"check\", value, CASE \"check\" "
                    "WHEN 'model_input_column_count' THEN value > 0 "
                    "WHEN 'min_future_calendar_days' THEN coalesce(value > 0, false) "
                    "ELSE value = 0 END AS passed FROM (VALUES"), (_PROF1, _PROF)),
    "duplicate_keys": """
        SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "calendar_quality": with_views("""
        SELECT count(*) AS n_rows,
               count(*) FILTER (WHERE price IS NULL) AS null_price,
               count(*) FILTER (WHERE adjusted_price IS NULL) AS null_adjusted_price,
               count(*) FILTER (WHERE available IS NULL) AS null_available,
               min(date) AS min_calendar_date, max(date) AS max_calendar_date
        FROM calendar_day""", ("calendar_day",)),
    "review_quality": with_views("""
        SELECT count(*) AS n_rows, count(*) FILTER (WHERE comment_len IS NULL) AS null_comment_len,
               min(review_date) AS min_review_date, max(review_date) AS max_review_date
        FROM review""", ("review",)),
    "date_ranges": with_views("""
        SELECT (SELECT min(date) FROM calendar_day) AS calendar_min_date,
               (SELECT max(date) FROM calendar_day) AS calendar_max_date,
               (SELECT min(review_date) FROM review) AS review_min_date,
               (SELECT max(review_date) FROM review) AS review_max_date""",
        ("calendar_day", "review")),
    "parse_bathrooms": with_views(
        f"SELECT listing_id, bathrooms_text, {_BATH.format(x='bathrooms_text')} AS bathrooms FROM listing",
        ("listing",)),
    "coerce_numeric": with_views("""
        SELECT listing_id, TRY_CAST(bathrooms_text AS DOUBLE) AS bathrooms_num,
               TRY_CAST(CAST(accommodates AS VARCHAR) AS BIGINT) AS accommodates,
               TRY_CAST(CAST(bedrooms AS VARCHAR) AS DOUBLE) AS bedrooms,
               TRY_CAST(regexp_extract(room_type, '([0-9]+)', 1) AS INTEGER) AS segment_no
        FROM listing""", ("listing",)),
    "coerce_boolean": with_views("""
        SELECT host_id, TRY_CAST(CAST(is_superhost AS VARCHAR) AS BOOLEAN) AS is_superhost,
               TRY_CAST(host_pseudo_id AS BOOLEAN) AS pseudo_as_bool
        FROM host""", ("host",)),
    "project_rename": with_views("SELECT host_id, is_superhost AS host_is_superhost FROM host", ("host",)),
    "sql_params": with_views("""
        SELECT listing_id, count(*) AS total_reviews_before_cutoff, max(review_date) AS last_review_date
        FROM review WHERE review_date <= (SELECT cutoff_date FROM win) GROUP BY listing_id""",
        ("review", "calendar_day"), (_WIN,)),
    "table_sample": with_views("""
        SELECT listing_id, host_id, neighbourhood_id, room_type, CAST(listing_price AS DOUBLE) AS listing_price
        FROM listing ORDER BY listing_id LIMIT 10""", ("listing",)),
    "model_inputs": _fs(f"""
        SELECT "column", starts_with("column", 'future_') AS is_leakage FROM prof
        WHERE NOT ("column" NOT IN ({_PROTECTED}) AND (missing_rate > 0.95 OR is_constant))
          AND "column" NOT IN ({", ".join(f"'{c}'" for c in FE.LABEL_ONLY_COLUMNS + FE.AUDIT_COLUMNS)})""",
        (_PROF1, _PROF)),
    "row_counts": with_views("""
        SELECT 'calendar_day' AS table_name, count(*) AS n_rows FROM calendar_day
        UNION ALL SELECT 'host', count(*) FROM host
        UNION ALL SELECT 'listing', count(*) FROM listing
        UNION ALL SELECT 'neighbourhood', count(*) FROM neighbourhood
        UNION ALL SELECT 'review', count(*) FROM review
        ORDER BY table_name""", ("listing", "host", "neighbourhood", "review", "calendar_day")),
}
