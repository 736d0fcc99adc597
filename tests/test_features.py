"""Edge frames for the point-in-time feature pipeline."""

import datetime as dt

from pyspark.sql import functions as F

from lodgeframe.functions.scalar import parse_bathrooms
from lodgeframe.operators import features as FE

CUT = dt.date(2026, 8, 11)
WIN = FE.CutoffWindow(dt.date(2026, 1, 1), dt.date(2026, 12, 31), CUT,
                      CUT - dt.timedelta(days=90), CUT + dt.timedelta(days=30))


def test_parse_bathrooms(spark):
    cases = [("1 bath", 1.0), ("1.5 shared baths", 1.5), ("Half-bath", 0.5), ("Shared half-bath", 0.5),
             ("", None), (None, None), ("unknown", None), ("  2 baths ", 2.0), ("10.25 baths", 10.25)]
    df = spark.createDataFrame([(c,) for c, _ in cases], "t string")
    got = [r[0] for r in df.select(parse_bathrooms("t")).collect()]
    assert got == [e for _, e in cases]


def _cal(spark, offsets, avail=True):
    rows = [(1, CUT + dt.timedelta(days=o), avail, 1, 30) for o in offsets]
    return spark.createDataFrame(rows, "listing_id long, date date, available boolean, "
                                       "minimum_nights int, maximum_nights int")


def test_history_window_boundaries(spark):
    cal = _cal(spark, [-90, -89, -30, -29, 0, 1])
    r = FE.calendar_features(cal, WIN).first()
    # scan covers [cutoff-90, cutoff]; measures use (cutoff - w, cutoff]
    assert r["calendar_days_observed_last_90d"] == 4      # -89, -30, -29, 0
    assert r["calendar_days_observed_last_30d"] == 2      # -29, 0


def test_first_day_only_listing_gets_zero_counts_and_null_rates(spark):
    r = FE.calendar_features(_cal(spark, [-90]), WIN).first()
    assert r["calendar_days_observed_last_90d"] == 0
    assert r["available_rate_last_90d"] is None


def test_label_window_and_threshold(spark):
    cal = _cal(spark, [0, 1, 30, 31])
    r = FE.future_label(cal, WIN).first()
    assert r["future_calendar_days_observed_30d"] == 2    # +1, +30
    rows = [(2, CUT + dt.timedelta(days=i + 1), i < 3, 1, 1) for i in range(10)]
    rows += [(3, CUT + dt.timedelta(days=i + 1), i < 4, 1, 1) for i in range(10)]
    rows += [(4, CUT + dt.timedelta(days=1), None, 1, 1), (4, CUT + dt.timedelta(days=2), True, 1, 1)]
    df = spark.createDataFrame(rows, "listing_id long, date date, available boolean, "
                                     "minimum_nights int, maximum_nights int")
    lab = {x["listing_id"]: x for x in FE.future_label(df, WIN).collect()}
    assert lab[2]["high_demand_proxy"] == 1               # 0.30 <= 0.30
    assert lab[3]["high_demand_proxy"] == 0
    assert lab[4]["future_available_rate_30d"] == 1.0     # null available ignored
    assert lab[4]["future_calendar_days_observed_30d"] == 2


def test_review_features_and_defaults(spark):
    rv = spark.createDataFrame(
        [(1, 10, CUT, 5), (1, 10, CUT - dt.timedelta(days=3), 7), (1, 11, CUT + dt.timedelta(days=1), 99)],
        "listing_id long, reviewer_id long, review_date date, comment_len int")
    r = FE.review_features(rv, CUT).first()
    assert (r["total_reviews_before_cutoff"], r["unique_reviewers_before_cutoff"]) == (2, 1)
    assert r["max_comment_len_before_cutoff"] == 7 and r["days_since_last_review"] == 0
    lst = spark.createDataFrame([(1,), (2,)], "listing_id long")
    j = FE.fill_review_defaults(lst.join(FE.review_features(rv, CUT), "listing_id", "left"))
    r2 = j.where("listing_id = 2").first()
    assert r2["total_reviews_before_cutoff"] == 0 and r2["days_since_last_review"] == 120


def test_drop_rule(spark):
    df = spark.createDataFrame(
        [(1, None, 5, "a", 1), (2, None, 5, "b", 1), (3, 1.0, None, "c", 1)],
        "listing_id long, mostly_null double, const_with_null int, varied string, high_demand_proxy int")
    df = df.withColumn("all_same", F.lit("x"))
    clean, dropped = FE.drop_unusable_columns(df, threshold=0.5)
    assert dropped == ["all_same", "mostly_null"]     # 2/3 missing > 0.5; constant
    assert "const_with_null" in clean.columns          # value + null = 2 distinct
    assert "high_demand_proxy" in clean.columns        # protected


def test_validate_feature_set_flags(spark):
    df = spark.createDataFrame(
        [(1, "d", "v", 1, 3, 1.0), (1, "d", "v", None, 0, 2.0)],
        "listing_id long, cutoff_date string, dataset_version string, high_demand_proxy int, "
        "future_calendar_days_observed_30d long, x double")
    res = {r["check"]: r for r in FE.validate_feature_set(df).collect()}
    assert res["duplicate_count"]["value"] == 1 and not res["duplicate_count"]["passed"]
    assert res["missing_target_count"]["value"] == 1
    assert not res["min_future_calendar_days"]["passed"]
    assert res["model_input_column_count"]["passed"]
