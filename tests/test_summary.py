"""Golden and edge tests for the neighbourhood summaries and PII handling."""

import pytest
from pyspark.sql import functions as F

from lodgeframe.operators import quality as Q
from lodgeframe.operators import summary as S

# The 8-listing golden input, its 5 segments and the expected summary.
LISTINGS = [
    (1, "Centrum-West", 180, 2, 120, 31, 901, "Alice"),
    (2, "Centrum-West", 210, 3, 80, 12, 902, "Bob"),
    (3, "De Pijp", 135, 2, 210, 44, 903, "Chris"),
    (4, "Oud-Noord", 95, 1, 300, 9, 904, "Dana"),
    (5, "Oud-Noord", 105, 2, 260, 18, 905, "Eve"),
    (6, "De Baarsjes", 125, 3, 170, 27, 906, "Farid"),
    (7, "De Baarsjes", 145, 4, 90, 21, 907, "Grace"),
    (8, "Westerpark", 155, 2, 140, 36, 908, "Hamed"),
]
SEGMENTS = [
    ("Centrum-West", "tourist-heavy", "high"),
    ("De Pijp", "mixed", "medium"),
    ("Oud-Noord", "emerging", "medium"),
    ("De Baarsjes", "local-heavy", "low"),
    ("Westerpark", "mixed", "medium"),
]
EXPECTED = [
    ("Centrum-West", 2, 195.0, 195.0, 2.5, 100.0, 43, 21.5, "tourist-heavy", "high"),
    ("De Baarsjes", 2, 135.0, 135.0, 3.5, 130.0, 48, 24.0, "local-heavy", "low"),
    ("De Pijp", 1, 135.0, 135.0, 2.0, 210.0, 44, 44.0, "mixed", "medium"),
    ("Oud-Noord", 2, 100.0, 100.0, 1.5, 280.0, 27, 13.5, "emerging", "medium"),
    ("Westerpark", 1, 155.0, 155.0, 2.0, 140.0, 36, 36.0, "mixed", "medium"),
]
LSCHEMA = ("listing_id long, neighbourhood string, price long, minimum_nights long, "
           "availability_365 long, number_of_reviews long, host_id long, host_name string")
SSCHEMA = "neighbourhood string, tourism_segment string, priority_level string"


def test_basic_summary_golden(spark):
    lst = spark.createDataFrame(LISTINGS, LSCHEMA)
    seg = spark.createDataFrame(SEGMENTS, SSCHEMA)
    out = S.neighbourhood_summary_basic(lst, seg).orderBy("neighbourhood").collect()
    assert [tuple(r) for r in out] == EXPECTED


def test_basic_summary_edges(spark):
    rows = LISTINGS + [(9, None, 100, 1, 10, 0, 909, "Zed"), (10, "Nowhere", 50, 1, 5, 0, None, "Y")]
    lst = spark.createDataFrame(rows, LSCHEMA)
    seg = spark.createDataFrame(SEGMENTS, SSCHEMA)
    out = {r["neighbourhood"]: r for r in S.neighbourhood_summary_basic(lst, seg).collect()}
    assert None not in out                     # null neighbourhood dropped
    assert out["Nowhere"]["tourism_segment"] == "unknown"
    assert out["Nowhere"]["priority_level"] == "unknown"
    empty = S.neighbourhood_summary_basic(lst.limit(0), seg)
    assert empty.count() == 0


def test_pseudonym_golden(spark):
    from lodgeframe.functions.scalar import pseudonymize
    df = spark.createDataFrame([(901,)], "host_id long")
    v = df.select(pseudonymize("host_id").alias("k")).first()["k"]
    assert v == "030263d863d8bf253d154856ad40f05143fc7ffd4fcb202138c1fbb0dc2ef49b"


def test_handle_pii_drops_and_tolerates(spark):
    lst = spark.createDataFrame(LISTINGS, LSCHEMA)
    out = S.handle_pii(lst)
    assert "host_id" not in out.columns and "host_name" not in out.columns
    assert "host_key" in out.columns
    assert S.handle_pii(lst.drop("host_id", "host_name")).columns == [
        "listing_id", "neighbourhood", "price", "minimum_nights", "availability_365", "number_of_reviews"]


def test_require_columns(spark):
    lst = spark.createDataFrame(LISTINGS, LSCHEMA).drop("price")
    with pytest.raises(ValueError, match="price"):
        S.neighbourhood_summary_basic(lst, spark.createDataFrame(SEGMENTS, SSCHEMA))


def test_validate_summary_basic_reports_all_failures(spark):
    bad = spark.createDataFrame(
        [(None, 0, -1.0, 1.0, 1.0, 400.0, 1, 1.0, "x", "y")],
        "neighbourhood string, num_listings long, avg_price double, median_price double, "
        "avg_minimum_nights double, availability_365_avg double, total_reviews long, "
        "reviews_per_listing double, tourism_segment string, priority_level string")
    failed = {r["check"] for r in Q.validate_summary_basic(bad).collect() if not r["passed"]}
    assert failed == {"neighbourhood_not_null", "num_listings_positive", "avg_price_non_negative",
                      "availability_365_in_range"}


def test_refresh_gate_keeps_old_table_on_failure(spark):
    from lodgeframe.operators import sinks as K
    from lodgeframe.session import scratch_path
    good = spark.createDataFrame([("A", 1, 10.0, 10.0, 1, 1.0, 0.5, 0.5)],
                                 "neighbourhood string, num_listings long, avg_price double, "
                                 "median_price double, total_reviews long, reviews_per_listing double, "
                                 "availability_30_rate double, availability_365_rate double")
    path = scratch_path(spark, "gate_test")
    pub, rep = K.refresh_summary(spark, good, path)
    assert rep["passed"] and pub.count() == 1
    bad = good.withColumn("availability_30_rate", F.lit(2.0))
    with pytest.raises(Q.ValidationError):
        K.refresh_summary(spark, bad, path)
    assert spark.read.parquet(path).first()["availability_30_rate"] == 0.5
    reports = {r["outcome"]: r["bad_availability"] for r in spark.read.json(f"{path}__reports").collect()}
    assert reports == {"published": 0, "refused": 1}


def test_calendar_rates_null_available_counts_as_zero(spark):
    cal = spark.createDataFrame(
        [(1, "2020-01-01", True, 10.0), (1, "2020-01-02", None, None), (1, "2020-03-01", True, 5.0),
         (2, "2020-01-05", False, 7.0)],
        "listing_id long, date string, available boolean, price double").withColumn(
        "date", F.to_date("date"))
    r = {x["listing_id"]: x for x in S.calendar_rates(cal).collect()}
    assert r[1]["availability_30_rate"] == 0.5          # null counts as unavailable
    assert r[1]["avg_calendar_price_30"] == 10.0        # null price ignored
    assert abs(r[1]["availability_365_rate"] - 2 / 3) < 1e-12
    assert r[2]["availability_30_rate"] == 0.0
