"""Operators that look at schemas or files only, so they are no registered queries."""

from lodgeframe.plans import io_plans, ml_plans
from lodgeframe.session import scratch_path
from lodgeframe.streaming import incremental as ST

SF = "/root/testdata/sf0.001"


def test_pii_audit_finds_no_leak(spark):
    rows = io_plans.q_pii_audit(spark, SF).collect()
    assert rows and not any(r["in_output"] for r in rows if r["decision"] in ("drop", "exclude"))


def test_sidecar_present_and_absent(spark):
    assert io_plans.q_scan_sidecar(spark, SF).count() == 1


def test_feature_lists(spark):
    rows = ml_plans.q_feature_lists(spark, SF).collect()
    assert all(r["in_leaky"] for r in rows) and 0 < sum(r["in_clean"] for r in rows) < len(rows)


def test_stream_counts_drop_late_rows(spark):
    """The second file moves the watermark on, the fourth brings a late row (a
    batch drops rows by the watermark that the batch before it ran with)."""
    path = scratch_path(spark, "late_events")
    schema = "event_type string, value double, ts timestamp_ntz"
    for rows in ([("a", 1.0, "2024-01-01 05:00:00"), ("a", 2.0, "2024-01-02 05:00:00")],
                 [("a", 4.0, "2024-01-09 05:00:00")], [("c", 3.0, "2024-01-09 06:00:00")], [("a", 8.0, "2024-01-01 06:00:00"), ("b", 1.0, "2024-01-09 07:00:00")]):
        df = spark.createDataFrame(rows, "event_type string, value double, t string")
        df.selectExpr("event_type", "value", "cast(t as timestamp_ntz) as ts").coalesce(1).write.mode("append").parquet(path)
    from pyspark.sql.types import StructType
    got = {(str(r.day), r.event_type): (r.n, r.total) for r in
           ST.daily_event_counts(spark, path, StructType.fromDDL(schema)).collect()}
    assert got == {("2024-01-01", "a"): (1, 1.0), ("2024-01-02", "a"): (1, 2.0), ("2024-01-09", "a"): (1, 4.0), ("2024-01-09", "b"): (1, 1.0), ("2024-01-09", "c"): (1, 3.0)}
