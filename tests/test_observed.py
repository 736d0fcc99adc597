"""Checks gathered while a table is written: equal to separate aggregations, inputs read once, empty tables."""

import pytest
from pyspark.sql import functions as F

from lodgeframe.operators import features as FE
from lodgeframe.operators import quality as Q
from lodgeframe.operators import summary as S
from lodgeframe.session import scratch_path

LISTINGS = ("listing_id long, neighbourhood string, price long, minimum_nights long, availability_365 long, "
            "number_of_reviews long, host_id long, host_name string")


def counted(df, reads):
    """``df`` that adds up how often its rows are computed."""
    def run(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b
    return df.mapInArrow(run, df.schema)


@pytest.mark.parametrize("n", [40, 0])
def test_run_report_reads_its_inputs_once(spark, n):
    rows = [(i, f"n{i % 7}" if i % 5 else None, 10 + i, 1, 100, i % 3, i, "x") for i in range(n)]
    listings, segments = spark.createDataFrame(rows, LISTINGS), spark.createDataFrame(
        [(f"n{i}", "t", "p") for i in range(4)], "neighbourhood string, tourism_segment string, priority_level string")
    reads, path = spark.sparkContext.accumulator(0), scratch_path(spark, "observed")
    report = Q.run_report(counted(listings, reads), segments, S.neighbourhood_summary_basic, lambda df: df.write.parquet(path)).first()
    assert reads.value == n
    assert report.asDict() == {"input_listings": n, "input_segments": 4, "output_neighbourhoods": 7 if n else 0,
                               "listings_with_reviews": sum(i % 3 > 0 for i in range(n)), "output_columns": 10}
    assert spark.read.parquet(path).count() == report.output_neighbourhoods


def test_profile_of_the_writing_pass(spark):
    df = spark.createDataFrame([(i, 1.0 if i % 9 == 0 else None, "same", float("nan"), None, i % 2 == 0) for i in range(50)],
                               "listing_id long, rare double, fixed string, nan double, gone string, flag boolean")
    reads = spark.sparkContext.accumulator(0)
    clean, dropped = FE.staged_clean(counted(df, reads), scratch_path(spark, "observed"))
    assert reads.value == 50 and (clean.columns, dropped) == (FE.drop_unusable_columns(df)[0].columns, FE.drop_unusable_columns(df)[1])
    assert clean.exceptAll(df.drop(*dropped)).count() == 0


def test_observed_without_a_finished_plan(spark):
    df = spark.range(5)
    found = Q.observed({"a": (df, [F.sum("id").alias("s")])}, lambda f: None)      # the job never ran it
    assert found == {"a": {"s": 10}}


def test_models_score_after_a_session_has_observed(spark):
    from lodgeframe.operators import ml as ML

    Q.observed({"a": (spark.range(3), [F.sum("id").alias("s")])}, lambda f: f["a"].collect())
    rows = spark.createDataFrame([(i, i % 2, float(i % 2) + i / 100, "xy"[i % 3 == 0]) for i in range(60)], "key long, label int, v double, c string")
    for kind in ("logreg", "forest"):
        _, _, scored = ML.train_and_score(rows, "label", "key", kind, True, columns=["v", "c"])
        assert scored.count() == 12 and scored.where("score between 0 and 1").count() == 12
