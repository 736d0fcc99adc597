"""Streams over tables that are folders of files in no order of time."""

import pytest
from pyspark.sql import functions as F

from lodgeframe.plans.io_plans import q_stream_daily_counts, q_stream_reindex
from lodgeframe.sources.tables import read_table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """events and documents as folders of files; the newest events come first."""
    d = str(tmp_path_factory.mktemp("stream"))
    ev = read_table(spark, SF, "events")
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
    step = (hi - lo) / 4
    for i in (3, 1, 0, 2):
        part = (F.col("ts") >= lo + i * step) & (F.col("ts") < lo + (i + 1) * step) if i < 3 else F.col("ts") >= lo + i * step
        ev.where(part).coalesce(1).write.mode("append").parquet(f"{d}/events.parquet")
    read_table(spark, SF, "documents").repartition(3).write.parquet(f"{d}/documents.parquet")
    return d


def test_daily_counts_of_unordered_files(spark, folder):
    got = {(r.day, r.event_type): r.n for r in q_stream_daily_counts(spark, folder).collect()}
    batch = read_table(spark, SF, "events").groupBy(F.to_date("ts").alias("day"), "event_type").count().collect()
    assert got == {(r.day, r.event_type): r["count"] for r in batch}


def test_reindex_of_a_folder(spark, folder):
    got = {r.lang: r.points for r in q_stream_reindex(spark, folder).collect()}
    assert got == {r.lang: r["count"] for r in read_table(spark, SF, "documents").groupBy("lang").count().collect()}
