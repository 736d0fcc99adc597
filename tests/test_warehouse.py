"""Stored views are computed once and sorted by date within their files."""

import datetime as dt

from pyspark.sql import functions as F

from lodgeframe.operators import summary as S
from lodgeframe.session import scratch_path
from lodgeframe.sources import warehouse as WH
from lodgeframe.sources.standin import StandIn


def test_a_large_view_is_computed_once(spark, monkeypatch):
    monkeypatch.setitem(WH.LAYOUT, "calendar_day", ("date", 50))
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    rows = spark.range(5000).select("id", F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") * 37 % 400).cast("int")).alias("date"))
    view = rows.repartition(6, "id").mapInArrow(count, "id long, date date")
    path = WH.materialize_view(spark, view, scratch_path(spark, "once"), "calendar_day", lambda: 5000)
    stored = spark.read.parquet(path)
    assert reads.value == 5000 and stored.exceptAll(rows).count() == 0 and stored.count() == 5000
    kept = stored.select(F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i"), "date").collect()
    for f in {r.f for r in kept}:
        dates = [r.date for r in sorted(kept, key=lambda r: r.i) if r.f == f]
        assert dates == sorted(dates)


def test_calendar_rows_and_nulls(spark):
    from types import SimpleNamespace

    li = spark.createDataFrame([(1, "R", "O", 1.005, 0.06, 3.9, 2), (1, "N", "F", None, None, None, None), (2, None, "O", 5.0, 0.05, 1.0, 1), (None, "N", "O", 1.0, 0.0, 1.0, 1),
                                (9, "N", "O", 1.0, 0.0, 1.0, 1)],
                               "l_orderkey long, l_returnflag string, l_linestatus string, l_extendedprice double, l_discount double, l_quantity double, l_linenumber int")
    li = li.withColumn("l_shipdate", F.timestamp_seconds(F.lit(0)))
    orders = spark.createDataFrame([(1, 10), (1, 11), (2, None), (None, 5)], "o_orderkey long, o_custkey long")
    v = StandIn(spark, "/nowhere", materialized=False)
    v.raw = SimpleNamespace(lineitem=li, orders=orders)
    got = [(r.listing_id or 0, r.available, r.price and float(r.price), r.adjusted_price and float(r.adjusted_price), r.minimum_nights, r.maximum_nights)
                 for r in v.calendar_day().collect()]
    assert sorted(map(str, got)) == sorted(map(str, [(0, None, 5.0, 5.0, 1, 30), (10, True, None, None, None, None), (10, None, 1.01, None, 3, 60),
                                                    (11, True, None, None, None, None), (11, None, 1.01, None, 3, 60)]))
    assert S.calendar_365(v.calendar_day()).count() == 3


def test_large_views_read_once_are_not_stored(spark, monkeypatch, tmp_path):
    """A summary over large tables writes no view and gives the rows that the stored views give."""
    import shutil

    from lodgeframe.plans import summary_plans as SP

    from .conftest import SMALL

    for t in ("customer", "nation", "orders", "lineitem"):
        shutil.copyfile(f"{SMALL}/{t}.parquet", tmp_path / f"{t}.parquet")
    at, stored = str(tmp_path), []
    real = WH.materialize_view
    monkeypatch.setattr(WH, "materialize_view", lambda spark, view, path, name, rows=None: stored.append(name) or real(spark, view, path, name, rows))
    monkeypatch.setitem(WH.LAYOUT, "calendar_day", ("date", 50))
    in_place = SP.q_neighbourhood_summary(spark, at).collect()
    assert stored == [] and SP.q_validate_summary(spark, at).first().passed is not None and stored == []
    v = StandIn(spark, at)
    assert v.calendar_day().count() == StandIn(spark, at, once=True).calendar_day().count() and stored == ["calendar_day"]
    assert StandIn(spark, at, once=True).stored_path("review").endswith("/review") and stored == ["calendar_day", "review"]
    # what is stored already is read
    assert StandIn(spark, at, once=True).calendar_day().inputFiles()[0].split("/")[-2] == "calendar_day"
    monkeypatch.setitem(WH.LAYOUT, "calendar_day", ("date", 250_000))
    assert SP.q_neighbourhood_summary(spark, at).collect() == in_place and len(in_place) > 0
    assert set(stored) >= {"listing", "neighbourhood"}
