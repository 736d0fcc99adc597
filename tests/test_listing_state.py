"""Maintained listing measures: any split into files gives the batch aggregate, late rows are dropped and counted."""

import datetime as dt
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from lodgeframe.operators import summary as S
from lodgeframe.operators import versions as V
from lodgeframe.session import scratch_path
from lodgeframe.streaming import listing_state as LS

CAL = "listing_id long, date date, available boolean, price decimal(12,2)"
REV = "listing_id long, review_date date"
D0 = dt.date(2024, 1, 1)


def calendar(rnd, n, days):
    from decimal import Decimal
    return [(rnd.choice([1, 2, 3, 4, None]), D0 + dt.timedelta(days=rnd.randrange(days)), rnd.choice([True, False, None]),
             rnd.choice([Decimal("10.50"), Decimal("7.25"), None])) for _ in range(n)]


def add_file(spark, folder, rows, schema):
    """One more file, newer than those before."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    path = folder.removeprefix("file:")
    now = time.time()
    add_file.clock = max(now, add_file.clock + 2)
    for name in os.listdir(path):
        full = f"{path}/{name}"
        if full not in add_file.known and name.endswith(".parquet"):
            os.utime(full, (add_file.clock, add_file.clock))
            add_file.known.add(full)


add_file.clock, add_file.known = time.time() - 10_000, set()


def expected(spark, rows, reviews):
    cal = spark.createDataFrame(rows, CAL)
    rates = {r.listing_id: (r.availability_30_rate, r.avg_calendar_price_30, r.availability_365_rate) for r in S.calendar_rates(cal).collect()}
    counts = {r.listing_id: r.total_reviews for r in S.review_counts(spark.createDataFrame(reviews, REV)).collect()}
    return {i: (*rates.get(i, (None, None, None)), counts.get(i, 0)) for i in rates.keys() | counts.keys()}


def found(spark, where):
    return {r.listing_id: tuple(r)[1:] for r in LS.measures(spark, where).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_equals_the_batch_aggregate(spark, tmp_path, seed):
    rnd = random.Random(seed)
    rows, reviews = calendar(rnd, 400, 90), [(rnd.choice([1, 3, 9, None]), D0 + dt.timedelta(days=rnd.randrange(90))) for _ in range(60)]
    cal, rev, where = f"{tmp_path}/cal", f"{tmp_path}/rev", scratch_path(spark, "listing_state_test")
    cuts = [0, 30, 31, 200, 400]
    for a, b in zip(cuts, cuts[1:]):
        add_file(spark, cal, rows[a:b], CAL)
        add_file(spark, rev, reviews[a * 60 // 400:b * 60 // 400 + 1] if a < 31 else reviews[a * 60 // 400 + 1:b * 60 // 400 + 1], REV)
    schemas = spark.createDataFrame([], CAL).schema, spark.createDataFrame([], REV).schema
    LS.maintain(spark, cal, rev, *schemas, delay_days=100, where=where, batch_files=1)
    loaded = [tuple(r) for r in spark.read.parquet(rev).collect()]
    assert found(spark, where) == expected(spark, rows, loaded)
    assert LS.progress(spark, where)["calendar"]["late"] == 0 and LS.progress(spark, where)["calendar"]["rows"] == 400
    # more files later: only they are read, and the state goes on
    more = [(5, D0 - dt.timedelta(days=3), True, None), (1, D0 + dt.timedelta(days=95), False, None)]
    add_file(spark, cal, more, CAL)
    LS.maintain(spark, cal, rev, *schemas, delay_days=100, where=where, batch_files=1)
    assert found(spark, where) == expected(spark, rows + more, loaded)
    assert LS.progress(spark, where)["calendar"]["rows"] == 402


def test_late_rows_are_dropped_and_counted_and_days_expire(spark, tmp_path):
    rnd = random.Random(7)
    rows = sorted(calendar(rnd, 300, 120), key=lambda r: r[1])
    batches = [rows[i:i + 60] for i in range(0, 300, 60)]
    late = [(1, D0, True, None)] * 3 + [(8, D0 + dt.timedelta(days=1), True, None)]
    batches.insert(4, late + [(2, rows[240][1], True, None)])
    cal, rev, where = f"{tmp_path}/cal", f"{tmp_path}/rev", scratch_path(spark, "listing_state_test")
    for b in batches:
        add_file(spark, cal, b, CAL)
    add_file(spark, rev, [(1, D0)], REV)
    schemas = spark.createDataFrame([], CAL).schema, spark.createDataFrame([], REV).schema
    LS.maintain(spark, cal, rev, *schemas, delay_days=10, where=where, batch_files=1)
    accepted, newest, dropped = [], None, 0
    for b in batches:
        ok = [r for r in b if newest is None or r[1] >= newest - dt.timedelta(days=10)]
        dropped += len(b) - len(ok)
        accepted += ok
        newest = max([r[1] for r in ok] + ([newest] if newest else []))
    notes = LS.progress(spark, where)["calendar"]
    assert dropped >= 4 and notes["late"] == dropped and notes["rows"] == sum(map(len, batches)) and notes["closed"]
    assert found(spark, where) == expected(spark, accepted, [(1, D0)])
    state = LS.keyed.read(spark, f"{where}/calendar")
    assert state.where(F.size("days") > 0).count() == 0                # the closed range is four numbers per listing


def test_a_replayed_batch_changes_nothing(spark):
    table = scratch_path(spark, "listing_state_replay")
    batch = spark.createDataFrame([(1, D0, True, None), (1, D0, False, None)], CAL)
    LS.merge_calendar(batch, 0, table, 5)
    LS.merge_calendar(batch, 0, table, 5)
    assert [(r.n_all, r.open_all) for r in LS.keyed.read(spark, table).collect()] == [(2, 1)]
    LS.merge_calendar(batch, 1, table, 5)
    assert [(r.n_all, r.open_all) for r in LS.keyed.read(spark, table).collect()] == [(4, 2)]
    LS.merge_calendar(batch.limit(0), 2, table, 5)
    assert V.latest(spark, table)["notes"]["rows"] == 4
