"""Growing keyed tables and versioned publishing: bucket sizes, write amounts, replays, concurrent writers and readers."""

import threading

import pytest
from pyspark.sql import functions as F

from lodgeframe.operators import keyed, sinks
from lodgeframe.operators import versions as V
from lodgeframe.session import scratch_path


def rows_of(spark, path):
    return {r["id"]: r["val"] for r in keyed.read(spark, path).collect()}


def test_linear_hash_buckets_follow_their_parents(spark):
    for old, new in [(1, 2), (1, 7), (3, 4), (5, 13), (8, 8)]:
        rows = spark.range(500).select(keyed.bucket_of("id", old).alias("a"), keyed.bucket_of("id", new).alias("b")).distinct().collect()
        assert all(keyed.parent(r.b, old) == r.a for r in rows) and {r.b for r in rows} == set(range(new))


def test_buckets_stay_bounded_while_the_table_grows(spark):
    path = scratch_path(spark, "growing")
    for first, last in [(0, 3), (3, 20_000), (20_000, 100_000)]:
        keyed.upsert(spark, spark.range(first, last).withColumn("val", F.lit("v0")), path, rows_per_bucket=1000)
        keyed.compact(spark, path, 1000)
        entry = V.latest(spark, path)
        sizes = [n for _, n in entry["buckets"].values()]
        assert sum(sizes) == last and max(sizes) <= 2.5 * 1000 and entry["n"] == max(1, -(-last // 1000))
    assert keyed.read(spark, path).select("id").distinct().count() == 100_000


def test_a_small_upsert_writes_one_delta(spark):
    path = scratch_path(spark, "delta")
    keyed.upsert(spark, spark.range(5000).withColumn("val", F.lit("v0")), path, rows_per_bucket=500)
    before = V.latest(spark, path)
    assert before["n"] == 10 and not before["deltas"]
    assert keyed.upsert(spark, spark.createDataFrame([(7, "v1")], "id long, val string"), path, rows_per_bucket=500) == 1
    after = V.latest(spark, path)
    assert after["buckets"] == before["buckets"] and [d["rows"] for d in after["deltas"]] == [1]
    found = rows_of(spark, path)
    assert len(found) == 5000 and found[7] == "v1" and found[8] == "v0"
    written = keyed.compact(spark, path, 500)
    assert len(written) == 3 and rows_of(spark, path) == found      # the bucket of the row, and the one that splits (row 5001)


def test_many_small_batches_merge_by_levels(spark):
    path = scratch_path(spark, "levels")
    expected = {}
    for k in range(20):
        batch = [(i, f"v{k}") for i in range(k % 5, 12, 3)] + [(None, f"n{k}")]
        expected |= dict(batch)
        keyed.upsert(spark, spark.createDataFrame(batch, "id long, val string"), path)
    deltas = V.latest(spark, path)["deltas"]
    assert len(deltas) < 2 * keyed.FAN and max(d["level"] for d in deltas) >= 1
    assert rows_of(spark, path) == expected and keyed.read(spark, path).count() == len(expected)
    keyed.compact(spark, path)
    assert rows_of(spark, path) == expected and not V.latest(spark, path)["deltas"]


def test_a_replayed_micro_batch_is_not_applied(spark):
    path = scratch_path(spark, "replay")
    a, b = (spark.createDataFrame([(1, v)], "id long, val string") for v in "ab")
    assert keyed.upsert(spark, a, path, batch=("s", 0), notes={"seen": 1}) == 1
    assert keyed.upsert(spark, b, path, batch=("s", 0)) == 0 and rows_of(spark, path) == {1: "a"}
    assert keyed.upsert(spark, b, path, batch=("s", 1)) == 1 and rows_of(spark, path) == {1: "b"}
    assert V.latest(spark, path)["notes"] == {"seen": 1}


def test_writers_at_the_same_time_both_count(spark):
    path = scratch_path(spark, "writers")
    keyed.upsert(spark, spark.createDataFrame([(0, "x")], "id long, val string"), path)
    errors = []

    def write(k):
        try:
            keyed.upsert(spark, spark.createDataFrame([(k, str(k))], "id long, val string"), path)
        except Exception as e:
            errors.append(e)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(1, 7)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors and rows_of(spark, path) == {0: "x"} | {k: str(k) for k in range(1, 7)}


def test_readers_see_whole_versions_during_refreshes(spark):
    path, schema = scratch_path(spark, "published"), "v int, part int"
    make = lambda k: spark.range(40).select(F.lit(k).cast("int").alias("v"), F.col("id").cast("int").alias("part")).repartition(4)
    V.publish(spark, path, V.stage_version(make(0), path), make(0).schema)
    seen, errors, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                rows = V.read_published(spark, path).groupBy("v").count().collect()
                seen.append([(r.v, r["count"]) for r in rows])
            except Exception as e:
                errors.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    for k in range(1, 9):
        V.publish(spark, path, V.stage_version(make(k), path), make(k).schema)
    stop.set()
    reader.join()
    assert not errors and all(len(s) == 1 and s[0][1] == 40 for s in seen)
    order = [s[0][0] for s in seen]
    assert order == sorted(order) and schema


def test_vacuum_keeps_what_entries_name(spark):
    path = scratch_path(spark, "vacuum")
    for k in range(3):
        keyed.upsert(spark, spark.range(50).withColumn("val", F.lit(f"v{k}")), path, rows_per_bucket=10)
    held = rows_of(spark, path)
    assert keyed.vacuum(spark, path, keep_s=3600) == []
    assert keyed.vacuum(spark, path, keep_s=-5) and rows_of(spark, path) == held
    assert len(V.entries(spark, path)) == 1


def test_a_cut_off_entry_is_passed_over(spark):
    path = scratch_path(spark, "cut")
    keyed.upsert(spark, spark.createDataFrame([(1, "a")], "id long, val string"), path)
    fs, p = V._fs(spark, V.entry_path(path, V.entries(spark, path)[0] + 1))
    out = fs.create(p, False)
    out.write(bytearray(b'{"key": "id", "buck'))
    out.close()
    assert rows_of(spark, path) == {1: "a"}
    keyed.upsert(spark, spark.createDataFrame([(2, "b")], "id long, val string"), path)
    assert rows_of(spark, path) == {1: "a", 2: "b"}


def test_missing_tables_are_errors(spark):
    for read in (keyed.read, V.read_published, sinks.read_upserted):
        with pytest.raises(FileNotFoundError):
            read(spark, scratch_path(spark, "absent"))


def test_wide_buckets_are_written_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(keyed, "TASK_BYTES", 1 << 14)
    path = scratch_path(spark, "wide")
    wide = spark.range(3000).withColumn("val", F.concat_ws("", *(F.sha2(F.concat(F.col("id"), F.lit(f"-{i}")), 512) for i in range(4))))
    keyed.upsert(spark, wide, path, rows_per_bucket=1000)
    buckets = V.latest(spark, path)["buckets"]
    folder = next(iter(buckets.values()))[0]
    files = spark.read.parquet(f"{path}/{folder}").select("__bucket", F.input_file_name().alias("file")).distinct().groupBy("__bucket").count().collect()
    assert len(buckets) == len(files) == 3 and all(r["count"] > 3 for r in files)
    assert keyed.read(spark, path).exceptAll(wide).count() == 0 and keyed.read(spark, path).count() == 3000
