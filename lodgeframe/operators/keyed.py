"""A growing table with one row per key: linear-hash buckets and delta folders.

``upsert`` writes its batch once, as a delta folder; no stored row is touched.
Deltas of one level are merged when ``FAN`` of them have gathered, and moved
into the buckets once they hold more than a share of the table, so the rewriting
per row stays bounded however small the batches are.

Buckets split by linear hashing: with ``n`` buckets and ``2**L <= n``, a key of
hash ``h`` lies in ``h mod 2**(L+1)`` if that is below ``n``, else in
``h mod 2**L``.  When the table outgrows ``n`` buckets of ``rows_per_bucket``,
``n`` grows and only the buckets that split, or that new rows fall into, are
written again.  A bucket holds about ``rows_per_bucket`` rows, at most twice
that while its turn to split has not come.

The table is what the newest log entry names (``versions.py``): readers never
see half an upsert, and concurrent upserts both take effect.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from . import versions as V

ROWS_PER_BUCKET = 100_000
FAN = 8
#: deltas move into the buckets when they hold this part of the stored rows
DELTA_SHARE = 0.5
#: stored bytes that one task of a compaction writes, about
TASK_BYTES = 16 << 20

_BUCKET, _SEQ, _TOP = "__bucket", "__seq", "__top"


def bucket_of(key: str, n: int) -> Column:
    """Linear-hash bucket of a key among ``n`` buckets."""
    h = F.xxhash64(F.col(key))
    low = 1 << (n.bit_length() - 1)
    return F.when(F.pmod(h, F.lit(2 * low)) < n, F.pmod(h, F.lit(2 * low))).otherwise(F.pmod(h, F.lit(low))).cast("int")


def parent(bucket: int, n: int) -> int:
    """The bucket, among ``n``, that held the rows of ``bucket`` before it split off."""
    while bucket >= n:
        bucket -= 1 << (bucket.bit_length() - 1)
    return bucket


def last_rows(df: DataFrame, key: str, order: str | None) -> DataFrame:
    """One row per key: the one of largest ``order`` (ties, and without an order
    column: the largest row by value)."""
    row = F.struct(*([F.col(order).alias("_order")] if order else []), *df.columns)
    return df.groupBy(F.col(key).alias("_key")).agg(F.max(row).alias("r")).select(*(F.col(f"r.{c}").alias(c) for c in df.columns))


def folders_of(entry: dict) -> list[str]:
    return [d["folder"] for d in entry["deltas"]] + sorted({f for f, _ in entry["buckets"].values()})


def _schema(entry: dict) -> StructType:
    return StructType.fromJson(json.loads(entry["schema"]))


def _read(spark: SparkSession, schema: StructType, paths: list[str]) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _base(spark: SparkSession, path: str, entry: dict, buckets=None) -> DataFrame:
    chosen = entry["buckets"] if buckets is None else {b: entry["buckets"][b] for b in buckets if b in entry["buckets"]}
    return _read(spark, _schema(entry), [f"{path}/{folder}/{_BUCKET}={b}" for b, (folder, rows) in chosen.items() if rows])


def _newest(spark: SparkSession, path: str, entry: dict, deltas: list[dict]) -> DataFrame:
    """The rows of some deltas, the latest of each key."""
    if len(deltas) <= 1:
        return _read(spark, _schema(entry), [f"{path}/{d['folder']}" for d in deltas])
    parts = [_read(spark, _schema(entry), [f"{path}/{d['folder']}"]).withColumn(_SEQ, F.lit(k)) for k, d in enumerate(deltas)]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    key = entry["key"]
    # only keys that several deltas hold need a comparison
    again = rows.groupBy(F.col(key).alias(_TOP)).agg(F.max(_SEQ).alias("seq"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = again.select(F.col(_TOP), F.col("seq").alias(f"{_TOP}_seq"))
    joined = rows.join(again, F.col(key).eqNullSafe(F.col(_TOP)), "left")
    return joined.where(F.coalesce(F.col(_SEQ) == F.col(f"{_TOP}_seq"), F.lit(True))).select(*_schema(entry).names)


def _over(base: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``base`` with the rows of ``new`` in place of those with their keys."""
    keys = new.select(F.col(key).alias(_TOP))
    return base.join(keys, F.col(key).eqNullSafe(F.col(_TOP)), "left_anti").unionByName(new)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per key, as of the newest entry (resolved once, here)."""
    path = path.rstrip("/")
    entry = V.latest(spark, path)
    if entry is None:
        raise FileNotFoundError(f"no keyed table at {path}")
    if not entry["deltas"]:
        return _base(spark, path, entry)
    new = _newest(spark, path, entry, entry["deltas"])
    return _over(_base(spark, path, entry), new, entry["key"]) if entry["buckets"] else new


def upsert(spark: SparkSession, new: DataFrame, path: str, key: str = "id", order: str | None = None,
           rows_per_bucket: int = ROWS_PER_BUCKET, limit: int | None = None, dry_run: bool = False,
           batch: tuple[str, int] | None = None, notes: dict | None = None) -> int:
    """Replace rows by ``key``, keep all others; the number of points of the batch.

    Of repeated keys in a batch one row stays (``last_rows``); a null key is a
    key.  ``limit`` takes the first keys only; a dry run counts and writes
    nothing.  ``batch`` names a stream and its micro-batch: one that has been
    applied is not applied again.  ``notes`` are stored in the same log entry.
    """
    path = path.rstrip("/")
    if limit is not None:
        new = new.orderBy(key).limit(limit)
    if dry_run:
        return new.select(key).distinct().count()
    now = V.latest(spark, path)
    if batch and now and now["streams"].get(batch[0], -1) >= batch[1]:
        return 0
    schema = StructType.fromJson(json.loads(new.schema.json()))
    folder = V.new_folder(path, "delta")
    new.write.parquet(f"{path}/{folder}")
    written = _read(spark, schema, [f"{path}/{folder}"])
    n, keys = written.select(F.count(F.lit(1)), F.count_distinct(F.struct(key))).first()
    if keys < n:                                                   # rare, and told by the keys alone
        folder = V.new_folder(path, "delta")
        last_rows(written, key, order).write.parquet(f"{path}/{folder}")

    def add(entry):
        entry = entry or {"key": key, "schema": schema.json(), "n": 1, "buckets": {}, "deltas": [], "streams": {}, "notes": {}}
        if batch and entry["streams"].get(batch[0], -1) >= batch[1]:
            return None
        streams = entry["streams"] | ({batch[0]: batch[1]} if batch else {})
        deltas = entry["deltas"] + ([{"folder": folder, "rows": keys, "level": 0}] if keys else [])
        return {**entry, "deltas": deltas, "streams": streams, "notes": entry["notes"] | (notes or {})}

    entry = V.commit(spark, path, add)
    stored, waiting = sum(r for _, r in entry["buckets"].values()), sum(d["rows"] for d in entry["deltas"])
    if waiting > max(rows_per_bucket, DELTA_SHARE * stored):
        compact(spark, path, rows_per_bucket)
    else:
        while (run := mergeable(V.latest(spark, path)["deltas"])):
            merge_deltas(spark, path, run)
    return keys


def mergeable(deltas: list[dict]) -> list[dict]:
    """The last ``FAN`` deltas if they are of one level."""
    tail = deltas[-FAN:]
    return tail if len(tail) == FAN and len({d["level"] for d in tail}) == 1 else []


def merge_deltas(spark: SparkSession, path: str, run: list[dict]) -> None:
    """Write some neighbouring deltas as one of the next level."""
    path = path.rstrip("/")
    entry, folder = V.latest(spark, path), V.new_folder(path, "delta")
    _newest(spark, path, entry, run).write.parquet(f"{path}/{folder}")
    rows = _read(spark, _schema(entry), [f"{path}/{folder}"]).count()
    names = [d["folder"] for d in run]

    def replace(now):
        at = [d["folder"] for d in now["deltas"]]
        if names[0] not in at or at[at.index(names[0]):][:len(names)] != names:
            return None                                            # another writer was faster
        i = at.index(names[0])
        one = {"folder": folder, "rows": rows, "level": run[0]["level"] + 1}
        return {**now, "deltas": now["deltas"][:i] + [one] + now["deltas"][i + len(names):]}

    V.commit(spark, path, replace)


def compact(spark: SparkSession, path: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> list[int]:
    """Move all deltas into the buckets, splitting as the table has grown; the
    buckets that were written."""
    path = path.rstrip("/")
    entry = V.latest(spark, path)
    deltas, old = entry["deltas"], entry["n"]
    if not deltas:
        return []
    new, key = _newest(spark, path, entry, deltas), entry["key"]
    total = sum(r for _, r in entry["buckets"].values()) + sum(d["rows"] for d in deltas)
    n = max(old, -(-total // rows_per_bucket))
    # bucket numbers only, at most n of them
    touched = [r[0] for r in new.select(bucket_of(key, n).alias("b")).distinct().collect()]
    before = sorted({parent(b, old) for b in touched} | {parent(b, old) for b in range(old, n)})
    written = [b for b in range(n) if parent(b, old) in set(before)] if n > old else before
    base = _base(spark, path, entry, [str(b) for b in before])
    folder = V.new_folder(path, "base")
    dealt = _over(base, new, key).withColumn(_BUCKET, bucket_of(key, n))
    # wide rows (texts, vectors): a bucket's rows are dealt to as many tasks as their bytes ask for
    stored_in = [f"{path}/{d['folder']}" for d in deltas]
    for b in map(str, before):
        if entry["buckets"].get(b, [None, 0])[1]:
            stored_in.append(f"{path}/{entry['buckets'][b][0]}/{_BUCKET}={b}")
    size = sum(V.stored_bytes(spark, f) for f in stored_in)
    each = max(1, -(-size // (TASK_BYTES * len(written))))
    share = F.pmod(F.xxhash64(F.col(key), F.lit(1)), F.lit(each))
    dealt.repartition(min(len(written) * each, 10_000), _BUCKET, share).write.partitionBy(_BUCKET).parquet(f"{path}/{folder}")
    stored = spark.read.schema(StructType([*_schema(entry).fields, StructField(_BUCKET, IntegerType())])).parquet(f"{path}/{folder}")
    rows = {r[0]: r[1] for r in stored.groupBy(_BUCKET).count().collect()}
    used = [d["folder"] for d in deltas]

    def replace(now):
        if now["n"] != old or [d["folder"] for d in now["deltas"]][:len(used)] != used or now["buckets"] != entry["buckets"]:
            return None                                            # another compaction was faster
        buckets = {b: x for b, x in now["buckets"].items() if int(b) not in set(before)}
        buckets |= {str(b): [folder, rows.get(b, 0)] for b in written}
        return {**now, "n": n, "buckets": buckets, "deltas": now["deltas"][len(used):]}

    V.commit(spark, path, replace)
    return written


def vacuum(spark: SparkSession, path: str, keep_s: float = V.KEEP_S) -> list[str]:
    """Delete folders that no entry of the last ``keep_s`` seconds names."""
    return V.vacuum(spark, path, folders_of, keep_s)
