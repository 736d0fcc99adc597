"""Exact dedup by a stateful stream, in DataFrame functions only.

The files of a table are streamed in micro-batches of ``batch_bytes``. A
streaming aggregation keyed by the text's SHA-256 keeps its state in RocksDB
(on disk, with a changelog in the checkpoint) and never expires it: for each
digest the first row seen as content locator (batch time, file, row in the
file) with its id, the row that stays, and the count. Partial aggregates leave
the scan, so a hot text is one row per task and batch. Files that arrive later
continue from the same checkpoint.

Digests only propose copies. Every hit is compared with the whole bytes of the
row at its class's locator; hot classes are salted for that. Classes in which
the bytes differ (a collision of the digest) are grouped again by the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeframe.llm.common import fresh_names, prepare, stage
from lodgeframe.session import is_folder, scratch_path
from lodgeframe.sources.tables import table_path

#: bytes of files in one micro-batch
BATCH_BYTES = 256 << 30

#: classes of copies (about 300 bytes each) that may be broadcast; more are joined by a shuffle
BROADCAST_CLASSES = 50_000

#: a class with more than this part of all rows is dealt to several tasks
SHARES = 1000

RESULTS = ("keep_id", "group_size", "kept")

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # logs of small state partitions take the disk they need, not preallocated blocks of megabytes
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # all state partitions of an executor share one bounded cache
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


def sha256(body: Column) -> Column:
    return F.unhex(F.sha2(body, 256))


def state_session(spark: SparkSession) -> SparkSession:
    """A session of its own for the state's settings; the caller's stay as they are."""
    own = spark.newSession()
    for key, value in STATE_CONF.items():
        own.conf.set(key, value)
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    return own


def body_of(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")


def ingest(spark: SparkSession, path: str, where: str, doc_id: str, text: str, digest=sha256,
           batch_bytes: int = BATCH_BYTES) -> None:
    """Bring the keyed state in ``where`` up to date with all files at ``path``
    (a Parquet file, or a folder to which files are added)."""
    own = state_session(spark)
    reader = own.readStream.schema(own.read.parquet(path).schema).option("maxBytesPerTrigger", batch_bytes)
    if is_folder(spark, path):
        rows = reader.parquet(path)
    else:
        folder, name = path.rstrip("/").rsplit("/", 1)
        rows = reader.option("pathGlobFilter", name).parquet(folder)
    # the batch time stays the same when a batch is run again
    keyed = rows.select(digest(body_of(text)).alias("digest"), F.col(doc_id).alias("id"), F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.row_index").alias("at"), F.current_timestamp().alias("seen"))
    state = keyed.groupBy("digest").agg(F.min(F.struct("seen", "file", "at", "id")), F.max(F.struct("id", "file", "at")), F.count(F.lit(1)))
    (state.writeStream.outputMode("update").format("noop").option("checkpointLocation", where)
          .trigger(availableNow=True).start().awaitTermination())


def classes(spark: SparkSession, where: str) -> DataFrame:
    """The keyed state: digest, first (locator and id), top (the row that stays), n."""
    state = state_session(spark).read.format("statestore").load(where)
    return state.select("key.digest", F.col("value.min").alias("first"), F.col("value.max").alias("top"), F.col("value.count").alias("n"))


def find_copies(spark: SparkSession, path: str, doc_id: str, text: str, where: str | None = None, digest=sha256,
                batch_bytes: int = BATCH_BYTES, broadcast_classes: int = BROADCAST_CLASSES) -> DataFrame:
    """All rows at ``path`` with keep_id (``doc_id`` of the row that stays),
    group_size and kept.

    Of equal texts the row with the largest id stays (a null id is the smallest;
    rows of the same id: the last by file and place), so one row of each class
    is kept, also among repeated rows. A null text is empty, blank texts are
    texts like others; an empty table gives no rows. Other columns pass through;
    those with a result's name are replaced. ``where`` keeps the state for
    later calls with more files; by default it is new.
    """
    prepare(spark)
    where = where or scratch_path(spark, "llm-copies-state")
    docs = spark.read.parquet(path)
    keep = [c for c in docs.columns if c.lower() not in RESULTS]
    if not is_folder(spark, path) or docs.inputFiles():
        ingest(spark, path, where, doc_id, text, digest, batch_bytes)
    else:
        return docs.select(*keep, F.col(doc_id).alias("keep_id"), F.lit(0).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    found = stage(classes(spark, where).where("n > 1"), "copies-classes")
    total, n_classes = docs.count(), found.count()
    key, file, at, n, first, top, parts, salt, whole = fresh_names(
        docs.columns, "digest", "file", "at", "n", "first", "top", "parts", "salt", "whole")
    n_parts = F.least("n", F.ceil(F.col("n") * F.lit(SHARES) / F.lit(max(total, 1))))
    found = found.select(F.col("digest").alias(key), F.col("n").alias(n), F.col("first").alias(first), F.col("top").alias(top),
                         F.greatest(F.lit(1), n_parts).cast("long").alias(parts))
    rows = docs.select(*keep, digest(body_of(text)).alias(key), F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(at))
    here, shares = F.xxhash64(file, at), F.sequence(F.lit(0).cast("long"), F.col(parts) - 1)
    if n_classes <= broadcast_classes:
        marked = rows.join(F.broadcast(found), key, "left").withColumn(salt, F.pmod(here, F.col(parts)))
    else:
        # at most SHARES classes hold more than one of SHARES parts of the rows: a bounded broadcast
        hot = found.where(F.col(parts) > 1).select(key, F.col(parts).alias(whole))
        dealt = rows.join(F.broadcast(hot), key, "left").withColumn(salt, F.pmod(here, F.coalesce(whole, F.lit(1)))).drop(whole)
        marked = dealt.join(found.withColumn(salt, F.explode(shares)), [key, salt], "left")

    def same(row: str) -> Column:
        return (F.col(file) == F.col(f"{row}.file")) & (F.col(at) == F.col(f"{row}.at"))

    # every hit against the whole bytes at its class's locator
    hits = marked.where(F.col(n) > 1).select(key, salt, parts, body_of(text).alias(whole), same(first).alias(first))
    held = hits.where(F.col(first)).select(key, F.explode(shares).alias(salt), F.col(whole).alias(top))
    differ = (hits.where(~F.col(first)).join(held, [key, salt]).where(F.col(whole) != F.col(top))
                  .select(key).distinct())
    differ = stage(differ, "copies-differ")
    out = marked.select(*keep, key, F.when(F.col(n) > 1, F.col(f"{top}.id")).otherwise(F.col(doc_id)).alias("keep_id"),
                        F.coalesce(n, F.lit(1)).cast("long").alias("group_size"), F.coalesce(same(top), F.lit(True)).alias("kept"))
    if not differ.isEmpty():
        mixed = rows.join(differ, key, "left_semi")
        own = mixed.groupBy(key, body_of(text).alias(whole)).agg(
            F.max(F.struct(F.col(doc_id).alias("id"), F.col(file).alias("file"), F.col(at).alias("at"))).alias(top), F.count(F.lit(1)).alias(n))
        again = mixed.withColumn(whole, body_of(text)).join(own, [key, whole]).select(
            *keep, key, F.col(f"{top}.id").alias("keep_id"), F.col(n).alias("group_size"), same(top).alias("kept"))
        out = out.join(differ, key, "left_anti").select(again.columns).union(again)
    return out.drop(key)


def keep_one(found: DataFrame) -> DataFrame:
    """Only the rows that stay, without the result columns."""
    return found.where("kept").drop(*RESULTS)


def op12_exact_dedup(spark, sf_dir: str) -> DataFrame:
    found = find_copies(spark, table_path(sf_dir, "documents"), "doc_id", "text")
    return found.select("doc_id", "keep_id", "group_size", "kept", F.sha2(body_of("text"), 256).alias("text_sha256"))
