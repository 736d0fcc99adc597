"""Incremental forms of two batch jobs as Structured Streaming queries.

Both run with ``Trigger.AvailableNow`` (process what is there, then stop)
and keep their progress in a checkpoint folder below the shared
``spark.checkpoint.dir``, so a restart -- or a lost executor -- resumes
from the last committed micro-batch.  The sinks are keyed tables: a
micro-batch is one delta folder whatever the table holds, its number is
committed with it, and a replayed batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import keyed
from ..operators import vectors as V
from ..operators.sinks import read_upserted, upsert_table
from ..session import own_session, scratch_path
from .listing_state import file_stream

#: bytes of files in one micro-batch of documents, or of events
DOCUMENT_BATCH_BYTES = 1 << 30
EVENT_BATCH_BYTES = 8 << 30


def _bounds(batch_bytes: int, batch_files: int | None) -> dict:
    return {"batch_files": batch_files} if batch_files is not None else {"batch_bytes": batch_bytes}


def daily_event_counts(spark: SparkSession, events_path: str, schema, out_path: str | None = None,
                       watermark: str | None = "1 day", max_files_per_trigger: int | None = 1,
                       checkpoint: str | None = None) -> DataFrame:
    """ST2: daily tumbling-window counts/sums per event type.

    ``readStream`` (file source) -> ``withWatermark`` -> ``window`` of one day
    -> update mode: each micro-batch upserts the windows it changed into the
    published table.  Windows older than the watermark leave the state, and
    rows for them (later than ``watermark``) are dropped.  A watermark as long
    as the table's time span (``span_watermark``) drops no row of files in any
    order.  Without one every window stays in the state.  A micro-batch is
    ``max_files_per_trigger`` files, or without that ``EVENT_BATCH_BYTES``.
    """
    out_path = out_path or scratch_path(spark, "daily_event_counts")
    checkpoint = checkpoint or scratch_path(spark, "daily_event_counts_ckpt")
    src = file_stream(spark, events_path, schema, **_bounds(EVENT_BATCH_BYTES, max_files_per_trigger))
    # the session runs in UTC (session.py), so a wall-clock day is a UTC day
    instant = F.col("ts").cast("timestamp")
    timed = src.withColumn("_event_time", instant)
    if watermark is not None:
        timed = timed.withWatermark("_event_time", watermark)
    agg = (timed.groupBy(F.window("_event_time", "1 day").alias("w"), "event_type")
                .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")))

    def publish(batch: DataFrame, epoch: int) -> None:
        rows = batch.select(F.col("w.start").cast("date").alias("day"), "event_type", "n", "total")
        upsert_table(spark, rows.withColumn("key", F.concat_ws("|", "day", "event_type")), out_path, key="key", order="n",
                     batch=("daily_event_counts", epoch))

    q = (agg.writeStream.outputMode("update").foreachBatch(publish)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return read_upserted(spark, out_path).drop("key")


def span_watermark(rows: DataFrame, instant: str) -> str:
    """A watermark as long as the time span of ``rows``: none of them is late."""
    low, high = rows.agg(F.min(F.col(instant).cast("timestamp")), F.max(F.col(instant).cast("timestamp"))).first()
    return f"{(high - low).days + 2 if low is not None else 1} days"


def stream_reindex(spark: SparkSession, docs_path: str, schema, index_path: str | None = None,
                   checkpoint: str | None = None, text_col: str = "text", key: str = "doc_id",
                   batch_bytes: int = DOCUMENT_BATCH_BYTES, max_files_per_trigger: int | None = None,
                   rows_per_bucket: int = keyed.ROWS_PER_BUCKET, payload=None) -> DataFrame:
    """ST1: new documents are embedded and upserted into a vector index by id.

    The stream checkpoint replaces the ``--since`` bookkeeping of the batch job.
    Micro-batches are bounded by the bytes of their files; each is embedded and
    written once, as a delta of the index.  ``payload`` maps the rows (id,
    embedding and the other columns of the files, without the text) to the stored
    points; by default they are id, lang, source and embedding.
    """
    index_path = index_path or scratch_path(spark, "stream_index")
    checkpoint = checkpoint or scratch_path(spark, "stream_index_ckpt")
    own = own_session(spark, spark__sql__execution__arrow__maxRecordsPerBatch="512")     # whole texts
    src = file_stream(own, docs_path, schema, **_bounds(batch_bytes, max_files_per_trigger))
    emb = V.embed(src.withColumnRenamed(key, "id"), text_col, keep_text=False)

    def upsert(batch: DataFrame, epoch: int) -> None:
        points = payload(batch) if payload else batch.select("id", "lang", "source", "embedding")
        upsert_table(own, points, index_path, rows_per_bucket=rows_per_bucket, batch=("stream_reindex", epoch))

    q = (emb.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
    q.awaitTermination()
    return read_upserted(spark, index_path)
