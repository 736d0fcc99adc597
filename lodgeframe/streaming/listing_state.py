"""Per-listing measures kept up to date by streams of new rows (ST2).

The daily job recomputes every listing's availability and review counts from
the whole calendar.  Here the measures are maintained: a micro-batch of new
calendar (or review) rows is summed per listing and merged into a stored row
per listing, so a refresh costs what is new, not what is stored.

Sums merge in any order, but the first 30 days of the calendar are only known
once no older row can come.  A stored row therefore keeps the days of
``[start, start + 30)`` apart, ``start`` being the oldest date so far: an older
date moves the range back, and the days that leave it are in the whole-calendar
sums already.  Once the watermark (the newest date of the batches before, less
the allowed delay) has passed the range, the days are summed up and dropped
from the state for good.

Rows older than the watermark are late: they are not merged, and counted.
Watermark, start and counts are committed in the same log entry as the rows, so
a replayed batch finds them as they were.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import keyed
from ..operators import versions as V
from ..session import scratch_path

FIRST_DAYS = 30
BATCH_BYTES = 8 << 30

_SUMS = ("n", "open", "priced")
#: per day of the first range: rows, open rows, rows with a price, sum of prices
_DAY = "struct<n:bigint,open:bigint,priced:bigint,price:decimal(38,2)>"


def file_stream(spark: SparkSession, path: str, schema, batch_bytes: int | None = None, batch_files: int | None = None) -> DataFrame:
    """File stream over a folder of files, or over one file, in micro-batches
    bounded by bytes or by files."""
    from ..session import is_folder

    reader = spark.readStream.schema(schema)
    if batch_files is not None:
        reader = reader.option("maxFilesPerTrigger", batch_files)
    elif batch_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", batch_bytes)
    if is_folder(spark, path):
        return reader.parquet(path)
    folder, name = path.rstrip("/").rsplit("/", 1)
    return reader.option("pathGlobFilter", name).parquet(folder)


def _notes(spark: SparkSession, table: str) -> dict:
    entry = V.latest(spark, table)
    return entry["notes"] if entry else {}


def _split_late(batch: DataFrame, day: str, notes: dict, delay_days: int) -> tuple[DataFrame, dict]:
    """The batch without late rows, and the notes that go with it."""
    mark = (dt.date.fromisoformat(notes["newest"]) - dt.timedelta(days=delay_days)) if notes else None
    late = F.lit(False) if mark is None else F.coalesce(F.col(day) < F.lit(mark), F.lit(False))
    total, n_late, low, high = batch.agg(F.count(F.lit(1)), F.count_if(late), F.min(F.when(~late, F.col(day))),
                                         F.max(F.when(~late, F.col(day)))).first()
    out = {"rows": notes.get("rows", 0) + total, "late": notes.get("late", 0) + n_late}
    for name, value, pick in (("start", low, min), ("newest", high, max)):
        known = [x for x in (notes.get(name), value.isoformat() if value else None) if x]
        if known:
            out[name] = pick(known)
    # the first range is final when no row at or before its end can still be merged
    if mark is not None and "start" in out:
        out["closed"] = notes.get("closed", False) or mark >= dt.date.fromisoformat(out["start"]) + dt.timedelta(days=FIRST_DAYS)
    return batch.where(~late), out


def _calendar_sums(rows: DataFrame, start: str) -> DataFrame:
    """One row per listing of a batch: sums over all its days, and those of the first range by day."""
    is_open, price = F.when(F.col("available"), 1).otherwise(0).cast("long"), F.col("price").cast("decimal(38,2)")
    by_day = rows.groupBy("listing_id", "date").agg(
        F.count(F.lit(1)).alias("n"), F.sum(is_open).alias("open"), F.count("price").alias("priced"), F.sum(price).alias("price"))
    first = (F.col("date") >= F.lit(start).cast("date")) & (F.col("date") < F.date_add(F.lit(start).cast("date"), FIRST_DAYS))
    entry = F.when(first, F.struct(F.col("date").alias("key"), F.struct("n", "open", "priced", "price").cast(_DAY).alias("value")))
    return by_day.groupBy("listing_id").agg(
        F.sum("n").alias("n_all"), F.sum("open").alias("open_all"),
        F.map_from_entries(F.collect_list(entry)).alias("days"))       # at most FIRST_DAYS entries


def _no_days():
    return F.create_map().cast(f"map<date,{_DAY}>")


def _plus(a, b, name):
    zero = F.lit(0).cast("decimal(38,2)" if name == "price" else "long")
    return F.coalesce(a[name], zero) + F.coalesce(b[name], zero)


def _merged_days(start: str):
    """Stored and new days by date, without those outside the first range."""
    both = F.map_zip_with(F.coalesce("old_days", _no_days()), F.coalesce("days", _no_days()), lambda k, a, b: F.struct(
        *[_plus(a, b, x).alias(x) for x in _SUMS],
        F.when(a["price"].isNull() & b["price"].isNull(), F.lit(None)).otherwise(_plus(a, b, "price")).alias("price")).cast(_DAY))
    low = F.lit(start).cast("date")
    return F.map_filter(both, lambda k, v: (k >= low) & (k < F.date_add(low, FIRST_DAYS)))


def _folded(days, name):
    kind = "decimal(38,2)" if name == "price" else "long"
    return F.aggregate(F.map_values(days), F.lit(0).cast(kind), lambda acc, d: (acc + F.coalesce(d[name], F.lit(0))).cast(kind))


def merge_calendar(batch: DataFrame, epoch: int, table: str, delay_days: int) -> None:
    """Merge one micro-batch of calendar rows into the state at ``table``."""
    spark = batch.sparkSession
    entry = V.latest(spark, table)
    if entry and entry["streams"].get("calendar", -1) >= epoch:
        return
    notes = _notes(spark, table)
    fresh, noted = _split_late(batch.select("listing_id", "date", "available", "price"), "date", notes, delay_days)
    start = noted.get("start", "9999-01-01")
    new = _calendar_sums(fresh, start)
    columns = ["listing_id", "n_all", "open_all", "days", "n_first", "open_first", "priced_first", "price_first"]
    empty = [F.lit(0).cast("long").alias(c) for c in columns[4:7]] + [F.lit(0).cast("decimal(38,2)").alias("price_first")]
    if entry is None:
        merged = new.select("listing_id", "n_all", "open_all", F.coalesce("days", _no_days()).alias("days"), *empty)
    else:
        old = keyed.read(spark, table)
        closing, moved = noted.get("closed", False) and not notes.get("closed", False), noted.get("start") != notes.get("start")
        # all stored rows change when the range closes or moves back, else only those of the batch's listings
        old = old.select(F.col("listing_id").alias("old_id"), *[F.col(c).alias(f"old_{c}") for c in columns[1:]])
        how = "full" if closing or moved else "left"
        both = new.join(old, F.col("listing_id").eqNullSafe(F.col("old_id")), how)
        both = both.withColumn("all_days", _merged_days(start))
        total = lambda c: (F.coalesce(c, F.lit(0)) + F.coalesce(f"old_{c}", F.lit(0))).cast("long").alias(c)
        kept = [F.coalesce(f"old_{c}", F.lit(0)) for c in columns[4:]]
        if noted.get("closed", False):
            # days of a closed range are in the sums; later rows are outside of it
            sums = [(old_sum + _folded(F.col("all_days"), x)).alias(c) for old_sum, x, c in zip(kept, (*_SUMS, "price"), columns[4:])]
            days = _no_days().alias("days")
        else:
            sums, days = [x.alias(c) for x, c in zip(kept, columns[4:])], F.col("all_days").alias("days")
        merged = both.select(F.coalesce("listing_id", "old_id").alias("listing_id"), total("n_all"), total("open_all"), days,
                             *[s.cast("decimal(38,2)" if c == "price_first" else "long").alias(c) for s, c in zip(sums, columns[4:])])
    keyed.upsert(spark, merged, table, key="listing_id", batch=("calendar", epoch), notes=noted)


def merge_reviews(batch: DataFrame, epoch: int, table: str, delay_days: int) -> None:
    """Merge one micro-batch of reviews into the counts at ``table``."""
    spark = batch.sparkSession
    entry = V.latest(spark, table)
    if entry and entry["streams"].get("review", -1) >= epoch:
        return
    fresh, noted = _split_late(batch.select("listing_id", "review_date"), "review_date", _notes(spark, table), delay_days)
    new = fresh.groupBy("listing_id").agg(F.count(F.lit(1)).alias("total_reviews"))
    if entry is not None:
        old = keyed.read(spark, table).select(F.col("listing_id").alias("old_id"), F.col("total_reviews").alias("old"))
        new = new.join(old, F.col("listing_id").eqNullSafe(F.col("old_id")), "left").select(
            "listing_id", (F.col("total_reviews") + F.coalesce("old", F.lit(0))).alias("total_reviews"))
    keyed.upsert(spark, new, table, key="listing_id", batch=("review", epoch), notes=noted)


def run_stream(rows: DataFrame, merge, table: str, checkpoint: str, delay_days: int) -> None:
    query = (rows.writeStream.foreachBatch(lambda batch, epoch: merge(batch, epoch, table, delay_days))
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def maintain(spark: SparkSession, calendar_path: str, review_path: str, calendar_schema, review_schema, delay_days: int,
             where: str | None = None, **bounds) -> str:
    """Bring the state below ``where`` up to date with all files of both
    folders; the folder of the state.  Call it again when files were added."""
    where = where or scratch_path(spark, "listing_state")
    bounds = bounds or {"batch_bytes": BATCH_BYTES}
    for name, path, schema, merge in (("calendar", calendar_path, calendar_schema, merge_calendar),
                                      ("review", review_path, review_schema, merge_reviews)):
        run_stream(file_stream(spark, path, schema, **bounds), merge, f"{where}/{name}", f"{where}/{name}-checkpoint", delay_days)
    return where


def measures(spark: SparkSession, where: str) -> DataFrame:
    """listing_id, availability_30_rate, avg_calendar_price_30, availability_365_rate,
    total_reviews of every listing with a calendar day or a review."""
    days, sums = F.col("days"), ("n_first", "open_first", "priced_first", "price_first")
    cal = keyed.read(spark, f"{where}/calendar").select("listing_id", "n_all", "open_all", *[
        (F.col(c) + _folded(days, x)).alias(c) for c, x in zip(sums, (*_SUMS, "price"))])
    ratio = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))
    rates = cal.select("listing_id", ratio("open_first", "n_first").alias("availability_30_rate"),
                       ratio("price_first", "priced_first").alias("avg_calendar_price_30"),
                       ratio("open_all", "n_all").alias("availability_365_rate"))
    counts = keyed.read(spark, f"{where}/review").withColumnRenamed("listing_id", "review_id")
    joined = rates.join(counts, F.col("listing_id").eqNullSafe(F.col("review_id")), "full")
    return joined.select(F.coalesce("listing_id", "review_id").alias("listing_id"), "availability_30_rate", "avg_calendar_price_30",
                         "availability_365_rate", F.coalesce("total_reviews", F.lit(0)).alias("total_reviews"))


def progress(spark: SparkSession, where: str) -> dict:
    """Rows read, late rows, start and newest date of each stream so far."""
    return {name: _notes(spark, f"{where}/{name}") for name in ("calendar", "review")}
