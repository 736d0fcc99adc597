"""Materialised stand-in tables (the "database" the queries read).

The relational views of ``standin.py`` are derived from the raw tables
(the calendar needs a lineitem x orders join).  Re-deriving them inside
every query repeats that join, and the driver's Parquet files hold one
row group each, so every re-derivation is one task.  The warehouse writes
each view once, in a layout chosen for the queries:

* ``review`` (and a calendar of few files) is range-partitioned by date and
  sorted within files, so each file covers a disjoint date range and the Parquet
  min/max statistics let window queries (history, label, first 30 days)
  skip whole files; files are sized for parallel scans;
* a large ``calendar_day`` is written as its join leaves it, one file per
  partition sorted by date: the statistics of the pages let window queries skip
  the rest of each file, and the rows are not shuffled once more;
* the small dimensions are written as a few files.

A query that reads each view about once does not write those of large tables:
it reads the derivation, or the stored copy where another query left one.

The location is keyed by the source files' names, sizes and modification
times and by the derivation's code, below the shared ``spark.checkpoint.dir`` -- a changed input gets a
new warehouse, and every executor (or a restarted driver) sees the same
files.  A view is published only after its ``_SUCCESS`` marker exists;
a half-written view is rewritten.
"""

from __future__ import annotations

import hashlib
import inspect

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir, path_exists
from .tables import TABLES, table_path

# view -> (date column for range layout or None, target rows per file)
LAYOUT = {
    "calendar_day": ("date", 250_000),
    "review": ("review_date", 250_000),
    "listing": (None, 500_000),
    "host": (None, 500_000),
    "neighbourhood": (None, 500_000),
    "listings_flat": (None, 500_000),
    "corpus": (None, 20_000),
    "vectors": (None, 100_000),
    "scores": (None, 500_000),
}
CONF_KEY = "lodgeframe.warehouse.enabled"


def enabled(spark: SparkSession) -> bool:
    return spark.conf.get(CONF_KEY, "true").lower() == "true"


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    from . import standin

    # an edited derivation must not read an old copy
    parts = [inspect.getsource(standin), repr(LAYOUT), sf_dir.rstrip("/")]
    for t in TABLES:
        p = jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, t))
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            found = fs.listFiles(p, True)
            while found.hasNext():
                st = found.next()
                parts.append(f"{t}:{st.getPath().getName()}:{st.getLen()}:{st.getModificationTime()}")
    return hashlib.sha256("|".join(sorted(parts)).encode()).hexdigest()[:20]


def warehouse_root(spark: SparkSession, sf_dir: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/lodgeframe/warehouse/{_fingerprint(spark, sf_dir)}"


def is_stored(spark: SparkSession, path: str) -> bool:
    """Whether a complete copy of a view exists."""
    return path_exists(spark, f"{path}/_SUCCESS")


def more_files_than_cores(spark: SparkSession, name: str, rows: int) -> bool:
    """Whether ``rows`` of a view fill more files than there are cores."""
    return -(-rows // LAYOUT[name][1]) > int(spark.sparkContext.defaultParallelism)


def materialize_view(spark: SparkSession, view: DataFrame, path: str, name: str, rows=None) -> str:
    """Write one view with its layout unless a complete copy exists.  ``rows``
    tells about how many rows a view has that leaves a shuffle (see above), so
    that it need not be computed to be counted."""
    if is_stored(spark, path):
        return path
    date_col, rows_per_file = LAYOUT.get(name, (None, 500_000))
    n = rows() if rows else view.count()
    # enough files for the target file size, and at least one per core
    # (never files of fewer than ~1000 rows) so the scans run in parallel
    par = int(spark.sparkContext.defaultParallelism)
    files = max(1, -(-n // rows_per_file), min(par, n // 1000))
    if date_col and rows and files > par:
        out = view.sortWithinPartitions(date_col)
    elif date_col:
        out = view.repartitionByRange(files, date_col).sortWithinPartitions(date_col)
    else:
        out = view.repartition(files) if files > 1 else view.coalesce(1)
    out.write.mode("overwrite").parquet(path)
    return path
