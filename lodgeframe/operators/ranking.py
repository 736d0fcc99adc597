"""Exact ranks and prefix sums without a single-task window.

``row_number().over(Window.partitionBy(g).orderBy(x))`` sends a whole
group to one task; a hot group (a third of all rows) then sorts in one
task, and an un-partitioned window sends *everything* to one task.  The
operators here compute the same numbers in a distributed way:

1. range-partition on ``(group, order)`` keys -- a hot group with many
   distinct order values is split over many partitions;
2. sort within partitions and number rows / accumulate weights locally;
3. per ``(partition, group)`` totals -- at most ``P + G`` rows -- give
   each partition's offset by a tiny window over partition ids;
4. join the offsets back (broadcast when AQE sees they are small).

The sorted, numbered partitions are checkpointed (reliable checkpoint in
the shared ``spark.checkpoint.dir``) before the two passes read them:
both passes then see the same partition numbering and row order, and a
lost executor re-reads the checkpoint instead of re-running the sort.

Ties in the order keys get distinct consecutive ranks in an arbitrary
order; pass a unique tie-break column when the assignment matters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def _range_partition(df: DataFrame, n: int | None, keys) -> DataFrame:
    """Range-partition on ``keys``.  Without an explicit count the shuffle is
    left to AQE, which merges small neighbouring ranges by data size (merged
    ranges stay contiguous and in order, which is all the offsets need)."""
    return df.repartitionByRange(n, *keys) if n else df.repartitionByRange(*keys)


def rank_within_groups(df: DataFrame, groups, order, n_partitions: int | None = None,
                       rank_col: str = "rank", split_ties: bool = True) -> DataFrame:
    """Add a 1-based ``rank_col``: position of the row within its group by ``order``.

    ``split_ties`` appends a unique row id to the sort key, so even one
    value repeated across a third of the table is spread over many range
    partitions (ranks among equal values are arbitrary anyway).
    """
    groups, order = list(groups), list(order)
    if split_ties:
        df = df.withColumn("_tb", F.monotonically_increasing_id())
        order = order + ["_tb"]
    keys = groups + order
    ensure_checkpoint_dir(df.sparkSession)
    r = (_range_partition(df, n_partitions, keys).sortWithinPartitions(*keys)
           .withColumn("_pid", F.spark_partition_id())
           .withColumn("_mid", F.monotonically_increasing_id())).checkpoint(eager=True)
    stats = r.groupBy("_pid", *groups).agg(F.min("_mid").alias("_first"),
                                           F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*groups).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1) \
        if groups else Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_before", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
    out = r.join(stats.select("_pid", *groups, "_first", "_before"), ["_pid", *groups], "inner")
    return out.withColumn(rank_col, F.col("_mid") - F.col("_first") + F.col("_before") + 1) \
              .drop("_pid", "_mid", "_first", "_before", "_tb")


def exclusive_prefix_sums(df: DataFrame, groups, order, weights, n_partitions: int | None = None,
                          suffix: str = "_before") -> DataFrame:
    """For each row, the sums of ``weights`` over rows strictly before it
    (by ``order``) in the same group, as ``<weight><suffix>`` columns.

    Local running sums are computed per partition with Arrow batches
    (``mapInPandas`` keeps the range partitioning; no extra shuffle).
    """
    groups, order, weights = list(groups), list(order), list(weights)
    keys = groups + order
    ensure_checkpoint_dir(df.sparkSession)
    r = (_range_partition(df, n_partitions, keys).sortWithinPartitions(*keys)
           .withColumn("_pid", F.spark_partition_id())).checkpoint(eager=True)
    local_cols = [f"_loc_{w}" for w in weights]
    schema = T.StructType(list(r.schema.fields) +
                          [T.StructField(c, T.DoubleType(), False) for c in local_cols])

    def local_prefix(batches):
        import numpy as np
        import pandas as pd
        carry: dict = {}  # (group key, weight) -> running total in this partition
        for pdf in batches:
            if pdf.empty:
                continue
            if groups:
                keys = pd.Series(list(zip(*[pdf[c].tolist() for c in groups])), dtype=object)
            else:
                keys = pd.Series([()] * len(pdf), dtype=object)
            codes, uniques = pd.factorize(keys)
            out = pdf.copy()
            for w, lc in zip(weights, local_cols):
                vals = pdf[w].astype("float64").fillna(0.0).to_numpy()
                cum = pd.Series(vals).groupby(codes).cumsum().to_numpy() - vals
                base = np.array([carry.get((u, w), 0.0) for u in uniques])[codes]
                out[lc] = cum + base
                tot = np.bincount(codes, weights=vals, minlength=len(uniques))
                for u, t in zip(uniques, tot):
                    carry[(u, w)] = carry.get((u, w), 0.0) + float(t)
            yield out

    loc = r.mapInPandas(local_prefix, schema)
    stats = r.groupBy("_pid", *groups).agg(*[F.sum(F.col(w).cast("double")).alias(f"_tot_{w}")
                                             for w in weights])
    win = (Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))) \
        .orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.select("_pid", *groups, *[F.coalesce(F.sum(f"_tot_{w}").over(win), F.lit(0.0))
                                            .alias(f"_off_{w}") for w in weights])
    out = loc.join(stats, ["_pid", *groups], "inner")
    for w, lc in zip(weights, local_cols):
        out = out.withColumn(f"{w}{suffix}", F.col(lc) + F.col(f"_off_{w}"))
    return out.drop("_pid", *local_cols, *[f"_off_{w}" for w in weights])

