"""Shared pieces of the training-data operators: table access, staging in the
shared checkpoint folder, and Arrow batch plumbing."""

from __future__ import annotations

import gc
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegralType, StringType, StructType

from lodgeframe.session import ensure_checkpoint_dir, scratch_path
from lodgeframe.sources.tables import read_table

#: rows of one Arrow batch handed to Python; with whole texts in the rows the
#: default of 10,000 would hold tens of MB each
BATCH_ROWS = 1000

#: uncompressed text that one task of a text shuffle should hold
TASK_TEXT_BYTES = 16 << 20

#: bits for a key, and most words of 64 bits, in the table that tells most rows without a match
KEY_BITS = 16
KEY_WORDS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A raw table; also prepares the session for text batches."""
    prepare(spark)
    return read_table(spark, sf_dir, name)


def prepare(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: cuts
    the lineage, survives lost executors and is computed once."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_last(df: DataFrame, name: str) -> DataFrame:
    """``stage``, after which Spark deletes the shuffle files of the queries that
    have ended. It does so when the driver's JVM has collected what refers to
    them; a driver with little to do might keep those of all stages till the end.
    The second collection finds what the first has let go of."""
    out = stage(df, name)
    gc.collect()
    for _ in range(2):
        df.sparkSession.sparkContext._jvm.System.gc()
    return out


def may_match(rows: DataFrame, keys: list[str], known: DataFrame, flag: str) -> DataFrame:
    """``rows`` with a column ``flag``: false if the ``keys`` are surely not among the
    rows of ``known`` (columns of the same order). A broadcast table of bits tells
    most of them, whose texts need no shuffle to a join then. Nulls count as equal;
    true for all rows where the keys differ in type."""
    kinds = [rows.schema[k].dataType for k in keys]
    if kinds != [f.dataType for f in known.schema] or not all(isinstance(k, IntegralType) or k == StringType() for k in kinds):
        return rows.withColumn(flag, F.lit(True))
    bits = 64 * min(KEY_WORDS, max(1, -(-known.count() * KEY_BITS // 64)))
    code, word, mask, marks = fresh_names([*rows.columns, *known.columns, flag], "_code", "_word", "_mask", "_marks")
    mask_of = F.expr(f"shiftleft(1L, cast({code} % 64 as int))")
    coded = lambda df, cols: (df.withColumn(code, F.pmod(F.xxhash64(*cols), F.lit(bits)))
                              .withColumn(word, F.expr(f"{code} div 64")))
    table = coded(known, known.columns).select(word, mask_of.alias(mask)).groupBy(word).agg(F.bit_or(mask).alias(marks))
    return (coded(rows, keys).join(F.broadcast(table), word, "left")
            .withColumn(flag, F.coalesce(F.col(marks).bitwiseAND(mask_of) != 0, F.lit(False))).select(*rows.columns, flag))


def bucketed(df: DataFrame, name: str, buckets: int, key: str, *order: str, dealt: bool = False) -> DataFrame:
    """Store ``df`` once, hashed into ``buckets`` by ``key``, so that later joins
    and groupings on the key need no shuffle of it. ``dealt``: its rows are in
    such buckets already (it comes from joins or groupings of bucketed tables)."""
    spark = df.sparkSession
    label = f"llm_{name}_{uuid.uuid4().hex[:12]}"
    rows = df if dealt else df.repartition(buckets, key)
    (rows.write.format("parquet").option("compression", "zstd")
       .option("path", scratch_path(spark, f"llm-{name}"))
       .bucketBy(buckets, key).sortBy(key, *order).saveAsTable(label))
    return spark.table(label)


def shuffle_width(spark: SparkSession, n_bytes: int | None, per_task: int = TASK_TEXT_BYTES) -> int:
    """Partitions for ``n_bytes`` of data, at least the session's own setting."""
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(own, -(-int(n_bytes or 0) // per_task))


def text_bytes(docs: DataFrame, text: str) -> int:
    """UTF-8 bytes of a text column (0 for an empty table)."""
    return docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0


def map_batches(df: DataFrame, fn, schema) -> DataFrame:
    """``mapInArrow`` for functions from one RecordBatch to an iterable of dicts
    of columns; the output types are those of ``schema`` (DDL or StructType)."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    out = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for cols in fn(batch):
                yield as_batch(cols, out)

    return df.mapInArrow(run, schema)


def as_batch(cols: dict, schema: pa.Schema) -> pa.RecordBatch:
    """Numpy arrays, lists or Arrow arrays as a RecordBatch of ``schema``."""
    arrays = []
    for field in schema:
        x = cols[field.name]
        if isinstance(x, pa.ChunkedArray):
            x = x.combine_chunks()
        if isinstance(x, pa.Array):
            x = x if x.type == field.type else x.cast(field.type)
        else:
            x = pa.array(x, type=field.type)
        arrays.append(x)
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def lists(values, offsets, kind: pa.DataType) -> pa.ListArray:
    """A list column from flat values and n+1 offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def fresh_names(columns, *names: str) -> list[str]:
    """Working column names that no column of a table has, whatever its case."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def crc_mod(key: str, n: int):
    """crc32 of a key's text, modulo ``n`` (null keys count as the text '')."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % n
