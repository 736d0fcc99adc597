"""One large JSON array, read by many tasks (SC4).

A file that holds one list of objects has no line to split at. Spark's text
reader still deals it out by byte ranges when every comma ends a row; what a
comma separates, elements of the list or something inside one, depends on all
bytes before it, but only through two numbers: whether a string is open, and
how many brackets are.

1. Each range is summed up once: the parity of its quotes, and its change of
   depth for either state of the first quote.
2. A prefix scan over the ranges of a file (windows over one small row per
   range) gives the state each range begins in.
3. The ranges are read again from their states and cut at the commas of depth
   one. An element that lies in several ranges is put together from its
   fragments, at most two per range.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import own_session

#: byte ranges of one read at most; their states are what every task gets
MAX_RANGES = 100_000
RANGE_BYTES = 64 << 20

_ESCAPED = re.compile(rb"\\.", re.DOTALL)


def depth_change(parts: list[bytes]) -> int:
    return sum(p.count(b"{") + p.count(b"[") - p.count(b"}") - p.count(b"]") for p in parts)


def piece_change(piece: bytes) -> tuple[int, int, int]:
    """(parity of quotes, change of depth if the piece begins outside of a
    string, or inside one). Escapes stand in strings only, and none is open at
    a comma."""
    if b"\\" in piece:
        piece = _ESCAPED.sub(b"", piece)
    if b'"' not in piece:
        return 0, depth_change([piece]), 0
    parts = piece.split(b'"')
    return (len(parts) - 1) % 2, depth_change(parts[::2]), depth_change(parts[1::2])


def range_states(pieces: DataFrame) -> DataFrame:
    """(file, start, inside, depth, end_inside, end_depth) of every byte range."""

    def sums(batches):
        key, total = None, None
        for batch in batches:
            for file, start, piece in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (file, start) != key:
                    if key is not None:
                        yield row(key, total)
                    key, total = (file, start), [0, 0, 0]
                parity, out, inside = piece_change(piece)
                # the changes for either start, from the range's own parity so far
                a, b = (out, inside) if total[0] == 0 else (inside, out)
                total = [total[0] ^ parity, total[1] + a, total[2] + b]
        if key is not None:
            yield row(key, total)

    def row(key, total):
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
        names = ["file", "start", "parity", "outside", "within"]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((*key, *total), kinds)], names=names)

    found = pieces.mapInArrow(sums, "file string, start long, parity int, outside long, within long")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    scan = found.withColumn("inside", F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2)
    scan = scan.withColumn("change", F.when(F.col("inside") == 0, F.col("outside")).otherwise(F.col("within")))
    scan = scan.withColumn("depth", F.coalesce(F.sum("change").over(before), F.lit(0)))
    return scan.select("file", "start", "inside", "depth", ((F.col("inside") + F.col("parity")) % 2).alias("end_inside"),
                       (F.col("depth") + F.col("change")).alias("end_depth"))


def strip_ends(piece: bytes, inside: int, depth: int) -> bytes:
    """A piece without the list's own brackets and what lies outside of them."""
    out, escaped = bytearray(), False
    for i in range(len(piece)):
        c = piece[i:i + 1]
        if inside:
            escaped, inside = (not escaped and c == b"\\"), inside and (escaped or c != b'"')
        elif c == b'"':
            inside = 1
        elif c in b"[{":
            depth += 1
            if depth == 1:
                if c == b"{":
                    raise ValueError("the JSON file is not a list")
                continue
        elif c in b"]}":
            depth -= 1
            if depth == 0:
                continue
        if depth > 0:
            out += c
        elif c.strip(b" \t\r\n\xef\xbb\xbf"):
            raise ValueError("the JSON file is not one list")
    return bytes(out)


def elements(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The text of every element of the lists at ``path`` (column ``element``),
    one list per file. A file that is not one whole list is an error; blank
    files and empty lists have no elements."""
    own = own_session(spark)
    plain = own.read.option("lineSep", ",").text(path)
    total = plain.select("_metadata.file_path", "_metadata.file_size").distinct().agg(F.sum("file_size")).first()[0] or 0
    own.conf.set("spark.sql.files.maxPartitionBytes", str(max(range_bytes, -(-total // MAX_RANGES))))
    pieces = own.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("piece"))
    states = range_states(pieces).collect()          # at most MAX_RANGES rows and one per file
    last = {}
    for r in sorted(states, key=lambda r: (r.file, r.start)):
        last[r.file] = (r.end_inside, r.end_depth)
    if bad := [f for f, end in last.items() if end != (0, 0)]:
        raise ValueError(f"not one whole JSON list: {bad[0]}")
    begin = spark.sparkContext.broadcast({(r.file, r.start): (r.inside, r.depth) for r in states})

    def cut(batches):
        key, held, inside, depth, number = None, [], 0, 0, 0

        def emit(rows):
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["file", "start", "kind", "text"])

        for batch in batches:
            rows = []
            for file, start, piece in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (file, start) != key:
                    if key is not None:
                        rows.append((*key, 0 if number == 0 else 2, b",".join(held) if held else None))
                    key, held, number = (file, start), [], 0
                    inside, depth = begin.value[key]
                parity, out, within = piece_change(piece)
                change = within if inside else out
                # only the first and the last piece of a list touch its brackets
                held.append(strip_ends(piece, inside, depth) if depth <= 0 or depth + change <= 0 else piece)
                inside, depth = inside ^ parity, depth + change
                if not inside and depth == 1:
                    # the first element to end in a range may have begun before it
                    rows.append((*key, 0 if number == 0 else 1, b",".join(held)))
                    held, number = [], number + 1
            if rows:
                yield emit(rows)
        if key is not None:
            yield emit([(*key, 0 if number == 0 else 2, b",".join(held) if held else None)])

    # kind 0: up to the first cut of a range; 1: a whole element; 2: after the last cut (null: nothing)
    found = pieces.mapInArrow(cut, "file string, start long, kind int, text binary")
    whole = found.where("kind = 1").select("text")
    # a fragment goes on until the next range with a cut: it is named by the range it began in
    order = Window.partitionBy("file").orderBy("start", "kind")
    began = F.last(F.when(F.col("kind") == 2, F.col("start")), ignorenulls=True).over(order)
    parts = found.where("kind <> 1").withColumn("began", F.coalesce(began, F.lit(-1)))
    joined = parts.groupBy("file", "began").agg(F.array_sort(F.collect_list(F.struct("start", "kind", F.col("text").cast("string").alias("text")))).alias("p"))
    joined = joined.select(F.concat_ws(",", "p.text").alias("element"))
    return whole.select(F.col("text").cast("string").alias("element")).union(joined).where(F.trim(F.translate("element", "\t\r\n", "   ")) != "")


def read_json_list(spark: SparkSession, path: str, schema, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Rows of the lists at ``path`` with an explicit schema; absent fields are null."""
    return elements(spark, path, range_bytes).select(F.from_json("element", schema).alias("row")).select("row.*")


def write_json_lists(df: DataFrame, path: str) -> None:
    """``df`` as files of one JSON list each, one per partition."""

    def lines(batches):
        started = False
        for batch in batches:
            texts = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([("," if started or i else "[") + t for i, t in enumerate(texts)], pa.string())], names=["value"])
            started = started or bool(texts)
        yield pa.RecordBatch.from_arrays([pa.array(["]" if started else "[]"])], names=["value"])

    df.select(F.to_json(F.struct("*")).alias("value")).mapInArrow(lines, "value string").write.text(path)
