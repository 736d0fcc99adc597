"""Substring dedup with hashed minimizer segments, kept in levels as a sparse
suffix array would be. No array holds suffixes in order of their bytes: equality
of hashes finds the repeats, and sorting all suffixes would shuffle about 28
times the input.

Every byte covered by a ``span``-byte string that also starts elsewhere is a
repeat. The index keeps sampled suffixes only: of each ``span``-byte window the
suffix at its minimizer (the ``CONTEXT``-byte string of smallest hash inside).
Equal windows have equal minimizers, so no repeat is missed. The windows that
share a minimizer form its segment; an entry is (context, segment, place),
ordered by the hashes of both, so equal contexts and equal segments are
adjacent.

New batches become an array each, bucketed by hash. ``SuffixLevels.insert`` merge-scans the
array with levels of equal size and merges them into one of twice the size, as
in a binary counter, so an entry is rewritten a logarithmic number of times. A
whole table comes in ``BATCHES`` batches: one merge, at most two levels. A level holds each distinct segment with its number of places.

Entries whose segment occurs twice are repeats as a whole. Where a context
occurs in different segments (a repeat ends inside), the segments are cut into
pieces of the first of ``PIECES`` windows and these, where they still differ
around an equal core, into finer ones down to single windows, each time
grouping by hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.llm import textscan as ts
from lodgeframe.llm.common import bucketed, map_batches, prepare, shuffle_width, table

SPAN = 200
CONTEXT = 24
#: windows in the pieces that contested segments are cut into, level by level; the last is 1
PIECES = (32, 6, 1)
#: batches that a whole table is inserted in
BATCHES = 3

ENTRY = "inner long, outer long, row long, first int, lead int, windows int, places long"
KEYS = ["inner", "outer"]
PLACE = ["row", "first", "lead", "windows"]


def segments(block: ts.Block, span: int):
    """Minimizers of a block: (document, first window, last window, minimizer)."""
    n = len(block.data)
    if n < span:
        return (np.zeros(0, np.int64),) * 4
    at = np.arange(n - CONTEXT + 1)
    shift = np.uint64(int(n).bit_length())
    tagged = (block.hashes(at, at + CONTEXT) >> shift << shift) | at.astype(np.uint64)
    least = (ts.sliding_min(tagged, span - CONTEXT + 1) & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64)
    doc = np.repeat(np.arange(len(block)), np.diff(block.starts))
    inside = doc[:len(least)] == doc[span - 1:span - 1 + len(least)]
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (doc[1:len(least)] != doc[:len(least) - 1]) | ~inside[:-1]
    first = np.flatnonzero(new & inside)
    ends = np.append(np.flatnonzero(new | ~inside), len(least))
    last = ends[np.searchsorted(ends, first, side="right")] - 1
    return doc[first], first, last, least[first]


def entries(docs: DataFrame, span: int) -> DataFrame:
    """Index entries of all documents (``ENTRY``). A segment that occurs several
    times in a block becomes one entry with that number of places; the other
    places are repeats for certain and come along merged, with -1 places and
    a key of their own document."""

    def run(batch):
        rows = batch.column(0).to_numpy()
        for block in ts.blocks(batch.column(1)):
            doc, first, last, low = segments(block, span)
            if not len(doc):
                continue
            inner, outer = block.hashes(low, low + CONTEXT), block.hashes(first, last + span)
            _, lead, of, count = np.unique(outer, return_index=True, return_inverse=True, return_counts=True)
            places = np.zeros(len(doc), np.int64)
            places[lead] = count
            zero, sure = block.starts[doc], places == 0
            keep = np.flatnonzero(~sure)
            yield {"inner": inner[keep].view(np.int64), "outer": outer[keep].view(np.int64), "row": rows[block.first + doc[keep]],
                   "first": (first - zero)[keep], "lead": (low - first)[keep], "windows": (last - first + 1)[keep], "places": places[keep]}
            if sure.any():
                d, f, t = doc[sure], first[sure], last[sure]
                new = np.ones(len(d), bool)      # runs of windows that touch
                new[1:] = (d[1:] != d[:-1]) | (f[1:] > t[:-1] + span)
                at = np.flatnonzero(new)
                d, f, t = d[at], f[at], t[np.append(at[1:], len(t)) - 1]
                of = rows[block.first + d]
                yield {"inner": ts.mix(of.astype(np.uint64)).view(np.int64), "outer": of, "row": of, "first": f - block.starts[d],
                       "lead": np.zeros(len(d), np.int64), "windows": t - f + 1, "places": np.full(len(d), -1)}

    return map_batches(docs.select("row", "text"), run, ENTRY)


def distinct_segments(rows: DataFrame) -> DataFrame:
    """Entries summed to one per segment: its places and one of them."""
    return (rows.where("places > 0").groupBy(*KEYS)
            .agg(F.sum("places").alias("places"), F.min(F.struct(*PLACE)).alias("at"))
            .select(*KEYS, *(F.col(f"at.{c}").alias(c) for c in PLACE), "places"))


class SuffixLevels:
    """Logarithmic family of sparse suffix arrays, stored in buckets by context."""

    def __init__(self, buckets: int, span: int = SPAN):
        self.buckets, self.span = buckets, span
        self.levels: dict[int, DataFrame] = {}
        self.arrays: list[DataFrame] = []

    def insert(self, docs: DataFrame) -> None:
        """Add a batch (row, text): build its array, merge-scan it with the levels
        of its size and store the result as a level twice as large."""
        array = bucketed(entries(docs, self.span), "suffix_array", self.buckets, "inner", "outer")
        self.arrays.append(array)
        level, rank = distinct_segments(array), 0
        while rank in self.levels:
            level, rank = merge(self.levels.pop(rank), level), rank + 1
        self.levels[rank] = bucketed(level, "suffix_level", self.buckets, "inner", "outer", dealt=True)

    def scan(self) -> DataFrame:
        """All levels merge-scanned: each distinct segment with its places."""
        found = None
        for rank in sorted(self.levels):
            found = self.levels[rank] if found is None else merge(self.levels[rank], found)
        return found

    def repeats(self, total: DataFrame) -> DataFrame:
        """(row, begin, end) of every entry whose segment has several places."""
        twice = total.where("places > 1").select(*KEYS)
        out = None
        for array in self.arrays:
            part = spans(array.where("places > 0").join(twice, KEYS), self.span).union(spans(array.where("places < 0"), self.span))
            out = part if out is None else out.union(part)
        return out


def merge(a: DataFrame, b: DataFrame) -> DataFrame:
    """Merge-scan of two sorted levels; equal segments add up their places."""
    b = b.select(*KEYS, *(F.col(c).alias(f"b_{c}") for c in (*PLACE, "places")))
    pick = lambda c: F.when(F.col("places").isNotNull(), F.col(c)).otherwise(F.col(f"b_{c}")).alias(c)
    return a.join(b, KEYS, "full").select(
        *KEYS, *(pick(c) for c in PLACE), (F.coalesce("places", F.lit(0)) + F.coalesce("b_places", F.lit(0))).alias("places"))


def spans(rows: DataFrame, span: int) -> DataFrame:
    return rows.select("row", F.col("first").alias("begin"), (F.col("first") + F.col("windows") - 1 + span).alias("end"))


def contested(total: DataFrame) -> DataFrame:
    """The segments whose context (or core) also occurs in another segment."""
    several = total.groupBy("inner").agg(F.count("*").alias("m")).where("m > 1").select("inner")
    return total.join(several, "inner", "left_semi").select(*PLACE)


def cut_finer(docs: DataFrame, rows: DataFrame, span: int, width: int) -> DataFrame:
    """Entries for the pieces of ``width`` windows that segments consist of. Pieces
    are aligned to the minimizer, so equal windows fall into like pieces; a
    piece's ``inner`` is the core that all its windows share."""
    wanted = rows.groupBy("row").agg(F.collect_list(F.struct("first", "lead", "windows")).alias("cuts"))

    def run(batch):
        ids = batch.column(0).to_numpy()
        cuts = batch.column(2)
        values, sizes = cuts.flatten(), cuts.value_lengths().to_numpy()
        begin, lead, n = (values.field(i).to_numpy().astype(np.int64) for i in range(3))
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        for block in ts.blocks(batch.column(1)):
            a, z = offsets[block.first], offsets[block.first + len(block)]
            doc = np.repeat(np.arange(len(block)), sizes[block.first:block.first + len(block)])
            first, low = begin[a:z] + block.starts[doc], begin[a:z] + lead[a:z] + block.starts[doc]
            last = first + n[a:z] - 1
            # piece q of a segment: windows that start width*q to width*q + width-1 bytes before the minimizer
            q_from, q_to = (low - last) // width, (low - first) // width
            count = q_to - q_from + 1
            seg = np.repeat(np.arange(len(first)), count)
            q = q_from[seg] + np.arange(len(seg)) - np.repeat(np.cumsum(count) - count, count)
            left = np.maximum(first[seg], low[seg] - width * q - width + 1)
            right = np.minimum(last[seg], low[seg] - width * q)
            core = low[seg] - width * q
            inner = block.hashes(core, core - width + 1 + span)
            outer = ts.mix(block.hashes(left, right + span) + ((low[seg] - left) * 256 + right - left).astype(np.uint64))
            yield {"inner": inner.view(np.int64), "outer": outer.view(np.int64), "row": ids[block.first + doc[seg]],
                   "first": (left - block.starts[doc[seg]]).astype(np.int32), "lead": (low[seg] - left).astype(np.int32),
                   "windows": (right - left + 1).astype(np.int32), "places": np.ones(len(seg), np.int64)}

    return map_batches(docs.select("row", "text").join(wanted, "row").select("row", "text", "cuts"), run, ENTRY)


def repeated_ranges(docs: DataFrame, text: str, span: int = SPAN, batches: int = BATCHES) -> DataFrame:
    """``docs`` with ``repeats``: the merged byte ranges [begin, end) of the UTF-8
    text, flattened, that are covered by a ``span``-byte string which also
    starts anywhere else (overlapping places and the same document included).

    Null texts count as empty; texts shorter than ``span`` bytes have no
    repeats; of repeated rows every copy is a repeat; an empty table gives an
    empty result. Extra columns pass through (one named ``repeats`` is replaced).
    """
    spark = docs.sparkSession
    prepare(spark)
    # entries are clustered by context, joins also name the segment: no new shuffle for that
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    columns = [c for c in docs.columns if c.lower() != "repeats"]
    others = [c for c in columns if c != text]
    kept = docs.select(F.monotonically_increasing_id().alias("row"), F.col(text).cast("string").alias("text"),
                       F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in others)).alias("doc"))
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    buckets = shuffle_width(spark, size)
    kept = bucketed(kept, "suffix_docs", buckets, "row")
    index = SuffixLevels(buckets, span)
    for b in range(batches):
        index.insert(kept.where(F.pmod(F.xxhash64("row"), F.lit(batches)) == b))
    total = index.scan()
    found = index.repeats(total)
    for width in PIECES:
        # stored in buckets: neither the counts nor the join below move the pieces again
        finer = bucketed(cut_finer(kept, contested(total), span, width), "suffix_pieces", buckets, "inner", "outer")
        total = distinct_segments(finer)
        found = found.union(spans(finer.join(total.where("places > 1").select(*KEYS), KEYS), span))
    merged = (found.groupBy("row").agg(F.collect_set(F.struct("begin", "end")).alias("ranges")))
    joined = kept.join(merged, "row", "left").select("text", "doc", "ranges")
    flat = map_batches(joined, merge_ranges, "text string, repeats array<int>, " + f"doc {joined.schema['doc'].dataType.simpleString()}")
    back = [F.col("text").alias(c) if c == text else F.col(f"doc.`{c}`").alias(c) for c in columns]
    return flat.select(*back, "repeats")


def merge_ranges(batch):
    out = []
    for pairs in batch.column(2).to_pylist():
        flat: list[int] = []
        for begin, end in sorted((p["begin"], p["end"]) for p in pairs or ()):
            if flat and begin <= flat[-1]:
                flat[-1] = max(flat[-1], end)
            else:
                flat += [begin, end]
        out.append(flat)
    yield {"text": batch.column(0), "doc": batch.column(1), "repeats": pa.array(out, pa.list_(pa.int32()))}


def kept_bytes(text: str | None, flat: list[int]) -> bytes:
    data, out, at = (text or "").encode(), [], 0
    for begin, end in zip(flat[::2], flat[1::2]):
        out.append(data[at:begin])
        at = end
    return b"".join([*out, data[at:]])


def remove_repeats(docs: DataFrame, text: str, span: int = SPAN) -> DataFrame:
    """``docs`` with the repeated bytes cut out of the text; bytes of a character
    that a cut goes through are dropped too. A text that is all repeats is empty."""

    def cut(batch):
        names = batch.schema.names
        cols = {c: batch.column(i) for i, c in enumerate(names)}
        cols[text] = [kept_bytes(t, r).decode("utf-8", "ignore") if r else t for t, r in
                      zip(cols[text].to_pylist(), cols["repeats"].to_pylist())]
        yield cols

    found = repeated_ranges(docs, text, span)
    return map_batches(found, cut, found.schema).drop("repeats")


def op9_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    found = repeated_ranges(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    n_removed = F.aggregate(F.transform("repeats", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)),
                            F.lit(0).cast("long"), lambda acc, x: acc + x)

    def digest(batch):
        import hashlib

        kept = [hashlib.sha256(kept_bytes(t, r)).hexdigest() for t, r in
                zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        yield {"doc_id": batch.column(0), "kept_sha256": kept} | {c: batch.column(c) for c in ("n_bytes", "n_removed", "n_spans")}

    rows = found.select("doc_id", "text", "repeats", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                        n_removed.alias("n_removed"), (F.size("repeats") / 2).cast("long").alias("n_spans"))
    return map_batches(rows, digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
