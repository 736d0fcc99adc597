"""Benchmark decontamination: documents are scanned for word windows of the
test items.

The items' normalised windows become a hash set that is broadcast. The set is
broadcast in blocks whose size is measured first (``block_bytes``), one scan
per block, so a larger benchmark makes more scans and never a larger broadcast.
Window hashes only propose hits; each one is verified word by word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.llm import textscan as ts
from lodgeframe.llm.common import map_batches, prepare, table

WINDOW = 10

#: text of test items in one broadcast hash set (its windows take about ten times as much)
BLOCK_BYTES = 4 << 20


def item_windows(items: DataFrame, item_id: str, text: str, window: int = WINDOW) -> DataFrame:
    """One row per window of each item: (item, width, hash, words); an item of
    fewer words, but not none, is one window of its own width."""

    def windows(batch):
        ids = batch.column(0).to_pylist()
        for block in ts.blocks(batch.column(1)):
            low = block.lower()
            begin, end, offsets = low.words(ts.ALNUM)
            h = low.hashes(begin, end)
            out = {"item": [], "width": [], "hash": [], "words": []}
            for i in range(len(block)):
                first, last = int(offsets[i]), int(offsets[i + 1])
                width = min(window, last - first)
                if not width:
                    continue
                at, codes = ts.runs_of(h[first:last], np.array([0, last - first]), width)
                for k, code in zip(at + first, codes):
                    out["item"].append(ids[block.first + i])
                    out["width"].append(width)
                    out["hash"].append(int(code.view(np.int64)))
                    out["words"].append(phrase(low.data, begin, end, int(k), width))
            yield out

    pairs = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"), F.col(text).alias("text"))
    return map_batches(pairs, windows, "item string, width int, hash long, words binary")


def phrase(data: np.ndarray, begin: np.ndarray, end: np.ndarray, k: int, width: int) -> bytes:
    return b" ".join(data[begin[j]:end[j]].tobytes() for j in range(k, k + width))


def hash_set(rows) -> dict:
    """Collected windows as {width: (sorted hashes, {words: items} of each)}."""
    by: dict[int, dict[int, dict[bytes, set]]] = {}
    for r in rows:
        by.setdefault(r.width, {}).setdefault(r.hash, {}).setdefault(bytes(r.words), set()).add(r.item)
    out = {}
    for width, codes in by.items():
        keys = np.array(sorted(codes), dtype=np.int64)
        out[width] = (keys, [codes[int(k)] for k in keys])
    return out


def merge_ranges(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(pairs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find_hits(docs: DataFrame, text: str, items: DataFrame, item_id: str, item_text: str,
              window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with n_words, hit_words (merged [first, last) word ranges inside
    any occurrence of a window, flattened), hit_bytes (their byte ranges,
    flattened) and hit_items (sorted item ids, as strings).

    Null or empty texts have no words and no hits; null item texts are ignored,
    a null item id counts as the id ``null``; repeated items and documents keep
    their own rows; an empty benchmark or document table gives no hits. Extra
    columns pass through (the four result names, if present, are replaced).
    """
    spark = docs.sparkSession
    prepare(spark)
    items = items.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("text")).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n_blocks = max(1, -(-size // block_bytes))
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)))
    names = ("n_words", "hit_words", "hit_bytes", "hit_items")
    keep = [c for c in docs.columns if c.lower() not in names]
    empty = F.array().cast("array<int>")
    out = docs.select(*keep, F.lit(0).cast("long").alias("n_words"), empty.alias("hit_words"),
                      empty.alias("hit_bytes"), F.array().cast("array<string>").alias("hit_items"))
    for b in range(n_blocks):
        found = item_windows(items.where(F.col("block") == b), "item_id", "text", window).collect()
        out = scan(out, keep.index(text), spark.sparkContext.broadcast(hash_set(found)), out.schema)
    return out


def scan(docs: DataFrame, at: int, index, schema) -> DataFrame:
    """One pass of the documents against one broadcast hash set."""

    def run(batches):
        wanted = index.value
        for batch in batches:
            words, ranges, spans, found = [], [], [], []
            old = [batch.column(i).to_pylist() for i in range(batch.num_columns - 3, batch.num_columns)]
            for block in ts.blocks(batch.column(at)):
                low = block.lower()
                begin, end, offsets = low.words(ts.ALNUM)
                words += np.diff(offsets).tolist()
                hits = block_hits(low, begin, end, offsets, wanted)
                for i in range(len(block)):
                    r = block.first + i
                    flat, first, zero = old[0][r], int(offsets[i]), int(block.starts[i])
                    mine = hits.get(i, ())
                    merged = merge_ranges([*zip(flat[::2], flat[1::2]), *((a - first, z - first) for a, z, _ in mine)])
                    ranges.append([x for pair in merged for x in pair])
                    spans.append([x for a, z in merged for x in (int(begin[first + a]) - zero, int(end[first + z - 1]) - zero)])
                    found.append(sorted({*old[2][r], *(t for *_, names in mine for t in names)}))
            columns = [batch.column(i) for i in range(batch.num_columns - 4)]
            columns += [pa.array(words, pa.int64()), pa.array(ranges, pa.list_(pa.int32())),
                        pa.array(spans, pa.list_(pa.int32())), pa.array(found, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, schema)


def block_hits(block: ts.Block, begin, end, offsets, table: dict) -> dict[int, list]:
    """{document: [(first word, end word, items)]} of verified windows."""
    hits: dict[int, list] = {}
    if not len(begin) or not table:
        return hits
    h = block.hashes(begin, end)
    for width, (keys, phrases) in table.items():
        first, codes = ts.runs_of(h, offsets, width)
        codes = codes.view(np.int64)
        k = np.minimum(np.searchsorted(keys, codes), len(keys) - 1)
        for i in np.flatnonzero(keys[k] == codes):
            names = phrases[k[i]].get(phrase(block.data, begin, end, int(first[i]), width))
            if names:
                doc = int(np.searchsorted(offsets, first[i], side="right")) - 1
                hits.setdefault(doc, []).append((int(first[i]), int(first[i]) + width, names))
    return hits


def cut_spans(text: str, flat) -> str:
    """``text`` without the byte ranges of a flattened range list."""
    data, out, at = text.encode(), [], 0
    for a, z in zip(flat[::2], flat[1::2]):
        out.append(data[at:a])
        at = z
    return b"".join([*out, data[at:]]).decode("utf-8", "ignore")


def remove_spans(hits: DataFrame, text: str) -> DataFrame:
    """``find_hits`` output with the hit byte ranges cut out of the text."""

    def cut(batch):
        names = batch.schema.names
        cols = {c: batch.column(i) for i, c in enumerate(names)}
        cols[text] = [t if t is None or not s else cut_spans(t, s) for t, s in
                      zip(cols[text].to_pylist(), cols["hit_bytes"].to_pylist())]
        yield cols

    return map_batches(hits, cut, hits.schema)


def remove_documents(hits: DataFrame, columns: list[str]) -> DataFrame:
    """Only the documents without any hit."""
    return hits.where(F.size("hit_items") == 0).select(*columns)


def op7_decontamination(spark, sf_dir: str) -> DataFrame:
    hits = find_hits(table(spark, sf_dir, "documents").select("doc_id", "text"), "text",
                     table(spark, sf_dir, "benchmark"), "item_id", "text")
    n_hit = F.aggregate(F.transform("hit_words", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)),
                        F.lit(0).cast("long"), lambda acc, x: acc + x)
    return hits.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
                       F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"),
                       (F.size("hit_items") > 0).alias("contaminated"))
