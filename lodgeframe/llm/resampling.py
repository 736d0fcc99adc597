"""Importance resampling towards a target text distribution.

Features are the runs of one to three words of a document, hashed into buckets
by their CRC-32. Each document's words, joined by one separator, are scanned
once for the running CRCs of its prefixes. A run's own CRC follows from two
of them: CRC-32 is linear over GF(2), so advancing the CRC of the text before
the run by the run's length and cancelling it from the CRC of the text up to
the run's end leaves the CRC of the run alone. The advance is a table look-up
(one table per length, powers of two for long runs), so all runs of a block
come out of a few numpy passes.

1. ``bucket_counts`` counts the buckets of a corpus; a task sends one row per
   bucket at most.
2. ``bucket_gains`` turns two counts into one gain per bucket (a table of
   ``BUCKETS`` numbers, which is what the driver handles).
3. ``weigh`` scores all documents by the sum of their gains plus Gumbel noise
   of their id, ``draw`` ranks them over range partitions and keeps the best.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lodgeframe.llm import textscan as ts
from lodgeframe.llm.common import as_batch, fresh_names, prepare, stage, table
from lodgeframe.operators.ranking import rank_within_groups

BUCKETS = 10_000
MAX_RUN = 3
SEED = 42
LEAST_WORDS = 20
PERCENT = 5

#: runs of fewer bytes than this have an advance table of their own
NEAR = 64

RESULTS = ("n_words", "n_features", "weight", "score", "rank")

#: bytes of words lower-cased, all others turned into the separator
_CLEAN = bytes(c + 32 if 65 <= c <= 90 else c if ts.ALNUM[c] else 32 for c in range(256))

_tables: dict[str, np.ndarray] = {}


# -- GF(2) arithmetic of CRC-32 ------------------------------------------------------------


def byte_table() -> np.ndarray:
    """The CRC-32 step of one byte, from its reflected polynomial."""
    if "byte" not in _tables:
        t = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            t = np.where(t & 1, (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
        _tables["byte"] = t
    return _tables["byte"]


def apply(t: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A linear map as four tables of 256 (one per byte of ``x``)."""
    return t[0][x & 0xFF] ^ t[1][(x >> 8) & 0xFF] ^ t[2][(x >> 16) & 0xFF] ^ t[3][x >> 24]


def advance_tables() -> np.ndarray:
    """[k]: the map that advances a CRC over k zero bytes, k < NEAR."""
    if "near" not in _tables:
        step = byte_table()
        one = np.arange(4)[:, None] * 8
        values = (np.arange(256, dtype=np.uint32)[None, :] << one.astype(np.uint32))
        out = [values]
        for _ in range(NEAR - 1):
            out.append(step[out[-1] & 0xFF] ^ (out[-1] >> 8))
        _tables["near"] = np.stack(out)
    return _tables["near"]


def power_table(k: int) -> np.ndarray:
    """The map that advances a CRC over 2**k zero bytes."""
    name = f"power{k}"
    if name not in _tables:
        if 1 << k < NEAR:
            _tables[name] = advance_tables()[1 << k]
        else:
            half = power_table(k - 1)
            _tables[name] = apply(half, half)
    return _tables[name]


def advance(crc: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """CRCs moved over ``n_bytes`` further bytes of any text: what the text
    before a run adds to the CRC at the run's end."""
    near = advance_tables()
    k = np.where(n_bytes < NEAR, n_bytes, 0)
    out = near[k, 0, crc & 0xFF] ^ near[k, 1, (crc >> 8) & 0xFF] ^ near[k, 2, (crc >> 16) & 0xFF] ^ near[k, 3, crc >> 24]
    far = np.flatnonzero(n_bytes >= NEAR)
    if len(far):
        rest, x = n_bytes[far].copy(), crc[far]
        for bit in range(int(rest.max()).bit_length()):
            on = np.flatnonzero((rest >> bit) & 1)
            x[on] = apply(power_table(bit), x[on])
        out[far] = x
    return out


def step_separator(crc: np.ndarray) -> np.ndarray:
    """Running CRCs after one more separator."""
    state = ~crc
    return ~(byte_table()[(state ^ np.uint32(0x20)) & 0xFF] ^ (state >> 8))


# -- features ------------------------------------------------------------------------------


def running(data: bytes) -> tuple[list[int], list[int]]:
    """(byte length of each word, CRC of the normalised text up to its end)."""
    words = data.translate(_CLEAN).split()
    if not words:
        return [], []
    first = zlib.crc32(words[0])
    return list(map(len, words)), list(accumulate([b" " + w for w in words[1:]], lambda crc, w: zlib.crc32(w, crc), initial=first))


def feature_crcs(column: pa.Array, max_run: int = MAX_RUN):
    """Per block of texts: (first row, words of each row, [(row of each run, its
    CRC) for runs of 1, 2, ... words])."""
    for block in ts.blocks(column):
        data, sizes, ends, counts = block.data.tobytes(), [], [], []
        for i in range(len(block)):
            length, crc = running(data[block.starts[i]:block.starts[i + 1]])
            sizes += length
            ends += crc
            counts.append(len(length))
        counts, length, end = np.array(counts, np.int64), np.array(sizes, np.int64), np.array(ends, np.uint32)
        row = np.repeat(np.arange(len(counts)), counts)
        start = np.zeros(len(end), np.uint32)                       # CRC of all before a word, the separator included
        start[1:] = step_separator(end[:-1])
        start[np.concatenate([[0], np.cumsum(counts)[:-1]])[counts > 0]] = 0   # nothing before the first word
        span, runs = length.copy(), []
        for k in range(min(max_run, len(end))):
            if k:
                span = span[:len(end) - k] + length[k:] + 1
            here = row[:len(end) - k]
            inside = here == row[k:]
            runs.append((here[inside], (end[k:] ^ advance(start[:len(end) - k], span))[inside]))
        yield block.first, counts, runs


def bucket_counts(docs: DataFrame, text: str, buckets: int = BUCKETS, max_run: int = MAX_RUN) -> DataFrame:
    """(bucket, n): features of all texts by bucket, repeats counted. Null
    texts have none; an empty table gives no rows."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, runs in feature_crcs(batch.column(0), max_run):
                for _, crc in runs:
                    total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found], pa.int64())], names=["bucket", "n"])

    sent = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "bucket int, n long")
    return sent.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """One integer gain per bucket from two ``bucket_counts`` (at most
    ``buckets`` rows each reach the driver): floor(1000 times the log of the
    smoothed target frequency over the smoothed source frequency)."""
    counts = np.zeros((2, buckets), dtype=object)
    for k, df in enumerate((source, target)):
        for r in df.collect():
            counts[k, r.bucket] = r.n
    all_s, all_t = int(counts[0].sum()), int(counts[1].sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (all_s + buckets) / ((s + 1) * (all_t + buckets))))
                     for s, t in counts.T], dtype=np.int64)


def gumbel(key: str, seed: int = SEED) -> int:
    """Thousandths of standard Gumbel noise drawn by an id."""
    h = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, doc_id: str, text: str, gains: np.ndarray, max_run: int = MAX_RUN, seed: int = SEED) -> DataFrame:
    """``docs`` with n_words, n_features, weight (sum of the gains of its
    features) and score (weight plus noise). Null and empty texts have weight 0;
    a null id draws as the id ``null``; other columns pass through, those with
    a result's name are replaced."""
    keep = [c for c in docs.columns if c.lower() not in RESULTS]
    key, body = fresh_names(docs.columns, "key", "body")
    table_of = docs.sparkSession.sparkContext.broadcast(gains)
    sent = docs.select(*keep, F.col(doc_id).cast("string").alias(key), F.col(text).cast("string").alias(body))
    schema = StructType([*sent.schema.fields[:-2], *StructType.fromDDL("n_words long, n_features long, weight long, score long").fields])
    arrow = to_arrow_schema(schema)

    def score(batches):
        gain = table_of.value
        for batch in batches:
            n = batch.num_rows
            words, features, weight = (np.zeros(n, np.int64) for _ in range(3))
            for first, counts, runs in feature_crcs(batch.column(len(keep) + 1), max_run):
                here = slice(first, first + len(counts))
                words[here] = counts
                for row, crc in runs:
                    features[here] += np.bincount(row, minlength=len(counts))
                    value = gain[crc % np.uint32(len(gain))]
                    sums = np.concatenate([[0], np.cumsum(value)])
                    at = np.searchsorted(row, np.arange(len(counts) + 1))
                    weight[here] += sums[at[1:]] - sums[at[:-1]]
            noise = np.array([gumbel("null" if k is None else k, seed) for k in batch.column(len(keep)).to_pylist()], np.int64)
            cols = {c: batch.column(i) for i, c in enumerate(keep)}
            yield as_batch(cols | {"n_words": words, "n_features": features, "weight": weight, "score": weight + noise}, arrow)

    return sent.mapInArrow(score, schema)


def draw(weighed: DataFrame, doc_id: str, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """``weighed`` with rank: of the N rows with ``least_words`` words or more,
    the floor(percent * N / 100) highest scores get 1, 2, 3, ... (ties to the
    smaller id, null last; repeated rows in any order), all others null."""
    n = weighed.where(F.col("n_words") >= least_words).count()
    packed = weighed.select(F.struct(*weighed.columns).alias("row"))
    ordered = packed.select("row", (F.col("row.n_words") < least_words).alias("short"), (-F.col("row.score")).alias("down"),
                            F.col(f"row.{doc_id}").isNull().alias("no_id"), F.col(f"row.{doc_id}").alias("id"))
    ranked = rank_within_groups(ordered, [], ["short", "down", "no_id", "id", "row.weight", "row.n_features"], rank_col="place")
    rank = F.when(~F.col("short") & (F.col("place") <= percent * n // 100), F.col("place")).cast("long")
    return ranked.select("row.*", rank.alias("rank"))


def resample(docs: DataFrame, doc_id: str, text: str, target: DataFrame, target_text: str) -> DataFrame:
    """All ``docs`` weighed towards the texts of ``target`` and drawn: the rows
    with a rank are the sample. Empty tables of either kind only leave the
    smoothing."""
    prepare(docs.sparkSession)
    gains = bucket_gains(bucket_counts(docs, text), bucket_counts(target, target_text))
    return draw(weigh(docs, doc_id, text, gains), doc_id)


def op13_importance_resampling(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark")
    gains = bucket_gains(bucket_counts(docs, "text"), bucket_counts(items, "text"))
    # ids and numbers only from here on, scored once
    scores = stage(weigh(docs, "doc_id", "text", gains).drop("text"), "resampling-scores")
    return draw(scores, "doc_id").select("doc_id", "n_features", "weight", "score", "rank")
