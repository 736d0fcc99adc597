"""Language-model scoring by context-tree weighting over bytes.

A text is its lower-cased (A-Z) UTF-8 bytes followed by one end symbol (0xFF,
which UTF-8 never uses). Each byte is predicted as eight binary decisions; for
every decision the Krichevsky-Trofimov estimates of all context depths from 0
to ``DEPTH`` preceding bytes are mixed by the weights that the context tree
assigns (one half to stopping at a node, one half to its children). The counts
are frozen after training, so a text's probability is a product over its
bytes and does not depend on the other scored texts.

Work layout. Documents are packed into chunks of about ``CHUNK_BYTES``. Each
chunk's distinct words and byte (DEPTH+1)-grams go, as packed sorted arrays,
to hash buckets: words by hash, grams by the two latest context bytes, so that
all tree nodes below depth 1 are inside one bucket. The buckets sum the counts
and build their subtrees; only the nodes of depth 0 and 1 (at most 257 * 255)
meet on the driver. Every bucket then sends the chunks the values of their own
words and grams, and each chunk is scored beside its texts. Nothing that grows
with the corpus is broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from lodgeframe.llm import textscan as ts
from lodgeframe.llm.common import as_batch, bucketed, crc_mod, prepare, shuffle_width, stage, table

DEPTH = 5
CHUNK_BYTES = 64 << 20
PACK_BYTES = 4 << 20
END = 0xFF
GRAM, WORD = 0, 1

#: distinct words and grams a task holds before it hands them on
HELD_KEYS = 4_000_000
#: text behind one bucket of words and grams
BUCKET_BYTES = 16 << 20


def grams(block: ts.Block, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, n+1 offsets): for every byte and end of each document the bytes
    of its context and itself, as one integer (the symbol in the low byte)."""
    n = len(block)
    size = len(block.data) + depth * (n + 1)
    s = np.full(size, END, dtype=np.uint8)
    doc = np.repeat(np.arange(n), np.diff(block.starts))
    s[np.arange(len(block.data)) + depth * (doc + 1)] = block.data
    key = np.zeros(size - depth, dtype=np.uint64)
    for j in range(depth + 1):
        key = (key << np.uint64(8)) | s[j:size - depth + j]
    lengths = np.diff(block.starts) + 1
    first = block.starts[:-1] + depth * np.arange(n)      # where a document's first byte is predicted
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    at = np.arange(offsets[-1]) + np.repeat(first - offsets[:-1], lengths)
    return key[at], offsets


def word_hashes(block: ts.Block) -> tuple[np.ndarray, np.ndarray]:
    begin, end, offsets = block.words(ts.NOT_SPACE)
    return block.hashes(begin, end), offsets


class Counter:
    """Sums of counts by 64-bit key, compacted as they come in."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.size += len(keys)

    def compact(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([k for k, _ in self.parts])
        counts = np.concatenate([c for _, c in self.parts])
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        if len(keys):
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            keys, counts = keys[first], np.add.reduceat(counts, first)
        self.parts, self.size = [(keys, counts)], len(keys)
        return keys, counts


def pack(x: np.ndarray) -> bytes:
    """An array of 8-byte numbers as compressed byte planes."""
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, n: int, kind) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).reshape(-1).view(kind)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys, as differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(data, n, np.uint64), dtype=np.uint64)


def pack_texts(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """(chunk, pack): documents as compressed Arrow streams of about
    ``PACK_BYTES``; consecutive packs of a task form a chunk."""

    def run(batches):
        task, chunk, size, held, held_bytes = TaskContext.get().partitionId(), 0, 0, [], 0

        def flush():
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                for x in held:
                    out.write_batch(x)
            return pa.RecordBatch.from_pydict({"chunk": pa.array([(task << 32) + chunk], pa.int64()),
                                               "pack": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

        for batch in batches:
            _, offsets = ts.binary_parts(batch.column(2))
            i = 0
            while i < batch.num_rows:
                j = int(np.searchsorted(offsets, offsets[i] + PACK_BYTES - held_bytes, side="right")) - 1
                j = min(max(j, i + 1), batch.num_rows)
                held.append(batch.slice(i, j - i))
                held_bytes += int(offsets[j] - offsets[i])
                if held_bytes >= PACK_BYTES or j < batch.num_rows:
                    yield flush()
                    size += held_bytes
                    held, held_bytes = [], 0
                    if size >= chunk_bytes:
                        chunk, size = chunk + 1, 0
                i = j
        if held:
            yield flush()

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, "chunk long, pack binary")


def vocabulary(packs: DataFrame, depth: int, buckets: int) -> DataFrame:
    """(bucket, chunk, kind, n, keys, counts): packed distinct grams and words of
    each chunk with their counts in its training documents (0 for held-out ones)."""

    def run(batches):
        held: dict[tuple[int, int], Counter] = {}

        def flush():
            for (chunk, kind), counter in held.items():
                keys, counts = counter.compact()
                of = bucket_of(kind, keys, buckets)
                order = np.argsort(of, kind="stable")
                cut = np.searchsorted(of[order], np.arange(buckets + 1))
                for b in range(buckets):
                    pick = order[cut[b]:cut[b + 1]]
                    if len(pick):
                        yield as_batch({"bucket": [b], "chunk": [chunk], "kind": [kind], "n": [len(pick)],
                                        "keys": [pack_keys(keys[pick])], "counts": [pack(counts[pick])]}, schema)
            held.clear()

        for batch in batches:
            for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                docs = pa.ipc.open_stream(data.as_buffer()).read_all()
                out = np.asarray(docs["held_out"].cast(pa.int8())).astype(bool)
                for train in (True, False):
                    for block in ts.blocks(docs["text"].filter(pa.array(out != train))):
                        low = block.lower()
                        for kind, (keys, _) in ((GRAM, grams(low, depth)), (WORD, word_hashes(low))):
                            keys, counts = np.unique(keys, return_counts=True)
                            held.setdefault((chunk, kind), Counter()).add(keys, counts * train)
                if sum(x.size for x in held.values()) > HELD_KEYS:
                    for x in held.values():
                        x.compact()
                    if sum(x.size for x in held.values()) > HELD_KEYS // 2:
                        yield from flush()
        yield from flush()

    schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int32()), ("n", pa.int32()),
                        ("keys", pa.binary()), ("counts", pa.binary())])
    return packs.mapInArrow(run, "bucket int, chunk long, kind int, n int, keys binary, counts binary")


def bucket_of(kind: int, keys: np.ndarray, buckets: int) -> np.ndarray:
    """Words by their hash; grams by the two latest bytes of their context."""
    code = ts.mix((keys >> np.uint64(8)) & np.uint64(0xFFFF)) if kind == GRAM else keys
    return ((code >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x >= 0.5: Stirling's series after raising
    the argument by 8."""
    rise = sum(np.log(x + i) for i in range(8))
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - rise


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov block probability of n0 zeros and n1 ones."""
    return np.where(n0 + n1 == 0, 0.0, log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1.0) - np.log(np.pi))


class Level:
    """The decision nodes of one context depth, keyed by context << 8 | bits so far."""

    def __init__(self, keys, n0, n1, below=None):
        self.keys, self.n0, self.n1 = keys, n0, n1
        kt = log_kt(n0, n1)
        stop = np.log(0.5) + kt
        self.log_w = kt if below is None else np.logaddexp(stop, np.log(0.5) + below)
        self.beta = np.ones(len(keys)) if below is None else np.exp(stop - self.log_w)
        self.p1 = (n1 + 0.5) / (n0 + n1 + 1.0)

    def above(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """(parents' keys, index of each node's parent), this level being ``depth`` deep."""
        mask = np.uint64(((1 << 8 * (depth - 1)) - 1) << 8 | 0xFF)
        return np.unique(self.keys & mask, return_inverse=True)


def subtrees(keys: np.ndarray, counts: np.ndarray, depth: int, last: int = 2) -> tuple[list, np.ndarray]:
    """Levels from ``depth`` up to ``last`` of the tree under some grams, each with the
    index of its nodes' parents in the next, and the deepest nodes on each gram's path."""
    symbol, context = keys & np.uint64(0xFF), keys >> np.uint64(8)
    path, bit = [], []
    for k in range(8):
        so_far = np.uint64(1 << k) + (symbol >> np.uint64(8 - k))
        path.append(context << np.uint64(8) | so_far)
        bit.append((symbol >> np.uint64(7 - k)) & np.uint64(1))
    nodes, at = np.unique(np.concatenate(path), return_inverse=True)
    ones = np.concatenate(bit).astype(bool)
    c = np.tile(counts, 8).astype(float)
    n1 = np.bincount(at, c * ones, minlength=len(nodes))
    level = Level(nodes, np.bincount(at, c * ~ones, minlength=len(nodes)), n1)
    levels = [(level, None)]
    for d in range(depth, last, -1):
        up, index = level.above(d)
        levels[-1] = (level, index)
        sums = [np.bincount(index, x, minlength=len(up)) for x in (level.n0, level.n1, level.log_w)]
        level = Level(up, *sums)
        levels.append((level, None))
    return levels, np.where(ones, at, ~at).reshape(8, -1)


def top_sums(levels: list) -> dict[str, np.ndarray]:
    """What the nodes of depth 1 get from a bucket's nodes of depth 2."""
    level = levels[-1][0]
    up, index = level.above(2)
    return {"node": up.astype(np.int64)} | {name: np.bincount(index, x, minlength=len(up)) for name, x in
                                            (("n0", level.n0), ("n1", level.n1), ("below", level.log_w))}


def top_mixture(rows) -> tuple[np.ndarray, np.ndarray]:
    """For each node of depth 1 (context << 8 | bits): the mixed probability of a
    one from depths 0 and 1, and the weight left to the depths below."""
    part, rest = np.full(1 << 16, 0.5), np.zeros(1 << 16)
    if len(rows):
        one = Level(rows["node"].to_numpy().astype(np.uint64), *(rows[c].to_numpy() for c in ("n0", "n1", "below")))
        up, index = one.above(1)
        zero = Level(up, *(np.bincount(index, x, minlength=len(up)) for x in (one.n0, one.n1, one.log_w)))
        left = (1 - zero.beta)[index]
        at = one.keys.astype(np.int64)
        part[at] = (zero.beta * zero.p1)[index] + left * one.beta * one.p1
        rest[at] = left * (1 - one.beta)
    return part, rest


def gram_values(levels: list, paths: np.ndarray, top: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """log10 probability of each gram's symbol in its context."""
    level = levels[-1][0]
    at = (level.keys & np.uint64(0xFFFF)).astype(np.int64)
    part, rest = top[0][at], top[1][at]
    for i in range(len(levels) - 1, -1, -1):
        level, _ = levels[i]
        if i < len(levels) - 1:
            index = levels[i][1]
            part, rest = part[index], rest[index]
        part, rest = part + rest * level.beta * level.p1, rest * (1 - level.beta)
    p = np.where(paths >= 0, part[np.where(paths >= 0, paths, ~paths)], 1 - part[np.where(paths >= 0, paths, ~paths)])
    return np.log10(p).sum(axis=0)


def read_bucket(bucket: pa.Table) -> dict[int, list]:
    """{kind: [(chunk, keys, counts)]} of a bucket's packed rows."""
    rows: dict[int, list] = {GRAM: [], WORD: []}
    for r in bucket.to_pylist():
        rows[r["kind"]].append((r["chunk"], unpack_keys(r["keys"], r["n"]), unpack(r["counts"], r["n"], np.int64)))
    return rows


def summed(rows: list) -> tuple[np.ndarray, np.ndarray]:
    counter = Counter()
    for _, keys, counts in rows:
        counter.add(keys, counts)
    return counter.compact() if rows else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def bucket_sums(depth: int):
    """Of a bucket: one row of word totals, and its sums for the nodes of depth 1."""

    def run(bucket: pa.Table) -> pa.Table:
        rows = read_bucket(bucket)
        _, counts = summed(rows[WORD])
        out = [as_batch({"node": [-1], "n0": [float(counts.sum())], "n1": [float((counts > 0).sum())], "below": [0.0]}, schema)]
        if rows[GRAM]:
            out.append(as_batch(top_sums(subtrees(*summed(rows[GRAM]), depth)[0]), schema))
        return pa.Table.from_batches(out, schema)

    schema = pa.schema([("node", pa.int64()), ("n0", pa.float64()), ("n1", pa.float64()), ("below", pa.float64())])
    return run


def bucket_values(depth: int, top, per_count):
    """Of a bucket: each chunk's own words and grams with their values."""

    def run(bucket: pa.Table) -> pa.Table:
        rows, out = read_bucket(bucket), []
        for kind in (GRAM, WORD):
            keys, counts = summed(rows[kind])
            if not len(keys):
                continue
            values = (gram_values(*subtrees(keys, counts, depth), top.value) if kind == GRAM else
                      np.log10((counts + 0.1) / per_count))
            for chunk, own, _ in rows[kind]:
                at = np.searchsorted(keys, own)
                out.append(as_batch({"chunk": [chunk], "kind": [kind], "n": [len(own)], "keys": [pack_keys(own)],
                                     "data": [pack(values[at])], "known": [np.packbits(counts[at] > 0).tobytes()]}, schema))
        return pa.Table.from_batches(out, schema)

    schema = pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()),
                        ("data", pa.binary()), ("known", pa.binary())])
    return run


class Lookup:
    """Columns by 64-bit key: buckets of a hash, probed for many keys at once."""

    def __init__(self, keys: np.ndarray, *columns: np.ndarray):
        self.bits = max(1, int(2 * len(keys)).bit_length())
        slot = self.slot(keys)
        order = np.argsort(slot)
        self.keys = np.append(keys[order], np.uint64(0))
        self.columns = [x[order] for x in columns]
        self.starts = np.searchsorted(slot[order], np.arange((1 << self.bits) + 1)).astype(np.int32)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * ts.BASE) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> list[np.ndarray]:
        at = self.starts[self.slot(keys)]
        missed = np.flatnonzero(self.keys[at] != keys)
        while len(missed):
            at[missed] += 1
            missed = missed[self.keys[at[missed]] != keys[missed]]
        return [x[at] for x in self.columns]


def score_chunk(depth: int, schema: pa.Schema, n_train: int, total: int, end_value: float):
    """Scores the documents of one chunk with its own words' and grams' values."""

    def run(packs: pa.Table, known: pa.Table) -> pa.Table:
        if not packs.num_rows:
            return schema.empty_table()
        own = {GRAM: [], WORD: []}
        for r in known.to_pylist():
            seen = np.unpackbits(np.frombuffer(r["known"], np.uint8), count=r["n"])
            own[r["kind"]].append((unpack_keys(r["keys"], r["n"]), unpack(r["data"], r["n"], np.float64), seen))
        of = {kind: Lookup(*(np.concatenate(x) for x in zip(*rows))) if rows else None for kind, rows in own.items()}
        out = []
        for data in packs["pack"]:
            docs = pa.ipc.open_stream(data.as_buffer()).read_all().combine_chunks()
            parts = []
            for block in ts.blocks(docs["text"]):
                low, n = block.lower(), len(block)
                g, at = grams(low, depth)
                score = np.bincount(np.repeat(np.arange(n), np.diff(at)), of[GRAM](g)[0], minlength=n)
                w, at = word_hashes(low)
                doc = np.repeat(np.arange(n), np.diff(at))
                value, seen = of[WORD](w) if len(w) else (np.zeros(0), np.zeros(0))
                base = np.bincount(doc, value, minlength=n) + end_value
                n_known = np.bincount(doc, seen, minlength=n).astype(np.int64) + (n_train > 0)
                parts.append((np.diff(at) + 1, n_known, base, score, np.diff(block.starts)))
            n_tokens, n_known, base, score, n_bytes = (np.concatenate(x) for x in zip(*parts))
            out.append(as_batch({"doc_id": docs["doc_id"], "held_out": docs["held_out"], "n_tokens": n_tokens.astype(np.int64),
                                 "n_known": n_known, "train_tokens": np.full(len(docs), total), "base_score": base,
                                 "score": score, "bits_per_byte": -score / np.log10(2) / (n_bytes + 1)}, schema))
        return pa.Table.from_batches(out, schema)

    return run


def score_texts(docs: DataFrame, doc_id: str, text: str, held_out: Column, depth: int = DEPTH,
                chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score (add-0.1 unigram over words and an end token), score (log10
    probability by the context tree) and bits_per_byte.

    Rows where ``held_out`` is false are the training texts. Null and empty
    texts are scored as the end alone; repeated rows are scored (and counted)
    each; without training rows every decision has probability 1/2; an empty
    table gives an empty result. Other columns are ignored. ``depth`` is 2 to 7.
    """
    if not 2 <= depth <= 7:
        raise ValueError("depth must be 2 to 7")
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    sizes = docs.agg(F.count("*"), F.count(F.when(~F.col("held_out"), 1)), F.sum(F.octet_length("text"))).first()
    n_train, buckets = sizes[1], shuffle_width(spark, sizes[2], BUCKET_BYTES)
    packs = stage(pack_texts(docs, chunk_bytes), "ctw-texts")
    vocab = bucketed(vocabulary(packs, depth, buckets), "ctw_vocabulary", buckets, "bucket", "kind")
    sums = (vocab.groupBy("bucket").applyInArrow(bucket_sums(depth), "node long, n0 double, n1 double, below double")
            .groupBy("node").agg(*(F.sum(c).alias(c) for c in ("n0", "n1", "below"))).toPandas())
    words = sums[sums["node"] < 0]
    total, distinct = int(words["n0"].sum()) + n_train, int(words["n1"].sum()) + (n_train > 0)
    per_count = total + 0.1 * (distinct + 1)
    top = spark.sparkContext.broadcast(top_mixture(sums[sums["node"] >= 0]))
    values = vocab.groupBy("bucket").applyInArrow(bucket_values(depth, top, per_count),
                                                  "chunk long, kind int, n int, keys binary, data binary, known binary")
    result = (docs.select("doc_id", "held_out")
              .select("*", *(F.lit(0).cast("long").alias(c) for c in ("n_tokens", "n_known", "train_tokens")),
                      *(F.lit(0.0).alias(c) for c in ("base_score", "score", "bits_per_byte"))).schema)
    scorer = score_chunk(depth, to_arrow_schema(result), n_train, total, float(np.log10((n_train + 0.1) / per_count)))
    return packs.groupBy("chunk").cogroup(values.groupBy("chunk")).applyInArrow(scorer, result)


def op10_language_model(spark, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), "doc_id", "text", crc_mod("doc_id", 10) == 0)
