"""Importance resampling: prefix-CRC features against plain CRCs, weights and draws against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lodgeframe.llm import resampling as rs

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return ALNUM.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def features(text):
    w = words(text)
    return [" ".join(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute(docs, items, least_words=20, percent=5):
    bucket = lambda g: zlib.crc32(g.encode()) % 10000
    s = Counter(bucket(g) for _, t in docs for g in features(t))
    t = Counter(bucket(g) for _, x in items for g in features(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000))))
    rows = []
    for i, x in docs:
        f = features(x)
        weight = sum(gain(bucket(g)) for g in f)
        rows.append([i, len(f), weight, weight + rs.gumbel("null" if i is None else str(i)), None, len(words(x))])
    drawable = sorted((r for r in rows if r[5] >= least_words), key=lambda r: (-r[3], r[0]))
    for k, r in enumerate(drawable[:percent * len(drawable) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def test_crcs_of_runs_equal_plain_crcs():
    rnd = random.Random(2)
    texts = [" .-".join(rnd.choices(["é", "Word", "x" * 63, "y" * 64, "z" * 5000, "1"], k=rnd.randrange(12))) for _ in range(60)]
    texts += [None, "", "?!", "one", "A b"]
    found = [Counter() for _ in texts]
    for first, counts, runs in rs.feature_crcs(pa.array(texts, pa.string())):
        for row, crc in runs:
            for r, c in zip(row, crc):
                found[first + r][int(c)] += 1
        assert counts.tolist() == [len(words(t)) for t in texts[first:first + len(counts)]]
    assert found == [Counter(zlib.crc32(g.encode()) for g in features(t)) for t in texts]


def test_advance_over_long_runs():
    rnd = np.random.default_rng(1)
    head, tails = b"some text before", [rnd.integers(0, 256, n, dtype=np.uint8).tobytes() for n in (0, 1, 63, 64, 65, 127, 128, 100_000)]
    whole = np.array([zlib.crc32(head + t) for t in tails], np.uint32)
    moved = rs.advance(np.full(len(tails), zlib.crc32(head), np.uint32), np.array([len(t) for t in tails]))
    assert (whole ^ moved).tolist() == [zlib.crc32(t) for t in tails]


def test_resample_equals_brute_force(spark):
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    docs = [(i, " ".join(rnd.choices(vocabulary[i % 5 * 40:], k=rnd.randrange(60)))) for i in range(400)]
    docs += [(500, None), (501, ""), (502, "Ünïcode Ä-b"), (503, docs[3][1])]
    items = [(1, " ".join(rnd.choices(vocabulary[300:], k=90))), (2, None)]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = rs.resample(frames[0], "doc_id", "text", frames[1], "text").select("doc_id", "n_features", "weight", "score", "rank")
    rows = sorted(map(tuple, got.collect()), key=repr)
    assert rows == brute(docs, items) and max(r[4] or 0 for r in rows) >= 10


def test_edges_ties_and_clashing_names(spark, edge_docs):
    clash = edge_docs.select("*", *[F.lit(c).alias(c) for c in ("row", "key", "body", "short", "_pid", "place", "weight", "N_WORDS", "id")])
    items = spark.createDataFrame([(None, "alpha beta gamma"), (2, None)], "item_id long, text string")
    rows = rs.resample(clash, "doc_id", "text", items, "text").collect()
    assert len(rows) == 9 and [r["_pid"] for r in rows] == ["_pid"] * 9 and {r.id for r in rows} == {"id"}
    assert [r.weight for r in rows if not words(r.text)] == [0, 0, 0]
    twice = [(r.weight, r.score) for r in rows if r.doc_id == 1]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert rs.resample(edge_docs.limit(0), "doc_id", "text", items, "text").count() == 0
    empty = rs.resample(edge_docs, "doc_id", "text", items.limit(0), "text")
    assert empty.count() == 9
    same = spark.createDataFrame([(i % 30, "word " * 25) for i in range(60)], "doc_id long, text string")
    weighed = rs.weigh(same, "doc_id", "text", np.zeros(10, np.int64)).withColumn("score", F.lit(5).cast("long"))
    drawn = rs.draw(weighed, "doc_id", percent=10).where("rank is not null").orderBy("rank")
    assert [(r["rank"], r.doc_id) for r in drawn.collect()] == [(1, 0), (2, 0), (3, 1), (4, 1), (5, 2), (6, 2)]
