"""Different strings with one polynomial hash, and clashing column names."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodgeframe.llm import cotrain, ctw, jaccard_join, suffix_levels, toxicity
from lodgeframe.llm import textscan as ts


def thue_morse(n, a, b):
    return "".join((a, b)[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("n", [256, 512, 1024, 4096])
def test_long_strings_have_hashes_of_their_own(n):
    block = next(ts.blocks(pa.array([thue_morse(n, "a", "b"), thue_morse(n, "b", "a"), thue_morse(n, "a", "b")])))
    h = block.hashes(block.starts[:-1], block.starts[1:])
    assert h[0] != h[1] and h[0] == h[2]


def test_short_strings_do_not_collide():
    """A Thue-Morse pair of up to LONG_BYTES needs codes that agree in some 29 low bits."""
    codes = ts.BYTE_CODE
    differ = codes[:, None] ^ codes[None, :]
    differ = differ[differ != 0]
    assert not (differ & np.uint64((1 << 26) - 1) == 0).any()


@pytest.mark.parametrize("n", [1024, 4096])
def test_no_link_no_removal_no_count(spark, n):
    t, u = thue_morse(n, "a", "b"), thue_morse(n, "b", "a")
    docs = spark.createDataFrame([(1, f"{t} x y z"), (2, f"{u} x y z")], "doc_id long, text string")
    found = jaccard_join.link_components(docs, "doc_id", "text", width=4).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(1, 1), (2, 2)]
    assert jaccard_join.keep_one(docs, "doc_id", "text").count() == 2
    scored = {r.doc_id: r.n_known for r in ctw.score_texts(docs, "doc_id", "text", F.col("doc_id") == 2).collect()}
    assert scored[1] == 5 and scored[2] == 4                    # x, y, z and the end


def test_repeats_of_such_strings_equal_brute_force(spark):
    t, u = thue_morse(1024, "a", "b"), thue_morse(1024, "b", "a")
    texts = [t, u, "x" * 150 + t[:260], "unlike " * 30]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen, span = {}, 200
    for i, x in enumerate(texts):
        for p in range(len(x) - span + 1):
            seen.setdefault(x[p:p + span], []).append((i, p))
    cut = {i: set() for i in range(len(texts))}
    for places in seen.values():
        if len(places) > 1:
            for i, p in places:
                cut[i] |= set(range(p, p + span))
    got = {r.doc_id: r.repeats for r in suffix_levels.repeated_ranges(docs, "text").collect()}
    assert {i: {p for a, z in zip(r[::2], r[1::2]) for p in range(a, z)} for i, r in got.items()} == cut


def test_clashing_names(spark, edge_docs, edge_labels):
    names = ["_text", "_lang", "_source", "_n_chars", "_digest", "body", "tongue", "code", "in_text", "in_source"]
    docs = edge_docs.select("*", *[F.lit(f"own {c}").alias(c) for c in names])
    scored = [toxicity.score_toxicity(docs, edge_labels), cotrain.score_quality(docs, edge_labels)]
    for found in scored:
        rows = found.collect()
        assert len(rows) == 9 and all(r[c] == f"own {c}" for r in rows for c in names)
    kept = jaccard_join.keep_one(docs, "doc_id", "text").collect()
    assert all(r[c] == f"own {c}" for r in kept for c in names) and sorted(kept[0].asDict()) == sorted(docs.columns)
