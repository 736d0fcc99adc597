"""Stateful exact dedup: streams of several files, collisions, hot classes and edge cases."""

import uuid
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lodgeframe.llm import exact_copies as ec
from lodgeframe.session import scratch_path


def stored(spark, *frames):
    path = scratch_path(spark, f"test-copies-{uuid.uuid4().hex[:6]}")
    for df in frames:
        df.write.mode("append").parquet(path)
    return path


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    return sorted((i, max(groups[t or ""]), len(groups[t or ""]), i == max(groups[t or ""])) for i, t in rows)


def weak(body):
    """A digest of few values: most hits are collisions."""
    return F.concat(F.substring(body, 1, 1), F.lit("").cast("binary"))


@pytest.mark.parametrize("digest", [ec.sha256, weak])
@pytest.mark.parametrize("broadcast_classes", [1000, 0])
def test_streamed_files_equal_brute_force(spark, digest, broadcast_classes):
    rows = [(i, f"text {i % 17}" if i % 3 else "hot text") for i in range(300)] + [(300, None), (301, ""), (302, "x"), (303, "xy"), (304, "X")]
    frames = [spark.createDataFrame(rows[k::4], "doc_id long, text string").coalesce(1) for k in range(4)]
    found = ec.find_copies(spark, stored(spark, *frames), "doc_id", "text", digest=digest, batch_bytes=1, broadcast_classes=broadcast_classes)
    assert sorted(map(tuple, found.select("doc_id", "keep_id", "group_size", "kept").collect())) == brute(rows)
    assert sorted(r.text or "" for r in ec.keep_one(found).collect()) == sorted({t or "" for _, t in rows})


def test_state_goes_on_with_new_files(spark):
    first, second = [(1, "a"), (2, "b"), (3, "a")], [(4, "a"), (0, "b"), (5, "c")]
    path, where = stored(spark, spark.createDataFrame(first, "doc_id long, text string")), scratch_path(spark, "test-copies-state")
    before = ec.find_copies(spark, path, "doc_id", "text", where=where)
    assert sorted(map(tuple, before.select("doc_id", "keep_id", "group_size", "kept").collect())) == brute(first)
    anchors = {bytes(r.digest): r["first"].id for r in ec.classes(spark, where).collect()}
    spark.createDataFrame(second, "doc_id long, text string").write.mode("append").parquet(path)
    after = ec.find_copies(spark, path, "doc_id", "text", where=where)
    assert sorted(map(tuple, after.select("doc_id", "keep_id", "group_size", "kept").collect())) == brute(first + second)
    state = {bytes(r.digest): r["first"].id for r in ec.classes(spark, where).collect()}
    assert len(state) == 3 and anchors.items() <= state.items()          # locators stay, nothing expires


def test_edges_and_clashing_names(spark, edge_docs):
    names = ["digest", "file", "at", "n", "first", "top", "parts", "salt", "whole", "seen", "_digest", "KEPT", "keep_id"]
    docs = edge_docs.select("*", *[F.lit(k).alias(c) for k, c in enumerate(names)])
    found = ec.find_copies(spark, stored(spark, docs.coalesce(2)), "doc_id", "text")
    rows = found.collect()
    assert len(rows) == 9 and [r["n"] for r in rows] == [3] * 9 and [r["_digest"] for r in rows] == [10] * 9
    assert sum(r.kept for r in rows) == 7                                   # one of the repeated row, one of null and empty
    assert {(r.doc_id, r.keep_id, r.group_size) for r in rows if not r.text} == {(2, 3, 2), (3, 3, 2)}
    assert [(r.doc_id, r.keep_id, r.group_size) for r in rows if r.doc_id is None] == [(None, None, 1)]
    assert ec.find_copies(spark, stored(spark, docs.limit(0)), "doc_id", "text").count() == 0


def test_no_python_in_the_plan(spark, edge_docs):
    found = ec.find_copies(spark, stored(spark, edge_docs), "doc_id", "text")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
