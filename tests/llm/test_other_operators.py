"""Chat trees, WARC archives, vector search, the two classifiers and the pipeline."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodgeframe.llm import chat, components, cotrain, multi_index, toxicity, warc
from lodgeframe.llm.common import crc_mod, stage
from lodgeframe.session import scratch_path

SF = "/root/testdata/sf0.01"
MESSAGE = "tree long, message string, parent string, role string, text string, score double"

# -- chat --------------------------------------------------------------------------------


def test_escaping_is_reversible(spark):
    texts = [r"</s> <\/s> <\\s> [INST] [/INST] \ [\INST] <s><<s>> </s", "", "<</s></s>", "a\nb é🙂", "[[INST]]"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect():
        assert r.u == r.t and not any(c in r.e for c in (chat.BEGIN, chat.HEAD, chat.HEAD_END, chat.END))


def test_branches_of_a_tree(spark):
    rows = [(1, "a", None, "user", "hi", 1.0), (1, "b", "a", "assistant", "x", 2.0), (1, "c", "a", "assistant", "y </s>", 3.0),
            (1, "d", "c", "user", "z", None), (2, "q", "gone", "user", None, None), (3, "m", "n", "user", "cycle", 1.0),
            (3, "n", "m", "user", "cycle", 1.0), (1, "b", "a", "assistant", "x", 2.0), (None, "e", None, "user", "no tree", 1.0)]
    df = spark.createDataFrame(rows, MESSAGE)
    got = [(r.tree, r.leaf, r.branch, r.branch_score, [(t.role, t.text) for t in r.read_turns], r.loss_text)
           for r in chat.read_back(chat.format_trees(df, None)).orderBy("tree", "branch").collect()]
    assert got == [(1, "d", 1, 2.0, [("user", "hi"), ("assistant", "y </s>"), ("user", "z")], "y </s>"),
                   (1, "b", 2, 1.5, [("user", "hi"), ("assistant", "x")], "x"), (2, "q", 1, None, [("user", "")], "")]
    assert chat.format_trees(df).where("tree = 1").count() == 1
    assert chat.format_trees(df.limit(0)).count() == 0


def test_long_chains(spark):
    n = 300
    df = spark.createDataFrame([(5, str(i), str(i - 1) if i else None, "assistant" if i % 2 else "user", f"m{i}", 1.0) for i in range(n)], MESSAGE)
    r = chat.read_back(chat.format_trees(df)).first()
    assert [t.text for t in r.read_turns] == [f"m{i}" for i in range(n)] and r.loss_text == "".join(f"m{i}" for i in range(1, n, 2))


def test_turn_tables_with_nulls_and_ties(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (1, 1, "assistant", "b"), (None, 0, "user", "x"), (2, 0, None, "[INST]"), (2, None, "user", "first")]
    got = {r.tree: [(t.role, t.text) for t in r.read_turns] for r in
           chat.read_back(chat.format_trees(chat.chains(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))).collect()}
    assert got == {1: [("user", ""), ("assistant", ""), ("assistant", "b")], 2: [("user", "first"), ("", "[INST]")]}


# -- WARC --------------------------------------------------------------------------------


def expected(rows):
    by = {}
    for i, _, h in rows:
        if i is not None:
            by.setdefault((h or "").encode(), []).append(i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        again = i is not None and len(b) >= 1000 and max(by[b]) != i
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", max(by[b]) if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("split, broadcast", [(4000, 0), (1 << 20, 1000)])
def test_archives_with_false_records(spark, monkeypatch, split, broadcast):
    monkeypatch.setattr(warc, "BROADCAST_REVISITS", broadcast)
    fake = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    big = "x" * 1200
    rows = [(1, "u", None), (2, "u", ""), (3, None, big), (4, "a\r\nb", big), (5, "u", fake), (6, "u", "\r\n\r\n\r\n" + fake * 3),
            (7, "u", "é\n\r\n"), (8, "u", big + "\n"), (9, "u", big), (10, "u", fake * 40), (11, "u", fake * 40), (12, "u", "\r\n"),
            (9, "u", big), (None, "u", "no id"), (13, "u", "long " * 50000)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        path = scratch_path(spark, "warc-test")
        warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")), path)
        got = [tuple(r) for r in warc.read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(got, key=repr) == expected(rows)


def test_a_broken_chain_ends_the_file(spark):
    """Records after a wrong length, and those that only payloads hold, do not count."""
    path = scratch_path(spark, "warc-test")
    record = lambda i, body, n=None: (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\n"  # noqa: E731
                                      f"Content-Length: {len(body) if n is None else n}\r\n\r\n{body}\r\n\r\n")
    http = "HTTP/1.1 200 OK\r\n\r\n"
    text = record(1, http + "one") + record(2, http + record(7, http + "inner") * 3) + record(3, http + "three", 5) + record(4, http + "four")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "\n").text(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split in (60, 333, 1 << 20):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
            got = {r.page_id: (r.payload_bytes, r.payload_digest) for r in warc.read(spark, path).collect()}
            inner = (record(7, http + "inner") * 3).encode()
            whole = {1: (3, hashlib.sha1(b"one").hexdigest()), 2: (len(inner), hashlib.sha1(inner).hexdigest())}
            assert {i: got[i] for i in (1, 2)} == whole and set(got) == {1, 2, 3}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_empty_archives(spark):
    path = scratch_path(spark, "warc-test")
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read(spark, path).count() == 0


# -- components --------------------------------------------------------------------------


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 120)] + [(119, 130), (7, 7), (None, 3), (130, 119)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[i] == 100 for i in (*range(100, 120), 130)) and len(got) == 82


# -- vector search -----------------------------------------------------------------------


def brute_nearest(ids, x, q, top):
    s = (x * x[q]).sum(axis=1)
    order = [i for i in np.lexsort((ids, -s)) if ids[i] != ids[q]][:top]
    return [int(ids[i]) for i in order]


def test_search_finds_the_nearest(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 12)) + 3 * rng.normal(size=(6, 12))[rng.integers(0, 6, 600)]
    x[100:160] = x[100]                                  # a very common vector
    df = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(600)], "vec_id long, embedding array<double>")
    rows = multi_index.search(df, "vec_id", "embedding", F.col("id") % 20 == 0, top=20).collect()
    found = {}
    for r in rows:
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    ids = np.arange(600)
    assert sorted(found) == list(range(0, 600, 20))
    hits = 0
    for q, got in found.items():
        got.sort()
        assert [g[0] for g in got] == list(range(1, 21)) and all(abs(s - x[q] @ x[v]) < 1e-9 for _, v, s in got)
        assert [(-s, v) for _, v, s in got] == sorted((-s, v) for _, v, s in got)
        hits += len({v for _, v, _ in got} & set(brute_nearest(ids, x, q, 20)))
    assert hits / (20 * len(found)) >= 0.9


def test_probing_everything_is_exact(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "BLOCK", 16)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(150, 6)).astype(np.float32).astype(float)
    x[20:40] = x[20]
    df = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(150)], "vec_id long, embedding array<float>")
    got = {}
    for r in multi_index.search(df, "vec_id", "embedding", F.col("id") % 5 == 0, top=7, probe=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {q: brute_nearest(np.arange(150), x, q, 7) for q in range(0, 150, 5)}


def test_unusable_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, []),
            (8, [1.0, 2.0, 3.0]), (None, [9.0, 9.0]), (0, [1.0, 0.0]), (20, [0.1, 0.1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit(1))
    got = [tuple(r) for r in multi_index.search(df, "vec_id", "embedding", F.col("id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 0.5), (0, 2, 20, 0.1), (20, 1, 0, 0.1), (20, 2, 0, 0.1), (20, 3, 1, 0.1)]
    assert multi_index.search(df.limit(0), "vec_id", "embedding", F.col("id") == 0).count() == 0


# -- classifiers -------------------------------------------------------------------------


def test_quality_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scored = cotrain.score_quality(docs, labels, held_out=crc_mod("_id", 5) == 0)
    rows = scored.join(labels, "doc_id").where(crc_mod("doc_id", 5) == 0).select("quality", "quality_score").collect()
    right = sum((r.quality_score >= cotrain.KEEP) == (r.quality == 1) for r in rows)
    assert len(rows) > 50 and right / len(rows) >= 0.95


def test_quality_on_edges(spark, edge_docs, edge_labels):
    rows = cotrain.score_quality(edge_docs, edge_labels).collect()
    assert len(rows) == 9 and all(0 <= r.quality_score <= 1 for r in rows)
    assert cotrain.keep_good(edge_docs, edge_labels.limit(0)).count() == 9
    assert cotrain.keep_good(edge_docs.limit(0), edge_labels).count() == 0


def test_toxicity_learns_stems_and_ignores_other_columns(spark):
    rng = np.random.default_rng(6)
    stems, words = ["zorg", "quib"], [f"w{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(700):
        text = list(rng.choice(words, rng.integers(5, 60)))
        bad = i % 4 == 0
        if bad:
            text.insert(rng.integers(0, len(text)), str(rng.choice(stems)) + str(rng.integers(0, 999)))
        rows.append((i, " ".join(text), "en" if i % 2 else "de"))
        labels.append((i, int(bad)))
    docs, y = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    scored = toxicity.score_toxicity(docs, y, held_out=crc_mod("_id", 3) == 1)
    held = scored.join(y, "doc_id").where(crc_mod("doc_id", 3) == 1).collect()
    right = sum((r.toxic_score >= toxicity.THRESHOLD) == (r.toxic == 1) for r in held)
    assert right / len(held) >= 0.9
    again = toxicity.score_toxicity(docs.withColumn("lang", F.lit("xx")).withColumn("doc_id", F.col("doc_id")), y, held_out=crc_mod("_id", 3) == 1)
    a, b = ({r.doc_id: r.toxic_score for r in x.collect()} for x in (scored, again))
    assert a == b


def test_toxicity_on_edges(spark, edge_docs, edge_labels):
    rows = toxicity.score_toxicity(edge_docs, edge_labels).collect()
    assert len(rows) == 9 and all(0 <= r.toxic_score <= 1 for r in rows)
    assert {r.toxic_score for r in toxicity.score_toxicity(edge_docs, edge_labels.limit(0)).collect()} == {0.5}
    assert toxicity.score_toxicity(edge_docs.limit(0), edge_labels).count() == 0


def test_long_texts_are_scored_in_blocks(monkeypatch):
    model = toxicity.initial()
    words = np.random.default_rng(1).integers(0, toxicity.SLOTS, (5000, 4)).astype(np.int32)
    offsets = np.array([0, 3000, 3000, 3004, 5000])
    whole = toxicity.forward(model, words, offsets)
    monkeypatch.setattr(toxicity, "BLOCK_WORDS", 64)
    assert np.allclose(whole, toxicity.forward(model, words, offsets), atol=1e-5)


# -- pipeline ----------------------------------------------------------------------------


def test_stages_return_documents_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, SF), f"test-{name}")
        counts.append(docs.count())
        if name != "encode":
            assert docs.columns == columns
    assert counts[0] > counts[1] > counts[2] >= counts[3] > counts[4] == counts[5]
    assert docs.where("not exact").count() == 0 and docs.where("n_tokens <> size(ids)").count() == 0


def test_pipeline_on_edges(spark, edge_docs, edge_labels):
    docs = edge_docs.select("doc_id", "text", "lang", "source", "n_chars")
    path = scratch_path(spark, "edges")
    edge_labels.write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    docs.write.parquet(f"{path}/documents.parquet")
    rows = corpus_pipeline.run(spark, path).collect()
    assert all(r.exact for r in rows) and 1 not in {r.doc_id for r in rows}
