"""Contract fixtures, vector-search invariants, embedding rules, files, streams."""

import json

import numpy as np
from pyspark.sql import functions as F

from lodgeframe.operators import contract as CT
from lodgeframe.operators import vectors as V
from lodgeframe.sources import files as FS

# an invented request that satisfies every rule
VALID = {
    "room_type": "Entire home/apt", "property_type": "Tiny cabin", "neighbourhood_name": "Harbour Hill",
    "accommodates": 5, "bedrooms": 2.0, "beds": 4.0, "bathrooms": 2.5, "listing_price": 87.5, "minimum_nights": 2,
    "maximum_nights": 60, "instant_bookable": True, "host_is_superhost": False, "host_listing_count": 7,
    "total_reviews_before_cutoff": 12.0, "unique_reviewers_before_cutoff": 11.0,
    "avg_comment_len_before_cutoff": 140.25, "max_comment_len_before_cutoff": 800.0,
    "days_since_last_review": 9.0, "available_days_last_90d": 45, "available_rate_last_90d": 0.5,
    "avg_minimum_nights_calendar_last_90d": 2.0, "avg_maximum_nights_calendar_last_90d": 60.0,
    "available_days_last_30d": 6, "available_rate_last_30d": 0.2,
    "avg_minimum_nights_calendar_last_30d": 2.0, "avg_maximum_nights_calendar_last_30d": 60.0,
}


def _violations(spark, payloads, rules=CT.W2_RULES):
    df = spark.createDataFrame([(i, json.dumps(p) if not isinstance(p, str) else p)
                                for i, p in enumerate(payloads)], "k int, payload string")
    return [r["violations"] for r in CT.with_violations(df, rules=rules).orderBy("k").collect()]


def test_contract_fixtures(spark):
    missing = {k: v for k, v in VALID.items() if k != "listing_price"}
    wrong = dict(VALID, accommodates="large")
    leak = dict(VALID, high_demand_proxy=1)
    extra = dict(VALID, foo=1)
    nullable = dict(VALID, bedrooms=None)
    lax = dict(VALID, accommodates="3", instant_bookable="yes", bedrooms="2.5")
    rng = dict(VALID, available_rate_last_90d=1.2, minimum_nights=-1)
    got = _violations(spark, [VALID, missing, wrong, leak, extra, nullable, lax, rng, "not json"])
    assert got[0] == []
    assert got[1] == ["missing:listing_price"]
    assert got[2] == ["type:accommodates"]
    assert got[3] == ["forbidden:high_demand_proxy"]
    assert got[4] == ["unknown:foo"]
    assert got[5] == []
    assert got[6] == []
    assert got[7] == ["range:available_rate_last_90d", "range:minimum_nights"]
    assert got[8] == ["parse:payload"]


def test_w3_contract_allows_omitted_optionals(spark):
    p = {("is_superhost" if k == "host_is_superhost" else k): v for k, v in VALID.items()}
    p.pop("bedrooms")
    bad = dict(p, listing_price=None)
    got = _violations(spark, [p, bad], CT.W3_RULES)
    assert got == [[], ["null:listing_price"]]


def test_query_bounds(spark):
    df = spark.createDataFrame([("ok", 5, "en"), ("", 0, "fr"), ("x" * 5000, 101, None)],
                               "query string, top_k int, lang string")
    got = [r["violations"] for r in CT.query_bound_violations(df).collect()]
    assert got == [[], ["query:empty", "top_k:out_of_range", "lang:unsupported"],
                   ["query:too_long", "top_k:out_of_range"]]


def _vec_df(spark, n=60, d=8, seed=1):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, d))
    X /= np.linalg.norm(X, axis=1, keepdims=True)
    labels = ["neutral", "good", None, "toxic"]
    rows = [(i, [float(x) for x in X[i]], labels[i % 4], "en" if i % 3 else "fr") for i in range(n)]
    return spark.createDataFrame(rows, "id long, embedding array<float>, primary_label string, lang string"), X


def test_knn_exact_matches_brute_force_and_filters_never_leak(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK_ROWS", 10)                # several blocks of queries and corpus
    df, X = _vec_df(spark)
    q = df.select(F.col("id").alias("qid"), "embedding")
    hits = V.knn_search(q, df, 4, lang="en", exclude_neutral=True, exclude_self=True)
    rows = hits.collect()
    labels = {r["id"]: (r["primary_label"], r["lang"]) for r in df.collect()}
    Xf = X.astype(np.float32).astype(np.float64)
    Xf /= np.linalg.norm(Xf, axis=1, keepdims=True)
    for qid in range(len(X)):
        cand = [j for j in range(len(X)) if j != qid and labels[j][1] == "en" and labels[j][0] != "neutral"]
        best = sorted(cand, key=lambda j: (-(Xf[qid] @ Xf[j]), j))[:4]
        got = [r["id"] for r in sorted((r for r in rows if r["qid"] == qid), key=lambda r: r["rank"])]
        assert got == best
    assert all(labels[r["id"]][0] != "neutral" and labels[r["id"]][1] == "en" for r in rows)
    assert any(labels[r["id"]][0] is None for r in rows)   # null labels are kept


def test_embedding_rules(spark):
    texts = ["the quick brown fox " * 1000, "🙂🙂", "متن فارسی", "中文文本", "café naïve", "12345", ".", "!!!",
             "", "   ", "dup", "dup"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    e1 = {r["i"]: np.array(r["embedding"]) for r in V.embed(df, "text", dim=64).collect()}
    e2 = {r["i"]: np.array(r["embedding"]) for r in V.embed(df, "text", dim=64).collect()}
    for i in e1:
        assert e1[i].shape == (64,) and e1[i].dtype == np.float64
        assert abs(np.linalg.norm(e1[i]) - 1.0) < 1e-5
        assert np.array_equal(e1[i], e2[i])                  # deterministic
    assert np.array_equal(e1[10], e1[11])                     # duplicates
    assert np.array_equal(e1[8], e1[9])                       # token-less -> special vector


def test_manifest_statuses(spark, tmp_path):
    d = tmp_path / "bundle"
    (d / "sub").mkdir(parents=True)
    (d / "a.txt").write_text("a")
    (d / "sub" / "b.txt").write_text("b")
    (d / "__pycache__").mkdir()
    (d / "__pycache__" / "x.pyc").write_text("x")
    m = {r["path"]: r["sha256"] for r in FS.file_manifest(spark, str(d)).collect()}
    assert set(m) == {"a.txt", "sub/b.txt"}
    declared = spark.createDataFrame(
        [("a.txt", m["a.txt"]), ("sub/b.txt", "0" * 64), ("gone.txt", "1" * 64), ("p.bin", "REPLACE_ME")],
        "path string, sha256 string")
    (d / "new.txt").write_text("n")
    st = {r["path"]: r["status"] for r in FS.verify_manifest(declared, FS.file_manifest(spark, str(d))).collect()}
    assert st == {"a.txt": "ok", "sub/b.txt": "mismatch", "gone.txt": "missing", "new.txt": "extra",
                  "p.bin": "placeholder"}


def test_json_list_file(spark, tmp_path):
    p = tmp_path / "corpus.json"
    p.write_text(json.dumps([{"text": "a", "primary": "good"}, {"text": "b", "labels": ["x"]}]))
    rows = FS.read_json_corpus(spark, str(p), list_file=True).collect()
    assert [r["text"] for r in rows] == ["a", "b"] and rows[0]["labels"] is None


def test_stream_equals_batch(spark):
    from lodgeframe.streaming.incremental import daily_event_counts
    from lodgeframe.sources.tables import read_table, table_path
    d = "/root/testdata/sf0.001"
    ev = read_table(spark, d, "events")
    s = daily_event_counts(spark, table_path(d, "events"), ev.schema)
    b = ev.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    assert sorted(tuple(r) for r in s.select("day", "event_type", "n").collect()) == \
        sorted(tuple(r) for r in b.collect())


def test_upsert_table_rewrites_only_touched_buckets(spark):
    from lodgeframe.operators.sinks import read_upserted, upsert_table
    from lodgeframe.session import scratch_path
    path = scratch_path(spark, "upsert_test")
    base = spark.range(1000).select(F.col("id"), F.lit("v0").alias("val"))
    assert upsert_table(spark, base, path, rows_per_bucket=64) == 1000
    new = spark.createDataFrame([(5, "v1"), (2000, "new")], "id long, val string")
    assert upsert_table(spark, new, path, dry_run=True) == 2
    assert read_upserted(spark, path).count() == 1000
    upsert_table(spark, new, path)
    upsert_table(spark, new, path)                       # idempotent replay
    out = {r["id"]: r["val"] for r in read_upserted(spark, path).collect()}
    assert len(out) == 1001 and out[5] == "v1" and out[2000] == "new" and out[6] == "v0"


def test_upsert_keeps_one_row_of_a_repeated_id(spark):
    from lodgeframe.operators.sinks import read_upserted, upsert_table
    from lodgeframe.session import scratch_path
    path = scratch_path(spark, "upsert_test")
    rows = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 2), (2, "x", 1)], "id long, val string, at int")
    upsert_table(spark, rows, path, order="at")
    upsert_table(spark, rows.where("id = 1").unionByName(rows.where("id = 1")), path, order="at")
    assert sorted((r.id, r.val) for r in read_upserted(spark, path).collect()) == [(1, "b"), (2, "x")]
    assert upsert_table(spark, rows, scratch_path(spark, "upsert_test"), limit=1) == 1


def test_ivf_finds_most_of_the_exact_hits(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK_ROWS", 16)
    df, _ = _vec_df(spark, n=200)
    q = df.where("id % 5 = 0").select(F.col("id").alias("qid"), "embedding")
    exact = V.knn_search(q, df, 5, exclude_self=True)
    found = V.recall_at_k(V.knn_ivf(q, df, 5, probe=0.8, exclude_self=True), exact).first()
    assert found["exact_hits"] == 200 and found["recall"] > 0.8


def test_numeric_texts(spark):
    from lodgeframe.operators import contract as CT
    texts = ["1", "-2.5", "+.5", "1e3", "3.", "NaN", "1d", "1f", "Infinity", "0x1", "1_000", "", "1 2", None]
    got = [r.v for r in spark.createDataFrame([(t,) for t in texts], "t string").select(CT.number(F.col("t")).alias("v")).collect()]
    assert got == [1.0, -2.5, 0.5, 1000.0, 3.0] + [None] * 9
    rules = (CT.FieldRule("x", CT.FLOAT),)
    rows = spark.createDataFrame([('{"x": "NaN"}',), ('{"x": "1d"}',), ('{"x": "1.5"}',), ('{"x": 2}',)], "payload string")
    found = [r.violations for r in CT.with_violations(rows, rules=rules).collect()]
    assert found == [["type:x"], ["type:x"], [], []]


def test_nan_becomes_null(spark):
    from lodgeframe.operators import contract as CT
    df = spark.createDataFrame([(1.5, float("nan"), "NaN", 1), (None, 2.0, None, None)], "a double, b double, c string, d int")
    assert [tuple(r) for r in CT.clean_for_json(df).collect()] == [(1.5, None, "NaN", 1), (None, 2.0, None, None)]


def test_batch_bounds(spark):
    from lodgeframe.operators import contract as CT
    df = spark.createDataFrame([(0,), (1,), (256,), (257,), (None,)], "n_texts int")
    assert [r.violations for r in CT.batch_bound_violations(df).collect()] == [["texts:too_few"], [], [], ["texts:too_many"], ["texts:too_few"]]


def test_audit_misses_take_the_whole_payload(spark):
    from lodgeframe.plans import vector_plans as VP
    hits = spark.createDataFrame([(0, 1, 1, 0.5), (0, 2, 2, 0.4), (0, 3, 3, 0.3)], "qid long, rank int, id long, score double")
    audit = spark.createDataFrame([(1, "audited", "good", ["good"], "de", "web")], "id long, text string, primary_label string, labels array<string>, lang string, source string")
    payload = spark.createDataFrame([(1, "p1", "x", ["x"], "fr", "s1"), (2, "p2", "y", ["y", "z"], "fr", "s2"), (3, None, None, None, None, None)],
                                    "id long, text string, primary_label string, labels array<string>, lang string, source string")
    import hashlib
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    got = {r.id: (r.text_md5, r.primary, r.labels, r.lang, r.source) for r in VP._audit_join(hits, audit, payload).collect()}
    assert got == {1: (md5("audited"), "good", "good", "de", "web"), 2: (md5("p2"), "y", "y;z", "fr", "s2"), 3: (md5(""), "unknown", "", "", "")}


def test_reindex_job_limits(spark):
    from lodgeframe.operators.sinks import read_upserted
    from lodgeframe.plans import vector_plans as VP
    from lodgeframe.session import scratch_path
    rows = spark.createDataFrame([(i, f"text {i}", None, None, "en", None, None if i % 2 else "2024-01-01T00:00:00") for i in range(10)],
                                 "id long, text string, primary string, labels array<string>, lang string, source string, timestamp string")
    path = scratch_path(spark, "reindex_job")
    assert VP.reindex_job(spark, rows, path, "2024-01-01T08:00:00", dry_run=True) == 5
    assert VP.reindex_job(spark, rows, path, None, limit=3) == 3
    assert sorted((r.id, r.source) for r in read_upserted(spark, path).collect()) == [(i, VP.DEFAULT_SOURCE) for i in range(3)]


def test_agreement(spark):
    from lodgeframe.operators import evaluate as EV
    df = spark.createDataFrame([(1, 1), (0, 1), (0, 0), (None, 1)], "label int, prediction int")
    assert tuple(EV.agreement(df).first()) == (4, 2, 0.5)
