"""Toxicity is learned and calibrated from all labelled rows, not from the sample that starts it."""

import numpy as np
from pyspark.sql import functions as F

from lodgeframe.llm import toxicity


def rows_beyond_the_sample(spark):
    """Of 900 rows (a third toxic) the first by id hash have one toxic word, the others another."""
    order = [r.id for r in spark.range(900).orderBy(F.xxhash64("id")).collect()]
    rng, rows = np.random.default_rng(2), []
    for k, i in enumerate(order):
        text = list(rng.choice([f"w{j}" for j in range(60)], 12))
        if i % 3 == 0:
            text.insert(int(rng.integers(0, 12)), "zorgish" if k < 300 else "quibble")
        rows.append((i, " ".join(text), "en" if i % 2 else None, int(i % 3 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")


def test_rows_beyond_the_sample_are_learned(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "GROUP_ROWS", 400)
    both = rows_beyond_the_sample(spark)
    docs, labels = both.drop("toxic"), both.select("doc_id", "toxic")
    held = F.col("_id") % 10 == 1
    first = {r.doc_id: r for r in toxicity.score_toxicity(docs, labels, held_out=held, sample=(60, 120)).collect()}
    late = [r for r in first.values() if r.doc_id % 10 == 1 and r.doc_id % 3 == 0 and "quibble" in r.text]
    kind = [r for r in first.values() if r.doc_id % 10 == 1 and r.doc_id % 3]
    assert len(late) >= 10 and np.mean([r.toxic_score >= 0.5 for r in late]) >= 0.9
    assert np.mean([r.toxic_score < 0.5 for r in kind]) >= 0.9
    again = toxicity.score_toxicity(docs.repartition(7, "text"), labels.repartition(3), held_out=held, sample=(60, 120)).collect()
    assert all(abs(r.toxic_score - first[r.doc_id].toxic_score) < 1e-9 for r in again)


def test_counts_stand_for_repeated_rows():
    rng = np.random.default_rng(4)
    z, y, n = rng.normal(size=40), rng.integers(0, 2, 40).astype(float), rng.integers(1, 6, 40)
    many = lambda x: np.repeat(x, n)
    assert np.allclose(toxicity.calibrate(z, y, 0.3, n), toxicity.calibrate(many(z), many(y), 0.3))
    assert toxicity.best_threshold(z, y, n) == toxicity.best_threshold(many(z), many(y))


def test_only_labelled_texts_meet_the_labels(spark, monkeypatch):
    """The texts are joined once, by merging whatever the size, without most of the rows that have no label."""
    both = rows_beyond_the_sample(spark)
    other = spark.range(900, 9000).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text"), F.lit("en").alias("lang"))
    docs, plans, stage = both.drop("toxic").union(other), [], toxicity.stage

    def watched(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        out = stage(df, name)
        assert out.count() == 900
        return out

    monkeypatch.setattr(toxicity, "stage", watched)
    assert toxicity.score_toxicity(docs, both.select("doc_id", "toxic"), sample=(60, 120)).count() == 9000
    assert len(plans) == 1 and "SortMergeJoin" in plans[0] and "BroadcastHashJoin [_word" in plans[0]
    known = both.select(F.col("doc_id").alias("_id"), F.col("toxic").alias("label"))
    texts = docs.select(F.col("doc_id").alias("_id"), "text")
    left = toxicity.likely(texts, known, 900)
    assert left.columns == ["_id", "text"] and left.join(known, "_id").count() == 900 and left.count() < 900 + 8100 / 5
    assert toxicity.likely(texts.withColumn("_id", F.col("_id").cast("int")), known, 900).count() == 9000
    monkeypatch.setattr(toxicity, "ID_WORDS", 1)
    assert toxicity.likely(texts, known, 900).join(known, "_id").count() == 900
