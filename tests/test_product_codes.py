"""Residual product codes: recall with few exact scores, code accuracy, edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgeframe.operators import product_codes as PC
from lodgeframe.operators import vectors as V
from lodgeframe.sources.standin import StandIn


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_the_given_vectors(spark, sf):
    vec = StandIn(spark, f"/root/testdata/{sf}").vectors()
    queries = vec.where("id % 20 = 0").select(F.col("id").alias("qid"), "embedding")
    n = vec.count()
    exact = V.knn_search(queries, vec, 5, exclude_self=True)
    rerank = 50
    found = V.recall_at_k(V.knn_ivf(queries, vec, 5, rerank=rerank, exclude_self=True), exact).first()
    assert rerank <= 0.2 * n and found.recall >= 0.9


def test_codes_rank_like_the_products(spark):
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(600, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    books = PC.Codebooks(x[:400], groups=8)
    cell, code = books.encode(x)
    q = x[:5]
    near = q @ books.centres[cell].T + sum(t[:, code[:, j]] for j, t in enumerate(books.tables(q)))
    assert np.abs(near - q @ x.T).mean() < 0.06 and code.shape == (600, 8)


def test_candidates_span_cells_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(PC, "BLOCK_CODES", 16)
    monkeypatch.setattr(PC, "QUERY_BLOCK", 3)
    rnd = np.random.default_rng(5)
    rows = [(i, [float(v) for v in rnd.normal(size=8)]) for i in range(150)] + [(200, [0.0] * 8), (201, [1.0] * 8), (202, [1.0] * 8)]
    df = spark.createDataFrame(rows, "id long, embedding array<double>")
    queries = df.where("id % 20 = 0").select(F.col("id").alias("qid"), "embedding")
    exact = V.knn_search(queries, df, 4, exclude_self=True)
    all_scored = V.knn_ivf(queries, df, 4, rerank=200, exclude_self=True)
    key = lambda rows: sorted((r.qid, r["rank"], r.id) for r in rows.collect())
    assert key(all_scored) == key(exact)                       # with every vector a candidate the result is exact
    half = V.knn_ivf(queries, df, 4, rerank=40, probe=0.5, exclude_self=True)
    assert V.recall_at_k(half, exact).first().recall > 0.4
    assert V.knn_ivf(queries, df.limit(0), 4).count() == 0
    one = V.knn_ivf(queries.limit(1), df.where("id = 7"), 4).collect()
    assert [(r.id, r["rank"]) for r in one] == [(7, 1)]
