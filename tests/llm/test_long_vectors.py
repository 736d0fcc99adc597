"""op6 on vectors far from unit norm."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgeframe.llm import multi_index


@pytest.mark.parametrize("norm", [1e4, 1e6])
def test_all_neighbours_of_long_vectors(spark, norm):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 64))
    x *= norm / np.linalg.norm(x, axis=1)[:, None]
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(400)], "vec_id long, embedding array<double>")
    got = {}
    for r in multi_index.search(df, "vec_id", "embedding", F.col("id") % 4 == 0, probe=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    exact = {q: [int(v) for v in np.argsort(-(x @ x[q]), kind="stable") if v != q][:20] for q in range(0, 400, 4)}
    assert got == exact
