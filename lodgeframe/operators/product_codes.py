"""Approximate top-k by residual product codes (VS2).

Every unit vector is stored as the number of its coarse cell and one byte per
group of dimensions: the nearest of up to 256 codewords for what the cell's
centre leaves over.  A query's inner product with a coded vector is then

    query . centre + sum over groups of  table[group, byte]

with one look-up table per query, so the search moves and reads ``GROUPS``
bytes per vector instead of the vector.  The best ``rerank`` candidates of each
query, over all the cells it visits, are scored exactly against their vectors.

Centres and codewords are fitted on at most ``SAMPLE`` vectors (those of
smallest id hash); every vector is coded.  The codebooks, some hundred KB, are
what each task gets.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import NORM_EPS, cosine

SAMPLE = 16_384
GROUPS = 16
WORDS = 256
MAX_CELLS = 256
BLOCK_CODES = 65_536      # codes of a cell in one scoring unit
QUERY_BLOCK = 1024        # queries of one scoring unit
TABLE_ROWS = 64           # queries whose scores are held at once


def unit_rows(column) -> np.ndarray:
    m = np.stack([np.asarray(v, dtype=np.float64) for v in column])
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), NORM_EPS)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Index of the nearest centre of each row, in slices of bounded size."""
    half = (centres ** 2).sum(axis=1) / 2
    step = max(1, (1 << 22) // len(centres))
    return np.concatenate([np.argmax(x[i:i + step] @ centres.T - half, axis=1) for i in range(0, len(x), step)] or [np.zeros(0, np.int64)])


def fit_centres(x: np.ndarray, k: int, rounds: int = 12, seed: int = 42) -> np.ndarray:
    """Lloyd's algorithm on a bounded sample; an empty cell starts again at a
    row far from its own centre."""
    rnd = np.random.default_rng(seed)
    centres = x[np.sort(rnd.choice(len(x), min(k, len(x)), replace=False))].copy()
    for _ in range(rounds):
        cell = nearest(x, centres)
        size = np.bincount(cell, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, cell, x)
        filled = size > 0
        centres[filled] = total[filled] / size[filled, None]
        if not filled.all():
            far = np.argsort(-((x - centres[cell]) ** 2).sum(axis=1), kind="stable")
            centres[~filled] = x[far[:(~filled).sum()]]
    return centres


class Codebooks:
    """Coarse centres and the codewords of each group of dimensions."""

    def __init__(self, sample: np.ndarray, groups: int = GROUPS, seed: int = 42):
        n, dim = sample.shape
        self.centres = fit_centres(sample, int(np.clip(round(n ** 0.5 / 4), 1, MAX_CELLS)), seed=seed)
        rest = sample - self.centres[nearest(sample, self.centres)]
        self.bounds = np.linspace(0, dim, min(groups, dim) + 1).astype(int)
        self.words = [fit_centres(rest[:, a:b], WORDS, seed=seed + i + 1) for i, (a, b) in enumerate(self.spans())]

    def spans(self):
        return list(zip(self.bounds[:-1], self.bounds[1:]))

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, bytes) of unit vectors."""
        cell = nearest(x, self.centres)
        rest = x - self.centres[cell]
        return cell, np.stack([nearest(rest[:, a:b], w) for (a, b), w in zip(self.spans(), self.words)], axis=1).astype(np.uint8)

    def tables(self, q: np.ndarray) -> list[np.ndarray]:
        """Per group: products of each query with each codeword."""
        return [q[:, a:b] @ w.T for (a, b), w in zip(self.spans(), self.words)]


def fit(vectors: DataFrame, vec: str = "cvec", key: str = "id", sample: int = SAMPLE, groups: int = GROUPS) -> Codebooks | None:
    """Codebooks of a bounded sample (at most ``sample`` vectors reach the
    driver); None for an empty table."""
    rows = vectors.orderBy(F.xxhash64(key), key).limit(sample).select(vec).collect()
    return Codebooks(unit_rows([r[0] for r in rows]), groups) if rows else None


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """(id, cell, code) of every vector of (id, cvec)."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        for pdf in batches:
            if len(pdf):
                cell, code = shared.value.encode(unit_rows(pdf["cvec"]))
                pdf["cell"], pdf["code"] = cell.astype(np.int32), [c.tobytes() for c in code]
                yield pdf[["id", "cell", "code"]]

    return vectors.select("id", "cvec").mapInPandas(run, "id long, cell int, code binary")


def _score_unit(books, rerank: int, exclude_self: bool):
    """The best ``rerank`` coded vectors of one unit for each of its queries."""

    def fn(key, q, c):
        import pandas as pd
        out = {"qid": [], "id": [], "near": []}
        if len(q) and len(c):
            b = books.value
            c = c.sort_values("id")
            ids = c["id"].to_numpy(dtype=np.int64)
            code = np.frombuffer(b"".join(c["code"]), np.uint8).reshape(len(c), -1)
            centre = b.centres[int(key[0])]
            for a in range(0, len(q), TABLE_ROWS):
                part = q.iloc[a:a + TABLE_ROWS]
                x, qids = unit_rows(part["qvec"]), part["qid"].to_numpy(dtype=np.int64)
                score = np.repeat((x @ centre)[:, None], len(c), axis=1)
                for j, table in enumerate(b.tables(x)):
                    score += table[:, code[:, j]]
                if exclude_self:
                    score[qids[:, None] == ids[None, :]] = -np.inf
                k = min(rerank, len(c))
                best = np.argpartition(-score, k - 1, axis=1)[:, :k]
                value = np.take_along_axis(score, best, axis=1)
                row, col = np.nonzero(np.isfinite(value))
                out["qid"].append(qids[row])
                out["id"].append(ids[best[row, col]])
                out["near"].append(value[row, col])
        empty = {"qid": np.int64, "id": np.int64, "near": np.float64}
        return pd.DataFrame({c: np.concatenate(v) if v else np.zeros(0, empty[c]) for c, v in out.items()})

    return fn


def candidates(queries: DataFrame, codes: DataFrame, books: Codebooks, rerank: int, probe: float = 1.0,
               exclude_self: bool = False) -> DataFrame:
    """(qid, id): the ``rerank`` best coded vectors of each query (qid, qvec)
    within the ``probe`` share of cells nearest to it."""
    spark = queries.sparkSession
    shared = spark.sparkContext.broadcast(books)
    visits = max(1, int(np.ceil(probe * len(books.centres))))
    sizes = {r["cell"]: r["count"] for r in codes.groupBy("cell").count().collect()}       # at most MAX_CELLS rows
    splits = F.array(*(F.lit(max(1, -(-sizes.get(i, 0) // BLOCK_CODES))) for i in range(len(books.centres))))

    def probes(batches):
        for pdf in batches:
            if len(pdf):
                near = np.argsort(-(unit_rows(pdf["qvec"]) @ shared.value.centres.T), axis=1, kind="stable")[:, :visits]
                pdf["cells"] = list(near.astype(np.int32))
                yield pdf

    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    here = queries.select("qid", "qvec")
    asked = (here.mapInPandas(probes, here.schema.simpleString()[7:-1] + ",cells:array<int>")
             .select("qid", "qvec", F.explode("cells").alias("cell"))
             .withColumn("cb", F.explode(F.sequence(F.lit(0), F.element_at(splits, F.col("cell") + 1) - 1)))
             .withColumn("qb", F.pmod(F.xxhash64("qid"), F.lit(blocks)).cast("int")))
    dealt = (codes.withColumn("cb", F.pmod(F.xxhash64("id"), F.element_at(splits, F.col("cell") + 1)).cast("int"))
             .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    unit = ["cell", "cb", "qb"]
    found = asked.groupBy(*unit).cogroup(dealt.groupBy(*unit)).applyInPandas(
        _score_unit(shared, rerank, exclude_self), "qid long, id long, near double")
    best = Window.partitionBy("qid").orderBy(F.desc("near"), F.asc("id"))
    return found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= rerank).select("qid", "id")


def rank_exactly(chosen: DataFrame, queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """(qid, id, score, rank): the candidates' exact cosines, the best ``k``."""
    scored = (chosen.join(vectors, "id").join(queries.select("qid", "qvec"), "qid")
              .select("qid", "id", cosine("qvec", "cvec").alias("score")))
    best = Window.partitionBy("qid").orderBy(F.desc("score"), F.asc("id"))
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
