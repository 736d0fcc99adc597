"""Approximate nearest neighbours by inner product: an inverted multi-index.

The two halves of the vectors are quantised separately (k-means on a bounded
sample); a pair of centroids names a cell, and every vector is in one. A query
ranks the cells by the summed inner products with the two centroids, taking
them from a heap of the next best pairs, until the visited cells hold ``PROBE``
of all vectors; the vectors of these cells are ranked by the exact inner
product. The number of centroids grows with the fourth root of the table, so
cells (and the table of their sizes) grow with its square root.

Cells are dealt to tasks by first centroid, large ones in blocks, and meet the
queries that visit them there. A query's scores against the sample's vectors in
those cells give a lower bound of its last result, so tasks return few rows for each query.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodgeframe.llm.common import as_batch, map_batches, prepare, stage, table

TOP = 20
#: vectors the codebooks are fitted on (all if fewer)
SAMPLE = 16384
#: share of all vectors in the visited cells; measured recall on the test tables is in the README
PROBE = 0.7
#: queries whose cells one task chooses
PROBE_QUERIES = 256
ROUNDS = 10
#: vectors, and queries, in one task's block
BLOCK = 8192


def centroids(x: np.ndarray, k: int) -> np.ndarray:
    rng = np.random.default_rng(3)
    c = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(ROUNDS):
        at = nearest(x, c)
        for j in range(len(c)):
            if (at == j).any():
                c[j] = x[at == j].mean(axis=0)
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c * c).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)


def rounding(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """For each row of ``q``, more than two ways to sum its inner product with a row of ``v`` differ."""
    return 1e-9 * np.maximum(1.0, np.linalg.norm(q, axis=1) * np.linalg.norm(v, axis=1).max(initial=0))


def visit(s1: np.ndarray, s2: np.ndarray, sizes: np.ndarray, wanted: int) -> list[tuple[int, int]]:
    """Non-empty cells (i, j) by falling s1[i] + s2[j] until they hold ``wanted`` vectors."""
    o1, o2 = np.argsort(-s1, kind="stable"), np.argsort(-s2, kind="stable")
    heap, out, got = [(-(s1[o1[0]] + s2[o2[0]]), 0, 0)], [], 0
    while heap and got < wanted:
        _, a, b = heapq.heappop(heap)
        n = sizes[o1[a], o2[b]]
        if n:
            out.append((int(o1[a]), int(o2[b])))
            got += n
        if a + 1 < len(o1) and b == 0:
            heapq.heappush(heap, (-(s1[o1[a + 1]] + s2[o2[0]]), a + 1, 0))
        if b + 1 < len(o2):
            heapq.heappush(heap, (-(s1[o1[a]] + s2[o2[b + 1]]), a, b + 1))
    return out


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(id, v): vectors in double precision without nulls, non-finite numbers or
    all zeros, of the most common length, with an id."""
    v = F.transform(F.col(embedding), lambda x: x.cast("double"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    clean = (vectors.select(F.col(vec_id).cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null")
             .where(F.coalesce(fine, F.lit(False)) & F.exists("v", lambda x: x != 0)))
    common = clean.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return clean.where(F.size("v") == (common.d if common else 0))


def as_matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def search(vectors: DataFrame, vec_id: str, embedding: str, is_query: Column, top: int = TOP, probe: float = PROBE,
           sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``top`` largest inner products
    found among the other vectors, ties to the smaller id; all candidates if
    there are fewer in the visited cells than asked for.

    ``is_query`` is a condition on the column ``id``. Vectors that are null, empty,
    zero, of another length than most, or hold null or non-finite numbers take
    no part, nor do null ids. Of rows with a query's id none is its candidate;
    such repeated rows are searched for once (the smallest vector) and are
    candidates each for others. An empty table gives an empty result; extra
    columns are ignored.
    """
    spark = vectors.sparkSession
    prepare(spark)
    clean = usable(vectors, vec_id, embedding)
    some = clean.orderBy(F.xxhash64("id", "v"), "id").limit(sample).toArrow()
    if not some.num_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    n = clean.count()
    ids, x = some["id"].to_numpy(), as_matrix(some["v"].combine_chunks())
    half = x.shape[1] // 2 or x.shape[1]
    k = min(max(1, int(np.ceil(2 * n**0.25))), len(x))
    books = (centroids(x[:, :half], k), centroids(x[:, half:], k))
    cells_of_sample = nearest(x[:, :half], books[0]), nearest(x[:, half:], books[1])
    shared = spark.sparkContext.broadcast((books, half, ids, x, cells_of_sample))

    def assign(batch):
        books, half = shared.value[:2]
        m = as_matrix(batch.column(1))
        yield {"id": batch.column(0), "v": batch.column(1), "c1": nearest(m[:, :half], books[0]).astype(np.int32) if len(m) else [],
               "c2": nearest(m[:, half:], books[1]).astype(np.int32) if len(m) else []}

    index = stage(map_batches(clean, assign, "id long, v array<double>, c1 int, c2 int"), "multi-index")
    sizes = np.zeros((k, k), np.int64)
    for r in index.groupBy("c1", "c2").count().collect():
        sizes[r.c1, r.c2] = r["count"]
    queries = index.where(is_query).groupBy("id").agg(F.min("v").alias("v"))
    n_queries = index.where(is_query).agg(F.count_distinct("id")).first()[0]
    blocks = np.maximum(1, -(-sizes.sum(axis=1) // BLOCK))
    sets = max(1, -(-n_queries // BLOCK))
    wanted = max(int(np.ceil(probe * n)), min(top + 1, n))

    def probes(batch):
        books, half, ids, x, at = shared.value
        m = as_matrix(batch.column(1))
        qs = batch.column(0).to_numpy()
        out = {c: [] for c in ("c1", "block", "query", "c2s", "least")}
        rows = []
        slack = rounding(m, x)
        for i in range(len(m)):
            cells: dict[int, list[int]] = {}
            visited = np.zeros(sizes.shape, bool)
            for a, b in visit(books[0] @ m[i, :half], books[1] @ m[i, half:], sizes, wanted):
                cells.setdefault(a, []).append(b)
                visited[a, b] = True
            seen = (x @ m[i])[(ids != qs[i]) & visited[at]]
            least = np.partition(seen, len(seen) - top)[len(seen) - top] if len(seen) >= top else -np.inf
            for a, c2s in cells.items():
                for block in range(int(blocks[a])):
                    for name, value in zip(out, (a, block, int(qs[i]), c2s, float(least - slack[i]))):
                        out[name].append(value)
                    rows.append(i)
        yield out | {"v": batch.column(1).take(pa.array(rows, pa.int64()))}

    def rank(cell: pa.Table, asking: pa.Table) -> pa.Table:
        if not cell.num_rows or not asking.num_rows:
            return schema.empty_table()
        v, q = as_matrix(cell["v"].combine_chunks()), as_matrix(asking["v"].combine_chunks())
        ids, c2, qs, least = cell["id"].to_numpy(), cell["c2"].to_numpy(), asking["query"].to_numpy(), asking["least"].to_numpy()
        out = []
        for a in range(0, len(q), 256):
            fast = q[a:a + 256] @ v.T
            slack = rounding(q[a:a + 256], v)
            for i, c2s in enumerate(asking["c2s"][a:a + 256].to_pylist()):
                mine = a + i
                ok = np.flatnonzero(np.isin(c2, c2s) & (ids != qs[mine]) & (fast[i] >= least[mine] - slack[i]))
                if len(ok) > top:       # leave ties and the last bits to the exact sums below
                    edge = np.partition(fast[i][ok], len(ok) - top)[len(ok) - top]
                    ok = ok[fast[i][ok] >= edge - slack[i]]
                score = (v[ok] * q[mine]).sum(axis=1)
                best = np.lexsort((ids[ok], -score))[:top]
                out.append(as_batch({"query_id": np.full(len(best), qs[mine]), "vec_id": ids[ok][best], "score": score[best]}, schema))
        return pa.Table.from_batches(out, schema)

    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    per_c1 = F.element_at(F.array(*(F.lit(int(b)) for b in blocks)), F.col("c1") + 1)
    dealt = (index.withColumn("block", F.pmod(F.xxhash64("id"), per_c1).cast("int"))
             .withColumn("set", F.explode(F.sequence(F.lit(0), F.lit(int(sets) - 1)))).select("c1", "block", "set", "id", "c2", "v"))
    # small rows, much work each: a task for every PROBE_QUERIES of them, whatever their bytes
    queries = queries.repartition(max(1, -(-n_queries // PROBE_QUERIES)))
    asked = (map_batches(queries, probes, "c1 int, block int, query long, c2s array<int>, least double, v array<double>")
             .withColumn("set", F.pmod(F.xxhash64("query"), F.lit(int(sets))).cast("int")))
    keys = ["c1", "block", "set"]
    found = dealt.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(rank, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def op6_multi_index(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("id") % 20 == 0)
