"""Text embedding and vector search as Spark jobs.

Embedding (EM1)
    ``embed(df, text_col)`` runs a pluggable encoder in ``mapInPandas``:
    the encoder is built once per Python worker and sees Arrow batches.
    The shipped encoder is a deterministic hashed-token encoder with the
    output rules of the source model (float32, fixed dimension, masked
    mean, L2-normalised, a fixed special-token vector for token-less
    text).  It reads the **whole** text (no token cap by default).

Exact filtered top-k (VS1)
    Queries and (filtered) corpus are dealt into hash blocks of
    ``BLOCK_ROWS``; every pair of blocks is one unit, scored in an executor
    as a float64 matrix product.  A unit returns at most ``k`` rows per
    query, and a window merges them.  Nothing passes through the driver.

Approximate top-k (VS2)
    Residual product codes: a byte per group of dimensions stands in for each
    vector, table look-ups rank the codes, a few candidates per query are
    scored exactly (``product_codes.py``).
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import NORM_EPS
from . import product_codes as PC

DEFAULT_DIM = 384
BLOCK_ROWS = 4096        # vectors per block of a scoring unit
QUERY_CHUNK = 512        # queries per matrix product inside a unit
POOL_ROWS = 256          # texts whose token hashes are pooled at once
RERANK = 10              # candidates of the approximate search for each of the k results


# -- encoder ---------------------------------------------------------------------------------

# Fixed values of the hashed-token encoder.
TOKEN_PATTERN = r"(?U)\w+|[^\w\s]"       # word runs (any script) or single symbols
SUB_HASH_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


class HashedTokenEncoder:
    """Deterministic text -> unit vector encoder (stand-in for the transformer).

    Tokenisation and the 64-bit token hash run in the JVM
    (``regexp_extract_all`` + ``xxhash64``); this class only pools the hash
    arrays of an Arrow batch with numpy: every token adds +/-1 at
    ``len(SUB_HASH_MULTIPLIERS)`` positions derived from its hash, the row
    vector is the mean over tokens (``sum / max(count, 1e-9)``) and is
    L2-normalised; token-less text gets a fixed special-token vector.
    """

    def __init__(self, dim: int = DEFAULT_DIM):
        import numpy as np
        self.dim = dim
        special = np.zeros(dim, dtype=np.float64)
        special[0] = special[dim - 1] = 1.0
        self.special = (special / np.linalg.norm(special)).astype(np.float32)
        self.mult = np.array(SUB_HASH_MULTIPLIERS, dtype=np.uint64)

    def pool(self, hash_lists) -> "list":
        import numpy as np
        n = len(hash_lists)
        lens = np.fromiter((0 if h is None else len(h) for h in hash_lists), dtype=np.int64, count=n)
        out = np.zeros((n, self.dim), dtype=np.float64)
        if lens.sum():
            flat = np.concatenate([np.asarray(h, dtype=np.int64) for h in hash_lists
                                   if h is not None and len(h)]).view(np.uint64)
            rows = np.repeat(np.arange(n), lens)
            mixed = flat ^ (flat >> np.uint64(33))
            for m in self.mult:
                v = mixed * m                                    # wraps mod 2^64
                pos = ((v >> np.uint64(20)) % np.uint64(self.dim)).astype(np.int64)
                sign = np.where((v >> np.uint64(63)) == 1, 1.0, -1.0)
                np.add.at(out, (rows, pos), sign)
            out /= np.maximum(lens, 1e-9)[:, None]
        norms = np.linalg.norm(out, axis=1)
        res = np.empty((n, self.dim), dtype=np.float32)
        ok = norms > NORM_EPS
        res[ok] = (out[ok] / norms[ok, None]).astype(np.float32)
        res[~ok] = self.special
        return list(res)


_ENCODERS: dict = {}


def _encoder(factory, key):
    # one encoder per Python worker process (model loaded once, reused)
    if key not in _ENCODERS:
        _ENCODERS[key] = factory()
    return _ENCODERS[key]


def token_hashes(text, max_tokens: int | None = None):
    """JVM-side tokenisation + xxhash64 per token -> array<bigint> (whole text)."""
    toks = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN_PATTERN), 0)
    if max_tokens is not None:
        toks = F.slice(toks, 1, max_tokens)
    return F.transform(toks, lambda t: F.xxhash64(t))


def embed(df: DataFrame, text_col: str = "text", out_col: str = "embedding",
          dim: int = DEFAULT_DIM, encoder_factory=None, encoder_name: str = "custom", max_tokens: int | None = None,
          keep_text: bool = True) -> DataFrame:
    """EM1: add ``out_col array<float>`` (unit norm) computed from ``text_col``.

    Default: the hashed-token encoder (tokens/hashes in the JVM, pooling in
    numpy per Arrow batch).  ``encoder_factory`` plugs in any model object
    with ``encode(list[str]) -> (n, dim) array``; it is constructed once per
    Python task and fed whole Arrow batches of texts; ``encoder_name`` keeps
    different models in one task apart.  Without ``keep_text`` the text stays
    in the JVM and is dropped (hashed encoder only).
    """
    if encoder_factory is None and not keep_text:
        df = df.withColumn("_tok_hashes", token_hashes(F.col(text_col), max_tokens)).drop(text_col)
    fields = [f for f in df.schema.fields if f.name != "_tok_hashes"]
    schema = T.StructType([*fields, T.StructField(out_col, T.ArrayType(T.FloatType(), False), False)])
    if encoder_factory is None:
        key = ("hashed", dim)
        tmp = "_tok_hashes"
        staged = df.withColumn(tmp, token_hashes(F.col(text_col), max_tokens)) if keep_text else df

        def run_hashed(batches):
            enc = _encoder(lambda: HashedTokenEncoder(dim), key)
            for pdf in batches:
                for a in range(0, len(pdf), POOL_ROWS):
                    part = pdf.iloc[a:a + POOL_ROWS]
                    yield part.drop(columns=[tmp]).assign(**{out_col: enc.pool(part[tmp].tolist())})

        return staged.mapInPandas(run_hashed, schema)

    key = (encoder_name, dim)

    def run(batches):
        enc = _encoder(encoder_factory, key)
        for pdf in batches:
            pdf[out_col] = list(enc.encode(pdf[text_col].tolist())) if len(pdf) else []
            yield pdf

    return df.mapInPandas(run, schema)


# -- top-k over scoring units -------------------------------------------------------------

def _unit_vectors(column) -> np.ndarray:
    m = np.stack([np.asarray(v, dtype=np.float64) for v in column])
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), NORM_EPS)


def _allowed(q, c, filters: dict) -> np.ndarray:
    """Mask (queries x corpus rows) of the per-query payload filters."""
    ok = np.ones((len(q), len(c)), dtype=bool)
    for col, (q_col, mode) in filters.items():
        cv, qv = c[col].to_numpy(dtype=object), q[q_col].to_numpy(dtype=object)
        if mode == "eq":          # query value null -> no filter
            free = np.array([x is None or x != x for x in qv])
            ok &= free[:, None] | (qv[:, None] == cv[None, :])
        else:                     # "ne_neutral": flagged queries skip neutral rows
            flag = np.array([bool(x) for x in qv])
            ok &= ~(flag[:, None] & np.array([x == "neutral" for x in cv])[None, :])
    return ok


def _score_unit(k: int, filters: dict, exclude_self: bool):
    """Top ``k`` of one unit's queries among its corpus rows (score desc, id asc)."""

    def fn(q, c):
        import pandas as pd
        out = {"qid": [], "id": [], "score": []}
        if len(q) and len(c):
            c = c.sort_values("id")
            ids, C = c["id"].to_numpy(dtype=np.int64), _unit_vectors(c["cvec"])
            for a in range(0, len(q), QUERY_CHUNK):
                part = q.iloc[a:a + QUERY_CHUNK]
                qids = part["qid"].to_numpy(dtype=np.int64)
                S = np.where(_allowed(part, c, filters), _unit_vectors(part["qvec"]) @ C.T, -np.inf)
                if exclude_self:
                    S[qids[:, None] == ids[None, :]] = -np.inf
                best = np.argsort(-S, axis=1, kind="stable")[:, :k]
                score = np.take_along_axis(S, best, axis=1)
                row, col = np.nonzero(np.isfinite(score))
                out["qid"].append(qids[row])
                out["id"].append(ids[best[row, col]])
                out["score"].append(score[row, col])
        empty = {"qid": np.int64, "id": np.int64, "score": np.float64}
        return pd.DataFrame({c: np.concatenate(v) if v else np.zeros(0, empty[c]) for c, v in out.items()})

    return fn


def _merge(queries: DataFrame, corpus: DataFrame, units: list[str], k: int, filters: dict, exclude_self: bool) -> DataFrame:
    """Score dealt queries (qid, qvec, k, ..) and corpus rows (id, cvec, ..) that
    share the unit columns and rank each query's hits."""
    hits = queries.groupBy(*units).cogroup(corpus.groupBy(*units)).applyInPandas(
        _score_unit(k, filters, exclude_self), "qid long, id long, score double")
    w = Window.partitionBy("qid").orderBy(F.desc("score"), F.asc("id"))
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _blocks(n: int) -> int:
    return max(1, -(-n // BLOCK_ROWS))


def _all_of(n: int, name: str):
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)


def _block_of(key: str, n: int, name: str):
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int").alias(name)


def _sides(queries: DataFrame, corpus: DataFrame, qid, qvec, cid, cvec, k_col, filters):
    q = queries.select(F.col(qid).alias("qid"), F.col(qvec).alias("qvec"),
                       *([F.col(k_col).alias("_k")] if k_col else []), *dict.fromkeys(c for c, _ in filters.values()))
    return q, corpus.select(F.col(cid).alias("id"), F.col(cvec).alias("cvec"), *filters)


def knn_search(queries: DataFrame, corpus: DataFrame, k: int = 5, *, qid: str = "qid",
               qvec: str = "embedding", cid: str = "id", cvec: str = "embedding",
               k_col: str | None = None, lang: str | None = None, primary: str | None = None,
               exclude_neutral: bool = False, query_filters: dict | None = None,
               exclude_self: bool = False) -> DataFrame:
    """VS1: exact filtered top-k by cosine -> (qid, id, score, rank).

    Static payload filters (``lang``, ``primary``, ``exclude_neutral``) are
    ``where`` clauses on the corpus.  ``query_filters`` maps a corpus
    column to ``(query column, mode)`` for per-query filters: mode "eq"
    (query value null = no filter) or "ne_neutral" (boolean query flag).
    ``NOT (primary_label <=> 'neutral')`` keeps null labels, as the source.
    ``k_col`` gives each query its own k, at most ``k``.
    """
    c = corpus
    if lang is not None:
        c = c.where(F.col("lang") == lang)
    if primary is not None:
        c = c.where(F.col("primary_label") == primary)
    if exclude_neutral:
        c = c.where(~F.col("primary_label").eqNullSafe("neutral"))
    filters = dict(query_filters or {})
    q, c = _sides(queries, c, qid, qvec, cid, cvec, k_col, filters)
    nq, nc = _blocks(q.count()), _blocks(c.count())
    ranked = _merge(q.select("*", _block_of("qid", nq, "qb"), _all_of(nc, "cb")),
                    c.select("*", _block_of("id", nc, "cb"), _all_of(nq, "qb")), ["qb", "cb"], k, filters, exclude_self)
    if k_col:
        return ranked.join(q.select("qid", "_k"), "qid").where(F.col("rank") <= F.col("_k")).drop("_k")
    return ranked


def knn_ivf(queries: DataFrame, corpus: DataFrame, k: int = 5, *, qid: str = "qid",
            qvec: str = "embedding", cid: str = "id", cvec: str = "embedding",
            probe: float = 1.0, rerank: int | None = None, sample: int = PC.SAMPLE, exclude_self: bool = False) -> DataFrame:
    """VS2: approximate top-k -> (qid, id, score, rank), scores exact.

    Product codes of every vector (``product_codes.py``) rank the vectors of the
    ``probe`` share of cells nearest to a query; the best ``rerank`` (by default
    ``RERANK`` for each of the k) are scored against their vectors."""
    q, c = _sides(queries, corpus, qid, qvec, cid, cvec, None, {})
    books = PC.fit(c, sample=sample)
    if books is None:
        return queries.sparkSession.createDataFrame([], "qid long, id long, score double, rank int")
    chosen = PC.candidates(q, PC.encode(c, books), books, rerank or RERANK * k, probe, exclude_self)
    return PC.rank_exactly(chosen, q, c, k)


def recall_at_k(approx: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of exact (qid, id) hits that the approximate search found."""
    e = exact.select("qid", "id")
    hit = e.join(approx.select("qid", "id"), ["qid", "id"], "left_semi")
    return e.agg(F.count(F.lit(1)).alias("exact_hits")).select(
        "exact_hits", hit.select(F.count(F.lit(1))).scalar().alias("found"),
    ).withColumn("recall", F.try_divide(F.col("found").cast("double"), F.col("exact_hits").cast("double")))


# -- cosine helpers (FN10) --------------------------------------------------------------------

def cosine_to_prototypes(df: DataFrame, protos: DataFrame, id_col: str = "id", vec: str = "embedding",
                         proto_key: str = "proto", proto_vec: str = "vec") -> DataFrame:
    """Row-normalised cosine of every row against every prototype (norms clipped
    at 1e-12) -> (id, proto, cos).  Both sides are dealt into blocks, so the
    number of prototypes is not bounded by a broadcast."""
    schema = f"id long, {proto_key} string, cos double"

    def fn(x, p):
        import pandas as pd
        if not len(x) or not len(p):
            return pd.DataFrame({"id": np.zeros(0, np.int64), proto_key: np.zeros(0, object), "cos": np.zeros(0)})
        s = _unit_vectors(x["x"]) @ _unit_vectors(p["p"]).T
        return pd.DataFrame({"id": np.repeat(x["id"].to_numpy(dtype=np.int64), len(p)),
                             proto_key: np.tile(p[proto_key].to_numpy(dtype=object), len(x)), "cos": s.reshape(-1)})

    nx, np_ = _blocks(df.count()), _blocks(protos.count())
    rows = df.select(F.col(id_col).alias("id"), F.col(vec).alias("x")).select("*", _block_of("id", nx, "xb"), _all_of(np_, "pb"))
    cols = protos.select(proto_key, F.col(proto_vec).alias("p")).select("*", _block_of(proto_key, np_, "pb"), _all_of(nx, "xb"))
    return rows.groupBy("xb", "pb").cogroup(cols.groupBy("xb", "pb")).applyInPandas(fn, schema)


def centroids(df: DataFrame, key: str, vec: str = "embedding") -> DataFrame:
    """Mean vector per key, as one aggregation."""
    v = array_to_vector(F.transform(vec, lambda x: x.cast("double")))
    return df.groupBy(key).agg(Summarizer.mean(v).alias("m")).select(key, vector_to_array("m").alias("vec"))
