"""Registered embedding / vector-search queries and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import cosine, l2_norm, l2_normalize, round_half_up
from ..operators import vectors as V
from ..sources.standin import StandIn
from .oracle_sql import rnd, with_views

K = 5
VEC_DIM = 64

# Payload defaults of the re-index job.
DEFAULT_PRIMARY = "neutral"
DEFAULT_LANG = "en"
DEFAULT_SOURCE = "instructor_indexer"
REINDEX_SINCE = "2024-01-01T08:00:00"


def _vectors(spark, sf_dir):
    return StandIn(spark, sf_dir).vectors()


def _queries(vec):
    """The query set: every vector whose id is divisible by 20 (self matches excluded)."""
    return vec.where(F.col("id") % 20 == 0).select(F.col("id").alias("qid"), "embedding", F.col("lang").alias("q_lang"),
                      ((F.col("id") % 2) == 0).alias("q_exclude_neutral"),
                      (F.col("id") % 5 + 1).cast("int").alias("top_k"))


def _audit(spark, sf_dir):
    """Audit rows: the curated (labelled) part of the text corpus."""
    return StandIn(spark, sf_dir).corpus().where(F.col("primary_label").isNotNull())


def _knn(spark, sf_dir, k=K):
    vec = _vectors(spark, sf_dir)
    return V.knn_search(_queries(vec), vec, k, lang="en", exclude_neutral=True, exclude_self=True)


def _audit_join(hits, audit, payload):
    """JN7: hits left-join audit rows by id; misses fall back to the payload."""
    a = audit.select(F.col("id"), F.col("text").alias("a_text"), F.col("primary_label").alias("a_primary"),
                     F.col("labels").alias("a_labels"), F.col("lang").alias("a_lang"),
                     F.col("source").alias("a_source"))
    p = payload.select("id", F.col("text").alias("p_text"), F.col("primary_label").alias("p_primary"), F.col("labels").alias("p_labels"),
                       F.col("lang").alias("p_lang"), F.col("source").alias("p_source"))
    j = hits.join(a, "id", "left").join(p, "id", "left")
    return j.select(
        "qid", "rank", "id", round_half_up("score", 6).alias("score"),
        F.md5(F.coalesce("a_text", "p_text", F.lit(""))).alias("text_md5"),
        F.coalesce("a_primary", "p_primary", F.lit("unknown")).alias("primary"),
        F.concat_ws(";", F.coalesce("a_labels", "p_labels", F.array().cast("array<string>"))).alias("labels"),
        F.coalesce("a_lang", "p_lang", F.lit("")).alias("lang"),
        F.coalesce("a_source", "p_source", F.lit("")).alias("source"))


def _payload(spark, sf_dir):
    """Stored payload of every point: its own label and language, and text, labels
    and source of the document of its id."""
    vec, docs = _vectors(spark, sf_dir).drop("embedding"), StandIn(spark, sf_dir).corpus().select("id", "text", "labels", "source")
    return vec.join(docs, "id", "left")


def q_knn_search(spark, sf_dir):
    return _knn(spark, sf_dir).select("qid", "id", "rank", round_half_up("score", 6).alias("score"))


def q_search_audit_join(spark, sf_dir):
    return _audit_join(_knn(spark, sf_dir), _audit(spark, sf_dir), _payload(spark, sf_dir))


def q_hybrid_search(spark, sf_dir):
    """VS3: per-query lang filter, neutral exclusion flag and top_k, then JN7."""
    vec = _vectors(spark, sf_dir)
    hits = V.knn_search(_queries(vec), vec, K, k_col="top_k", exclude_self=True,
                        query_filters={"lang": ("q_lang", "eq"),
                                       "primary_label": ("q_exclude_neutral", "ne_neutral")})
    return _audit_join(hits, _audit(spark, sf_dir), _payload(spark, sf_dir))


def q_knn_label(spark, sf_dir):
    """VS4: 1-NN label per query (lang en, neutral excluded); no match -> nulls."""
    vec = _vectors(spark, sf_dir)
    hits = V.knn_search(_queries(vec), vec, 1, lang="en", exclude_neutral=True, exclude_self=True)
    lab = hits.join(vec.select("id", F.col("primary_label").alias("label")), "id")
    return (_queries(vec).select("qid")
            .join(lab.select("qid", F.col("id").alias("matched_id"), "label",
                             round_half_up("score", 6).alias("score")), "qid", "left"))


def q_fetch_by_ids(spark, sf_dir):
    """SC7: id lists fetched in request order; missing ids dropped."""
    hits = _knn(spark, sf_dir)
    req = hits.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("rank", "id"))).alias("s")) \
              .select("qid", F.transform("s", lambda t: t["id"]).alias("ids"))
    ex = req.select("qid", F.posexplode("ids").alias("pos", "id"))
    a = _audit(spark, sf_dir).select("id", F.md5("text").alias("text_md5"))
    return ex.join(a, "id", "inner").select("qid", "pos", "id", "text_md5").orderBy("qid", "pos")


def q_cosine_pairs(spark, sf_dir):
    v = _vectors(spark, sf_dir)
    a = v.select(F.col("id").alias("a_id"), F.col("embedding").alias("a"))
    b = v.select(F.col("id").alias("b_id"), F.col("embedding").alias("b"))
    j = a.join(b, b.b_id == a.a_id + 1)
    return j.select("a_id", "b_id", round_half_up(cosine("a", "b"), 6).alias("cosine"))


def q_cosine_matrix(spark, sf_dir):
    """FN10: every vector against the per-label centroid matrix."""
    v = _vectors(spark, sf_dir)
    cent = V.centroids(v, "primary_label").withColumnRenamed("primary_label", "proto")
    out = V.cosine_to_prototypes(v, cent)
    return out.select("id", "proto", round_half_up("cos", 6).alias("cos"))


def q_l2_normalize(spark, sf_dir):
    v = _vectors(spark, sf_dir)
    n = v.select("id", l2_normalize("embedding").alias("u"), l2_norm("embedding").alias("before"))
    return n.select("id", round_half_up("before", 6).alias("norm_before"),
                    round_half_up(l2_norm("u"), 6).alias("norm_after"),
                    round_half_up(F.col("u")[0], 6).alias("first"))


def q_embedding_checks(spark, sf_dir):
    """VA9/EM2: dimension and unit-norm checks over the vector table."""
    v = _vectors(spark, sf_dir)
    return v.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count(F.when(F.size("embedding") != VEC_DIM, F.lit(1))).alias("bad_dim"),
                 F.count(F.when(F.abs(l2_norm("embedding") - 1.0) >= 1e-5, F.lit(1))).alias("not_unit"))


def q_corpus_counts(spark, sf_dir):
    s = StandIn(spark, sf_dir)
    return s.corpus().agg(F.count(F.lit(1)).alias("corpus_rows")).select(
        "corpus_rows", s.vectors().select(F.count(F.lit(1))).scalar().alias("vector_rows"))


def reindex_input(spark, sf_dir):
    """Re-index input rows (text, primary, labels, lang, source, timestamp) from the corpus.

    Timestamps are derived from the key: some rows have none (null or
    empty text), which the ``since`` filter keeps.
    """
    c = StandIn(spark, sf_dir).corpus()
    ts = (F.when(F.col("id") % 7 == 0, F.lit(None).cast("string"))
           .when(F.col("id") % 7 == 1, F.lit(""))
           .otherwise(F.date_format(F.timestamp_add("MINUTE", F.col("id"), F.lit("2024-01-01 00:00:00")
                                                    .cast("timestamp")), "yyyy-MM-dd'T'HH:mm:ss")))
    return c.select("id", "text", F.col("primary_label").alias("primary"), "labels", "lang", "source",
                    ts.alias("timestamp"))


def since_filter(df, since: str, ts: str = "timestamp"):
    """PF16: keep rows without a timestamp (null/empty) or with ts >= since."""
    t = F.col(ts)
    return df.where(t.isNull() | (t == "") |
                    (F.to_timestamp(t) >= F.to_timestamp(F.lit(since))))


def payload_defaults(df):
    """PF17: defaults for absent payload values."""
    return df.select(
        "id",
        F.coalesce("primary", F.lit(DEFAULT_PRIMARY)).alias("primary"),
        F.coalesce("primary", F.lit(DEFAULT_PRIMARY)).alias("primary_label"),
        F.coalesce("labels", F.array().cast("array<string>")).alias("labels"),
        F.coalesce("lang", F.lit(DEFAULT_LANG)).alias("lang"),
        F.coalesce("source", F.lit(DEFAULT_SOURCE)).alias("source"),
        *[c for c in df.columns if c in ("text", "embedding")])


def q_reindex_since(spark, sf_dir):
    r = since_filter(reindex_input(spark, sf_dir), REINDEX_SINCE)
    return r.select("id", "timestamp")


def q_payload_defaults(spark, sf_dir):
    p = payload_defaults(reindex_input(spark, sf_dir))
    return p.select("id", "primary", "primary_label", F.concat_ws(";", "labels").alias("labels"),
                    "lang", "source")


def q_reindex_upsert(spark, sf_dir):
    """SK8: an index loaded in three batches of growing size, then an upsert of updated + new points."""
    from ..operators.sinks import read_upserted, upsert_table
    from ..session import scratch_path
    old = _vectors(spark, sf_dir).select("id", "primary_label", "lang")
    path = scratch_path(spark, "upsert_index")
    share = F.pmod(F.xxhash64("id"), F.lit(100))
    for batch in (share < 1, (share >= 1) & (share < 20), share >= 20):
        upsert_table(spark, old.where(batch), path)
    upd = old.where(F.col("id") % 4 == 0).withColumn("primary_label", F.lit("updated"))
    ins = old.where(F.col("id") % 4 == 1).withColumn("id", F.col("id") + 1_000_000)
    upsert_table(spark, upd.unionByName(ins), path)
    return read_upserted(spark, path).select("id", "primary_label", "lang")


def q_embed_documents(spark, sf_dir):
    """EM1: embed the whole corpus text; report shape/norm checks per language."""
    docs = StandIn(spark, sf_dir).corpus().select(F.col("id").alias("doc_id"), "text", "lang")
    e = V.embed(docs, "text", dim=V.DEFAULT_DIM)
    return e.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.size("embedding") == V.DEFAULT_DIM, F.lit(1))).alias("dim_ok"),
        F.count(F.when(F.abs(l2_norm("embedding") - 1.0) < 1e-5, F.lit(1))).alias("unit_ok"))


def q_embed_edge_cases(spark, sf_dir):
    """EM3: every conversation turn (blank, symbols, any script) maps to a unit vector."""
    conv = StandIn(spark, sf_dir).raw.conversations.select("conv_id", "turn", "text")
    e = V.embed(conv, "text")
    return e.agg(F.count(F.lit(1)).alias("n"),
                 F.count(F.when(F.abs(l2_norm("embedding") - 1.0) < 1e-5, F.lit(1))).alias("unit_ok"),
                 F.count(F.when(F.size("embedding") == V.DEFAULT_DIM, F.lit(1))).alias("dim_ok"))


def reindex_job(spark, rows, path: str, since: str | None = None, limit: int | None = None, dry_run: bool = False) -> int:
    """VS5: since filter -> limit -> embed -> payload defaults -> upsert; the number
    of points. A dry run counts the points, and embeds and writes nothing."""
    from ..operators.sinks import upsert_table
    chosen = since_filter(rows, since) if since else rows
    if limit is not None:
        chosen = chosen.orderBy("id").limit(limit)
    if dry_run:
        return chosen.select("id").distinct().count()
    return upsert_table(spark, payload_defaults(V.embed(chosen, "text")), path)


def q_reindex(spark, sf_dir):
    """VS5: the re-index job over the whole corpus; points by language."""
    from ..operators.sinks import read_upserted
    from ..session import scratch_path
    path = scratch_path(spark, "vector_index")
    reindex_job(spark, reindex_input(spark, sf_dir), path, REINDEX_SINCE)
    return read_upserted(spark, path).groupBy("lang").agg(F.count(F.lit(1)).alias("points"))


def q_reindex_dry_run(spark, sf_dir):
    """VS5: points that the job would write, of all rows and of the first 100."""
    rows = reindex_input(spark, sf_dir)
    counts = [reindex_job(spark, rows, "", REINDEX_SINCE, limit, dry_run=True) for limit in (None, 100)]
    return spark.createDataFrame([tuple(counts)], "points long, limited long")


def q_reindex_points(spark, sf_dir):
    """VS5: the stored points of a limited re-index, with their payload."""
    from ..operators.sinks import read_upserted
    from ..session import scratch_path
    path = scratch_path(spark, "vector_index")
    reindex_job(spark, reindex_input(spark, sf_dir), path, REINDEX_SINCE, limit=100)
    return read_upserted(spark, path).select("id", "primary", "primary_label", F.concat_ws(";", "labels").alias("labels"), "lang", "source",
                                             F.md5("text").alias("text_md5"), F.size("embedding").alias("dim"))


def q_knn_ivf(spark, sf_dir):
    """VS2: top-k by product codes; its share of the exact search's hits, and of the pairs scored exactly."""
    vec = _vectors(spark, sf_dir)
    queries, corpus = _queries(vec), vec.where((F.col("lang") == "en") & ~F.col("primary_label").eqNullSafe("neutral"))
    rerank = V.RERANK * K
    found = V.recall_at_k(V.knn_ivf(queries, corpus, K, rerank=rerank, exclude_self=True), _knn(spark, sf_dir))
    return found.select("exact_hits", (F.col("recall") >= 0.9).alias("recall_reached"),
                        (F.least(F.lit(rerank), corpus.select(F.count(F.lit(1))).scalar())
                         <= 0.2 * corpus.select(F.count(F.lit(1))).scalar()).alias("few_scored"))


QUERIES = {
    "knn_search": q_knn_search,
    "search_audit_join": q_search_audit_join,
    "hybrid_search": q_hybrid_search,
    "knn_label": q_knn_label,
    "fetch_by_ids": q_fetch_by_ids,
    "cosine_pairs": q_cosine_pairs,
    "cosine_matrix": q_cosine_matrix,
    "l2_normalize": q_l2_normalize,
    "embedding_checks": q_embedding_checks,
    "corpus_counts": q_corpus_counts,
    "reindex_since": q_reindex_since,
    "payload_defaults": q_payload_defaults,
    "reindex_upsert": q_reindex_upsert,
    "embed_documents": q_embed_documents,
    "embed_edge_cases": q_embed_edge_cases,
    "reindex": q_reindex,
    "reindex_dry_run": q_reindex_dry_run,
    "reindex_points": q_reindex_points,
    "knn_ivf": q_knn_ivf,
}

# ---------------------------------------------------------------------------------------
# Oracle SQL
# ---------------------------------------------------------------------------------------

_D = "CAST({x} AS DOUBLE[])"


def _cos(a, b):
    da, db = _D.format(x=a), _D.format(x=b)
    return (f"(list_dot_product({da}, {db}) / (greatest(sqrt(list_dot_product({da}, {da})), 1e-12)"
            f" * greatest(sqrt(list_dot_product({db}, {db})), 1e-12)))")


_Q = ("q", """SELECT id AS qid, embedding, lang AS q_lang, (id % 2 = 0) AS q_exclude_neutral,
                     CAST(id % 5 + 1 AS INTEGER) AS top_k FROM vectors WHERE id % 20 = 0""")
_HITS = ("hits", f"""
    SELECT qid, id, score, CAST(rank AS INTEGER) AS rank FROM (
      SELECT q.qid, c.id, {_cos('q.embedding', 'c.embedding')} AS score,
             row_number() OVER (PARTITION BY q.qid ORDER BY {_cos('q.embedding', 'c.embedding')} DESC, c.id) AS rank
      FROM q JOIN vectors c ON c.lang = 'en' AND c.primary_label IS DISTINCT FROM 'neutral' AND c.id <> q.qid) t
    WHERE rank <= {K}""")
_AUDIT = ("audit", "SELECT * FROM corpus WHERE primary_label IS NOT NULL")


def _audit_sql(hits):
    return f"""
    SELECT h.qid, h.rank, h.id, {rnd('h.score', 6)} AS score,
           md5(coalesce(a.text, d.text, '')) AS text_md5,
           coalesce(a.primary_label, p.primary_label, 'unknown') AS primary,
           array_to_string(coalesce(a.labels, d.labels, []), ';') AS labels,
           coalesce(a.lang, p.lang, '') AS lang, coalesce(a.source, d.source, '') AS source
    FROM {hits} h LEFT JOIN audit a ON h.id = a.id LEFT JOIN vectors p ON h.id = p.id LEFT JOIN corpus d ON h.id = d.id"""


_HHITS = ("hh", f"""
    SELECT qid, id, score, CAST(rank AS INTEGER) AS rank FROM (
      SELECT q.qid, q.top_k, c.id, {_cos('q.embedding', 'c.embedding')} AS score,
             row_number() OVER (PARTITION BY q.qid ORDER BY {_cos('q.embedding', 'c.embedding')} DESC, c.id) AS rank
      FROM q JOIN vectors c ON (q.q_lang IS NULL OR c.lang = q.q_lang)
                           AND (NOT q.q_exclude_neutral OR c.primary_label IS DISTINCT FROM 'neutral')
                           AND c.id <> q.qid) t
    WHERE rank <= top_k""")
_TS = """CASE WHEN id % 7 = 0 THEN NULL WHEN id % 7 = 1 THEN ''
              ELSE strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(id), '%Y-%m-%dT%H:%M:%S') END"""

ORACLES = {
    "knn_search": with_views(f"SELECT qid, id, rank, {rnd('score', 6)} AS score FROM hits",
                             ("vectors",), (_Q, _HITS)),
    "search_audit_join": with_views(_audit_sql("hits"), ("vectors", "corpus"), (_Q, _HITS, _AUDIT)),
    "hybrid_search": with_views(_audit_sql("hh"), ("vectors", "corpus"), (_Q, _HHITS, _AUDIT)),
    "knn_label": with_views(f"""
        SELECT q.qid, h.id AS matched_id, p.primary_label AS label, {rnd('h.score', 6)} AS score
        FROM q LEFT JOIN (SELECT * FROM hits WHERE rank = 1) h ON h.qid = q.qid
        LEFT JOIN vectors p ON p.id = h.id""", ("vectors",), (_Q, _HITS)),
    "knn_ivf": with_views("""
        SELECT count(*) AS exact_hits, true AS recall_reached,
               (SELECT count(*) >= 50 / 0.2 FROM vectors WHERE lang = 'en' AND primary_label IS DISTINCT FROM 'neutral') AS few_scored
        FROM hits""", ("vectors",), (_Q, _HITS)),
    "fetch_by_ids": with_views("""
        SELECT h.qid, CAST(h.rank - 1 AS INTEGER) AS pos, h.id, md5(a.text) AS text_md5
        FROM hits h JOIN audit a ON a.id = h.id ORDER BY h.qid, pos""",
        ("vectors", "corpus"), (_Q, _HITS, _AUDIT)),
    "cosine_pairs": with_views(f"""
        SELECT a.id AS a_id, b.id AS b_id,
               {rnd(f"CASE WHEN list_dot_product({_D.format(x='a.embedding')}, {_D.format(x='a.embedding')}) = 0 "
                    f"OR list_dot_product({_D.format(x='b.embedding')}, {_D.format(x='b.embedding')}) = 0 THEN 0.0 "
                    f"ELSE list_dot_product({_D.format(x='a.embedding')}, {_D.format(x='b.embedding')}) / "
                    f"(sqrt(list_dot_product({_D.format(x='a.embedding')}, {_D.format(x='a.embedding')})) * "
                    f"sqrt(list_dot_product({_D.format(x='b.embedding')}, {_D.format(x='b.embedding')}))) END", 6)}
               AS cosine
        FROM vectors a JOIN vectors b ON b.id = a.id + 1""", ("vectors",)),
    "cosine_matrix": with_views(f"""
        SELECT v.id, c.proto, {rnd(_cos('v.embedding', 'c.vec'), 6)} AS cos
        FROM vectors v CROSS JOIN (
          SELECT proto, list(m ORDER BY i) AS vec FROM (
            SELECT primary_label AS proto, i, avg(CAST(embedding[i] AS DOUBLE)) AS m
            FROM vectors, range(1, {VEC_DIM} + 1) r(i) GROUP BY primary_label, i) t
          GROUP BY proto) c""", ("vectors",)),
    "l2_normalize": with_views(f"""
        SELECT id, {rnd('n', 6)} AS norm_before,
               {rnd('sqrt(list_sum(list_transform(u, lambda x: x * x)))', 6)} AS norm_after,
               {rnd('u[1]', 6)} AS first
        FROM (SELECT id, n, list_transform({_D.format(x='embedding')}, lambda x: x / greatest(n, 1e-12)) AS u
              FROM (SELECT id, embedding, sqrt(list_sum(list_transform({_D.format(x='embedding')},
                           lambda x: x * x))) AS n FROM vectors) s) t""", ("vectors",)),
    "embedding_checks": with_views(f"""
        SELECT count(*) AS n_rows, count(*) FILTER (WHERE len(embedding) <> {VEC_DIM}) AS bad_dim,
               count(*) FILTER (WHERE abs(sqrt(list_sum(list_transform({_D.format(x='embedding')},
                                     lambda x: x * x))) - 1.0) >= 1e-5) AS not_unit
        FROM vectors""", ("vectors",)),
    "corpus_counts": with_views(
        "SELECT (SELECT count(*) FROM corpus) AS corpus_rows, (SELECT count(*) FROM vectors) AS vector_rows",
        ("corpus", "vectors")),
    "reindex_since": f"""
        SELECT id, ts AS timestamp FROM (SELECT doc_id AS id, {_TS} AS ts FROM documents) t
        WHERE ts IS NULL OR ts = '' OR CAST(ts AS TIMESTAMP) >= TIMESTAMP '{REINDEX_SINCE.replace('T', ' ')}'""",
    "payload_defaults": with_views("""
        SELECT id, coalesce(primary_label, 'neutral') AS primary, coalesce(primary_label, 'neutral') AS primary_label,
               array_to_string(coalesce(labels, []), ';') AS labels, coalesce(lang, 'en') AS lang,
               coalesce(source, 'instructor_indexer') AS source FROM corpus""", ("corpus",)),
    "reindex_upsert": with_views("""
        SELECT id, 'updated' AS primary_label, lang FROM vectors WHERE id % 4 = 0
        UNION ALL SELECT id + 1000000, primary_label, lang FROM vectors WHERE id % 4 = 1
        UNION ALL SELECT id, primary_label, lang FROM vectors WHERE id % 4 <> 0""", ("vectors",)),
    # invariant oracles: every text embeds to a unit vector of the model dimension
    "embed_documents": """
        SELECT lang, count(*) AS n, count(*) AS dim_ok, count(*) AS unit_ok
        FROM documents GROUP BY lang""",
    "embed_edge_cases": """
        SELECT count(*) AS n, count(*) AS unit_ok, count(*) AS dim_ok FROM conversations""",
    "reindex_dry_run": f"""
        SELECT count(*) AS points, least(count(*), 100) AS limited FROM (SELECT {_TS} AS ts FROM (SELECT doc_id AS id FROM documents) d) t
        WHERE ts IS NULL OR ts = '' OR CAST(ts AS TIMESTAMP) >= TIMESTAMP '{REINDEX_SINCE.replace('T', ' ')}'""",
    "reindex_points": with_views(f"""
        SELECT id, coalesce(primary_label, 'neutral') AS primary, coalesce(primary_label, 'neutral') AS primary_label,
               array_to_string(coalesce(labels, []), ';') AS labels, coalesce(lang, 'en') AS lang,
               coalesce(source, 'instructor_indexer') AS source, md5(text) AS text_md5, CAST(384 AS INTEGER) AS dim
        FROM (SELECT *, {_TS} AS ts FROM corpus) t
        WHERE ts IS NULL OR ts = '' OR CAST(ts AS TIMESTAMP) >= TIMESTAMP '{REINDEX_SINCE.replace('T', ' ')}'
        ORDER BY id LIMIT 100""", ("corpus",)),
    "reindex": f"""
        SELECT coalesce(lang, 'en') AS lang, count(*) AS points
        FROM (SELECT doc_id AS id, lang, {_TS} AS ts FROM documents) t
        WHERE ts IS NULL OR ts = '' OR CAST(ts AS TIMESTAMP) >= TIMESTAMP '{REINDEX_SINCE.replace('T', ' ')}'
        GROUP BY 1""",
}

