"""Registered sink / source / streaming / manifest queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import l2_norm, round_half_up
from ..operators import evaluate as EV
from ..operators import features as FE
from ..operators import reports as R
from ..operators import runs as RU
from ..operators import sinks as K
from ..session import scratch_path
from ..sources import files as FS
from ..sources.standin import StandIn
from ..sources.tables import read_table, table_path
from ..streaming import incremental as ST
from ..streaming import listing_state as LS
from .feature_plans import _Ctx
from .oracle_sql import avg_exact, rnd, with_views


def q_feature_set_roundtrip(spark, sf_dir):
    """SK2 + SC2: feature set to Parquet and CSV, read back (Parquet preferred)."""
    ctx = _Ctx(spark, sf_dir)
    clean, _ = FE.drop_unusable_columns(ctx.staged_features())
    base = scratch_path(spark, "feature_set")
    K.write_feature_set(clean, base)
    return K.read_feature_set(spark, base)


def q_scan_feature_set(spark, sf_dir):
    """SC2 fallback branch: only the CSV copy exists -> read CSV with the schema."""
    ctx = _Ctx(spark, sf_dir)
    clean, _ = FE.drop_unusable_columns(ctx.staged_features())
    base = scratch_path(spark, "feature_set_csv_only")
    clean.write.mode("overwrite").option("header", True).csv(f"{base}/csv")
    return K.read_feature_set(spark, base, schema=clean.schema)


def q_dataset_metadata(spark, sf_dir):
    ctx = _Ctx(spark, sf_dir)
    clean, _ = FE.drop_unusable_columns(ctx.staged_features())
    path = scratch_path(spark, "metadata_json")
    K.write_json_rows(R.dataset_metadata(clean, ctx.window), path)
    return spark.read.json(path)


def q_validation_report(spark, sf_dir):
    ctx = _Ctx(spark, sf_dir)
    clean, dropped = FE.drop_unusable_columns(ctx.staged_features())
    path = scratch_path(spark, "validation_json")
    K.write_json_rows(R.validation_report(clean, dropped), path)
    return spark.read.json(path)


def q_pii_audit(spark, sf_dir):
    """VA7 + SK5: policy vs actual columns, written as CSV and read back."""
    ctx = _Ctx(spark, sf_dir)
    v = ctx.v
    sources = {"listing": v.listing(), "host": v.host(), "review": v.review(),
               "neighbourhood": v.neighbourhood(), "calendar_day": ctx.cal}
    clean, _ = FE.drop_unusable_columns(ctx.staged_features())
    audit = R.pii_audit(spark, sources, {"feature_set": clean})
    path = scratch_path(spark, "pii_audit_csv")
    K.write_csv(audit, path, single_file=True)
    return spark.read.schema(audit.schema).option("header", True).csv(path)


def q_run_artifacts(spark, sf_dir):
    """SK9: evaluation artefacts of a run (report, confusion matrix, features)."""
    s = StandIn(spark, sf_dir).scores()
    return R.run_artifacts(EV.classification_report(s), EV.confusion_matrix(s),
                           "v4_balanced_logistic_threshold_0.50", ["score"])


def q_run_artifact_files(spark, sf_dir):
    """SK9: a run's artefacts written as files; the confusion matrix and feature list read back."""
    ctx = _Ctx(spark, sf_dir)
    s = ctx.v.scores()
    folder = RU.write_artifacts(EV.classification_report(s), EV.confusion_matrix(s), ["score"],
                                R.dataset_metadata(ctx.features(), ctx.window), "v4 balanced/threshold 0.50", scratch_path(spark, "artifacts"))
    features = spark.read.json(f"{folder}/feature_columns.json").select(F.concat_ws(",", "feature_columns")).scalar()
    return (spark.read.schema("y int, yhat int, n long").json(f"{folder}/confusion_matrix.json")
            .select(F.lit(folder.rsplit("/", 1)[1]).alias("artifact_name"), features.alias("features"), "y", "yhat", "n"))


def q_scan_json(spark, sf_dir):
    """SC4: re-index input written as JSON lines and read back with the corpus schema."""
    from .vector_plans import reindex_input
    inp = reindex_input(spark, sf_dir).drop("id")
    path = scratch_path(spark, "corpus_json")
    inp.write.mode("overwrite").json(path)
    return FS.read_json_corpus(spark, path).select(
        "primary", "lang", "source", "timestamp", F.length("text").alias("text_chars"))


def q_scan_json_list(spark, sf_dir):
    """SC4: the re-index input written as JSON lists and read back in byte ranges that cut through elements."""
    from ..sources.json_list import read_json_list, write_json_lists
    from .vector_plans import reindex_input
    path = scratch_path(spark, "corpus_json_lists")
    write_json_lists(reindex_input(spark, sf_dir).drop("id").coalesce(4), path)
    return read_json_list(spark, path, FS.CORPUS_SCHEMA, range_bytes=8 << 20).select(
        "primary", "lang", "source", "timestamp", F.length("text").alias("text_chars"), F.md5("text").alias("text_md5"))


def q_scan_sidecar(spark, sf_dir):
    """SC5: a JSON sidecar read with its schema; an absent sidecar gives an empty frame."""
    ctx = _Ctx(spark, sf_dir)
    meta = R.dataset_metadata(ctx.features(), ctx.window)
    path = scratch_path(spark, "sidecar_json")
    K.write_json_rows(meta, path)
    present = K.read_json_sidecar(spark, path, meta.schema)
    absent = K.read_json_sidecar(spark, path + "_absent", meta.schema)
    return present.unionByName(absent).select("dataset_version", "cutoff_date",
                                              F.size("model_input_columns").alias("n_inputs"))


def q_file_manifest(spark, sf_dir):
    """VA10: sha256 of every data file of the directory."""
    return FS.file_manifest(spark, sf_dir, "*.parquet")


def q_manifest_verify(spark, sf_dir):
    """VA11: the manifest written as JSON, then verified against the files."""
    m = FS.file_manifest(spark, sf_dir, "*.parquet")
    path = scratch_path(spark, "manifest_json")
    m.write.mode("overwrite").json(path)
    return FS.verify_bundle(spark, sf_dir, path, "*.parquet")


def q_stream_daily_counts(spark, sf_dir):
    """ST2: streaming daily counts per event type; the watermark spans the table, so no row is late."""
    ev = read_table(spark, sf_dir, "events")
    out = ST.daily_event_counts(spark, table_path(sf_dir, "events"), ev.schema, watermark=ST.span_watermark(ev, "ts"),
                                max_files_per_trigger=None)
    return out.select("day", "event_type", "n", round_half_up("total", 4).alias("total"))


def q_stream_reindex(spark, sf_dir):
    """ST1: streaming embed + upsert of the documents into a vector index."""
    docs = read_table(spark, sf_dir, "documents")
    idx = ST.stream_reindex(spark, table_path(sf_dir, "documents"), docs.schema)
    return idx.groupBy("lang").agg(F.count(F.lit(1)).alias("points"))


def q_stream_listing_measures(spark, sf_dir):
    """ST2: listing rates and review counts maintained by streams over the calendar and review files."""
    v = StandIn(spark, sf_dir)
    cal, rev = v.calendar_day(), v.review()
    low, high = cal.agg(F.min("date"), F.max("date")).first()
    first, last = rev.agg(F.min("review_date"), F.max("review_date")).first()
    # allowed delay: the longer time span of the two tables, so no stored row is late
    spans = [(b - a).days for a, b in ((low, high), (first, last)) if a is not None]
    where = LS.maintain(spark, v.stored_path("calendar_day"), v.stored_path("review"), cal.schema, rev.schema, max(spans, default=0) + 1)
    return LS.measures(spark, where).select(
        "listing_id", "availability_30_rate", round_half_up("avg_calendar_price_30", 4).alias("avg_calendar_price_30"),
        "availability_365_rate", "total_reviews")


def q_stream_reindex_points(spark, sf_dir):
    """ST1 + PF17: the streamed index's points with their payload defaults."""
    from .vector_plans import payload_defaults

    def payload(batch):
        absent = [F.lit(None).cast("string").alias("primary"), F.lit(None).cast("array<string>").alias("labels")]
        return payload_defaults(batch.select("*", *absent))

    docs = read_table(spark, sf_dir, "documents")
    idx = ST.stream_reindex(spark, table_path(sf_dir, "documents"), docs.schema, payload=payload)
    return idx.select("id", "primary", "primary_label", F.concat_ws(";", "labels").alias("labels"), "lang", "source",
                      F.size("embedding").alias("dim"), (F.abs(l2_norm("embedding") - 1.0) < 1e-5).alias("unit"))


QUERIES = {
    "feature_set_roundtrip": q_feature_set_roundtrip,
    "scan_feature_set": q_scan_feature_set,
    "dataset_metadata": q_dataset_metadata,
    "validation_report": q_validation_report,
    "run_artifacts": q_run_artifacts,
    "run_artifact_files": q_run_artifact_files,
    "scan_json": q_scan_json,
    "scan_json_list": q_scan_json_list,
    "file_manifest": q_file_manifest,
    "manifest_verify": q_manifest_verify,
    "stream_daily_counts": q_stream_daily_counts,
    "stream_reindex": q_stream_reindex,
    "stream_reindex_points": q_stream_reindex_points,
    "stream_listing_measures": q_stream_listing_measures,
}

_TS = """CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 7 = 1 THEN ''
              ELSE strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id), '%Y-%m-%dT%H:%M:%S') END"""

ORACLES = {
    "run_artifact_files": with_views("""
        SELECT 'v4_balanced_threshold_0.50' AS artifact_name, 'score' AS features, y, yhat,
               count(*) FILTER (WHERE (label = 1) = (y = 1) AND (score >= 0.5) = (yhat = 1)) AS n
        FROM scores, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) c(y, yhat) GROUP BY y, yhat""", ("scores",)),
    "scan_json_list": f"""
        SELECT CASE WHEN l.toxic = 1 THEN 'toxic' WHEN l.quality = 1 THEN 'good'
                    WHEN l.doc_id IS NOT NULL THEN 'neutral' END AS primary,
               d.lang, d.source, {_TS.replace('doc_id', 'd.doc_id')} AS timestamp,
               CAST(length(d.text) AS INTEGER) AS text_chars, md5(d.text) AS text_md5
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "scan_json": f"""
        SELECT CASE WHEN l.toxic = 1 THEN 'toxic' WHEN l.quality = 1 THEN 'good'
                    WHEN l.doc_id IS NOT NULL THEN 'neutral' END AS primary,
               d.lang, d.source, {_TS.replace('doc_id', 'd.doc_id')} AS timestamp,
               CAST(length(d.text) AS INTEGER) AS text_chars
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "stream_reindex": "SELECT lang, count(*) AS points FROM documents GROUP BY lang",
    "stream_reindex_points": """
        SELECT doc_id AS id, 'neutral' AS primary, 'neutral' AS primary_label, '' AS labels, coalesce(lang, 'en') AS lang,
               coalesce(source, 'instructor_indexer') AS source, CAST(384 AS INTEGER) AS dim, true AS unit FROM documents""",
    "stream_listing_measures": with_views(f"""
        SELECT coalesce(c.listing_id, r.listing_id) AS listing_id, c.first_rate AS availability_30_rate,
               {rnd('c.first_price', 4)} AS avg_calendar_price_30, c.rate AS availability_365_rate,
               coalesce(r.total_reviews, 0) AS total_reviews
        FROM c FULL JOIN r ON c.listing_id = r.listing_id""", ("calendar_day", "review"), (
        ("c", f"""
            SELECT listing_id, CAST(count(*) FILTER (WHERE available) AS DOUBLE) / count(*) AS rate,
                   CAST(count(*) FILTER (WHERE available AND first) AS DOUBLE) / nullif(count(*) FILTER (WHERE first), 0) AS first_rate,
                   {avg_exact('CASE WHEN first THEN price END')} AS first_price
            FROM (SELECT *, date < (SELECT min(date) FROM calendar_day) + INTERVAL 30 DAY AS first FROM calendar_day) d
            GROUP BY listing_id"""),
        ("r", "SELECT listing_id, count(*) AS total_reviews FROM review GROUP BY listing_id"))),
    "stream_daily_counts": """
        SELECT CAST(date_trunc('day', ts) AS DATE) AS day, event_type, count(*) AS n,
               CAST(round(CAST(sum(value) AS DECIMAL(18,8)), 4) AS DOUBLE) AS total
        FROM events GROUP BY 1, 2""",
}
