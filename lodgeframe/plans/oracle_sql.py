"""DuckDB SQL twins of the stand-in views, for the independent oracle.

Every oracle query is ``WITH <views it needs>, <its own CTEs> SELECT ...``
over the raw Parquet tables the checker pre-registers.  The view rules
mirror ``lodgeframe.sources.standin`` and are written independently.
"""

from __future__ import annotations

VIEW_SQL: dict[str, str] = {
    "listing": """
        SELECT c_custkey AS listing_id,
               c_custkey % 100 AS host_id,
               c_nationkey AS neighbourhood_id,
               c_mktsegment AS room_type,
               CASE c_custkey % 4 WHEN 0 THEN 'Entire rental unit'
                                  WHEN 1 THEN 'Private room in home'
                                  WHEN 2 THEN 'Entire condo' END AS property_type,
               CAST(1 + c_custkey % 6 AS INTEGER) AS accommodates,
               CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE CAST(c_custkey % 4 AS DOUBLE) END AS bedrooms,
               CAST(1 + c_custkey % 5 AS DOUBLE) AS beds,
               CASE c_custkey % 8 WHEN 0 THEN '1 bath' WHEN 1 THEN '1.5 shared baths'
                                  WHEN 2 THEN 'Half-bath' WHEN 3 THEN 'Shared half-bath'
                                  WHEN 4 THEN '' WHEN 5 THEN NULL WHEN 6 THEN 'unknown'
                                  ELSE '2 baths' END AS bathrooms_text,
               CAST(c_acctbal AS DECIMAL(12,2)) AS listing_price,
               CAST(1 + c_custkey % 7 AS INTEGER) AS minimum_nights,
               CAST(30 + c_custkey % 335 AS INTEGER) AS maximum_nights,
               (c_custkey % 3 = 0) AS instant_bookable,
               'LIC-' || CAST(c_custkey AS VARCHAR) AS license
        FROM customer""",
    "neighbourhood": "SELECT n_nationkey AS neighbourhood_id, n_name AS name FROM nation",
    "segment": """
        SELECT n_name AS neighbourhood, lower(r_name) AS tourism_segment,
               CASE n_regionkey % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END
                 AS priority_level
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "host": """
        SELECT s_suppkey AS host_id, s_name AS host_pseudo_id, (s_acctbal > 5000) AS is_superhost
        FROM supplier""",
    "review": """
        SELECT o_orderkey AS review_id, o_custkey AS listing_id,
               o_orderkey % 501 AS reviewer_id,
               'R-' || CAST(o_orderkey % 501 AS VARCHAR) AS reviewer_pseudo_id,
               CAST(o_orderdate AS DATE) AS review_date,
               CAST(floor(o_totalprice / 1000) AS INTEGER) AS comment_len
        FROM orders""",
    "calendar_day": """
        SELECT o_custkey AS listing_id,
               CAST(l_shipdate AS DATE) AS date,
               CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN NULL
                    ELSE l_returnflag = 'N' END AS available,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
               CASE WHEN l_discount > 0.05 THEN NULL
                    ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS adjusted_price,
               CAST(floor(l_quantity) AS INTEGER) AS minimum_nights,
               CAST(l_linenumber * 30 AS INTEGER) AS maximum_nights
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "listings_flat": """
        SELECT c_custkey AS listing_id, n_name AS neighbourhood,
               CAST(floor(c_acctbal) AS BIGINT) AS price,
               1 + c_custkey % 7 AS minimum_nights,
               c_custkey % 366 AS availability_365,
               c_custkey % 50 AS number_of_reviews,
               c_custkey % 100 AS host_id,
               c_name AS host_name
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "corpus": """
        SELECT d.doc_id AS id, d.text,
               CASE WHEN l.toxic = 1 THEN 'toxic' WHEN l.quality = 1 THEN 'good'
                    WHEN l.doc_id IS NOT NULL THEN 'neutral' END AS primary_label,
               list_filter([CASE WHEN l.toxic = 1 THEN 'toxic' END,
                            CASE WHEN l.quality = 1 THEN 'good' END], lambda x: x IS NOT NULL) AS labels,
               d.lang, d.source
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "vectors": """
        SELECT vec_id AS id, embedding,
               CASE WHEN label = 0 THEN 'neutral' ELSE CAST(label AS VARCHAR) END AS primary_label,
               CASE WHEN vec_id % 4 = 3 THEN 'fr' ELSE 'en' END AS lang
        FROM embeddings""",
    "scores": """
        SELECT event_id AS key, user_id AS grp, value / 500.0 AS score,
               CAST(event_type IN ('purchase', 'signup') AS INTEGER) AS label
        FROM events""",
}

ROUND = "CAST(round(CAST({x} AS DECIMAL(18,8)), {d}) AS DOUBLE)"


def rnd(x: str, d: int) -> str:
    """Half-up rounding through DECIMAL(18,8), as ``round_half_up``."""
    return ROUND.format(x=x, d=d)


def avg_exact(x: str) -> str:
    return f"CAST(sum({x}) AS DOUBLE) / CAST(count({x}) AS DOUBLE)"


def with_views(body: str, views=(), ctes=()) -> str:
    """Prefix ``body`` with the view CTEs it needs and its own CTEs."""
    parts = [f"{v} AS ({VIEW_SQL[v]})" for v in views]
    parts += [f"{name} AS ({sql})" for name, sql in ctes]
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body
