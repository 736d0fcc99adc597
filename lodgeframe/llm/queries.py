"""Registered queries of the training-data operators, and their oracle SQL.

Trained models, the approximate search, and the piece encoding have no SQL
twin; ``tests/llm`` holds them against brute force, exact round trips and
held-out labels.
"""

from __future__ import annotations

from lodgeframe.llm import (chat, cotrain, ctw, decontam, exact_copies, infill, jaccard_join, multi_index,
                            resampling, subwords, suffix_levels, toxicity, warc)

QUERIES = {
    "op1_chat_format": chat.op1_chat_format,
    "op2_sentencepiece": subwords.op2_sentencepiece,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_warc": warc.op4_warc,
    "op5_jaccard_join": jaccard_join.op5_jaccard_join,
    "op6_multi_index": multi_index.op6_multi_index,
    "op7_decontamination": decontam.op7_decontamination,
    "op8_quality": cotrain.op8_quality,
    "op9_suffix_dedup": suffix_levels.op9_suffix_dedup,
    "op10_language_model": ctw.op10_language_model,
    "op11_fill_in_middle": infill.op11_fill_in_middle,
    "op12_exact_dedup": exact_copies.op12_exact_dedup,
    "op13_importance_resampling": resampling.op13_importance_resampling,
}

_LOWER = "translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str, pattern: str) -> str:
    return f"regexp_extract_all({_LOWER.format(x=f'''coalesce({text}, '')''')}, '{pattern}')"


_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_NOT_SPACE = r"[^\x20\x09-\x0D]+"

ORACLES: dict[str, str] = {
    # every escaped control string adds one character
    "op1_chat_format": r"""
        WITH turns AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
          UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        sized AS (SELECT *, length(role) + length(text)
                         + len(regexp_extract_all(role, '[<\[]\\*(/?s>|/?INST\])'))
                         + len(regexp_extract_all(text, '[<\[]\\*(/?s>|/?INST\])')) AS chars FROM turns)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               CAST(length('<s>') + sum(chars + length('[INST][/INST]</s>')) AS BIGINT) AS formatted_chars
        FROM sized GROUP BY conv_id""",
    "op4_warc": """
        SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest,
               CASE WHEN strlen(body) >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN strlen(body) >= 1000 AND page_id <> top THEN top END AS refers_to
        FROM (SELECT page_id, coalesce(html, '') AS body,
                     max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages) t""",
    "op5_jaccard_join": f"""
        WITH RECURSIVE w AS (SELECT doc_id, {_words('text', _NOT_SPACE)} AS w FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(w) >= 4 THEN list_distinct([w[i:i+3] for i in range(1, len(w) - 2)])
                                  WHEN len(w) > 0 THEN [w] ELSE [] END AS s FROM w),
        e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
        links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
                  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
        reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
        SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles,
               least(s.doc_id, coalesce((SELECT min(b) FROM reach r WHERE r.a = s.doc_id), s.doc_id)) AS component_id
        FROM s""",
    "op7_decontamination": f"""
        WITH d AS (SELECT doc_id, {_words('text', _ALNUM)} AS w FROM documents),
        i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words('text', _ALNUM)} AS w FROM benchmark),
        iw AS (SELECT DISTINCT item, m, w[k:k+m-1] AS g
               FROM (SELECT item, w, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS k
                     FROM i WHERE len(w) > 0) t),
        dw AS (SELECT doc_id, k, m, w[k:k+m-1] AS g
               FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS k
                     FROM d, (SELECT DISTINCT m FROM iw) u WHERE len(w) >= m) t),
        hits AS (SELECT doc_id, k, m, item FROM dw JOIN iw USING (m, g)),
        covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
                    FROM (SELECT doc_id, unnest(range(k, k + m)) AS p FROM hits) t GROUP BY doc_id),
        found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                  FROM (SELECT DISTINCT doc_id, item FROM hits) t GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op9_suffix_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        parts AS (SELECT doc_id, i, substr(h, 2 * i + 1, 2398) AS c
                  FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2, 1000)) AS i FROM d) t),
        starts AS (SELECT doc_id, i + p AS p, hash(substr(c, 2 * p + 1, 400)) AS g
                   FROM (SELECT doc_id, i, c, unnest(range(0, least(1000, len(c) // 2 - 199))) AS p FROM parts) t),
        hit AS (SELECT doc_id, p FROM starts WHERE g IN (SELECT g FROM starts GROUP BY g HAVING count(*) > 1)),
        marked AS (SELECT doc_id, p, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY p) AS run
                   FROM (SELECT doc_id, p, coalesce(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 200, true) AS fresh
                         FROM hit) t),
        runs AS (SELECT doc_id, min(p) AS a, max(p) + 200 AS z FROM marked GROUP BY doc_id, run),
        cuts AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs),
        kept AS (SELECT c.doc_id, sum(z - a) AS n_removed, count(*) AS n_spans,
                        string_agg(h[2 * before + 1:2 * a], '' ORDER BY a) || any_value(h)[2 * max(z) + 1:] AS k
                 FROM cuts c JOIN d USING (doc_id) GROUP BY c.doc_id)
        SELECT d.doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
               coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(k, d.h))) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op11_fill_in_middle": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
                          regexp_extract_all(coalesce(text, ''),
                                             '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
        h AS (SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
                     CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
        s AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                     CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                               OR h3 % 100 >= 50 THEN 'plain'
                          WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM h),
        p AS (SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
                     array_to_string(u[b + 1:], '') AS e FROM s)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || e || '<M>' || m
                                ELSE '<S>' || e || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(text) AS restored_sha256 FROM p""",
    "op12_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
               count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents""",
    # CRC-32 from its polynomial: a table of the byte steps, folded over the bytes of each distinct run
    "op13_importance_resampling": f"""
        WITH steps AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)),
                         lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
        texts AS (SELECT 'd' AS kind, doc_id AS id, {_words('text', _ALNUM)} AS w FROM documents
                  UNION ALL SELECT 'b', 0, {_words('text', _ALNUM)} FROM benchmark),
        runs AS (SELECT kind, id, array_to_string(w[i:i + k - 1], ' ') AS g
                 FROM (SELECT kind, id, w, k, unnest(range(1, len(w) - k + 2)) AS i
                       FROM texts, (VALUES (1), (2), (3)) v(k)) r),
        counted AS (SELECT kind, id, g, count(*) AS n FROM runs GROUP BY ALL),
        codes AS (SELECT g, list_reduce(list_prepend(4294967295,
                              [CAST('0x' || hex(encode(g))[2 * i + 1:2 * i + 2] AS BIGINT) for i in range(strlen(g))]),
                              lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])) AS c
                  FROM (SELECT DISTINCT g FROM counted) u, steps),
        hashed AS (SELECT kind, id, xor(c, 4294967295) % 10000 AS bucket, sum(n) AS n FROM counted JOIN codes USING (g) GROUP BY ALL),
        sums AS (SELECT bucket, coalesce(sum(n) FILTER (WHERE kind = 'd'), 0) AS s, coalesce(sum(n) FILTER (WHERE kind = 'b'), 0) AS t
                 FROM hashed GROUP BY bucket),
        totals AS (SELECT coalesce(sum(s), 0) AS ss, coalesce(sum(t), 0) AS tt FROM sums),
        gains AS (SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (ss + 10000) AS DOUBLE)
                                                      / CAST((s + 1) * (tt + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM sums, totals),
        weights AS (SELECT id, sum(n) AS n_features, sum(n * gain) AS weight FROM hashed JOIN gains USING (bucket)
                    WHERE kind = 'd' GROUP BY id),
        scored AS (SELECT doc_id, len(w) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features,
                          CAST(coalesce(weight, 0) AS BIGINT) AS weight,
                          CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || sha256('42:' || doc_id)[1:8] AS BIGINT)
                               + CAST(0.5 AS DOUBLE)) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
                   FROM documents JOIN texts ON kind = 'd' AND id = doc_id LEFT JOIN weights ON weights.id = doc_id)
        SELECT doc_id, n_features, weight, score,
               CASE WHEN n_words >= 20 AND place <= (SELECT count(*) FROM scored WHERE n_words >= 20) * 5 // 100 THEN place END AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place FROM scored) p""",
}
