"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP9 = f"""
WITH t AS (SELECT doc_id, {_LOWER} AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM t WINDOW same AS (PARTITION BY norm)
"""

_OP10 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS w
           FROM embeddings
           WHERE embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.w, c.w) AS BIGINT) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
             vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

# base32 of the SHA-1: five hex digits are 20 bits, four letters.
_OP7 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
w AS (SELECT *, max(page_id) OVER (PARTITION BY t) AS kept FROM p)
SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + CAST((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS BIGINT)
                   // [32768, 1024, 32, 1][i % 4 + 1]) % 32 AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> kept THEN kept END AS refers_to
FROM w
"""

_OP12 = """
WITH d AS (SELECT doc_id, row_number() OVER () AS r, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
w AS (SELECT r, coalesce(doc_id, -9223372036854775808) AS k, p, substr(h, 2 * p + 1, 100) AS s
      FROM (SELECT r, doc_id, h, unnest(range(0, greatest(len(h) // 2 - 49, 0))) AS p FROM d)),
g AS (SELECT r, p FROM (SELECT r, p, k, min(k) OVER (PARTITION BY s) AS least FROM w) WHERE least < k),
b AS (SELECT r, p, CASE WHEN p <= lag(p) OVER (PARTITION BY r ORDER BY p) + 50 THEN 0 ELSE 1 END AS new FROM g),
c AS (SELECT r, p, sum(new) OVER (PARTITION BY r ORDER BY p) AS span FROM b),
s AS (SELECT r, span, min(p) AS a, max(p) + 50 AS z FROM c GROUP BY r, span),
e AS (SELECT r, a, z, lag(z, 1, 0) OVER (PARTITION BY r ORDER BY a) AS before FROM s),
t AS (SELECT e.r, sum(z - a) AS n_removed, count(*) AS n_spans, max(z) AS last,
             string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS pre
      FROM e JOIN d USING (r) GROUP BY e.r)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(pre || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM d LEFT JOIN t USING (r)
"""

_OP13 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w,
             list_transform([1, 9, 17, 25], lambda i: CAST('0x' || h[i:i + 7] AS BIGINT)) AS r FROM d),
c AS (SELECT doc_id, t, w, len(w) AS n,
             least(r[1] % (len(w) + 1), r[2] % (len(w) + 1)) AS a, greatest(r[1] % (len(w) + 1), r[2] % (len(w) + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 50
                  THEN 'plain' WHEN r[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT doc_id, n, form, t, array_to_string(w[1:a], '') AS pre, array_to_string(w[a + 1:b], '') AS mid,
             array_to_string(w[b + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


def oracle_sql() -> dict[str, str]:
    return {"op7_warc": _OP7, "op9_exact_dedup": _OP9, "op10_top_k": _OP10, "op12_passages": _OP12,
            "op13_fill_in_middle": _OP13}
