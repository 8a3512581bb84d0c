"""The registered queries of this subpackage and, where SQL can express them, their DuckDB equivalents."""

from __future__ import annotations

from . import divergence, license_scan, resampling
from .byte_bpe import op7_byte_bpe
from .class_lm import op9_class_lm
from .code_search import op8_exact_top_k
from .decontamination import op4_benchmark_decontamination
from .divergence import op12_source_divergence
from .language_id import op1_language_id
from .license_scan import op10_license_scan
from .line_dedup import op2_line_dedup
from .near_dedup import op3_minhash_near_dedup
from .piece_bpe import op13_sentencepiece
from .resampling import op11_importance_resampling
from .secret_scan import op5_secret_scan
from .token_counts import op6_token_counts

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_line_dedup": op2_line_dedup,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_secret_scan": op5_secret_scan,
    "op6_token_counts": op6_token_counts,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_exact_top_k": op8_exact_top_k,
    "op9_class_lm": op9_class_lm,
    "op10_license_scan": op10_license_scan,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_source_divergence": op12_source_divergence,
    "op13_sentencepiece": op13_sentencepiece,
}

ORACLE_SQL = {
    "op3_minhash_near_dedup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.a),
m AS (SELECT a, min(c) AS c FROM r GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM documents d JOIN m ON m.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
""",
    "op4_benchmark_decontamination": r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
i AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, n, array_to_string(ws[p:p + n - 1], ' ') AS g
  FROM (SELECT item_id, ws, least(13, len(ws)) AS n, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS p FROM i WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT n FROM win),
dg AS (SELECT doc_id, n, p, array_to_string(ws[p:p + n - 1], ' ') AS g
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS p FROM d, lens WHERE len(ws) >= n)),
o AS (SELECT DISTINCT doc_id, p, dg.n AS n, item_id FROM dg JOIN win ON dg.n = win.n AND dg.g = win.g),
h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM o) GROUP BY doc_id),
s AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM o) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN h ON h.doc_id = d.doc_id LEFT JOIN s ON s.doc_id = d.doc_id
""",
    "op5_secret_scan": r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
rules(k, kind, pat, least_len) AS (VALUES
  (0, 'assign', '([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 12),
  (1, 'access', '(AKIA[A-Z0-9]+)', 18), (2, 'hex', '([0-9a-f]+)', 16)),
a AS (SELECT doc_id, 0 AS k, 'assign' AS kind, string_split_regex(text, (SELECT pat FROM rules WHERE k = 0)) AS gaps,
    regexp_extract_all(text, '([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0) AS hits,
    regexp_extract_all(text, '([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2) AS part FROM t
  UNION ALL SELECT doc_id, 1, 'access', string_split_regex(text, 'AKIA[A-Z0-9]+'), regexp_extract_all(text, 'AKIA[A-Z0-9]+'), regexp_extract_all(text, 'AKIA[A-Z0-9]+') FROM t
  UNION ALL SELECT doc_id, 2, 'hex', string_split_regex(text, '[0-9a-f]+'), regexp_extract_all(text, '[0-9a-f]+'), regexp_extract_all(text, '[0-9a-f]+') FROM t),
u AS (SELECT doc_id, k, kind, i, length(gaps[i]) AS gap, length(hits[i]) AS size, length(part[i]) AS val FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM a)),
p AS (SELECT *, CAST(sum(gap + size) OVER (PARTITION BY doc_id, k ORDER BY i) AS BIGINT) AS stop FROM u),
f AS (SELECT * FROM p WHERE val >= CASE k WHEN 0 THEN 12 WHEN 1 THEN 18 ELSE 16 END),
g AS (SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
    string_agg(kind || ':' || (stop - size) || ':' || stop, ',' ORDER BY stop - size, k) AS s FROM f GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(s, '')) AS base_sha256, coalesce(s, '') AS spans
FROM t LEFT JOIN g ON g.doc_id = t.doc_id
""",
    "op8_exact_top_k": r"""
WITH c AS (SELECT vec_id, CAST(array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '') AS BIT) AS code FROM embeddings WHERE len(embedding) > 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(bit_count(xor(q.code, c.code)) AS INTEGER) AS distance FROM c q JOIN c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, distance FROM r WHERE rank <= 10
""",
    "op10_license_scan": license_scan.oracle_sql(),
    "op11_importance_resampling": resampling.ORACLE_SQL,
    "op12_source_divergence": divergence.ORACLE_SQL,
}
