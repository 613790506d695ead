"""DuckDB SQL for the operators that SQL can express, written from their contracts."""

from __future__ import annotations

from salesloom.llm import revisits

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

def _components(words: int, more: str = "") -> str:
    """Documents linked by 0.85 similarity of their word shingles, by all pairs and reachability."""
    return rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE
    WHEN len(w) >= {words} THEN list_distinct(
      [array_to_string(w[i:i + {words - 1}], ' ') for i in range(1, len(w) - {words - 2})])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words
), single AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS both_
  FROM single a JOIN single b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  WHERE least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 85 GROUP BY 1, 2
), links AS (
  SELECT x, y FROM pairs WHERE 100 * both_ >= 85 * (nx + ny - both_)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM sets UNION
  SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
)
SELECT sets.doc_id, len(s)::BIGINT AS n_shingles, min(reach.y) AS component_id{more}
FROM sets JOIN reach ON sets.doc_id = reach.x GROUP BY sets.doc_id, s
"""


NGRAM_JACCARD = _components(4)
MINHASH = _components(3, ", sets.doc_id = min(reach.y) AS kept")

_DIGEST = "sha256('1:' || doc_id)"


def _draw(number: int) -> str:
    return f"('0x' || substr({_DIGEST}, {8 * number - 7}, 8))::BIGINT"


MIDDLE = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n,
    {_draw(1)} AS h1, {_draw(2)} AS h2, {_draw(3)} AS h3, {_draw(4)} AS h4 FROM documents
), cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
      THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d
), pieces AS (
  SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM cuts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE t END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM pieces
"""

DECONTAMINATE = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS passage FROM (
    SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
    FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM item_windows
), windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS passage FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), found AS (
  SELECT doc_id, i, n, item_id FROM windows JOIN item_windows USING (n, passage)
), hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
    SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM found)
  ) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (
    SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found
  ) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# Kind, pattern and condition on a match m (RE2 has no look-behind and needs none here).
_SECRETS = (
    ("assign", r"(?i)(?:password|passwd|secret|token|api_?key)[\"'']?\x20*[:=]\x20*[\"'']?[A-Za-z0-9+/_.=-]+",
     r"length(regexp_extract(m, '(?i)(password|passwd|secret|token|api_?key)[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)', 2)) >= 6"),
    ("access", "AKIA[A-Z0-9]+", "length(m) >= 20"),
    ("hex", "[0-9a-f]+", "length(m) >= 24"),
    ("private_key", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", "true"),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", "true"),
    ("service_token", "(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,})", "true"),
    ("url_login", r"://[^\x00-\x20/:@]{1,64}:[^\x00-\x20/:@]{1,64}@", "true"),
)


def _kind(order: int, kind: str, pattern: str, keep: str) -> str:
    return rf"""
  SELECT doc_id, '{kind}' AS kind, {order} AS kind_order, m, upto - length(m) AS begin_, upto AS end_ FROM (
    SELECT doc_id, m, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY k) AS upto FROM (
      SELECT doc_id, unnest(ms) AS m, unnest(gaps[1:len(ms)]) AS gap, unnest(range(len(ms))) AS k FROM (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{pattern}') AS ms,
          string_split_regex(coalesce(text, ''), '{pattern}') AS gaps FROM documents))) WHERE {keep}"""


SECRETS = (
    "WITH found AS (" + " UNION ALL ".join(_kind(i, *rule) for i, rule in enumerate(_SECRETS)) + r""")
SELECT documents.doc_id, count(*) FILTER (kind = 'assign') AS n_assign,
  count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(kind || ':' || begin_ || ':' || end_, ',' ORDER BY begin_, kind_order)
    FILTER (kind_order < 3), '')) AS base_sha256,
  coalesce(string_agg(kind || ':' || begin_ || ':' || end_, ',' ORDER BY begin_, kind_order), '') AS spans
FROM documents LEFT JOIN found USING (doc_id) GROUP BY documents.doc_id
"""
)

ORACLE_SQL: dict[str, str] = {
    "op2_ngram_jaccard": NGRAM_JACCARD,
    "op3_decontaminate": DECONTAMINATE,
    "op5_secrets": SECRETS,
    "op6_revisits": revisits.ORACLE,
    "op11_minhash": MINHASH,
    "op12_middle": MIDDLE,
}
