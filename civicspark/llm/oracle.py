"""DuckDB SQL for the queries of this package that SQL can express over whole tables."""

from __future__ import annotations

from civicspark.llm.url_filter import SOFT_TERMS, STRICT_TERMS

# The site rules of the url query (verdict, host, path).
SITE_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _low(expr: str) -> str:
    return f"translate({expr}, '{_UP}', '{_LOW}')"


_WARC = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), first AS (
  SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
  CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM p LEFT JOIN first USING (payload_digest)
"""


def _has_term(term: str) -> str:
    return f"CAST(regexp_matches(low, '(^|[^a-z0-9]){term}([^a-z0-9]|$)') AS INTEGER)"


def _url_filter() -> str:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in SITE_RULES)
    strict = " + ".join(_has_term(t) for t in STRICT_TERMS)
    soft = " + ".join(_has_term(t) for t in SOFT_TERMS)
    return f"""
WITH rules(rule_verdict, rule_host, rule_path) AS (VALUES {rules}),
u AS (
  SELECT page_id, coalesce({_low("url")}, '') AS low,
    coalesce({_low("regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1)")}, '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), fit AS (
  SELECT DISTINCT host, path, rule_host || rule_path AS rule, rule_verdict, length(rule_host || rule_path) AS n
  FROM (SELECT DISTINCT host, path FROM u) JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
), best AS (
  SELECT host, path, arg_max(rule, n) AS rule, arg_max(rule_verdict, n) AS rule_verdict FROM fit GROUP BY host, path
), hits AS (
  SELECT page_id, host, path, {strict} AS strict_hits, {soft} AS soft_hits FROM u
)
SELECT h.page_id, h.host, h.path, b.rule,
  coalesce(b.rule_verdict, CASE WHEN strict_hits >= 1 OR soft_hits >= 2 THEN 'block' ELSE 'allow' END) AS verdict,
  CAST(strict_hits AS INTEGER) AS strict_hits, CAST(soft_hits AS INTEGER) AS soft_hits
FROM hits h LEFT JOIN best b ON h.host = b.host AND h.path = b.path
"""


_EXACT = f"""
WITH t AS (SELECT doc_id, {_low("coalesce(text, '')")} AS low FROM documents),
g AS (SELECT low, max(doc_id) AS keep_id, count(*) AS group_size, sha256(low) AS text_sha256 FROM t GROUP BY low)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (low)
"""


_CONTAMINATION = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_low("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({_low("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM benchmark
), item_windows AS (
  SELECT item_id, array_to_string(words[i : i + 12], ' ') AS w, least(13, len(words)) AS n
  FROM (SELECT item_id, words, unnest(range(1, greatest(1, len(words) - 12) + 1)) AS i FROM b WHERE len(words) > 0)
), sizes AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, i, n, array_to_string(words[i : i + n - 1], ' ') AS w
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM d, sizes)
), found AS (SELECT DISTINCT doc_id, i, n, item_id FROM doc_windows JOIN item_windows USING (w, n)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _draw(k: int) -> str:
    return f"CAST('0x' || substr(h, {8 * k - 7}, 8) AS BIGINT)"


_FILL_IN_MIDDLE = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || CAST(doc_id AS VARCHAR)) AS h,
    regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS u
  FROM documents
), cut AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, least({_draw(1)} % (len(u) + 1), {_draw(2)} % (len(u) + 1)) AS a,
    greatest({_draw(1)} % (len(u) + 1), {_draw(2)} % (len(u) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR {_draw(3)} % 100 >= 50
      THEN 'plain' WHEN {_draw(4)} % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), piece AS (
  SELECT *, coalesce(array_to_string(u[1 : a], ''), '') AS p, coalesce(array_to_string(u[a + 1 : b], ''), '') AS m,
    coalesce(array_to_string(u[b + 1 : n], ''), '') AS s
  FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM piece
"""


def _vector_codes(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Assign and average, round by round, each as two common table expressions."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, p, any_value(x) AS x, min({entries} * d + e) % {entries} AS e, min({entries} * d + e) // {entries} AS d
  FROM (SELECT vec_id, part.p, x, e, CAST(list_inner_product(x, x) + list_inner_product(v, v) - 2 * list_inner_product(x, v) AS BIGINT) AS d
    FROM part JOIN c{r} ON part.p = c{r}.p)
  GROUP BY vec_id, p
)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c{r}.p, c{r}.e, coalesce(m.v, c{r}.v) AS v
  FROM c{r} LEFT JOIN (
    SELECT p, e, list(floor(s / n) ORDER BY i) AS v
    FROM (SELECT p, e, i, sum(x[i]) AS s, count(*) AS n FROM a{r}, unnest(range(1, len(x) + 1)) AS t(i) GROUP BY p, e, i)
    GROUP BY p, e
  ) AS m ON m.p = c{r}.p AND m.e = c{r}.e
)""")
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda c: floor(1024 * CAST(c AS DOUBLE))) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), part AS MATERIALIZED (
  SELECT vec_id, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS x FROM kept, range({parts}) AS t(p)
), c0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS v FROM part QUALIFY e < {entries}
), {", ".join(steps)}, coded AS (
  SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id
), books AS (
  SELECT sha256(string_agg(array_to_string(list_transform(v, lambda c: CAST(c AS BIGINT)), ','), ',' ORDER BY p, e)) AS digest FROM c{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256
FROM coded JOIN kept USING (vec_id), books
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc": _WARC,
        "op2_url_filter": _url_filter(),
        "op3_block_naming": _EXACT,
        "op8_decontaminate": _CONTAMINATION,
        "op11_fill_in_middle": _FILL_IN_MIDDLE,
        "op12_vector_codes": _vector_codes(),
    }
