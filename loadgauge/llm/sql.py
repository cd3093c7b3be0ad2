"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

_WHITE = r"[\x20\x09-\x0D]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP2 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), cut AS (
  SELECT *, replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\e') AS body,
    replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\e'), ':', '\c') AS name FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(name) + length(body) + 14) AS BIGINT) AS formatted_chars
FROM cut GROUP BY conv_id
"""

OP3 = rf"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(list_transform(range(1, greatest(2, len(w) - 1)), lambda i: array_to_string(list_slice(w, i, i + 2), ' '))) AS s
    FROM split WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), edges AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * m >= 85 * (x.n + y.n - m)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a
), least_ids AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least_ids ON a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""

_OP6_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP6 = f"""
WITH items AS (
  SELECT item_id, {_OP6_WORDS} AS w FROM benchmark
), grams AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, unnest(list_transform(range(1, greatest(1, len(w) - 12) + 1), lambda i: array_to_string(list_slice(w, i, i + least(13, len(w)) - 1), ' '))) AS g
  FROM items WHERE len(w) > 0
), docs AS (
  SELECT doc_id, {_OP6_WORDS} AS w FROM documents
), windows AS (
  SELECT doc_id, n, pos, array_to_string(list_slice(w, pos, pos + n - 1), ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS pos FROM docs, (SELECT DISTINCT n FROM grams) WHERE len(w) >= n)
), hits AS (
  SELECT doc_id, pos, g.n, item_id FROM windows JOIN grams g ON windows.g = g.g AND windows.n = g.n
), hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS p FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs d LEFT JOIN hit_words h ON h.doc_id = d.doc_id LEFT JOIN hit_items i ON i.doc_id = d.doc_id
"""

OP8 = f"""
WITH cut AS (
  SELECT doc_id, coalesce(source, '') AS site, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents
), plain AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^{_WHITE}+', ''), '{_WHITE}+$', ''), '{_UPPER}', '{_LOWER}') AS k FROM cut
), boiler AS (
  SELECT k FROM plain WHERE k <> '' GROUP BY k HAVING count(DISTINCT site) >= 10
), marked AS (
  SELECT p.*, b.k IS NOT NULL AS gone FROM plain p LEFT JOIN boiler b ON p.k = b.k
), back AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text FROM marked GROUP BY doc_id
)
SELECT doc_id, n_lines, n_removed, length(text) AS n_chars, sha256(text) AS text_sha256 FROM back
"""

OP10 = f"""
WITH plain AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '{_WHITE}', '', 'g') AS k FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY k) AS group_size,
  doc_id = first_value(doc_id) OVER w AS kept, sha256(k) AS text_sha256
FROM plain WINDOW w AS (PARTITION BY k ORDER BY n DESC, doc_id)
"""

_OP11_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP11 = f"""
WITH items AS (
  SELECT item_id, unnest(list_distinct({_OP11_TERMS})) AS term FROM benchmark
), docs AS (
  SELECT doc_id, row_number() OVER () AS rid, {_OP11_TERMS} AS w FROM documents
), totals AS (
  SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM docs WHERE len(w) > 0
), counts AS (
  SELECT doc_id, rid, size, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT doc_id, rid, CAST(len(w) AS BIGINT) AS size, unnest(w) AS term FROM docs) WHERE term IN (SELECT term FROM items) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM counts, totals GROUP BY term, n_docs
), gains AS (
  SELECT doc_id, rid, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * size * n_docs) // n_terms))) AS g FROM counts JOIN weights USING (term), totals
), scores AS (
  SELECT item_id, doc_id, rid, CAST(sum(g) AS BIGINT) AS score FROM gains JOIN items USING (term) GROUP BY item_id, doc_id, rid HAVING sum(g) > 0
)
SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score
FROM scores WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER best <= 10
"""

SQL = {"op2_chat_format": OP2, "op3_near_dup": OP3, "op6_decontaminate": OP6, "op8_line_dedup": OP8, "op10_exact_dedup": OP10, "op11_lexical_search": OP11}
