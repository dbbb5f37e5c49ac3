"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _shingles(name: str, table: str, key: str, n: int) -> str:
    """CTE of the distinct shingles of every text; a shorter text is one."""
    return f"""{name} AS (
  SELECT DISTINCT {key}, unnest(CASE
      WHEN len(w) >= {n} THEN list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM (SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w
        FROM {table}))"""


OP2 = f"""WITH {_shingles('ds', 'documents', 'doc_id', 5)},
{_shingles('bs', 'benchmark', 'item_id', 5)},
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_shared, n_item, CAST(count(*) AS DOUBLE) / n_item AS containment
FROM ds JOIN bs USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING 100 * count(*) >= 80 * n_item"""

_NIBBLE = "(instr('0123456789abcdef', substr(x, CAST(5 * i + {j} AS INTEGER), 1)) - 1)"
_V = "(" + " + ".join(f"{_NIBBLE.format(j=j)} * {16 ** (5 - j)}" for j in range(1, 6)) + ")"
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(({_V} // {32 ** k}) % 32 AS INTEGER) + 1, 1)" for k in (3, 2, 1, 0))

OP8 = f"""SELECT DISTINCT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id IS DISTINCT FROM top AND top IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, max(page_id) OVER (PARTITION BY h) AS top,
             array_to_string(list_transform(range(0, 8), lambda i: {_BASE32}), '') AS payload_digest
      FROM (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages))"""

_TRIM = "' ' || chr(9) || chr(11) || chr(12) || chr(13)"

OP9 = f"""WITH parts AS (
  SELECT doc_id, CAST(generate_subscripts(ls, 1) - 1 AS INTEGER) AS pos, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)),
words AS (
  SELECT *, len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS w
  FROM (SELECT doc_id, pos, trim(line, {_TRIM}) AS t FROM parts) WHERE t <> ''),
ends AS (
  SELECT *, e - w AS s, max(e) OVER (PARTITION BY doc_id) AS total
  FROM (SELECT *, CAST(sum(w) OVER (PARTITION BY doc_id ORDER BY pos) AS BIGINT) AS e FROM words)),
spans AS (
  SELECT doc_id, pos, s, e, total, list(t) OVER fwd AS ft, max(pos) OVER fwd AS fhi, list(t) OVER bwd AS bt, min(pos) OVER bwd AS blo
  FROM ends
  WINDOW fwd AS (PARTITION BY doc_id ORDER BY s RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING),
         bwd AS (PARTITION BY doc_id ORDER BY e RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
windows AS (
  SELECT doc_id, pos AS lo, fhi AS hi, ft AS k FROM spans WHERE total - s >= 50
  UNION SELECT doc_id, blo, pos, bt FROM spans WHERE e >= 50),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(lo, hi)) AS pos
  FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, lo) AS r FROM windows) WHERE r > 1)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(x.text, '') END AS text,
       CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS BIGINT) AS n_lines, coalesce(x.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN (
  SELECT p.doc_id, string_agg(p.line, chr(10) ORDER BY p.pos) FILTER (g.pos IS NULL) AS text, count(g.pos) AS n_removed
  FROM parts p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.pos = p.pos GROUP BY p.doc_id) x ON x.doc_id = d.doc_id"""

OP5 = f"""WITH RECURSIVE {_shingles('ds', 'documents', 'doc_id', 3)},
n AS (SELECT doc_id, count(*) AS n FROM ds GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM ds x JOIN ds y ON x.s = y.s AND x.doc_id < y.doc_id JOIN n nx ON nx.doc_id = x.doc_id JOIN n ny ON ny.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, nx.n, ny.n HAVING 100 * count(*) >= 85 * (nx.n + ny.n - count(*))),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT a AS doc_id, b AS other FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
component AS (SELECT doc_id, min(other) AS least FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(c.least, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(c.least, d.doc_id) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN component c ON c.doc_id = d.doc_id"""

_H = "CAST('0x' || substr(d, {}, 8) AS BIGINT)"

OP13 = f"""WITH units AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u,
         sha256('7:' || CAST(doc_id AS VARCHAR)) AS d
  FROM documents),
drawn AS (
  SELECT doc_id, t, u, len(u) AS n, {_H.format(1)} % (len(u) + 1) AS x, {_H.format(9)} % (len(u) + 1) AS y,
         d IS NULL OR t = '' OR t LIKE '%<P>%' OR t LIKE '%<S>%' OR t LIKE '%<M>%' OR {_H.format(17)} % 100 >= 100 AS plain,
         {_H.format(25)} % 100 < 50 AS spm
  FROM units),
cut AS (
  SELECT *, array_to_string(u[1:least(x, y)], '') AS prefix, array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS middle,
         array_to_string(u[greatest(x, y) + 1:], '') AS suffix
  FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
       CASE WHEN NOT plain THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN NOT plain THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE WHEN plain THEN t WHEN spm THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                   ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM cut"""
