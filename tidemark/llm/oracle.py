"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from tidemark.llm.licenses import NOTICES, PHRASES, template_words

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {}

ORACLE["op4_benchmark_decontamination"] = f"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '{WORD}') AS w FROM documents
), item AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_LOWERED}, '{WORD}') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, len(w[s : s + 9]) AS size, array_to_string(w[s : s + 9], ' ') AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s FROM item WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT size FROM windows
), places AS (
  SELECT doc_id, s, size, array_to_string(w[s : s + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS s FROM doc) p, sizes
  WHERE s + size - 1 <= len(w)
), hits AS (
  SELECT doc_id, item_id, s, p.size FROM places p JOIN windows USING (size, win)
), covered AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(s, s + size - 1)) AS pos FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

ORACLE["op3_line_dedup"] = """
WITH split AS (
  SELECT doc_id, source, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL
), placed AS (
  SELECT doc_id, source, lines, unnest(generate_series(1, len(lines))) AS place FROM split
), line AS (
  SELECT doc_id, source, place, lines[place] AS line FROM placed
), wide AS (
  SELECT line, min(doc_id) AS first_doc FROM line WHERE trim(line, ' ') <> ''
  GROUP BY line HAVING count(DISTINCT source) >= 8
), marked AS (
  SELECT l.doc_id, l.place, l.line, w.line IS NOT NULL AND l.doc_id IS DISTINCT FROM w.first_doc AS gone
  FROM line l LEFT JOIN wide w USING (line)
), clean AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '') AS text
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, d.source, coalesce(c.n_lines, 0) AS n_lines, coalesce(c.n_removed, 0) AS n_removed, c.text
FROM documents d LEFT JOIN clean c USING (doc_id)
"""

ORACLE["op1_suffix_dedup"] = f"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '{WORD}') AS w FROM documents
), windows AS (
  SELECT doc_id, s, md5(array_to_string(w[s : s + 49], ' ')) AS win
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS s FROM doc WHERE len(w) >= 50)
), again AS (
  SELECT win FROM windows GROUP BY win HAVING count(*) > 1
), hits AS (
  SELECT doc_id, s FROM windows SEMI JOIN again USING (win)
), edges AS (
  SELECT doc_id, s, CASE WHEN s < lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 50 THEN 0 ELSE 1 END AS edge FROM hits
), runs AS (
  SELECT doc_id, s, sum(edge) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM edges
)
SELECT doc_id, min(s) - 1 AS start_word, max(s) + 49 AS end_word FROM runs GROUP BY doc_id, run
"""

_BIGRAMS = ", ".join(
    f"({n}, '{label}', {base}, {len(own) - 1}, {at}, '{own[at]}', '{own[at + 1]}')"
    for n, (text, label, base) in enumerate([(t, x, True) for t, x in PHRASES.items()] + [(t, x, False) for t, x in NOTICES.items()])
    for own in [template_words(text)]
    for at in range(len(own) - 1)
)

ORACLE["op9_license_scan"] = f"""
WITH template(template, label, is_base, grams, place, w1, w2) AS (VALUES {_BIGRAMS}), doc AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '{WORD}') AS w FROM documents
), gram AS (
  SELECT doc_id, p - 1 AS pos, w[p] AS w1, w[p + 1] AS w2
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 1)) AS p FROM doc WHERE len(w) > 1)
), vote AS (
  SELECT DISTINCT doc_id, template, label, is_base, grams, pos - place AS diagonal, place, pos FROM gram JOIN template USING (w1, w2)
), diagonals AS (
  SELECT doc_id, template, label, is_base, grams, diagonal, bit_or(CAST(1 AS BIGINT) << place) AS places,
         min(pos) AS first_pos, max(pos) AS last_pos
  FROM vote GROUP BY doc_id, template, label, is_base, grams, diagonal
), whole AS (
  SELECT * FROM diagonals WHERE bit_count(places) = grams
), stepped AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) <= 3 THEN 0 ELSE 1 END AS fresh
  FROM diagonals WHERE NOT is_base AND bit_count(places) < grams
), run AS (
  SELECT *, sum(fresh) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS run FROM stepped
), stretch AS (
  SELECT a.doc_id, a.template, a.label, a.grams, a.diagonal AS start, b.places,
         max(b.last_pos) OVER upto + 2 - min(b.first_pos) OVER upto AS length
  FROM run a JOIN run b ON b.doc_id = a.doc_id AND b.template = a.template AND b.run = a.run AND b.diagonal BETWEEN a.diagonal AND a.diagonal + 300
  WINDOW upto AS (PARTITION BY a.doc_id, a.template, a.diagonal ORDER BY b.diagonal)
), notice AS (
  SELECT doc_id, label, bit_count(bit_or(places)) / CAST(grams AS DOUBLE) AS cover FROM stretch WHERE length <= 1.5 * (grams + 1) + 3
  GROUP BY doc_id, template, label, grams, start
  HAVING bit_count(bit_or(places)) / CAST(grams AS DOUBLE) >= CASE WHEN grams < 10 THEN 1.0 ELSE 0.8 END
), found AS (
  SELECT doc_id, label, 1.0 AS cover, CASE WHEN is_base THEN diagonal END AS start, CASE WHEN is_base THEN label END AS base_label FROM whole
  UNION ALL SELECT doc_id, label, cover, NULL, NULL FROM notice
), labelled AS (
  SELECT doc_id, count(start) AS n_base, min(start) AS first_word, max(start) AS last_word,
         string_agg(DISTINCT base_label, ',' ORDER BY base_label) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(cover) AS score
  FROM found GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM doc LEFT JOIN labelled USING (doc_id)
"""
