"""DuckDB SQL of the queries that SQL can express, over the same tables."""

WORD = r"[^\x20\x09-\x0D]+"

OP6 = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM d GROUP BY source),
ranked AS (
  SELECT *, 2 * source_size AS most, row_number() OVER (ORDER BY 2 * source_size / w, source NULLS LAST) AS i FROM per),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () -
             coalesce(sum(most) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked),
aims AS (
  SELECT source, source_size,
         least(CAST(most AS DOUBLE), coalesce(
           (SELECT arg_min(level, i) FROM levels WHERE level * w <= most) * w, CAST(most AS DOUBLE))) AS target
  FROM levels),
placed AS (
  SELECT d.doc_id, d.size, a.source_size, a.target,
         CAST(floor(a.target) AS BIGINT) AS words,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN aims a ON d.source IS NOT DISTINCT FROM a.source),
cut AS (
  SELECT *, CASE WHEN source_size > 0 THEN words // source_size ELSE 0 END AS whole FROM placed)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * whole + greatest(0, least(size, words - whole * source_size - before)) AS BIGINT) AS taken
FROM cut
"""

OP9 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
g AS (
  SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i + 1 : i + least(13, len(w))], ' ') AS g
  FROM b, unnest(range(greatest(len(w) - 12, 1))) AS u(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM g),
t AS (
  SELECT r, n, i, array_to_string(w[i + 1 : i + n], ' ') AS g
  FROM d, sizes, unnest(range(greatest(len(w) - n + 1, 0))) AS u(i)),
hits AS (SELECT t.r, t.n, t.i, g.item FROM t JOIN g USING (n, g)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS u(p) GROUP BY r),
items AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hits GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

OP12 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
draws AS (
  SELECT doc_id, t, n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS one, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS two,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS three, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS four
  FROM d),
cuts AS (
  SELECT doc_id, t, n, least(one, two) AS lo, greatest(one, two) AS hi,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR three >= 90 THEN 'plain'
              WHEN four < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM draws),
parts AS (
  SELECT *, substr(t, 1, lo) AS prefix, substr(t, lo + 1, hi - lo) AS middle, substr(t, hi + 1) AS suffix FROM cuts)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN lo END AS prefix_chars, CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""


def all_oracles() -> dict[str, str]:
    return {"op6_mix": OP6, "op9_decontaminate": OP9, "op12_middle": OP12}
