"""SQL for DuckDB that returns what the queries of this subpackage return."""

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP = f"""
WITH d AS (SELECT doc_id, {LOWERED} AS norm, row_number() OVER () AS row_no FROM documents)
SELECT doc_id,
  first_value(doc_id) OVER g AS keep_id,
  count(*) OVER (PARTITION BY norm) AS group_size,
  row_number() OVER g = 1 AS kept,
  sha256(norm) AS text_sha256
FROM d WINDOW g AS (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST, row_no)
"""

LINE_DEDUP = """
WITH d AS (SELECT row_number() OVER () AS row_no, * FROM documents),
l AS (
  SELECT row_no, doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM d
),
b AS (
  SELECT trim(line, ' ') AS bare FROM l WHERE trim(line, ' ') <> ''
  GROUP BY 1 HAVING count(DISTINCT coalesce('s' || source, 'none')) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(bare) AS n_removed,
  sha256(coalesce(string_agg(CASE WHEN bare IS NULL THEN line END, chr(10) ORDER BY pos), '')) AS kept_sha256
FROM l LEFT JOIN b ON trim(l.line, ' ') = b.bare
GROUP BY row_no, doc_id
"""


def mixing(documents: str = "documents", id_order: str = "doc_id NULLS FIRST") -> str:
    """Targets by repeated resharing of the excess, then one pass over the running sum per source."""
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM {documents}
),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight
  FROM d GROUP BY source
),
total AS (SELECT 3 * sum(source_size) AS halves FROM s),
rounds AS (
  SELECT 0 AS r, source, source_size, weight, false AS is_full FROM s
  UNION ALL
  SELECT r + 1, source, source_size, weight, is_full OR 4 * source_size * open_weight <= weight * open_halves
  FROM (
    SELECT *, sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER () AS open_weight,
      (SELECT halves FROM total) - 4 * sum(CASE WHEN is_full THEN source_size ELSE 0 END) OVER () AS open_halves
    FROM rounds
  ) WHERE r < (SELECT count(*) FROM s)
),
last AS (
  SELECT source, source_size, weight, is_full,
    sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER () AS open_weight,
    (SELECT halves FROM total) - 4 * sum(CASE WHEN is_full THEN source_size ELSE 0 END) OVER () AS open_halves
  FROM rounds WHERE r = (SELECT count(*) FROM s)
),
t AS (
  SELECT source, source_size,
    CASE WHEN is_full THEN CAST(2 * source_size AS DOUBLE)
      ELSE CAST(weight * open_halves AS DOUBLE) / CAST(2 * open_weight AS DOUBLE) END AS target
  FROM last
),
ranked AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
    row_number() OVER (PARTITION BY d.source ORDER BY d.size, {id_order}) AS place,
    CAST(('0x' || substr(md5('mix:' || coalesce(d.source, '')), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CAST((floor(rate * place + start) - floor(rate * (place - 1) + start)) AS BIGINT) * size AS taken
FROM ranked
"""


MIXING = mixing()


def shared_words(documents: str = "documents") -> str:
    """CTEs: ``d`` documents as word lists, ``found`` their spans of benchmark windows, ``held`` spans per item."""
    words = f"regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
d AS (SELECT row_number() OVER () AS row_no, *, {words} AS w FROM {documents}),
b AS (SELECT row_number() OVER () AS item_no, item_id, {words} AS w FROM benchmark),
held AS (
  SELECT item_no, item_id, 10 AS size, array_to_string(w[i:i + 9], ' ') AS words
  FROM (SELECT *, unnest(range(1, len(w) - 8)) AS i FROM b WHERE len(w) >= 10)
  UNION ALL
  SELECT item_no, item_id, len(w), array_to_string(w, ' ') FROM b WHERE len(w) BETWEEN 1 AND 9
),
sizes AS (SELECT DISTINCT size FROM held),
windows AS (
  SELECT row_no, size, i, array_to_string(w[i:i + size - 1], ' ') AS words
  FROM (SELECT row_no, w, size, unnest(range(1, CAST(len(w) - size + 2 AS BIGINT))) AS i FROM d, sizes WHERE len(w) >= size)
),
found AS (SELECT * FROM windows WHERE (size, words) IN (SELECT size, words FROM held))
"""


DECONTAMINATION = f"""
WITH {shared_words()},
hit AS (SELECT row_no, count(DISTINCT pos) AS n_hit FROM (SELECT row_no, unnest(range(i, i + size)) AS pos FROM found) GROUP BY 1),
items AS (
  SELECT row_no, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT f.row_no, h.item_no, coalesce(CAST(h.item_id AS VARCHAR), '') AS id FROM found f JOIN held h USING (size, words))
  GROUP BY 1
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (row_no) LEFT JOIN items USING (row_no)
"""

FILL_IN_MIDDLE = """
WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), numbers AS (
    SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n,
        CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
        CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
    FROM hashed
), cuts AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
        CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
            WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM numbers
), parts AS (
    SELECT *, substr(t, 1, low) AS prefix, substr(t, low + 1, high - low) AS middle, substr(t, high + 1) AS suffix FROM cuts
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN low END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN high - low END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t
        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM parts
"""
