"""Query of operator 9 and its SQL."""

from __future__ import annotations

from mailloom.llm.common import table
from mailloom.llm.contamination import contamination


def op9_winnowing(spark, sf_dir):
    """Words of every document that lie in windows of benchmark items."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("key")


SQL = r"""
WITH items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size,
         array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS words
  FROM (SELECT *, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i
        FROM items WHERE len(w) > 0)),
docs AS (
  SELECT row_number() OVER () AS row, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT row, i, size, array_to_string(w[i : i + size - 1], ' ') AS words
  FROM (SELECT row, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
        FROM docs, sizes WHERE len(w) >= size)),
hits AS (
  SELECT d.row, d.i, d.size, t.item_id
  FROM doc_windows d JOIN item_windows t ON d.size = t.size AND d.words = t.words),
words AS (
  SELECT row, count(DISTINCT place) AS n_hit
  FROM (SELECT row, unnest(generate_series(i, i + size - 1)) AS place
        FROM (SELECT DISTINCT row, i, size FROM hits)) GROUP BY row),
lists AS (
  SELECT row, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT row, item_id::VARCHAR AS id FROM hits WHERE item_id IS NOT NULL)
  GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN words USING (row) LEFT JOIN lists USING (row)
"""

QUERIES = {"op9_winnowing": (op9_winnowing, SQL)}
