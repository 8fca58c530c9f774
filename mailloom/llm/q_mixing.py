"""Query of operator 1 and its SQL."""

from __future__ import annotations

from mailloom.llm.common import table
from mailloom.llm.mixing import mix


def op1_pareto_mix(spark, sf_dir):
    """The mix of all documents, sources weighing 1, 2, 3, repeating."""
    return mix(table(spark, sf_dir, "documents"))


SQL = r"""
WITH docs AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         (CAST('0x' || substr(md5('1:' || coalesce(doc_id::VARCHAR, '') || ':' ||
               md5(coalesce(text, ''))), 1, 13) AS BIGINT)::DOUBLE + 0.5)
           / 4503599627370496.0::DOUBLE AS u
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM docs GROUP BY source),
ranked AS (
  SELECT *, sum(source_size) OVER ()::BIGINT AS total,
         coalesce(sum(source_size) OVER before, 0)::BIGINT AS capped,
         (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::BIGINT AS still,
         row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS place
  FROM sources
  WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (
  SELECT *, (total - 3 * capped) / still AS level FROM ranked),
lifted AS (
  SELECT *, (SELECT arg_min(level, place) FROM levels
             WHERE level * weight <= 3 * source_size) AS first FROM levels),
targets AS (
  SELECT source, source_size,
         coalesce(least((3 * source_size)::DOUBLE, first * weight), (3 * source_size)::DOUBLE)
           AS target
  FROM lifted),
rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS ratio
  FROM targets),
parts AS (
  SELECT *, floor(ratio)::BIGINT AS sure, ratio - floor(ratio) AS part,
         target - floor(ratio)::BIGINT * source_size AS rest
  FROM rates),
odds AS (
  SELECT d.*, p.source_size, p.target, p.sure, p.part, p.rest,
         CASE WHEN part > 0 THEN (u / (1 - u)) / (part / (1 - part)) END AS rank
  FROM docs d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source),
taken AS (
  SELECT *, coalesce(sum(size) OVER (
              PARTITION BY source ORDER BY rank, doc_id NULLS FIRST, size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
  FROM odds)
SELECT doc_id, source, size, source_size, target,
       (sure + CASE WHEN part > 0 AND earlier + size / 2 <= rest THEN 1 ELSE 0 END)::INTEGER
         AS copies,
       ((sure + CASE WHEN part > 0 AND earlier + size / 2 <= rest THEN 1 ELSE 0 END) * size)
         ::BIGINT AS taken
FROM taken
"""

QUERIES = {"op1_pareto_mix": (op1_pareto_mix, SQL)}
