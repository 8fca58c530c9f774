"""Query of operator 13 and its SQL."""

from __future__ import annotations

from mailloom.llm.common import table
from mailloom.llm.manifest import verified


def op13_merkle_manifest(spark, sf_dir):
    """Leaf, subroot, root and proof of every document, checked on partly tampered rows."""
    return verified(table(spark, sf_dir, "documents"))


def _field(value: str) -> str:
    return (f"CASE WHEN {value} IS NULL THEN '-' ELSE "
            f"strlen({value}::VARCHAR) || ':' || {value}::VARCHAR END")


def _row(text: str) -> str:
    return "sha256(" + " || ".join(
        f"({_field(v)})" for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


SQL = rf"""
WITH RECURSIVE
crcs AS (
  SELECT list(list_reduce(list_prepend(i, range(8)),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END)
         ORDER BY i) AS t
  FROM range(256) AS r(i)),
rows AS (
  SELECT *, doc_id::VARCHAR AS digits, (SELECT t FROM crcs) AS t FROM documents),
leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_row('text')} AS leaf,
         CASE WHEN xor(4294967295::BIGINT, list_reduce(
                list_prepend(4294967295::BIGINT,
                  list_transform(range(1, len(digits) + 1), lambda j: ascii(digits[j])::BIGINT)),
                lambda c, b: xor(t[xor(c, b) % 256 + 1], c >> 8))) % 3 = 0
              THEN {_row("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
         END AS other
  FROM rows),
low AS (
  SELECT *, coalesce(other, leaf) AS folded,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY tree) AS size
  FROM leaves),
nodes AS (
  SELECT tree, 0 AS lvl, idx, size, leaf AS digest FROM low
  UNION ALL
  SELECT tree, lvl + 1, idx // 8, max(size), sha256(string_agg(digest, '' ORDER BY idx))
  FROM nodes WHERE size > pow(8, lvl) GROUP BY tree, lvl, idx // 8),
subroots AS (
  SELECT *, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS trees
  FROM nodes WHERE size <= pow(8, lvl) AND (lvl = 0 OR size > pow(8, lvl - 1))),
upper AS (
  SELECT 0 AS lvl, place AS idx, trees AS size, digest FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 8, max(size), sha256(string_agg(digest, '' ORDER BY idx))
  FROM upper WHERE size > pow(8, lvl) GROUP BY lvl, idx // 8),
root AS (
  SELECT digest FROM upper WHERE size <= pow(8, lvl) AND (lvl = 0 OR size > pow(8, lvl - 1))),
beside AS (
  SELECT a.tree, a.lvl, a.idx,
         coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS before,
         coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS after
  FROM nodes a JOIN nodes b ON a.tree = b.tree AND a.lvl = b.lvl AND a.idx // 8 = b.idx // 8
  WHERE a.size > pow(8, a.lvl) GROUP BY ALL),
beside_upper AS (
  SELECT a.lvl, a.idx,
         coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS before,
         coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS after
  FROM upper a JOIN upper b ON a.lvl = b.lvl AND a.idx // 8 = b.idx // 8
  WHERE a.size > pow(8, a.lvl) GROUP BY ALL),
walk AS (
  SELECT tree, idx AS leaf_idx, 0 AS lvl, idx, '' AS proof, folded FROM low
  UNION ALL
  SELECT w.tree, leaf_idx, w.lvl + 1, w.idx // 8, proof || before || after,
         sha256(before || folded || after)
  FROM walk w JOIN beside b ON w.tree = b.tree AND w.lvl = b.lvl AND w.idx = b.idx),
at_subroot AS (
  SELECT w.*, s.place, s.digest AS subroot
  FROM walk w JOIN subroots s ON w.tree = s.tree AND w.lvl = s.lvl),
walk_upper AS (
  SELECT tree, leaf_idx, subroot, 0 AS up, place AS idx, proof, folded FROM at_subroot
  UNION ALL
  SELECT tree, leaf_idx, subroot, up + 1, w.idx // 8, proof || before || after,
         sha256(before || folded || after)
  FROM walk_upper w JOIN beside_upper b ON w.up = b.lvl AND w.idx = b.idx),
ended AS (
  SELECT * FROM walk_upper WHERE up = (SELECT max(lvl) FROM upper))
SELECT l.doc_id, l.leaf, e.subroot, r.digest AS root, sha256(e.proof) AS proof_sha256,
       e.folded AS folded_root, e.folded = r.digest AS verified
FROM ended e JOIN low l ON e.tree = l.tree AND e.leaf_idx = l.idx CROSS JOIN root r
"""

QUERIES = {"op13_merkle_manifest": (op13_merkle_manifest, SQL)}
