"""Merkle manifest of a dataset: a digest per document, proofs and their check.

Leaves of a tree are ranked, and a node is labelled with the interval ``[lo, hi)`` of the
leaf ranks that it covers. Every ``fan`` consecutive nodes of a level become one node of
the next, so the nodes of a level lie in buckets of ``fan ** level`` ranks. Proofs come
down from the root: the nodes of a level are joined with the parents of the next one on
the bucket and on containment of the intervals, and the siblings are those children of the
parent whose intervals lie before or after the node's own. A key of these joins never has
more than ``fan`` rows, whatever the size of a tree, and the work of all levels together
is little more than that of the lowest.

Trees (here: languages) have a subroot each; the subroots, in the order of the trees'
names, are the leaves of the tree that gives the root.

Nulls, ties and odd rows: a null field is written ``-`` and differs from an empty one; a
null tree is one of its own and comes first; null ids come first in their tree. Rows that
share an id are all leaves, in the order of their digests; rows that agree in everything
have the same digest, and their proofs differ by place. A tree of one leaf has that leaf as
subroot. An empty table has no rows and no root. Columns that are not named are passed over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailloom.llm.common import stored
from mailloom.llm.ranks import ranked

#: Children of a node.
FAN = 8

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes before it, so that fields cannot run together."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaves(
    documents: DataFrame, fields: tuple[str, ...] = FIELDS, tree: str = "lang",
    changed: dict[str, Column] | None = None, where: Column | None = None,
) -> DataFrame:
    """``(tree, doc_id, leaf, folded)``: the digest, and that of the row as it is checked.

    ``changed`` gives other values of some fields to the rows that meet ``where``.
    """
    own = digest(*[field(F.col(c)) for c in fields])
    other = digest(*[field((changed or {}).get(c, F.col(c))) for c in fields])
    return documents.select(
        F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit("")).alias("tree"),
        "doc_id", own.alias("leaf"),
        F.when(F.coalesce(where, F.lit(False)), other).alias("other") if where is not None
        else F.lit(None).cast("string").alias("other"),
    ).withColumn("folded", F.coalesce("other", "leaf")).drop("other")


def _levels(low: DataFrame, fan: int) -> list[DataFrame]:
    """Nodes per level, the given ones first, each with the children it is made of.

    ``low`` has ``tree, size, lo, hi, digest``; a tree goes up until one node covers it.
    """
    largest = low.agg(F.max("size")).first()[0] or 0
    found, covers = [low], 1
    while covers < largest:
        open_nodes = found[-1].where(F.col("size") > covers)
        covers *= fan
        kids = F.sort_array(F.collect_list(F.struct("lo", "hi", "digest")))
        up = open_nodes.groupBy(
            "tree", "size", F.floor(F.col("lo") / F.lit(covers)).alias("bucket")
        ).agg(kids.alias("children"))
        found.append(stored(up.select(
            "tree", "size", F.col("children")[0]["lo"].alias("lo"),
            F.element_at("children", -1)["hi"].alias("hi"),
            digest(F.array_join(F.transform("children", lambda c: c["digest"]), "")).alias("digest"),
            "children",
        )))
    return found


def _tops(levels: list[DataFrame], fan: int) -> DataFrame:
    """``(tree, digest)`` of the nodes that cover their whole tree."""
    whole = [
        level.where((F.col("size") <= fan**k) & (F.col("size") > (fan ** (k - 1) if k else 0)))
        .select("tree", "digest")
        for k, level in enumerate(levels)
    ]
    found = whole[0]
    for more in whole[1:]:
        found = found.unionByName(more)
    return found


def _between(children: str, keep) -> Column:
    return F.array_join(F.transform(F.filter(children, keep), lambda c: c["digest"]), "")


def _proofs(levels: list[DataFrame], tops: DataFrame, fan: int) -> DataFrame:
    """The lowest nodes with ``path``: digests left and right of them on every level.

    ``tops`` has ``tree`` and, for the node that covers it, ``subroot`` and ``path``.
    """
    above = None
    for k in range(len(levels) - 1, -1, -1):
        level, covers = levels[k], fan**k
        top = (F.col("size") <= covers) & (F.col("size") > (covers // fan if k else 0))
        found = level.where(top).join(tops, "tree")
        if above is not None:
            parents = above.select(
                F.col("tree").alias("_tree"), F.floor(F.col("lo") / F.lit(covers * fan)).alias("_bucket"),
                F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), F.col("children").alias("_children"),
                "subroot", F.col("path").alias("_path"),
            )
            inside = level.where(F.col("size") > covers).join(parents, (
                (F.col("tree") == F.col("_tree"))
                & (F.floor(F.col("lo") / F.lit(covers * fan)) == F.col("_bucket"))
                & (F.col("lo") >= F.col("_lo")) & (F.col("hi") <= F.col("_hi"))
            ))
            step = F.struct(
                _between("_children", lambda c: c["hi"] <= F.col("lo")).alias("left"),
                _between("_children", lambda c: c["lo"] >= F.col("hi")).alias("right"),
            )
            inside = inside.withColumn("path", F.concat(F.array(step), "_path"))
            found = inside.select(*found.columns).unionByName(found)
        above = found
    return above


_NO_PATH = "array<struct<left:string,right:string>>"


def manifest(
    documents: DataFrame, fields: tuple[str, ...] = FIELDS, tree: str = "lang",
    changed: dict[str, Column] | None = None, where: Column | None = None, fan: int = FAN,
) -> DataFrame:
    """Per document its leaf, its subroot, the root, its proof and the root that it folds to.

    ``path`` is the proof, from the leaf up to the root; ``folded_root`` follows from it and
    from the row as changed where ``where`` holds, so it equals ``root`` as long as a row is
    what it was.
    """
    found = ranked(stored(leaves(documents, fields, tree, changed, where)), "tree", ["doc_id", "leaf"])
    low = found.select(
        "tree", "size", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"),
        F.col("leaf").alias("digest"), "doc_id", "folded",
    )
    levels = _levels(low, fan)
    subroots = stored(_tops(levels, fan).withColumn("all", F.lit("")))
    upper = _levels(ranked(subroots, "all", ["tree"]).select(
        F.col("all").alias("tree"), "size", F.col("rank").alias("lo"),
        (F.col("rank") + 1).alias("hi"), "digest", F.col("tree").alias("name"),
    ), fan)
    top = _tops(upper, fan).select("digest").first()
    root = F.lit(top["digest"] if top else None).cast("string")
    start = _tops(upper, fan).select(
        "tree", F.lit("").alias("subroot"), F.from_json(F.lit("[]"), _NO_PATH).alias("path")
    )
    tops = stored(_proofs(upper, start, fan).select(
        F.col("name").alias("tree"), F.col("digest").alias("subroot"), "path"
    ))
    fold = F.aggregate("path", F.col("folded"), lambda at, s: digest(s["left"], at, s["right"]))
    return _proofs(levels, tops, fan).select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", root.alias("root"), "path",
        fold.alias("folded_root"),
    )


def proof_digest(path: str = "path") -> Column:
    """One digest for a proof: all siblings level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def verified(documents: DataFrame) -> DataFrame:
    """The manifest, checked against rows of which every third has been tampered with.

    Where 3 divides the crc32 of the id's digits, the text is checked with its letters A-Z
    in lower case; a row without an id is checked as it is.
    """
    tampered = {"text": F.translate("text", _UPPER, _LOWER)}
    where = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return manifest(documents, changed=tampered, where=where).select(
        "doc_id", "leaf", "subroot", "root", proof_digest().alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )
