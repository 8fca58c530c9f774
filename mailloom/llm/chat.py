"""Chat formatting of reply trees, with DataFrame functions only.

Messages name the message they reply to. Rounds of self-joins make jump tables: the
message 1, 2, 4, ... replies up. From every leaf the jumps are taken from the longest to
the shortest, each round adding for every message found so far the one a jump further up;
after them every leaf has its whole path to the root, in a number of rounds that grows
with the logarithm of the depth. The branches of a tree are ranked by the mean score of
their messages, and each chosen one is written as one conversation.

The template is ``<|im_start|>role``, a line break, the text, ``<|im_end|>`` and a line
break. Control strings inside roles and texts are escaped: the first character of each is
replaced by a backslash and a letter, and a backslash by ``\\b``, so that no control
string stands inside a text and each text can be read back. The loss mask lists start
and length, in code points of the formatted text, of every assistant text.

Nulls, ties and odd rows: null texts and roles are empty. In :func:`chains`, rows of a
conversation are ordered by turn, role and text, null turns first; rows that repeat are
messages of their own; a null conversation is one of its own. In trees, a reply to a
message that does not exist starts a tree; replies in a circle raise an error. Branches
with equal scores rank by their leaf's id. Extra columns are passed over. Empty tables
give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailloom.llm.common import stored

#: Fixed values of the template.
START, END = "<|im_start|>", "<|im_end|>\n"

#: Strings that no text may hold as they are, and what they become.
ESCAPES = [
    ("\\", "\\b"),
    ("<|", "\\l|"), ("<s>", "\\ls>"), ("</s>", "\\l/s>"),
    ("<<SYS>>", "\\l<SYS>>"), ("<</SYS>>", "\\l</SYS>>"),
    ("[INST]", "\\iINST]"), ("[/INST]", "\\i/INST]"),
]


def escaped(text) -> Column:
    for plain, safe in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescaped(text) -> Column:
    for safe, plain in (("\\l", "<"), ("\\i", "["), ("\\n", "\n"), ("\\b", "\\")):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def escaped_role(role) -> Column:
    """A role is one line."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def chains(conversations: DataFrame) -> DataFrame:
    """Rows of conversations as messages, each a reply to the one before it."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    place = F.row_number().over(order).cast("long")
    return conversations.select(
        F.col("conv_id").alias("tree"), place.alias("message"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("reply_to", F.when(F.col("message") > 1, F.col("message") - 1)).withColumn(
        "score", F.lit(0.0)
    )


def paths(messages: DataFrame) -> DataFrame:
    """``(tree, leaf, message, up)``: the messages of every path, ``up`` replies above its leaf.

    ``messages`` has ``tree, message, reply_to``; a message is known by its tree and id.
    """
    nodes = stored(messages.select(
        F.struct("tree", "message").alias("node"),
        F.when(F.col("reply_to").isNotNull(), F.struct("tree", F.col("reply_to").alias("message")))
        .alias("above"),
    ).distinct())
    known = nodes.select(F.col("node").alias("above"))
    # The jump of one reply; a message that replies to nothing there is, is a root.
    jump = stored(_meet(nodes.where("above is not null"), known, "above").select("node", "above"))
    replied = jump.select(F.col("above").alias("node")).distinct()
    leaves = _meet(nodes.select("node"), replied, "node", "left_anti")
    found = stored(leaves.select(
        F.col("node.tree").alias("tree"), F.col("node.message").alias("leaf"), "node",
        F.lit(0).cast("long").alias("up"),
    ))

    jumps, many = [], nodes.count()
    while not jump.isEmpty():
        if 2 ** len(jumps) > many:
            raise ValueError("messages reply to each other in a circle")
        jumps.append(jump)
        further = jump.select(F.col("node").alias("above"), F.col("above").alias("next"))
        jump = stored(_meet(jump, further, "above").select("node", F.col("next").alias("above")))

    for k in range(len(jumps) - 1, -1, -1):
        more = _meet(found, jumps[k], "node").select(
            "tree", "leaf", F.col("above").alias("node"), (F.col("up") + 2**k).alias("up")
        )
        found = stored(found.unionByName(more))
    return found.select("tree", "leaf", F.col("node.message").alias("message"), "up")


def _meet(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on a struct of a tree, which may be null, and a message."""
    named = right.withColumnRenamed(key, "_key")
    same = F.coalesce(F.col(f"{key}.tree").cast("string"), F.lit("")) == F.coalesce(
        F.col("_key.tree").cast("string"), F.lit("")
    )
    # The plain parts are what the rows are dealt out by; nulls are told apart after.
    match = (F.col(f"{key}.message") == F.col("_key.message")) & same & (
        F.isnull(f"{key}.tree") == F.isnull("_key.tree")
    )
    joined = left.join(named, match, how)
    return joined if how == "left_anti" else joined.drop("_key")


def branches(messages: DataFrame, best: int | None = None) -> DataFrame:
    """``(tree, leaf, place, turns)``: the paths of a tree in order of their mean score.

    ``turns`` are the path's roles and texts from the root on. ``best`` keeps as many
    paths of each tree.
    """
    found = paths(messages).withColumnRenamed("message", "_message").withColumnRenamed("tree", "_tree")
    told = messages.select("tree", "message", "role", "text", "score")
    walked = told.join(
        found, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("message") == F.col("_message"))
    )
    whole = walked.groupBy("tree", "leaf").agg(
        F.avg("score").alias("score"),
        F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("n"), "role", "text"))).alias("turns"),
    )
    place = F.row_number().over(
        Window.partitionBy("tree").orderBy(F.col("score").desc_nulls_last(), "leaf")
    )
    ranked = whole.withColumn("place", place)
    if best is not None:
        ranked = ranked.where(F.col("place") <= best)
    return ranked.select("tree", "leaf", "place", "turns")


def formatted(chosen: DataFrame) -> DataFrame:
    """``chosen`` with ``formatted`` and ``loss``, the mask, for its ``turns``."""
    pieces = F.transform("turns", lambda turn: F.struct(
        F.concat(F.lit(START), escaped_role(turn["role"]), F.lit("\n")).alias("head"),
        escaped(turn["text"]).alias("body"), turn["role"].alias("role"),
    ))
    # Each piece starts where the lengths of those before it end.
    begun = F.aggregate(
        "_pieces",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("starts")),
        lambda done, piece: F.struct(
            (done["at"] + F.length(piece["head"]) + F.length(piece["body"]) + len(END)).alias("at"),
            F.concat(done["starts"], F.array(done["at"])).alias("starts"),
        ),
        lambda done: done["starts"],
    )
    spans = F.zip_with("_pieces", "_starts", lambda piece, start: F.struct(
        piece["role"].alias("role"),
        (start + F.length(piece["head"])).alias("start"),
        F.length(piece["body"]).cast("long").alias("length"),
    ))
    loss = F.transform(
        F.filter(spans, lambda span: span["role"] == "assistant"),
        lambda span: F.struct(span["start"].alias("start"), span["length"].alias("length")),
    )
    text = F.array_join(
        F.transform("_pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), ""
    )
    return (
        chosen.withColumn("_pieces", pieces).withColumn("_starts", begun)
        .withColumn("formatted", text).withColumn("loss", loss).drop("_pieces", "_starts")
    )


def read_turns(text: str) -> Column:
    """Roles and texts of a formatted conversation."""
    pieces = F.filter(F.split(F.col(text), r"<\|im_end\|>\n"), lambda p: p != "")

    def turn(piece):
        plain = F.substr(piece, F.lit(len(START) + 1))
        role = F.substring_index(plain, "\n", 1)
        return F.struct(
            unescaped(role).alias("role"),
            unescaped(F.substr(plain, F.length(role) + 2)).alias("text"),
        )

    return F.transform(pieces, turn)


def read_loss(text: str, loss: str) -> Column:
    """The texts under the loss mask, as they were before they were escaped."""
    return F.transform(F.col(loss), lambda span: unescaped(
        F.substr(F.col(text), (span["start"] + 1).cast("int"), span["length"].cast("int"))
    ))
