"""Chat formatting of reply trees, with DataFrame operations only.

Messages name their parent, by ids in any order. Root-to-leaf paths are enumerated by self-joins that double the
distance: the jump table gives each message's ancestor at distance 2^k and is joined with
itself, and every path found so far is lengthened by it, so a chain of n replies takes log2(n)
rounds. Branches are ranked by the sum of their messages' scores (ties: the smaller leaf) and
each chosen path becomes one conversation.

The template is ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn. Inside texts and roles a
backslash becomes ``\\0``, ``<|`` becomes ``<\\1`` and, in roles, a new line becomes ``\\2``: no
control string is left there, and ``unescaped`` gives the original back. The loss mask covers
each assistant text and nothing else.

Defined results: a null text or role is empty, a null score 0; a null conversation id is a
conversation like others; rows without a node are left out; a message whose parent doesn't exist
is a root; of messages that answer each other in a cycle the one with the smallest id is a root.
Rows that repeat count once. Different messages under one id of a conversation are kept, as answers
to the same parent: replies to that id belong to the first in order of (role, text, score, parent), the others are
leaves, told apart by ``variant``. Equal scores are ranked by the smaller leaf. Texts of any length
are taken whole; no rows give no conversations; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import checkpointed

START, END = "<|im_start|>", "<|im_end|>\n"


def escaped(text: Column, role: bool = False) -> Column:
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\0")), F.lit("<|"), F.lit("<\\1"))
    return F.replace(out, F.lit("\n"), F.lit("\\2")) if role else out


def unescaped(text: Column) -> Column:
    out = F.replace(F.replace(text, F.lit("\\2"), F.lit("\n")), F.lit("<\\1"), F.lit("<|"))
    return F.replace(out, F.lit("\\0"), F.lit("\\"))


def linear(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Conversations without branches as reply trees: each turn answers the one before; equal turns stand in order of role and text."""
    own = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    node = F.row_number().over(Window.partitionBy("conv").orderBy("turn", "role", "text"))
    return own.select("conv", node.cast("long").alias("node"), F.when(node > 1, node - 1).cast("long").alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def _on(a: str, b: str, node_a: str = "node", node_b: str = "node") -> Column:
    return F.col(f"{a}.conv").eqNullSafe(F.col(f"{b}.conv")) & (F.col(f"{a}.{node_a}") == F.col(f"{b}.{node_b}"))


def _squared(jump: DataFrame) -> DataFrame:
    """Jumps twice as far; nodes that have no ancestor at that distance drop out."""
    return jump.alias("a").join(jump.alias("b"), _on("a", "b", "to")).select("a.conv", "a.node", F.col("b.to").alias("to"))


def without_cycles(edges: DataFrame) -> DataFrame:
    """``edges`` (conv, node, to), one for each node, without those that start at the smallest node of a cycle.

    A cycle has an edge to a node that isn't smaller; where there is none, nothing is done. Jumps that
    double find the nodes without a root (their number stops shrinking) and then those on cycles
    (the jumps' ends stop shrinking, too); the smallest node ahead is found by doubling as well.
    """
    if edges.filter("to >= node").isEmpty():
        return edges
    jump, last = edges, (-1, -1)
    while True:
        here = jump.agg(F.count(F.lit(1)), F.count_distinct(F.struct("conv", "to"))).first()
        if not here[0]:
            return edges
        if tuple(here) == last:
            break
        last = tuple(here)
        jump = checkpointed(_squared(jump))
    ring = jump.select("conv", F.col("to").alias("node")).distinct()
    jump = checkpointed(edges.alias("a").join(ring.alias("b"), _on("a", "b"), "left_semi").withColumn("least", F.least("node", "to")))
    while not jump.alias("a").join(jump.alias("b"), _on("a", "b", "to")).filter("a.least <> b.least").isEmpty():
        jump = checkpointed(jump.alias("a").join(jump.alias("b"), _on("a", "b", "to")).select("a.conv", "a.node", F.col("b.to").alias("to"), F.least("a.least", "b.least").alias("least")))
    cut = jump.filter("node = least").select("conv", "node")
    return checkpointed(edges.alias("a").join(cut.alias("b"), _on("a", "b"), "left_anti"))


def paths(messages: DataFrame) -> DataFrame:
    """``messages`` (conv, node, parent, ...) -> (conv, leaf, node, up): every leaf's ancestors, itself included, ``up`` replies above it."""
    nodes = checkpointed(messages.filter("node is not null").groupBy("conv", "node").agg(F.min("parent").alias("parent")))
    jump = nodes.alias("a").join(nodes.select("conv", "node").alias("b"), _on("a", "b", "parent")).select("a.conv", "a.node", F.col("a.parent").alias("to"))
    jump = without_cycles(checkpointed(jump))
    inner = jump.select("conv", F.col("to").alias("node")).distinct()
    leaves = nodes.alias("a").join(inner.alias("b"), _on("a", "b"), "left_anti").select("a.conv", "a.node")
    found = checkpointed(leaves.select("conv", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")))
    step = 1
    while not jump.isEmpty():
        longer = found.alias("a").join(jump.alias("b"), _on("a", "b")).select("a.conv", "a.leaf", F.col("b.to").alias("node"), (F.col("a.up") + step).alias("up"))
        found = checkpointed(found.unionByName(longer))
        jump = checkpointed(_squared(jump))
        step *= 2
    return found


def format_trees(messages: DataFrame, top: int | None = None) -> DataFrame:
    """``messages`` (conv, node, parent, role, text, score) -> (conv, leaf, variant, branch, score, formatted, loss_spans).

    ``branch`` ranks a conversation's paths from 1; ``top`` keeps so many, ranked before any text is
    formatted. ``loss_spans`` are [start, end) in code points of ``formatted``.
    """
    own = messages.filter("node is not null").select("conv", "node", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("score", F.lit(0.0)).alias("score"), "parent")
    one = own.groupBy("conv", "node").agg(F.array_sort(F.collect_set(F.struct("role", "text", "score", "parent"))).alias("all"))  # as many as an id has messages
    each = one.select("conv", "node", F.posexplode("all").alias("variant", "m"))
    point = F.struct(F.col("node"), F.col("variant"))
    whole = checkpointed(each.select("conv", point.alias("node"), F.when(F.col("m.parent").isNotNull(), F.struct(F.col("m.parent").alias("node"), F.lit(0).alias("variant"))).alias("parent"), "m.role", "m.text", "m.score"))
    p = paths(whole.select("conv", "node", "parent"))
    scores = p.alias("a").join(whole.select("conv", "node", "score").alias("b"), _on("a", "b")).groupBy("a.conv", "a.leaf").agg(F.sum("b.score").alias("score"))
    ranked = scores.withColumn("branch", F.row_number().over(Window.partitionBy("conv").orderBy(F.desc("score"), "leaf")))
    if top is not None:
        ranked = checkpointed(ranked.filter(F.col("branch") <= top))
        p = p.alias("a").join(ranked.alias("b"), _on("a", "b", "leaf", "leaf"), "left_semi")
    body = whole.select("conv", "node", "role", F.concat(F.lit(START), escaped(F.col("role"), True), F.lit("\n")).alias("head"), escaped(F.col("text")).alias("body"))
    rows = p.alias("a").join(body.alias("b"), _on("a", "b")).select("a.conv", "a.leaf", "a.up", "b.role", "b.head", "b.body")
    line = Window.partitionBy("conv", "leaf").orderBy(F.desc("up"))
    rows = rows.withColumn("to", F.sum(F.length("head") + F.length("body") + len(END)).over(line))
    end = F.col("to") - len(END)
    turn = F.struct((-F.col("up")).alias("at"), F.concat("head", "body", F.lit(END)).alias("piece"), (end - F.length("body")).alias("start"), end.alias("end"), (F.col("role") == "assistant").alias("loss"))
    joined = rows.groupBy("conv", "leaf").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    out = joined.alias("a").join(ranked.alias("b"), _on("a", "b", "leaf", "leaf"))
    return out.select(
        "a.conv",
        "a.leaf.node",
        "a.leaf.variant",
        "b.branch",
        "b.score",
        F.array_join(F.col("turns.piece"), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"))).alias("loss_spans"),
    ).withColumnRenamed("node", "leaf")


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""

    def turn(x: Column) -> Column:
        role = F.substring_index(x, "\n", 1)
        text = x.substr(F.length(role) + 2, F.length(x) - F.length(role) - 1 - len(END))
        return F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"))

    pieces = F.split(formatted, "\\Q" + START + "\\E")
    return F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescaped(formatted.substr(s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int")))), "")
