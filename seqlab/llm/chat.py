"""Chat formatting of reply trees: paths from root to leaf, ranked by score, each written as one conversation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqlab.session import land

#: A turn is <s>[role]text</s>. The characters that control strings start or end with never occur inside: they are written as
#: these, the mark of an escape first.
ESCAPES = {"&": "&amp;", "<": "&lt;", "[": "&lb;", "]": "&rb;"}
TURN = r"<s>\[([^\]]*)\]([^<]*)</s>"


def escape(text: Column) -> Column:
    for plain, written in ESCAPES.items():
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for plain, written in reversed(ESCAPES.items()):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def reply_paths(messages: DataFrame, keep: int | None = 1) -> DataFrame:
    """(leaf, node, position) of the nodes on the chosen paths from root to leaf, position 0 at the root.

    ``messages`` has tree, node, parent and score. A node whose parent is null, unknown or itself is a root; the first of rows
    that repeat a node counts (smallest parent, nulls first), and a null node is none. Self-joins double the jumps to an ancestor until all
    reach a root, so a path of n messages takes log2(n) of them and no tree is gathered in one task. On the way the scores
    along the jump add up. The ``keep`` paths of a tree with the highest mean score stay, ties to the smaller leaf; all if
    ``keep`` is None. Only the chosen paths are listed, by the same jumps. Messages below a cycle have no root, and no path.
    """
    nodes = messages.where("node is not null").groupBy("node").agg(F.min(F.struct("parent", "tree", "score")).alias("m"))
    nodes = nodes.select("node", "m.parent", "m.tree", F.coalesce(F.col("m.score").cast("double"), F.lit(0.0)).alias("score"))
    nodes = land(nodes, "messages")
    known = nodes.select(F.col("node").alias("parent"), F.lit(True).alias("there"))
    up = F.when(F.col("there") & (F.col("parent") != F.col("node")), F.col("parent")).alias("to")
    linked = land(nodes.join(known, "parent", "left").select("node", up, "tree", "score", F.lit(1).cast("long").alias("steps")), "links")
    # A level holds the jumps of 2**k messages that there are; the others end at messages whose way to the root is known.
    levels, most = [linked.where("to is not null").drop("tree")], nodes.count()
    ended = linked.where("to is null").select("node", "score", "steps")
    while 2 ** (len(levels) - 1) <= most and not levels[-1].isEmpty():
        live = levels[-1]
        further = (F.col("score") + F.col("above")).alias("score"), (F.col("steps") + F.col("more")).alias("steps")
        on = live.select(F.col("node").alias("to"), F.col("to").alias("next"), F.col("score").alias("above"), F.col("steps").alias("more"))
        levels.append(land(live.join(on, "to").select("node", F.col("next").alias("to"), *further), "jumps"))
        rest = ended.select(F.col("node").alias("to"), F.col("score").alias("above"), F.col("steps").alias("more"))
        ended = ended.union(land(live.join(rest, "to").select("node", *further), "ended"))
    parents = linked.where("to is not null").select(F.col("to").alias("node")).distinct()
    leaves = ended.join(parents, "node", "left_anti").join(linked.select("node", "tree"), "node")
    leaves = leaves.select(F.col("node").alias("leaf"), "tree", (F.col("score") / F.col("steps")).alias("mean"), "steps")
    if keep is not None:
        best = Window.partitionBy("tree").orderBy(F.desc("mean"), "leaf")
        leaves = leaves.withColumn("place", F.row_number().over(best)).where(F.col("place") <= keep)
    listed = leaves.select("leaf", F.col("leaf").alias("node"), (F.col("steps") - 1).alias("position"))
    # The last level is empty. Lower ones fill what the higher have left: each node so far gives one that is 2**k above.
    for k, jump in reversed(list(enumerate(levels[:-1]))):
        listed = land(listed.union(listed.join(jump.select("node", "to"), "node").select("leaf", F.col("to").alias("node"), F.col("position") - 2**k)), "paths")
    return listed


def format_paths(paths: DataFrame, messages: DataFrame) -> DataFrame:
    """(leaf, tree, formatted, loss): the text of each path in the template, and the spans (start, length) of what is learned.

    ``messages`` has node, tree, role and text; the texts of the role assistant are learned. Spans count code points from 0 and
    cover escaped texts without the marks around them. A null role or text is empty.
    """
    said = messages.where("node is not null").groupBy("node").agg(F.min(F.struct("parent", "tree", "role", "text")).alias("m"))
    said = said.select("node", "m.tree", F.coalesce("m.role", F.lit("")).alias("role"), escape(F.coalesce("m.text", F.lit(""))).alias("body"))
    turns = paths.join(said, "node").withColumn("head", F.concat(F.lit("<s>["), escape(F.col("role")), F.lit("]")))
    turns = turns.withColumn("turn", F.concat("head", "body", F.lit("</s>")))
    before = Window.partitionBy("leaf").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("turn").cast("long")).over(before), F.lit(0)) + F.length("head")
    span = F.when(F.col("role") == "assistant", F.struct(start.alias("start"), F.length("body").cast("long").alias("length")))
    whole = turns.withColumn("span", span).groupBy("leaf").agg(F.min("tree").alias("tree"), F.array_sort(F.collect_list(F.struct("position", "turn", "span"))).alias("turns"))
    loss = F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull())
    return whole.select("leaf", "tree", F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"), loss.alias("loss"))


def format_trees(messages: DataFrame, keep: int | None = 1) -> DataFrame:
    """The formatted chosen paths of reply trees ``messages`` (tree, node, parent, role, text, score); other columns are ignored.

    One formatted path is one value, so a path has to fit a row. An empty table gives an empty table.
    """
    messages = messages.select("tree", "node", "parent", "role", "text", "score")
    return format_paths(reply_paths(messages, keep), messages)


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds, unescaped."""
    roles, bodies = (F.regexp_extract_all(formatted, F.lit(TURN), F.lit(k)) for k in (1, 2))
    return F.zip_with(roles, bodies, lambda r, b: F.struct(unescape(r).alias("role"), unescape(b).alias("text")))


def as_trees(conversations: DataFrame) -> DataFrame:
    """Reply trees of ``conversations`` (conv_id, turn, role, text): each row answers the one before it by turn, then role and text,
    nulls first. Equal rows are told apart by a number. Rows without a conv_id are one conversation."""
    same = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("tie", F.row_number().over(same))
    node = F.to_json(F.struct("conv_id", "turn", "tie"))
    chain = Window.partitionBy("conv_id").orderBy("turn", "tie")
    keyed = rows.select(F.col("conv_id").alias("tree"), "turn", "tie", "role", "text", node.alias("node"))
    parents = rows.select(node.alias("node"), F.lag(node).over(chain).alias("parent"))
    return keyed.join(parents, "node").select("tree", "node", "parent", "role", "text", F.lit(None).cast("double").alias("score"))


def conversation_digests(conversations: DataFrame) -> DataFrame:
    """Every conversation formatted, and what is read back from it.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of ``conversations`` (conv_id, turn, role, text;
    other columns are ignored). A null role or text is empty; repeated rows are turns of their own. An empty table gives an
    empty table.
    """
    made = format_trees(as_trees(conversations), keep=1)
    turns = read_turns(F.col("formatted"))
    told = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
    read = made.select(F.col("tree").alias("conv_id"), turns.alias("turns"), told.alias("told"), learned.alias("learned"), F.length("formatted").cast("long").alias("formatted_chars"))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2("told", 256).alias("turns_sha256"), F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"), "formatted_chars"
    )
