"""Chat formatting of reply trees, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

# The template's marks, and marks of other templates that a tokenizer may know.
START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL = (START, MIDDLE, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|system|>", "<|user|>", "<|assistant|>")


def _quoted(text: str) -> str:
    return "".join("\\" + c if c in r"\.[]{}()<>*+-=!?^$|/" else c for c in text)


def escape(text: Column) -> Column:
    """A backslash after the first character of each control string, and before each backslash; null is empty."""
    inside = "|".join(f"(?<={_quoted(c[0])})(?={_quoted(c[1:])})" for c in CONTROL)
    return F.regexp_replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\")), inside, r"\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def leaf_paths(nodes: DataFrame, top: int = 1) -> DataFrame:
    """(tree, leaf, node, depth, branch): the nodes of the ``top`` best root-to-leaf paths of each tree.

    ``nodes`` has tree, node, parent (null or unknown: a root) and score (null: 0). A path's score is
    the sum over its nodes; branches are ranked from 1 by it, ties by the leaf. Paths are found by
    iterative self-joins whose reach doubles: after round r each node knows its ancestor 2**r replies
    up and the score of the way there, so a tree of depth d takes log2(d) rounds. The chosen leaves
    are then spread over their ancestors by the same pointers, longest first. Nodes on a cycle have no
    root and appear on no path. Rows with a null tree or node are left out; of rows that share tree
    and node one is kept.
    """
    nodes = nodes.where("tree is not null and node is not null").dropDuplicates(["tree", "node"]).select("tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    known = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("there"))
    rows = nodes.join(known, ["tree", "parent"], "left").select("tree", "node", F.when(F.col("there"), F.col("parent")).alias("up"), "score", F.lit(1).cast("long").alias("depth"))
    levels = []
    rows = materialize(rows, "reply-pointers")
    leaves = nodes.select("tree", "node").join(nodes.select("tree", F.col("parent").alias("node")).where("node is not null").distinct(), ["tree", "node"], "left_anti")
    rounds, limit = 0, nodes.count()
    while rows.where("up is not null").head(1) and (1 << rounds) <= 2 * limit:
        levels.append(rows.where("up is not null").select("tree", "node", "up"))
        # Only rows that still point somewhere meet; finished ones are carried along.
        above = rows.select("tree", F.col("node").alias("up"), F.col("up").alias("next"), F.col("score").alias("more"), F.col("depth").alias("further"))
        moving = rows.where("up is not null").join(above, ["tree", "up"])
        moving = moving.select("tree", "node", F.col("next").alias("up"), (F.col("score") + F.col("more")).alias("score"), (F.col("depth") + F.col("further")).alias("depth"))
        rows = materialize(rows.where("up is null").unionByName(moving), "reply-pointers")
        rounds += 1
    order = Window.partitionBy("tree").orderBy(F.desc("score"), "node")
    chosen = rows.where("up is null").join(leaves, ["tree", "node"]).withColumn("branch", F.row_number().over(order)).where(F.col("branch") <= top)
    path = chosen.select("tree", F.col("node").alias("leaf"), "node", "depth", "branch")
    for r in reversed(range(len(levels))):
        step = path.join(levels[r], ["tree", "node"]).select("tree", "leaf", F.col("up").alias("node"), (F.col("depth") - (1 << r)).alias("depth"), "branch")
        path = materialize(path.unionByName(step), "reply-paths")
    return path


def format_conversations(turns: DataFrame, top: int = 1) -> DataFrame:
    """(tree, leaf, branch, formatted, loss): each of the ``top`` best branches of each tree as one conversation.

    ``turns`` has tree, node, parent, role, text and score, see leaf_paths. A turn becomes START role
    MIDDLE text END, with control strings in role and text escaped; null roles and texts are empty.
    ``loss`` lists the (begin, end) code points in ``formatted`` of the texts of assistants.
    """
    path = leaf_paths(turns, top)
    texts = turns.where("tree is not null and node is not null").dropDuplicates(["tree", "node"])
    texts = texts.select("tree", "node", escape(F.col("role")).alias("head"), escape(F.col("text")).alias("body"), F.coalesce(F.col("role") == "assistant", F.lit(False)).alias("learn"))
    rows = path.join(texts, ["tree", "node"])
    rows = rows.withColumn("piece", F.concat(F.lit(START), "head", F.lit(MIDDLE), "body", F.lit(END)))
    before = Window.partitionBy("tree", "leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("begin", F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0)) + F.length("head") + len(START + MIDDLE))
    rows = rows.withColumn("span", F.when(F.col("learn"), F.struct("begin", (F.col("begin") + F.length("body")).alias("end"))))
    whole = rows.groupBy("tree", "leaf", "branch").agg(F.sort_array(F.collect_list(F.struct("depth", "piece", "span"))).alias("rows"))
    return whole.select("tree", "leaf", "branch", F.array_join("rows.piece", "").alias("formatted"), F.filter("rows.span", lambda s: s.isNotNull()).alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds turns (role and text of each, unescaped) and learned (the texts under the loss mask, unescaped)."""
    turn = f"(?s){_quoted(START)}(.*?){_quoted(MIDDLE)}(.*?){_quoted(END)}"
    part = lambda n: F.transform(F.regexp_extract_all("formatted", F.lit(turn), F.lit(n)), unescape)
    turns = F.arrays_zip(part(1).alias("role"), part(2).alias("text"))
    learned = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["begin"].cast("int") + 1, (s["end"] - s["begin"]).cast("int"))))
    return formatted.withColumns({"turns": turns, "learned": learned})


def chained(conversations: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) as reply trees: each row answers the row before it.

    Rows are ordered by turn, ties by role and text, nulls first; so each conversation is one path.
    A row's score is the length of its text. Rows with a null conv_id are left out.
    """
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").alias("tree"), "turn", "role", "text")
    rows = rows.withColumn("node", F.row_number().over(order).cast("long"))
    return rows.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.length("text").alias("score"))


def digest(formatted: DataFrame) -> DataFrame:
    """Counts and digests of formatted conversations, taken from what can be read back from them."""
    rows = read_back(formatted)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return rows.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )
