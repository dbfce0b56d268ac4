"""Chat formatting of reply trees; DataFrame functions only.

A tree is rows (tree_id, node_id, parent_id, role, text, score); a node whose parent is null or not in the tree is a
root. Iterative self-joins enumerate root-to-leaf paths: pointers to ancestors double their reach each round, so a tree
of depth d takes log2(d) rounds. The first rounds add up the scores along each leaf's path and find its root; leaves are
ranked within their tree by mean score (ties: shorter path, then the leaf's id); the chosen leaves' paths are then
listed and each is formatted as one conversation:

    <|im_start|>role\\ntext<|im_end|>\\n

In texts and roles `\\` is written `\\\\` and `<|` is written `<\\|`, in roles a line break is preceded by `\\` too;
dropping each escaping backslash gives the text back. `loss_spans` are the places (code points, from 0) of the texts of
assistant turns in the formatted string.

Defined results: null roles and texts are empty, null scores 0; a null tree or node id counts as the smallest one;
rows that repeat a node are turns of their own, in the order of role, text and score, each a reply to the one before;
nodes on a cycle, or below one, lie on no path from a root and are in no conversation; other columns play no part; an
empty table gives no conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from triplake.llm.shared import NULL_ID, known_id, public_id, stored

START, END = "<|im_start|>", "<|im_end|>\n"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\\n"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _distinct_nodes(nodes: DataFrame) -> DataFrame:
    """_tree, _id, _parent, role, text, score with one row for each _id.

    _id is a struct of the node id and the number among rows that repeat it; replies to a repeated node go to the last.
    """
    rows = nodes.select(known_id("tree_id").alias("_tree"), known_id("node_id").alias("_node"), F.col("parent_id").cast("long").alias("_up"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    same = Window.partitionBy("_tree", "_node")
    rows = rows.withColumns({"_k": F.row_number().over(same.orderBy("role", "text", "score")), "_of": F.count(F.lit(1)).over(same)})
    last = rows.where("_k = _of").select("_tree", F.col("_node").alias("_up"), F.struct(F.col("_up").alias("node"), F.col("_k").alias("k")).alias("_p"))
    last = last.withColumn("_p", F.struct(F.col("_up").alias("node"), F.col("_p.k").alias("k")))
    rows = rows.join(last, ["_tree", "_up"], "left")
    own = F.struct(F.col("_node").alias("node"), F.col("_k").alias("k"))
    before = F.struct(F.col("_node").alias("node"), (F.col("_k") - 1).alias("k"))
    return rows.select("_tree", own.alias("_id"), F.when(F.col("_k") > 1, before).otherwise(F.col("_p")).alias("_parent"), "role", "text", "score")


def _jumps(nodes: DataFrame) -> list[DataFrame]:
    """Tables (_tree, _id, _far, _sum, _steps): 2^i steps up from _id is _far, passing scores _sum; while any has so many."""
    out = [stored(nodes.where("_parent is not null").select("_tree", "_id", F.col("_parent").alias("_far"), F.col("score").alias("_sum")))]
    # 2^i steps that stay within the tree exist only while i < log2(rows), unless there is a cycle.
    most = max(1, nodes.count()).bit_length()
    while out[-1].limit(1).count() and len(out) <= most:
        last = out[-1]
        on = last.select("_tree", F.col("_id").alias("_far"), F.col("_far").alias("_next"), F.col("_sum").alias("_more"))
        out.append(stored(last.join(on, ["_tree", "_far"]).select("_tree", "_id", F.col("_next").alias("_far"), (F.col("_sum") + F.col("_more")).alias("_sum"))))
    return out


def paths(nodes: DataFrame, best: int | None = None) -> DataFrame:
    """(_tree, leaf, rank, depth, role, text) of the turns on every chosen root-to-leaf path; best: leaves kept a tree."""
    nodes = stored(_distinct_nodes(nodes))
    jumps = _jumps(nodes)
    leaves = nodes.join(nodes.select("_tree", F.col("_parent").alias("_id")).where("_id is not null"), ["_tree", "_id"], "left_anti")
    # Up from each leaf by falling powers of two: its root, path length and sum of scores.
    up = leaves.select("_tree", F.col("_id").alias("leaf"), F.col("_id").alias("_at"), F.lit(0.0).alias("_sum"), F.lit(0).cast("long").alias("_steps"))
    for i in reversed(range(len(jumps))):
        jump = jumps[i].select("_tree", F.col("_id").alias("_at"), F.col("_far"), F.col("_sum").alias("_more"))
        up = up.join(jump, ["_tree", "_at"], "left").select("_tree", "leaf", F.coalesce("_far", "_at").alias("_at"), (F.col("_sum") + F.coalesce("_more", F.lit(0.0))).alias("_sum"), (F.col("_steps") + F.when(F.col("_far").isNotNull(), 1 << i).otherwise(0)).alias("_steps"))
    roots = nodes.where("_parent is null").select("_tree", F.col("_id").alias("_at"), F.col("score").alias("_first"))
    up = stored(up.join(roots, ["_tree", "_at"]))
    mean = (F.col("_sum") + F.col("_first")) / (F.col("_steps") + 1)
    order = Window.partitionBy("_tree").orderBy(mean.desc(), "_steps", "leaf")
    chosen = up.withColumn("rank", F.row_number().over(order))
    chosen = chosen if best is None else chosen.where(F.col("rank") <= best)
    # Every node of a chosen path: those within 2^i - 1 steps of the leaf, then as many again.
    on_path = chosen.select("_tree", "leaf", "rank", F.col("leaf").alias("_id"), F.col("_steps").alias("depth"))
    for i, jump in enumerate(jumps):
        more = on_path.join(jump.select("_tree", "_id", "_far"), ["_tree", "_id"]).select("_tree", "leaf", "rank", F.col("_far").alias("_id"), (F.col("depth") - (1 << i)).alias("depth"))
        on_path = stored(on_path.unionByName(more))
    return on_path.join(nodes, ["_tree", "_id"]).select("_tree", "leaf", "rank", "depth", "role", "text")


def format_paths(turns: DataFrame) -> DataFrame:
    """tree_id, leaf_id, rank, formatted and loss_spans of paths()."""
    written = turns.select("_tree", "leaf", "rank", F.struct("depth", F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n")).alias("head"), escaped(F.col("text")).alias("body"), (F.col("role") == "assistant").alias("loss")).alias("turn"))
    grouped = written.groupBy("_tree", "leaf", "rank").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        begin = acc["at"] + F.length(t["head"])
        end = begin + F.length(t["body"])
        span = F.struct(begin.alias("start"), end.alias("end"))
        return F.struct((end + len(END)).alias("at"), F.when(t["loss"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    spans = F.aggregate("turns", start, step, lambda acc: acc["spans"])
    return grouped.select(public_id("_tree").alias("tree_id"), F.when(F.col("leaf.node") != NULL_ID, F.col("leaf.node")).alias("leaf_id"), "rank", formatted.alias("formatted"), spans.alias("loss_spans"))


def format_trees(nodes: DataFrame, best: int | None = 1) -> DataFrame:
    """The best-ranked paths of every tree, formatted."""
    return format_paths(paths(nodes, best))


def parsed(formatted: Column) -> Column:
    """array<struct<role, text>> read back from a formatted conversation."""
    turns = F.split(formatted, r"<\|im_end\|>\n")

    def one(t: Column) -> Column:
        role = F.regexp_extract(t, r"(?s)^<\|im_start\|>((?:[^\\\n]|\\.)*+)\n", 1)
        text = F.substr(t, F.length(role) + F.lit(len(START) + 2))
        return F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"))

    return F.transform(F.slice(turns, 1, F.size(turns) - 1), one)


def loss_text(formatted: Column, spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substr(formatted, s["start"] + 1, s["end"] - s["start"]))), "")


def chains(conversations: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as trees: each turn answers the one before; rows of one turn go by role and text."""
    one = Window.partitionBy(known_id("conv_id")).orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = conversations.select("conv_id", "role", "text", F.row_number().over(one).cast("long").alias("node_id"))
    return rows.select(F.col("conv_id").alias("tree_id"), "node_id", F.when(F.col("node_id") > 1, F.col("node_id") - 1).alias("parent_id"), "role", "text", F.lit(0.0).alias("score"))
