"""Chat formatting of reply trees.

Root-to-leaf paths are enumerated by iterative self-joins: jump tables hold each message's 2^k-th ancestor, and each leaf's
set of ancestors doubles with every join, so a thread of n turns takes about log2(n) joins. Branches are ranked by
score, and each chosen path becomes one conversation in a template whose control strings cannot occur in texts.

A turn is ``<s>`` role ``[INST]`` text ``</s>``. Inside roles and texts a backslash is doubled, and a control string gets
one after its first character; reading back takes a backslash away before whatever follows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windgrid.llm.common import stored

# The template's control strings, and others that are masked with them.
OPEN, SPLIT, CLOSE = "<s>", "[INST]", "</s>"
CONTROL = r"(<)(/?s>|<SYS>>|</SYS>>|\|[a-z_]+\|>)|(\[)(/?INST\])"


def escape(text: Column) -> Column:
    """Null counts as empty."""
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, CONTROL, "$1$3\\\\$2$4")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def linear_messages(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A tree without branches from rows by turn: tree, id, parent, score, role, text. Rows of equal turn follow by
    role and text, so repeated rows are turns of their own. Null conversation ids form one conversation."""
    order = Window.partitionBy("tree").orderBy("_turn", F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))
    rows = conversations.select(F.col(conv_id).alias("tree"), F.col(turn).alias("_turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    at = F.row_number().over(order).cast("long")
    return rows.select("tree", at.alias("id"), F.lit(0.0).alias("score"), "role", "text").withColumn(
        "parent", F.when(F.col("id") > 1, F.col("id") - 1)
    )


def paths(messages: DataFrame, most_levels: int = 40) -> DataFrame:
    """tree, leaf, id: every leaf with all messages on its way from the root, leaf included.

    ``messages`` has tree, id, parent; (tree, id) is unique. A parent that is missing, not in the tree, or not smaller
    than its reply makes the reply a root, so cycles cannot arise. Only ids travel through the joins.
    """
    nodes = messages.select("tree", "id", "parent")
    there = nodes.select(F.col("tree").alias("_t"), F.col("id").alias("_p"))
    linked = nodes.join(there, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("parent") == F.col("_p")) & (F.col("parent") < F.col("id")))
    jump = stored(linked.select("tree", "id", F.col("_p").alias("up")), "jump")
    jumps = [jump]
    while len(jumps) < most_levels:
        last = jumps[-1]
        again = last.select(F.col("tree").alias("_t"), F.col("id").alias("_id"), F.col("up").alias("_up"))
        further = last.join(again, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("up") == F.col("_id"))).select("tree", "id", F.col("_up").alias("up"))
        further = stored(further, "jump")
        if further.isEmpty():
            break
        jumps.append(further)
    replied = jump.select(F.col("tree").alias("_t"), F.col("up").alias("_up")).distinct()
    leaves = nodes.join(replied, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("id") == F.col("_up")), "left_anti")
    found = leaves.select("tree", F.col("id").alias("leaf"), "id")
    for jump in reversed(jumps):
        step = jump.select(F.col("tree").alias("_t"), F.col("id").alias("_id"), "up")
        more = found.join(step, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("id") == F.col("_id"))).select("tree", "leaf", F.col("up").alias("id"))
        # Stored, as the plan would double with every level.
        found = stored(found.unionByName(more), "paths")
    return found


def format_paths(messages: DataFrame, best: int = 1, target_role: str = "assistant") -> DataFrame:
    """One row per chosen path: tree, leaf, rank, path_score, n_turns, formatted, loss_spans.

    ``messages`` has tree, id, parent, score, role, text. A path's score is the sum over its messages (null: 0); the
    ``best`` highest of each tree are kept, ties to the smaller leaf. ``loss_spans`` are (start, length) in code points of
    the formatted text, one for each turn of ``target_role``, covering its escaped text. An empty table gives no rows.
    """
    steps = paths(messages).select(F.col("tree").alias("_t"), F.col("leaf"), F.col("id").alias("_id"))
    scored = messages.select("tree", "id", F.coalesce(F.col("score"), F.lit(0.0)).alias("score"))
    on = F.col("tree").eqNullSafe(F.col("_t")) & (F.col("id") == F.col("_id"))
    branches = steps.join(scored, on).groupBy("tree", "leaf").agg(F.sum("score").alias("path_score"))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("path_score"), "leaf"))
    chosen = branches.withColumn("rank", rank).filter(F.col("rank") <= best)
    chosen = chosen.select(F.col("tree").alias("_c"), F.col("leaf").alias("_leaf"), "rank", "path_score")
    kept = steps.join(chosen, F.col("_t").eqNullSafe(F.col("_c")) & (F.col("leaf") == F.col("_leaf"))).select("_t", "leaf", "_id", "rank", "path_score")
    turns = kept.join(messages.select("tree", "id", "role", "text"), on).withColumns({"_role": escape(F.col("role")), "_text": escape(F.col("text"))})
    turns = turns.withColumn("_turn", F.concat(F.lit(OPEN), "_role", F.lit(SPLIT), "_text", F.lit(CLOSE)))
    before = Window.partitionBy("tree", "leaf").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("_turn")).over(before), F.lit(0)) + len(OPEN) + F.length("_role") + len(SPLIT)
    turns = turns.withColumn("_span", F.when(F.col("role") == target_role, F.struct(start.cast("long").alias("start"), F.length("_text").cast("long").alias("length"))))
    gathered = turns.groupBy("tree", "leaf", "rank", "path_score").agg(F.array_sort(F.collect_list(F.struct("id", "_turn", "_span"))).alias("_turns"))
    return gathered.select(
        "tree",
        "leaf",
        "rank",
        "path_score",
        F.size("_turns").cast("long").alias("n_turns"),
        F.array_join(F.col("_turns._turn"), "").alias("formatted"),
        F.filter(F.col("_turns._span"), lambda s: s.isNotNull()).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The (role, text) pairs of a formatted conversation."""
    pieces = F.filter(F.split(formatted, CLOSE), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescape(F.substr(F.substring_index(p, SPLIT, 1), F.lit(len(OPEN) + 1))).alias("role"),
            unescape(F.substr(p, F.length(F.substring_index(p, SPLIT, 1)) + len(SPLIT) + 1)).alias("text"),
        ),
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
