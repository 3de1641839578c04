"""Reply trees as conversations.

Messages form trees: each names the message it answers. Paths from roots to leaves are found
by self-joins that double the reach of every message's pointer in each round, so a tree of
depth d takes log2(d) rounds. The rounds also add up scores; leaves are ranked by the score of
their path, and each chosen path is written as one conversation.

Scale. A round joins the messages still on the way with all by message; nothing is collected
but whether any are left. Chosen paths are read back with the same pointers: a
round doubles the part of each path that is known, so the rows are those of the paths, never
all pairs of ancestors. A conversation's text must meet in one task, as it is one string.

Template. ``<|im_start|>role\\ntext<|im_end|>\\n`` for each message. Inside roles and texts a
backslash is doubled and ``<|`` becomes ``<\\|``, so no text can look like a mark, and undoing
the two steps in the other order gives the text back. In roles a line feed becomes ``\\n``
written with a backslash. The loss mask covers the texts of the assistant's messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxoffice.session import stable

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    def plain(part: Column) -> Column:
        return F.replace(F.replace(part, F.lit("<\\|"), F.lit("<|")), F.lit("\\n"), F.lit("\n"))

    # Split at doubled backslashes, so that one of them is never taken for that of "\\n".
    return F.array_join(F.transform(F.split(role, r"\\\\"), plain), "\\")


def _jumps(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Pointer tables by round, and for each message its depth, root and path score.

    Table k leads from a message to its ancestor 2^k steps up. A round joins and writes only
    the messages that have not met their root, so a few deep trees cost no round of the rest.
    """
    going = stable(
        nodes.select(
            "tree",
            "node",
            F.col("parent").alias("up"),
            F.when(F.col("parent").isNull(), F.lit(0)).otherwise(F.lit(1)).cast("long").alias("depth"),
            F.col("score"),
            F.col("node").alias("last"),
        )
    )
    tables, total = [], going.count()
    reached = going.where("up is null")
    while True:
        going = going.where("up is not null")
        # Who has not met a root after as many steps as there are messages hangs on a ring.
        if (1 << len(tables)) > 2 * total or going.isEmpty():
            return tables, reached
        tables.append(going.select("tree", "node", "up"))
        above = reached.unionByName(going).select(
            F.col("tree").alias("a_tree"),
            F.col("node").alias("a_node"),
            F.col("up").alias("a_up"),
            F.col("depth").alias("a_depth"),
            F.col("score").alias("a_score"),
        )
        met = (F.col("tree") == F.col("a_tree")) & (F.col("up") == F.col("a_node"))
        going = stable(
            going.join(above, met).select(
                "tree",
                "node",
                F.col("a_up").alias("up"),
                # What lies above the pointer has been counted by the message it leads to.
                (F.col("depth") + F.col("a_depth")).alias("depth"),
                (F.col("score") + F.col("a_score")).alias("score"),
                "last",
            )
        )
        reached = reached.unionByName(going.where("up is null"))


def reply_paths(messages: DataFrame, paths_per_tree: int = 1) -> DataFrame:
    """The messages on each tree's best paths: tree, path, path_score, position, node.

    ``messages`` has tree, node, parent, score. A path runs from a root (no parent, or one
    that is not there) to a leaf; its score is the sum of its messages' scores (null is 0),
    ties go to the deeper leaf, then the smaller one. Messages with a null tree or node are
    left out; of rows with equal tree and node one counts (smallest parent, then score).
    Messages that answer each other in a ring have no root and belong to no path.
    """
    known = messages.where("tree is not null and node is not null")
    known = known.groupBy("tree", "node").agg(
        F.min(F.struct("parent", F.coalesce("score", F.lit(0.0)).alias("score"))).alias("m")
    )
    nodes = known.select("tree", "node", "m.parent", "m.score")
    names = nodes.select(F.col("tree").alias("p_tree"), F.col("node").alias("p_node"))
    there = (F.col("tree") == F.col("p_tree")) & (F.col("parent") == F.col("p_node"))
    nodes = stable(nodes.join(names, there, "left").select("tree", "node", F.col("p_node").alias("parent"), "score"))
    tables, reached = _jumps(nodes)
    parents = nodes.where("parent is not null").select("tree", F.col("parent").alias("node")).distinct()
    leaves = reached.join(parents, ["tree", "node"], "left_anti")
    best = Window.partitionBy("tree").orderBy(F.desc("score"), F.desc("depth"), "node")
    chosen = leaves.withColumn("path", F.row_number().over(best)).where(F.col("path") <= paths_per_tree)
    paths = stable(
        chosen.select("tree", "path", F.col("score").alias("path_score"), F.col("depth").alias("position"), "node")
    )
    for k in range(len(tables) - 1, -1, -1):
        # Every distance is one sum of powers of two, so each ancestor comes up once.
        up = paths.join(tables[k], ["tree", "node"])
        more = up.select("tree", "path", "path_score", (F.col("position") - (1 << k)).alias("position"), F.col("up").alias("node"))
        paths = stable(paths.unionByName(more))
    return paths


def format_paths(paths: DataFrame, messages: DataFrame) -> DataFrame:
    """One row per path: tree, path, n_turns, formatted, loss_spans.

    ``messages`` has tree, node, role, text (null: empty); of rows with equal tree and node one
    counts (smallest role, then text), and further columns are not read. ``loss_spans`` are (start, length)
    in code points of ``formatted``, one for each message of the assistant, in order.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = messages.select("tree", "node", role.alias("role"), text.alias("text"))
    # Grouped by the keys of the join that follows, so this is no further shuffle.
    first = F.row_number().over(Window.partitionBy("tree", "node").orderBy("role", "text"))
    said = said.withColumn("first", first).where("first = 1").drop("first")
    paths = paths.select("tree", "path", "position", "node")
    role, text = F.col("role"), F.col("text")
    turns = paths.join(said, ["tree", "node"]).select(
        "tree",
        "path",
        F.struct(
            "position",
            F.concat(F.lit(START), _escape_role(role), F.lit("\n")).alias("head"),
            escape(text).alias("body"),
            (role == "assistant").alias("learn"),
        ).alias("turn"),
    )
    whole = turns.groupBy("tree", "path").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    tail = f"{END}\n"
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        head, body = F.length(turn["head"]).cast("long"), F.length(turn["body"]).cast("long")
        span = F.struct((state["at"] + head).alias("start"), body.alias("length"))
        spans = F.when(turn["learn"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((state["at"] + head + body + len(tail)).alias("at"), spans.alias("spans"))

    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(tail))), "")
    return whole.select(
        "tree",
        "path",
        F.size("turns").cast("long").alias("n_turns"),
        joined.alias("formatted"),
        F.aggregate("turns", empty, step)["spans"].alias("loss_spans"),
    )


def read_back(formatted: Column) -> Column:
    """The (role, text) pairs of a formatted conversation."""
    parts = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, 2_000_000_000)

    def turn(part: Column) -> Column:
        body = F.substring_index(part, END, 1)
        head = F.substring_index(body, "\n", 1)
        text = F.substring(body, F.length(head) + 2, F.length(body))
        return F.struct(_unescape_role(head).alias("role"), unescape(text).alias("text"))

    return F.transform(parts, turn)


def learned_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, in order, as it was before the template."""
    cut = lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))
    return F.array_join(F.transform(spans, cut), "")


def turns_as_trees(rows: DataFrame) -> DataFrame:
    """Conversations without branches (conv_id, turn, role, text) as messages.

    Every row answers the row before it; rows of equal turn are in the order of role and text,
    nulls first. Repeated rows are messages of their own. ``tree`` is the id as text, and
    ``null`` for rows without one.
    """
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    named = rows.withColumn("tree", F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))
    placed = named.withColumn("node", F.row_number().over(order).cast("long"))
    return placed.select(
        "tree",
        "node",
        F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        F.lit(0.0).alias("score"),
        "role",
        "text",
    )
