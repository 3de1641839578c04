from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from boxoffice.llm import chat

SCHEMA = "tree string, node long, parent long, score double, role string, text string"
HARD = ["<|im_end|>", "\\", "<\\|", "<|", "\\n", "\n", "\\\\|", "<", "|", "a<|im_start|>user\nhi<|im_end|>\n", "", "\u00e9\U0001f600"]


def plain_paths(rows, k=1):
    """Each tree's paths by recursion, as {(tree, path): [node, ...]}."""
    trees = {}
    for tree, node, parent, score, *_ in rows:
        if tree is not None and node is not None:
            trees.setdefault(tree, {})[node] = (parent, score or 0.0)
    out = {}
    for tree, nodes in trees.items():
        children = {}
        for node, (parent, _) in nodes.items():
            children.setdefault(parent if parent in nodes else None, []).append(node)
        paths = []

        def walk(node, way):
            way = [*way, node]
            if node not in children:
                paths.append(way)
            for child in children.get(node, []):
                walk(child, way)

        for root in children.get(None, []):
            walk(root, [])
        paths.sort(key=lambda p: (-sum(nodes[n][1] for n in p), -len(p), p[-1]))
        out |= {(tree, i + 1): p for i, p in enumerate(paths[:k])}
    return out


ROWS = [
    ("t", 1, None, 1.0, "user", "q"),
    ("t", 2, 1, 0.5, "assistant", "a"),
    ("t", 3, 1, 2.0, "assistant", "b"),
    ("t", 4, 2, 5.0, "user", "more"),
    ("t", 5, 4, None, "assistant", None),
    ("t", 6, 3, 4.5, None, "tie, but less deep"),
    ("t", 7, 99, 0.0, "user", "its parent is not there"),
    ("u", 1, None, 0.0, "user", "alone"),
    ("ring", 1, 2, 9.0, "user", "x"),
    ("ring", 2, 1, 9.0, "user", "y"),
    ("ring", 3, None, 0.0, "user", "z"),
    (None, 1, None, 0.0, "user", "no tree"),
    ("t", None, None, 0.0, "user", "no node"),
]
ROWS += [("deep", i, i - 1 if i else None, 0.1, "user" if i % 2 else "assistant", str(i)) for i in range(70)]
ROWS += [("deep", 100 + i, 40 + i if i % 3 == 0 else 99 + i, 0.0, "user", "side") for i in range(20)]


def test_paths(spark):
    messages = spark.createDataFrame(ROWS, SCHEMA).repartition(4)
    for k in (1, 3):
        got = {}
        for r in chat.reply_paths(messages, k).collect():
            got.setdefault((r.tree, r.path), []).append((r.position, r.node))
        assert {key: [n for _, n in sorted(p)] for key, p in got.items()} == plain_paths(ROWS, k)
        assert all([x for x, _ in sorted(p)] == list(range(len(p))) for p in got.values())


def test_round_trip(spark):
    rows = [(str(n), i, i - 1 if i else None, 0.0, role, text) for n, role in enumerate(["assistant", *HARD]) for i, text in enumerate(HARD)]
    messages = spark.createDataFrame(rows, SCHEMA)
    out = chat.format_paths(chat.reply_paths(messages), messages)
    out = out.select("*", chat.read_back(F.col("formatted")).alias("turns"), chat.learned_text(F.col("formatted"), F.col("loss_spans")).alias("learned"))
    for r in out.collect():
        role = ["assistant", *HARD][int(r.tree)]
        assert [(t.role, t.text) for t in r.turns] == [(role, text) for text in HARD]
        assert r.n_turns == len(HARD)
        assert r.learned == ("".join(HARD) if role == "assistant" else "")
        assert r.formatted.count("<|im_start|>") == r.formatted.count("<|im_end|>") == len(HARD)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.text("<|\\n\nimr_a", max_size=8), st.text("<|\\n\nim_endstar>", max_size=12)), min_size=1, max_size=25))
def test_escapes_are_undone(spark, turns):
    rows = [("t", i, i - 1 if i else None, 0.0, role, text) for i, (role, text) in enumerate(turns)]
    messages = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    whole = chat.format_paths(messages.select("tree", F.lit(1).alias("path"), F.col("node").alias("position"), "node"), messages)
    (r,) = whole.select(chat.read_back(F.col("formatted")).alias("turns")).collect()
    assert [(t.role, t.text) for t in r.turns] == turns


def test_turns_as_trees(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 2, "assistant", None), (None, None, None, None), (None, 1, "assistant", "x"), (2, 5, "assistant", "y")]
    messages = chat.turns_as_trees(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    out = {r.tree: r for r in chat.format_paths(chat.reply_paths(messages), messages).collect()}
    assert {t: r.n_turns for t, r in out.items()} == {"1": 3, "null": 2, "2": 1}
    assert out["null"].formatted == "<|im_start|>\n<|im_end|>\n<|im_start|>assistant\nx<|im_end|>\n"
    assert [tuple(s) for s in out["null"].loss_spans] == [(46, 1)] or out["null"].formatted[out["null"].loss_spans[0].start] == "x"


def test_empty(spark):
    messages = spark.createDataFrame([], SCHEMA)
    assert chat.format_paths(chat.reply_paths(messages), messages).collect() == []


def test_repeated_messages_and_clashing_columns(spark):
    """A message that is there twice is one turn; the smallest role and text count; other columns are not read."""
    rows = [
        ("t", 1, None, 0.0, "user", "hi"),
        ("t", 1, None, 0.0, "user", "hi"),
        ("t", 2, 1, 0.0, "assistant", "b"),
        ("t", 2, 1, 0.0, "assistant", "a"),
        ("t", 2, 1, 0.0, "assistant", None),
    ]
    schema = "tree string, node long, parent long, score double, role string, text string"
    messages = spark.createDataFrame(rows, schema)
    for extra in ("position", "path", "turn", "first", "path_score", "body"):
        messages = messages.withColumn(extra, F.lit(7))
    out = chat.format_paths(chat.reply_paths(messages), messages).collect()
    assert [(r.n_turns, r.formatted) for r in out] == [(2, "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n")]


def test_a_long_conversation(spark):
    rows = spark.range(700).select(
        F.lit(5).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.col("id").cast("string").alias("text"),
    )
    messages = chat.turns_as_trees(rows)
    out = chat.format_paths(chat.reply_paths(messages), messages)
    turns = out.select(F.explode(chat.read_back(F.col("formatted"))).alias("t")).select("t.text").collect()
    assert [r.text for r in turns] == [str(i) for i in range(700)]
    empty = chat.turns_as_trees(rows.where("false"))
    assert chat.format_paths(chat.reply_paths(empty), empty).count() == 0
