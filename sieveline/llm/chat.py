"""Chat formatting: reply trees to conversations.

Messages name their parent. Root-to-leaf paths come from iterative self-joins that
double the distance walked each time (a chain of depth d takes log2 d joins).
Every leaf is a branch; branches of a tree are ranked by score, and each chosen
path becomes one conversation::

    <|im_start|>role\\ntext<|im_end|>\\n

Inside roles and texts a backslash becomes two, ``<|`` becomes ``<\\|`` and, in
roles, a line feed becomes ``\\n``: no text can forge a mark, and the inverse is
exact. ``loss_spans`` holds [start, end) code point positions of assistant texts.

Edge cases: null texts and roles are empty; a message whose parent is missing is a
root; a null tree id is a tree of its own; of rows with the same tree and node the
smallest (role, text) by order comes first; a cycle has no root and gives no path;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sieveline.llm.common import cut

START, END = "<|im_start|>", "<|im_end|>"
_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + "\n", re.S)


def escape(col) -> F.Column:
    return F.replace(F.replace(col, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text)


def threads(turns: DataFrame) -> DataFrame:
    """Linear conversations as trees: each row's parent is the row before it by (turn, role, text)."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    n = turns.select(F.col("conv_id").alias("tree"), "turn", "role", "text", F.row_number().over(w).cast("long").alias("node"))
    return n.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def paths(messages: DataFrame) -> DataFrame:
    """tree, leaf, node, up: every node on the path of every leaf, ``up`` steps above it."""
    nodes = messages.select("tree", "node", "parent")
    kept = nodes.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    up = nodes.join(kept, F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("n")), "left").select("tree", "node", F.col("n").alias("above"))
    inner = up.where("above is not null").select(F.col("tree").alias("t"), F.col("above").alias("n")).distinct()
    walk = up.join(inner, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")), "left_anti").select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up"))
    jump, reach, most = cut(up.where("above is not null")), 1, nodes.count()
    roots = up.where("above is null").select(F.col("tree").alias("t"), F.col("node").alias("n"))
    walk = cut(walk)
    while reach <= most and not jump.isEmpty():
        j = jump.select(F.col("tree").alias("t"), F.col("node").alias("n"), "above")
        more = walk.join(j, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n"))).select("tree", "leaf", F.col("above").alias("node"), (F.col("up") + reach).alias("up"))
        walk = cut(walk.unionByName(more))
        k = jump.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("above").alias("next"))
        jump, reach = cut(jump.join(k, F.col("tree").eqNullSafe(F.col("t")) & (F.col("above") == F.col("n"))).select("tree", "node", F.col("next").alias("above"))), reach * 2
    if reach > most:  # a cycle walks further than there are messages; its branches have no root
        rooted = walk.join(roots, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")), "left_semi").select(F.col("tree").alias("t"), F.col("leaf").alias("n")).distinct()
        walk = walk.join(rooted, F.col("tree").eqNullSafe(F.col("t")) & (F.col("leaf") == F.col("n")), "left_semi")
    return walk


def format_trees(messages: DataFrame, best: int = 1) -> DataFrame:
    """tree, leaf, branch_score, formatted, loss_spans of the ``best`` branches of each tree.

    ``messages``: tree, node (long), parent (long, null at a root), role, text, score.
    A branch's score is the mean of its messages' scores (null: 0); ties go to the smaller leaf.
    """
    one = Window.partitionBy("tree", "node").orderBy("role", "text")
    m = messages.select("tree", "node", "parent", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("score", F.lit(0.0)).alias("score"))
    m = m.withColumn("_k", F.row_number().over(one)).where("_k = 1").drop("_k")
    w = paths(m)
    said = m.select(F.col("tree").alias("t"), F.col("node").alias("n"), "role", "text", "score")
    full = w.join(said, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n"))).drop("t", "n")
    rank = Window.partitionBy("tree").orderBy(F.desc("branch_score"), "leaf")
    chosen = full.groupBy("tree", "leaf").agg(F.avg("score").alias("branch_score")).withColumn("_r", F.row_number().over(rank)).where(F.col("_r") <= best)
    chosen = chosen.select(F.col("tree").alias("t"), F.col("leaf").alias("f"), "branch_score")
    picked = full.join(chosen, F.col("tree").eqNullSafe(F.col("t")) & (F.col("leaf") == F.col("f"))).drop("t", "f")
    role = F.replace(escape(F.col("role")), F.lit("\n"), F.lit("\\n"))
    row = F.struct((-F.col("up")).alias("at"), F.concat(F.lit(START), role, F.lit("\n")).alias("head"), escape(F.col("text")).alias("body"), (F.col("role") == "assistant").alias("loss"))
    turns = picked.groupBy("tree", "leaf", "branch_score").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    piece = F.transform("rows", lambda r: F.concat(r["head"], r["body"], F.lit(END + "\n")))
    width = F.transform("rows", lambda r: F.length(r["head"]) + F.length(r["body"]) + F.lit(len(END) + 1))
    out = turns.withColumn("formatted", F.array_join(piece, "")).withColumn("_w", width)
    start = lambda i: F.aggregate(F.slice("_w", 1, i), F.lit(0), lambda a, b: a + b)
    span = F.transform("rows", lambda r, i: F.when(r["loss"], F.struct((start(i) + F.length(r["head"])).alias("start"), (start(i) + F.length(r["head"]) + F.length(r["body"])).alias("end"))))
    return out.select("tree", "leaf", "branch_score", "formatted", F.filter(span, lambda s: s.isNotNull()).alias("loss_spans"))


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted text itself says: turns and masked text, read back and unescaped."""

    def read(batches):
        for pdf in batches:
            rows = []
            for tree, leaf, text, spans in zip(pdf["tree"], pdf["leaf"], pdf["formatted"], pdf["loss_spans"], strict=True):
                turns = [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(text)]
                loss = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
                sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
                rows.append((tree, leaf, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(text)))
            out = pd.DataFrame(rows, columns=["tree", "leaf", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
            out["tree"] = out["tree"].astype("Int64")
            yield out

    return formatted.select("tree", "leaf", "formatted", "loss_spans").mapInPandas(read, "tree long, leaf long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
