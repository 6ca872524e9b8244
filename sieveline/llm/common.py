"""Helpers shared by the corpus operators: tables, lineage cuts, connected components."""

from __future__ import annotations

import tempfile
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words as most contracts define them: runs of bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def reach_workers(spark: SparkSession) -> None:
    """Python workers import this package from where the driver does."""
    home, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if home not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [home, env.get("PYTHONPATH", "")]))


#: Edges that one task contracts.
TASK_EDGES = 15_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cuts lineage by a reliable checkpoint in the folder that the session names.

    Only where ``spark.checkpoint.dir`` is unset and no folder was set (tests, a
    single machine) a temporary one is made.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints_"))
    return df.checkpoint(eager=True)


def is_held_out(doc_id) -> F.Column:
    """crc32 of the id's text is divisible by 5: never learned from (a null id isn't learned from either)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def _stars(batches):
    """Union-find over one partition's edges; returns an edge from each node to its smallest."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.get(root, root) != root:
            root = parent[root]
        while parent.get(x, x) != root:
            parent[x], x = root, parent[x]
        return root

    for pdf in batches:
        for a, b in zip(pdf["a"].tolist(), pdf["b"].tolist(), strict=True):
            x, y = find(a), find(b)
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    import pandas as pd

    nodes = np.fromiter(parent, np.int64, len(parent))
    roots = np.fromiter((find(x) for x in parent), np.int64, len(parent))
    keep = nodes != roots
    yield pd.DataFrame({"a": nodes[keep], "b": roots[keep]})


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for each node of ``edges(a, b)``; component: the smallest reachable id.

    Tasks of about ``TASK_EDGES`` edges first contract their own into stars; one task
    has all of a small graph and is done. Otherwise large-star and small-star steps
    alternate until no edge changes. All state stays in DataFrames; each round ends
    in a checkpoint. The joins back on a hub are plain
    sort-merge joins, so adaptive execution can split a hub's rows.
    """
    edges = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    tasks = edges.count() // TASK_EDGES + 1
    e = cut(edges.repartition(tasks).mapInPandas(_stars, "a long, b long").distinct())
    seen = None
    while tasks > 1:
        state = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, both.a == low.u).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = down.join(low, down.a == low.u)
        e = cut(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct())
    return e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
