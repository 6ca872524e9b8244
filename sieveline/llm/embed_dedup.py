"""Embedding near-dedup with a forest of random-projection trees.

Equal vectors form one class, named by a 64-bit hash of the vector. Each tree splits the
space by random directions at the median of a bounded sample (``fit_rows``, by a hash of
the vector) until a leaf holds ``leaf_rows`` of the whole table or 8 of the sample; a
vector within the spill margin of a split goes to both sides. Beyond ``fit_rows *
leaf_rows / 8`` vectors (500,000) leaves therefore grow with the table. Every vector is
put into its leaves in every tree. Leaves are compared in tiles of at most ``TILE``
vectors a side, in double precision; a pair that meets in several leaves counts in the
first one only, so no pair is ever listed: a tile returns link counts and an edge from
each vector to its local component.

Edge cases: null, empty and zero vectors and those with a null or non-finite
component link with nothing; vectors of different lengths never meet; sizes of any
magnitude are scaled exactly, by powers of two; repeated ids are separate rows, and
equal rows are links of each other; a component is named by its smallest id that isn't
null, and a row is kept if it has its component's name (null equals null here); an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from sieveline.llm.common import components, cut

TILE = 2048


def fit_tree(x: np.ndarray, tree: int, leaf: float, spill: float) -> list[tuple]:
    """Nodes as (direction, low, high, left, right); low to high is the spill zone; children below 0 are leaves."""
    nodes: list[tuple] = []
    rng = np.random.default_rng(1000 + tree)
    leaves = [0]

    def grow(rows: np.ndarray) -> int:
        if len(rows) <= leaf or len(rows) < 8:
            leaves[0] += 1
            return -leaves[0]
        direction = rng.standard_normal(x.shape[1])
        direction /= np.linalg.norm(direction)
        p = x[rows] @ direction
        low, mid, high = np.quantile(p, [0.5 - spill / 2, 0.5, 0.5 + spill / 2])
        if low == high and (p <= mid).all():
            leaves[0] += 1
            return -leaves[0]
        k = len(nodes)
        nodes.append(())
        a = grow(rows[p <= mid])
        b = grow(rows[p > mid])
        nodes[k] = (direction, low, high, a, b)
        return k

    root = grow(np.arange(len(x)))
    return nodes if root >= 0 else []


def leaves_of(nodes: list[tuple], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and leaf number (from 1) of each place in a tree."""
    if not nodes:
        return np.arange(len(x)), np.ones(len(x), np.int64)
    rows, out, work = [], [], [(0, np.arange(len(x)))]
    while work:
        k, r = work.pop()
        if k < 0:
            rows.append(r)
            out.append(np.full(len(r), -k))
            continue
        direction, low, high, a, b = nodes[k]
        p = x[r] @ direction
        mid = (low + high) / 2
        work += [(a, r[(p <= mid) | (p <= high)]), (b, r[(p > mid) | (p > low)])]
    return np.concatenate(rows), np.concatenate(out)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors in double precision, scaled by powers of two to a largest component of 0.5 to 1."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def _compare(table, least: float):
    cls, copies = table.column("cls").to_numpy(), table.column("copies").to_numpy()
    dim, here = table.column("dim")[0].as_py(), table.column("leaf")[0].as_py()
    x = _matrix(table.column("v").combine_chunks(), dim)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    places = table.column("places").to_pylist()
    width = max(map(len, places))
    m = np.full((len(cls), width), -1, np.int64)
    for r, p in enumerate(places):
        m[r, : len(p)] = p
    block, i, j = (table.column(c).to_numpy() for c in ("block", "i", "j"))
    root, count = np.arange(len(cls)), np.zeros(len(cls), np.int64)
    for lo in range(0, len(cls), 512):
        g = x[lo : lo + 512] @ x.T
        a, b = np.nonzero(g >= least)
        a = a + lo
        keep = a < b
        if i[0] != j[0]:
            keep &= block[a] != block[b]
        a, b = a[keep], b[keep]
        for s in range(0, len(a), 100_000):
            p, q = a[s : s + 100_000], b[s : s + 100_000]
            before = np.zeros(len(p), bool)
            for c in range(width):
                left = m[p, c]
                earlier = (left >= 0) & (left < here)
                if earlier.any():
                    for e in range(width):
                        before |= earlier & (left == m[q, e])
            p, q = p[~before], q[~before]
            count += np.bincount(p, copies[q], len(cls)).astype(np.int64) + np.bincount(q, copies[p], len(cls)).astype(np.int64)
        while True:
            ra, rb = root[a], root[b]
            apart = ra != rb
            if not apart.any():
                break
            np.minimum.at(root, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
            while (root[root] != root).any():
                root = root[root]
    some = np.flatnonzero(count | (root != np.arange(len(cls))))
    return pa.table({"a": cls[some], "b": cls[root[some]], "links": count[some]})


def dedup_embeddings(embeddings: DataFrame, least: float = 0.9, trees: int = 12, leaf_rows: int = 200, spill: float = 0.1, fit_rows: int = 20_000) -> DataFrame:
    """vec_id, n_links, component_id, kept for each vector."""
    spark = embeddings.sparkSession
    kind = embeddings.schema["embedding"].dataType.elementType
    kind = kind if isinstance(kind, FloatType) else DoubleType()
    # Adding zero makes the two zeros one.
    e = embeddings.select("vec_id", F.transform("embedding", lambda v: v.cast(kind) + F.lit(0.0).cast(kind)).alias("v"))
    sound = F.coalesce((F.size("v") > 0) & F.forall("v", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))) & F.exists("v", lambda v: v != 0), F.lit(False))
    e = e.withColumn("v", F.when(sound, F.col("v"))).withColumn("cls", F.when(F.col("v").isNotNull(), F.xxhash64("v")))
    classes = cut(e.where("v is not null").groupBy("cls").agg(F.first("v").alias("v"), F.min("vec_id").alias("lo"), F.count("*").alias("copies")).withColumn("dim", F.size("v")))
    total = classes.groupBy("dim").count().collect()  # one row for each vector length
    forest: dict[int, list] = {}
    for r in total:
        rows = classes.where(F.col("dim") == r["dim"]).orderBy(F.xxhash64("cls", F.lit("fit")), "cls").limit(fit_rows).select("v").toArrow()
        x = _matrix(rows.column("v").combine_chunks(), r["dim"])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        forest[r["dim"]] = [fit_tree(x, t, leaf_rows * len(x) / r["count"], spill) for t in range(trees)]
    # At most trees * fit_rows / 4 directions for each vector length.
    held = spark.sparkContext.broadcast(forest)

    def place(batches):
        for batch in batches:
            dims = batch.column(3).to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                x = _matrix(part.column(0), int(dim))
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                of: list[list[int]] = [[] for _ in range(len(x))]
                for t, nodes in enumerate(held.value[int(dim)]):
                    for r, k in zip(*(v.tolist() for v in leaves_of(nodes, x)), strict=True):
                        of[r].append((t << 40) | k)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), part.column(3), pa.array([sorted(p) for p in of], pa.list_(pa.int64()))], ["v", "cls", "copies", "dim", "places"])

    placed = cut(classes.select("v", "cls", "copies", "dim").mapInArrow(place, f"v array<{kind.simpleString()}>, cls long, copies long, dim int, places array<long>"))
    spread = placed.withColumn("leaf", F.explode("places"))
    sizes = spread.groupBy("dim", "leaf").count()
    # At most one row for each leaf of the trees, trees * fit_rows / 4 for each vector length: a proven bound for the broadcast.
    large = F.broadcast(sizes.where(F.col("count") > TILE).select("dim", "leaf", F.ceil(F.col("count") / TILE).cast("int").alias("blocks")))
    dealt = spread.join(large, ["dim", "leaf"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("cls", F.lit("block")), F.col("blocks")).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("dim", "leaf", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "block", "cls", "copies", "places", "v")
    tiles = dealt.groupBy("dim", "leaf", "i", "j").applyInArrow(lambda t: _compare(t, least), "a long, b long, links long")
    found = cut(tiles)
    links = found.groupBy(F.col("a").alias("cls")).agg(F.sum("links").alias("links"))
    comp = components(found.where("a <> b").select("a", "b"))
    known = classes.select("cls", "lo", "copies").join(links, "cls", "left").join(comp.select(F.col("node").alias("cls"), "component"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    lowest = known.groupBy("component").agg(F.min("lo").alias("c"))
    known = known.join(lowest, "component").select(F.col("cls").alias("k"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), "c")
    out = e.select("vec_id", "cls").join(known, F.col("cls") == F.col("k"), "left")
    out = out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("k").isNotNull(), F.col("c")).otherwise(F.col("vec_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
