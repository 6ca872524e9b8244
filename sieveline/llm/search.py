"""Ranked lexical search by WAND in shards of documents.

The query set is taken in blocks of at most about ``BLOCK_TERMS`` terms, whatever the number
of its items; each block goes to all tasks. One pass over the texts counts documents, terms
and, for the block's terms, the documents that hold them (summed within tasks first). A
second pass searches: a task gathers the postings of the block's terms for ``SHARD`` bytes
of text at a time and runs WAND for each item: cursors stand on the term's next documents,
in order; the pivot is the first at which the terms' greatest impacts add up to the score
that the item's heap demands; documents before it can't get there and are skipped. Heaps
live as long as the task, so that later shards start with a high demand, and are merged over
tasks by a window that keeps only ``k`` rows of an item in each task. No postings and no
texts are shuffled.

Scores are whole numbers, as in ``impact``. Terms are compared by 64-bit hashes.

Edge cases: null and empty texts, of documents or items, have no terms, are in no count and
no result; items that share an id, or have none, are one item, whose terms add up; documents
that share an id are documents of their own, and each may be in a result; of equal scores
the smaller id is first, ids that are null last; very long texts are read whole; an empty
table on either side gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from array import array
from bisect import bisect_left
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sieveline.llm import textscan
from sieveline.llm.common import cut, reach_workers

#: Distinct terms of items that are searched for at once, and bytes of text in a shard.
BLOCK_TERMS, SHARD = 1 << 20, 1 << 24
_END = 1 << 62
_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of each term of a block of texts."""
    start, end = textscan.runs(_TERM[data], at)
    return textscan.Rolling(data)(start, end).astype(np.int64), np.searchsorted(at, start, "right") - 1


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term, n: the hashed terms of each item and how often it has them."""

    def run(batches):
        for batch, data, at in textscan.blocks(batches):
            h, of = terms(data, at)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of)), pa.array(h)], ["item_id", "term"])

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", "text").mapInArrow(run, f"item_id {kind}, term bigint").groupBy("item_id", "term").agg(F.count("*").alias("n"))


def query_blocks(asked: DataFrame) -> list[DataFrame]:
    """Disjoint parts of ``asked`` that hold whole items and about ``BLOCK_TERMS`` rows each; one with more is a single item or few."""
    total = asked.count()
    parts = 1 + 8 * total // BLOCK_TERMS
    numbered = asked.withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(parts)))
    # Eight rows for each block.
    sizes = {r["part"]: r["count"] for r in numbered.groupBy("part").count().collect()}
    blocks, first, held = [], 0, 0
    for part in range(parts):
        if held and held + sizes.get(part, 0) > BLOCK_TERMS:
            blocks.append((first, part))
            first, held = part, 0
        held += sizes.get(part, 0)
    blocks.append((first, parts))
    return [numbered.where((F.col("part") >= a) & (F.col("part") < b)).drop("part") for a, b in blocks] if total else []


class Queries:
    """The items of one block: their terms' numbers, and for each item its terms with their weights."""

    def __init__(self, rows: pa.Table):
        hashes = rows["term"].to_numpy()
        self.hashes, number = np.unique(hashes, return_inverse=True)
        ids = rows["item_id"].combine_chunks()
        self.ids, place = [], {}
        self.terms: list[list[tuple[int, int]]] = []
        for item, term, n in zip(ids.to_pylist(), number.tolist(), rows["n"].to_pylist(), strict=True):
            if item not in place:
                place[item] = len(self.ids)
                self.ids.append(item)
                self.terms.append([])
            self.terms[place[item]].append((term, n))

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of each hash among the block's terms, or -1."""
        i = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[i] == h, i, -1)


def statistics(docs: DataFrame, queries: Queries) -> tuple[int, int, np.ndarray]:
    """Documents with terms, terms of all documents, and the documents that hold each of the block's terms."""
    size = len(queries.hashes)

    def run(batches):
        held, some, all_ = np.zeros(size, np.int64), 0, 0
        for _, data, at in textscan.blocks(batches):
            h, of = terms(data, at)
            number = queries.find(h)
            hit = number >= 0
            held += np.bincount(np.unique(of[hit] * size + number[hit]) % size, minlength=size)
            some, all_ = some + len(np.unique(of)), all_ + len(h)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([at, [size, size + 1]])), pa.array(np.concatenate([held[at], [some, all_]]))], ["number", "n"])

    # As many rows as the block has terms, and two.
    rows = docs.select("text").mapInArrow(run, "number bigint, n bigint").groupBy("number").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size + 2, np.int64)
    out[rows["number"].to_numpy()] = rows["n"].to_numpy()
    return int(out[size]), int(out[size + 1]), out[:size]


def weights(n_docs: int, held: np.ndarray) -> list[int]:
    """A term's weight by the number of documents that hold it."""
    return [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in held.tolist()]


def impact(tf: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a weight is multiplied by in a document that holds the term ``tf`` times among ``length`` terms."""
    m = 100 - 75 + (75 * length * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Shard:
    """The postings of the block's terms in some documents, by term, in the order of documents."""

    def __init__(self, number: np.ndarray, doc: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int):
        code, tf = np.unique((number << 32) | doc, return_counts=True)
        docs = code & 0xFFFFFFFF
        worth = impact(tf.astype(np.int64), length[docs], n_docs, n_terms)
        present, first = np.unique(code >> 32, return_index=True)
        most = np.maximum.reduceat(worth, first) if len(first) else first
        ends = np.append(first[1:], len(code))[: len(first)]
        self.at = {t: (a, b, m) for t, a, b, m in zip(present.tolist(), first.tolist(), ends.tolist(), most.tolist(), strict=True)}
        self.docs, self.worth = array("q", docs.astype(np.int64).tobytes()), array("q", worth.astype(np.int64).tobytes())

    def wand(self, weighted: list[tuple[int, int]], heap: list, k: int, key: list[int]) -> None:
        """Puts the shard's best documents of one item into its heap of (score, minus the document's key)."""
        docs, worth = self.docs, self.worth
        # Next document, greatest impact, weight, place and end of each term's postings.
        cursors = [[docs[at[0]], w * at[2], w, at[0], at[1]] for t, w in weighted if (at := self.at.get(t)) and w]
        first = itemgetter(0)
        while cursors:
            cursors.sort(key=first)
            while cursors and cursors[-1][0] == _END:
                cursors.pop()
            demand, sum_, pivot = heap[0][0] if len(heap) == k else 1, 0, None
            for c in cursors:
                sum_ += c[1]
                if sum_ >= demand:
                    pivot = c[0]
                    break
            if pivot is None:
                return
            if cursors[0][0] == pivot:
                score = 0
                for c in cursors:
                    if c[0] != pivot:
                        break
                    i = c[3]
                    score += c[2] * worth[i]
                    c[3] = i = i + 1
                    c[0] = docs[i] if i < c[4] else _END
                found = (score, -key[pivot])
                if score > 0 and len(heap) < k:
                    heapq.heappush(heap, found)
                elif score > 0 and found > heap[0]:
                    heapq.heapreplace(heap, found)
            else:
                for c in cursors:
                    if c[0] >= pivot:
                        break
                    c[3] = i = bisect_left(docs, pivot, c[3] + 1, c[4])
                    c[0] = docs[i] if i < c[4] else _END


def best(docs: DataFrame, queries: Queries, k: int, kind: str) -> DataFrame:
    """item_id, doc_id, score: each task's ``k`` best documents of each item of a block."""
    n_docs, n_terms, held = statistics(docs, queries)
    if not n_docs:
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, doc_id bigint, score bigint")
    weight = weights(n_docs, held)
    weighted = [[(t, n * weight[t]) for t, n in item] for item in queries.terms]
    # Only what the tasks need.
    lookup, ids = queries, queries.ids

    def run(batches):
        heaps: list[list] = [[] for _ in ids]
        number, doc, length, key, size = [], [], [], [], 0

        def search():
            shard = Shard(np.concatenate(number), np.concatenate(doc), np.concatenate(length), n_docs, n_terms)
            for item, heap in zip(weighted, heaps, strict=True):
                shard.wand(item, heap, k, key)

        for batch, data, at in textscan.blocks(batches):
            h, of = terms(data, at)
            found = lookup.find(h)
            hit = found >= 0
            number.append(found[hit])
            doc.append(of[hit] + len(key))
            length.append(np.bincount(of, minlength=len(at) - 1).astype(np.int64))
            key += [_END if i is None else i for i in batch.column(0).to_pylist()]
            size += len(data)
            if size >= SHARD:
                search()
                number, doc, length, key, size = [], [], [], [], 0
        if key:
            search()
        rows = [(ids[q], None if -d == _END else -d, score) for q, heap in enumerate(heaps) for score, d in heap]
        if rows:
            item, doc_id, score = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.string() if kind == "string" else pa.int32() if kind == "int" else pa.int64()), pa.array(doc_id, pa.int64()), pa.array(score, pa.int64())], ["item_id", "doc_id", "score"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, f"item_id {kind}, doc_id bigint, score bigint")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` highest-scoring documents of each item (all with a score above 0, if fewer)."""
    spark = docs.sparkSession
    reach_workers(spark)
    kind = items.schema["item_id"].dataType.simpleString()
    if kind not in ("bigint", "int", "string"):
        raise TypeError(f"item ids of type {kind}")
    asked = cut(item_terms(items))
    found = spark.createDataFrame([], f"item_id {kind}, doc_id bigint, score bigint")
    for block in query_blocks(asked):
        found = found.unionByName(best(docs, Queries(block.toArrow()), k, kind))
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.select("item_id", place.alias("rank"), "doc_id", "score").where(F.col("rank") <= k)
