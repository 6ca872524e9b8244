"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of hashed words over all documents (a fixed-size histogram
   per task, summed).
2. A randomised SVD of TF-IDF passages: every benchmark item, and every ``PASSAGE``
   words of all documents. Rounds over the items alone choose where to begin; in one
   round over everything each task adds up its passages' part of ``A'A Omega``. The sums
   meet in one small matrix, whose singular vectors are taken.
3. Every whole document is cut into overlapping windows (16, 32 or 64 words, by the
   length of the items), each is folded into the latent space, and windows with a
   cosine of ``min_cosine`` or more to an item are candidates. Whatever its cosine, a
   place is one too if the words around it could hold a subsequence of
   ``min_paraphrase`` of the item: so many of the item's rarest words are there.
4. A candidate is kept if the longest common subsequence of the words covers
   ``min_lcs`` of the item, or ``min_paraphrase`` of it and the item's answer (its
   ``answer`` column, else its last words) stands in the window.

The second rule is exact: a subsequence of a share of the item's words leaves out at
most the rest of them, so of the rarest ``COUNTED`` it holds all but that rest.

Edge cases: null and empty texts match nothing; an empty benchmark gives no rows;
items of fewer than ``min_words`` words are too short for either rule and match only
where all their words stand in order, one behind the other; items without a word match
nothing; repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm import textscan

FEATURES, RANK, STRIDE, SCALES = 1 << 14, 48, 8, (16, 32, 64)
#: Share of an item's words, the rarest, that are counted; items that are counted at once.
COUNTED, AT_ONCE = 0.6, 256
#: Words of a document's passage, passages whose words become one small dense matrix.
PASSAGE, TOGETHER = 64, 32


def _features(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(40)).astype(np.int64) & (FEATURES - 1)


def _count_words(batches):
    """Per task: in how many documents each hashed word occurs."""
    seen, n = np.zeros(FEATURES, np.int64), 0
    for _, data, at in textscan.blocks(batches):
        w = textscan.words(data, at)
        f = _features(textscan.Rolling(data)(w.start, w.end))
        for lo in range(0, len(at) - 1, 256):  # a table of 256 documents at a time
            own = slice(int(w.first[lo]), int(w.first[min(lo + 256, len(at) - 1)]))
            there = np.zeros(256 * FEATURES, bool)
            there[(w.doc[own] - lo) * FEATURES + f[own]] = True
            seen += np.bincount(np.flatnonzero(there) & (FEATURES - 1), minlength=FEATURES)
        n += len(at) - 1
    if n:
        part = seen.reshape(16, -1)
        yield pd_batch({"part": np.arange(16), "n": np.full(16, n)}, "seen", [p.tobytes() for p in part])


def pd_batch(numbers: dict, name: str, raw: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(pa.array(v, pa.int64()) for v in numbers.values()), pa.array(raw, pa.binary())], [*numbers, name])


def _sum_parts(key, table):
    total = sum(np.frombuffer(x, np.int64) for x in table.column("seen").to_pylist())
    return pa.table({"part": [key[0].as_py()], "n": [sum(table.column("n").to_pylist())], "seen": [total.tobytes()]})


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """log(documents / documents with the hashed word), over all documents: FEATURES numbers."""
    parts = docs.select("text").mapInArrow(_count_words, "part long, n long, seen binary").groupBy("part").applyInArrow(_sum_parts, "part long, n long, seen binary").collect()
    seen, n = np.zeros((16, FEATURES // 16)), 0
    for r in parts:
        seen[r["part"]], n = np.frombuffer(r["seen"], np.int64), r["n"]
    return np.log((n + 1) / (seen.ravel() + 0.5)).astype(np.float32)


def _gram_times(f: np.ndarray, passage: np.ndarray, idf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Sum over unit-length TF-IDF passages a of a'(a m); ``passage`` numbers the passages word by word, in order."""
    out = np.zeros(m.shape)
    bounds = np.searchsorted(passage, np.arange(0, (int(passage[-1]) if len(passage) else -1) + TOGETHER + 1, TOGETHER))
    for a, b in zip(bounds, bounds[1:], strict=False):
        if a == b:
            continue
        used, column = np.unique(f[a:b], return_inverse=True)
        at = passage[a:b] - passage[a]
        n = int(at[-1]) + 1
        v = np.bincount(at * len(used) + column, minlength=n * len(used)).reshape(n, -1) * idf[used]
        v = (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)).astype(m.dtype)
        out[used] += v.T @ (v @ m[used])
    return out


def _passages(w) -> np.ndarray:
    """For each word the number of its passage; no passage crosses a document's end."""
    n = np.diff(w.first)
    count = -(-n // PASSAGE)
    return (np.cumsum(count) - count)[w.doc] + (np.arange(len(w.doc)) - w.first[:-1][w.doc]) // PASSAGE


def _rotated(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Left singular vectors and singular values of a tall matrix, from its small Gram matrix."""
    square, turn = np.linalg.eigh(y.T @ y)
    s = np.sqrt(np.maximum(square[::-1], 1e-18))
    return y @ (turn[:, ::-1] / s), s


def basis(docs: DataFrame, items: list[str], idf: np.ndarray, rank: int = RANK, rounds: int = 2) -> np.ndarray:
    """FEATURES x rank: the leading right singular vectors of all passages of all documents and items over their singular values."""
    rng = np.random.default_rng(7)
    raw = [t.encode() for t in items]
    data, at = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    w = textscan.words(data, at)
    own = _features(textscan.Rolling(data)(w.start, w.end))
    start = rng.standard_normal((FEATURES, rank + 8))
    start[idf <= 0] = 0
    q = start
    for _ in range(rounds):
        # Items may be fewer than the rank: what they don't span stays random.
        q = _rotated(_gram_times(own, w.doc, idf, q) + start * 1e-3)[0]
    held = docs.sparkSession.sparkContext.broadcast((q.astype(np.float32), idf))

    def part(batches):
        m, idf = held.value
        total = None
        for _, data, at in textscan.blocks(batches):
            w = textscan.words(data, at)
            y = _gram_times(_features(textscan.Rolling(data)(w.start, w.end)), _passages(w), idf, m)
            total = y if total is None else total + y
        if total is not None:
            for k, rows in enumerate(np.array_split(total.astype(np.float32), 16)):
                yield pd_batch({"part": np.array([k])}, "y", [rows.tobytes()])

    def meet(key, table):
        return pa.table({"part": [key[0].as_py()], "y": [sum(np.frombuffer(x, np.float32).astype(np.float64) for x in table.column("y").to_pylist()).astype(np.float32).tobytes()]})

    y = _gram_times(own, w.doc, idf, q)
    for r in docs.select("text").mapInArrow(part, "part long, y binary").groupBy("part").applyInArrow(meet, "part long, y binary").collect():
        size = FEATURES // 16
        y[r["part"] * size : (r["part"] + 1) * size] += np.frombuffer(r["y"], np.float32).reshape(size, -1)
    q, s = _rotated(y)
    # A'A has the squares; folding in divides by the singular values, so that what all texts of a language share doesn't drown the rest.
    return np.ascontiguousarray(q[:, :rank] / np.sqrt(np.maximum(s[:rank], 1e-9)), np.float32)


def lcs(a: list, b: list) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    row = (1 << len(a)) - 1
    for x in b:
        m = row & where.get(x, 0)
        row = ((row + m) | (row - m)) & ((1 << len(a)) - 1)
    return len(a) - row.bit_count()


def _sequences(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` words."""
    n = max(0, len(h) - k + 1)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total += textscan.mix(h[j : j + n] + np.uint64(j))
    return textscan.mix(total)


class Index:
    """Benchmark items by scale, in the latent space."""

    def __init__(self, ids: list[int], texts: list[str], answers: list[str | None], idf: np.ndarray, vectors: np.ndarray, min_words: int, answer_words: int):
        self.weighted = np.vstack([vectors * idf[:, None], np.zeros((1, vectors.shape[1]), np.float32)])  # the last row: no word
        raw = [t.encode() for t in texts]
        data, at = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
        w = textscan.words(data, at)
        h = textscan.Rolling(data)(w.start, w.end)
        self.ids, self.words, self.answer, scale, rows, self.rare, self.left_out, self.lots = [], [], [], [], [], [], [], {}
        self.short: dict[int, dict[int, list[int]]] = {}  # by number of words: the hash of the sequence, the items
        for d, i in enumerate(ids):
            own = h[w.first[d] : w.first[d + 1]]
            if len(own) < min_words:
                if len(own):
                    self.short.setdefault(len(own), {}).setdefault(int(_sequences(own, len(own))[0]), []).append(i)
                continue
            # Items longer than the largest window are found by each of their windows; the check reads the item's whole span.
            begins = range(0, max(1, len(own) - SCALES[-1] // 2), SCALES[-1])
            for a in begins:
                piece = own[a : a + SCALES[-1]] if len(own) > SCALES[-1] else own
                rows.append(self.weighted[_features(piece)].sum(0))
                own_features = _features(piece)
                self.rare.append(own_features[np.argsort(-idf[own_features], kind="stable")[: math.ceil(COUNTED * len(piece))]])
                # Words behind an item's last piece, its pieces, and this one's words: what a subsequence may leave out of it.
                self.left_out.append((max(0, len(own) - SCALES[-1] * len(begins)), len(begins), len(piece)))
                scale.append(next((s for s in SCALES if len(piece) <= s), SCALES[-1]))
                self.ids.append(i)
                self.words.append(own.tolist())
                said = textscan.hash_words((answers[d] or "").split()).tolist() if answers[d] else own[-answer_words:].tolist()
                self.answer.append(said)
        v = np.array(rows, np.float32).reshape(len(rows), vectors.shape[1])
        self.unit = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
        self.scale = np.array(scale)

    def counters(self, scale: int, min_share: float) -> list[tuple]:
        """For each lot of items of a scale: their indices, and per feature the range of a list of those that count it; how many an item needs."""
        if (scale, min_share) in self.lots:
            return self.lots[scale, min_share]
        out, all_own = [], np.flatnonzero(self.scale == scale)

        def need(k: int) -> int:
            behind, parts, size = self.left_out[k]
            held = -(-(math.ceil(min_share * len(self.words[k]) - 1e-9) - behind) // parts)
            return max(1, len(self.rare[k]) - (size - held))

        for lo in range(0, len(all_own), AT_ONCE):
            own = all_own[lo : lo + AT_ONCE]
            pairs = np.concatenate([np.unique(self.rare[k]) * len(own) + c for c, k in enumerate(own)])
            pairs.sort()
            begin = np.searchsorted(pairs // len(own), np.arange(FEATURES + 1))
            # The words that a subsequence of min_share leaves out may all be counted ones.
            out.append((own, begin, pairs % len(own), np.array([need(k) for k in own])))
        self.lots[scale, min_share] = out
        return out


def _counted(f: np.ndarray, cell: np.ndarray, n_cells: int, counter: tuple) -> np.ndarray:
    """(cells + 1) x items: running count of the words that each item counts."""
    own, begin, columns, _ = counter
    many = begin[f + 1] - begin[f]
    has = np.flatnonzero(many)
    many = many[has]
    at = np.repeat(begin[f[has]] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    hits = np.bincount(np.repeat(cell[has], many) * len(own) + columns[at], minlength=n_cells * len(own))
    ran = np.zeros((n_cells + 1, len(own)), np.int32)
    np.cumsum(hits.reshape(n_cells, len(own)), 0, dtype=np.int32, out=ran[1:])
    return ran


def _within(needle: list, hay: list) -> bool:
    return any(hay[i : i + len(needle)] == needle for i in range(len(hay) - len(needle) + 1))


def search(index: Index, data: np.ndarray, at: np.ndarray, min_cosine: float, min_lcs: float, min_paraphrase: float) -> list[tuple]:
    """(document, item, cosine, lcs share, first word, answered) of the best window of each pair that passes."""
    w = textscan.words(data, at)
    h = textscan.Rolling(data)(w.start, w.end)
    n = np.diff(w.first)
    best: dict[tuple[int, int], tuple] = {}
    for k, known in index.short.items():
        runs = _sequences(h, k)
        for at_word in np.flatnonzero(np.isin(runs, np.array(list(known), np.uint64))).tolist():
            d = int(w.doc[at_word])
            if at_word + k <= w.first[d + 1]:
                for i in known[int(runs[at_word])]:
                    best.setdefault((d, i), (1.0, 1.0, -(at_word - int(w.first[d])), True))
    if not len(h) or not len(index.ids):
        return [(d, i, s[1], s[0], -s[2], s[3]) for (d, i), s in sorted(best.items())]
    # Sums of STRIDE words each, documents apart.
    cells = -(-n // STRIDE)
    first_cell = np.cumsum(cells) - cells
    cell_doc = np.repeat(np.arange(len(n)), cells)
    starts = w.first[:-1][cell_doc] + (np.arange(len(cell_doc)) - first_cell[cell_doc]) * STRIDE
    f, end = _features(h), w.first[1:][cell_doc]
    sums = np.zeros((len(starts), index.weighted.shape[1]), np.float32)
    for k in range(STRIDE):
        sums += index.weighted[np.where(starts + k < end, f[np.minimum(starts + k, len(f) - 1)], FEATURES)]
    ran = np.zeros((len(sums) + 1, sums.shape[1]), np.float32)
    np.cumsum(sums, 0, out=ran[1:])
    last = (first_cell + cells)[cell_doc]
    cell = first_cell[w.doc] + (np.arange(len(h)) - w.first[:-1][w.doc]) // STRIDE
    every = np.arange(len(cell_doc))

    def read(a: int, k: int, cosine: float) -> None:
        """Compares the item with the words around a cell, beyond the window's ends too."""
        scale, d, item = int(index.scale[k]), int(cell_doc[a]), index.words[k]
        i = max(int(starts[a]) - max(STRIDE, len(item) - scale // 2), int(w.first[d]))
        span = h[i : min(int(starts[a]) + max(scale, len(item)) + STRIDE, int(w.first[d + 1]))].tolist()
        there = set(span)
        if sum(x in there for x in item) < min_paraphrase * len(item):  # no subsequence is longer
            return
        share = lcs(item, span) / len(item)
        if share < min_paraphrase:
            return
        answered = _within(index.answer[k], span)
        if share >= min_lcs or answered:
            key = (d, index.ids[k])
            best[key] = max(best.get(key, (0,)), (share, cosine, -(i - int(w.first[d])), answered))

    for scale in SCALES:
        own = np.flatnonzero(index.scale == scale)
        if not len(own):
            continue
        wide = scale // STRIDE
        b = np.minimum(every + wide, last)
        # Windows of 16 and 32 words begin at each cell, those of 64 at every other one; a document's last words are in one.
        at_cell = every - first_cell[cell_doc]
        whole = ((every + wide <= last) & (at_cell % max(1, wide // 4) == 0)) | (every + wide == last) | (at_cell == 0)
        a, b = every[whole], b[whole]
        unit = np.ascontiguousarray(index.unit[own].T)
        for lo in range(0, len(a), 8192):
            v = ran[b[lo : lo + 8192]] - ran[a[lo : lo + 8192]]
            norm = np.sqrt(np.maximum(np.einsum("ij,ij->i", v, v), 1e-18))
            cos = v @ unit
            for r, c in zip(*np.nonzero(cos >= (min_cosine * norm)[:, None]), strict=True):
                read(int(a[lo + r]), int(own[c]), float(cos[r, c] / norm[r]))
        for counter in index.counters(scale, min_paraphrase):
            # The words that are read for any item of this scale, in whole cells.
            before = max(STRIDE, scale // 2) // STRIDE
            lo, hi = np.maximum(every - before, first_cell[cell_doc]), np.minimum(every + wide + 1, last)
            count = _counted(f, cell, len(every), counter)
            for r, c in zip(*np.nonzero(count[hi] - count[lo] >= counter[3]), strict=True):
                v = ran[min(r + wide, last[r])] - ran[r]
                k = int(counter[0][c])
                read(int(r), k, float(v @ index.unit[k] / max(np.linalg.norm(v), 1e-9)))
    return [(d, i, s[1], s[0], -s[2], s[3]) for (d, i), s in sorted(best.items())]


def find_leaks(docs: DataFrame, benchmark: DataFrame, min_cosine: float = 0.6, min_lcs: float = 0.8, min_paraphrase: float = 0.6, min_words: int = 8, answer_words: int = 3) -> DataFrame:
    """doc_id, item_id, cosine, lcs_share, first_word, answered: a row for each document and item that it holds.

    ``benchmark``: item_id, text and, if there is one, answer; the driver and the executors hold it whole.
    """
    spark = docs.sparkSession
    answer = F.col("answer") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = benchmark.where("text is not null and item_id is not null").select("item_id", "text", answer.alias("answer")).distinct().orderBy("item_id", "text").collect()
    schema = "doc_id long, item_id long, cosine double, lcs_share double, first_word long, answered boolean"
    if not items:
        return spark.createDataFrame([], schema)
    idf = inverse_frequencies(docs)
    vectors = basis(docs, [r["text"] for r in items], idf)
    index = Index([r["item_id"] for r in items], [r["text"] for r in items], [r["answer"] for r in items], idf, vectors, min_words, answer_words)
    # FEATURES x RANK numbers and the benchmark, whatever the corpus.
    held = spark.sparkContext.broadcast(index)

    def run(batches):
        for batch, data, at in textscan.blocks(batches):
            ids = batch.column(0).to_pylist()
            rows = [(ids[d], *rest) for d, *rest in search(held.value, data, at, min_cosine, min_lcs, min_paraphrase)]
            out = pd.DataFrame(rows, columns=["doc_id", "item_id", "cosine", "lcs_share", "first_word", "answered"])
            yield pa.RecordBatch.from_pandas(out.astype({"doc_id": "Int64"}), preserve_index=False, schema=pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("cosine", pa.float64()), ("lcs_share", pa.float64()), ("first_word", pa.int64()), ("answered", pa.bool_())]))

    return docs.select("doc_id", "text").mapInArrow(run, schema)
