"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of the whole text: densities of a fixed lexicon, of the same lexicon in
disguise (digits and signs for letters) and of words learned from labels; their
closeness to second-person words; capitals, punctuation, obfuscation and
repetition rates. Trees are boosted on logistic loss over quantile bins and
calibrated by pool-adjacent-violators on rows that the trees didn't see.

Learned from at most ``max_rows`` labelled rows, chosen by a hash of the id; the
features of all rows are computed where the rows are.

Edge cases: null and empty texts have all features 0 and get that point's score;
several labels of one id count as toxic if one is; without labels every score is
0, with one class only every score is that class's rate.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm import textscan
from sieveline.llm.common import is_held_out

#: Insults, in four languages.
LEXICON = (
    "idiot idiots moron morons stupid dumb fool fools loser losers scum trash garbage pathetic disgusting worthless clown clowns jerk creep ugly hate shut "
    "idiota estúpido estúpida imbécil tonto basura asqueroso payaso inútil imbécile stupide crétin débile ordure pourriture dégoûtant minable "
    "dumm blöd trottel abschaum müll widerlich erbärmlich wertlos versager"
).split()
#: Second-person words, in four languages.
SECOND_PERSON = "you your yours yourself u ur tú tu tus ti usted ustedes vos du dich dir dein deine euch ihr toi te vous votre vos".split()
NAMES = ("lexicon", "disguised", "learned", "hits", "you", "near_you", "capitals", "shouted", "punctuation", "exclaimed", "obfuscated", "repeated", "words")

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_DISGUISE = np.zeros(256, bool)
_DISGUISE[[ord(c) for c in "0134578@$!|*#"]] = True
_TOKEN = _LETTER | _DISGUISE
#: Digits and signs that stand for letters.
_LEET = textscan.LOWER.copy()
for _a, _b in zip("0134578@$!|", "oieastbasii", strict=True):
    _LEET[ord(_a)] = ord(_b)


@cache
def _hashes(words: tuple[str, ...]) -> np.ndarray:
    return np.sort(textscan.hash_words(list(words))) if words else np.zeros(0, np.uint64)


def _in(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known) or not len(h):
        return np.zeros(len(h), bool)
    return known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h


def features(data: np.ndarray, at: np.ndarray, learned: tuple[str, ...] = (), near: int = 5) -> np.ndarray:
    """documents x features."""
    n = len(at) - 1
    start, end = textscan.runs(_TOKEN[data], at)
    # Signs at a word's edges belong to the sentence: "moron!" is plain.
    while len(start):
        trim = (end - start > 1) & ~_LETTER[data[end - 1]] & np.isin(data[end - 1], (33, 42, 35, 124))
        if not trim.any():
            break
        end = end - trim
    doc = np.searchsorted(at, start, "right") - 1
    plain, leet = textscan.Rolling(data), textscan.Rolling(data, _LEET)
    h = plain(start, end)
    hit, taught, you = _in(h, _hashes(tuple(LEXICON))), _in(h, _hashes(learned)), _in(h, _hashes(tuple(SECOND_PERSON)))
    hidden = _in(leet(start, end), _hashes(tuple(LEXICON))) & ~hit
    sums = lambda mask: np.concatenate([[0], np.cumsum(mask)])
    letters, uppers = sums(_LETTER[data]), sums(_UPPER[data])
    mixed = sums(_DISGUISE[data])
    k, inside = letters[end] - letters[start], mixed[end] - mixed[start]
    obfuscated = (k > 0) & (inside > 0)
    shouted = (k >= 3) & (uppers[end] - uppers[start] == k)
    twice = np.zeros(len(data), bool)
    if len(data) > 2:
        twice[2:] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & _LETTER[data[2:]]
        # A text's first two bytes repeat nothing, whatever stands before it in the block.
        twice[at[:-1][at[:-1] < len(data)]] = False
        twice[at[:-1][at[:-1] + 1 < len(data)] + 1] = False
    bad = hit | taught | hidden
    first = np.searchsorted(doc, np.arange(n + 1))
    ran = sums(you)
    i = np.arange(len(doc))
    close = bad & (ran[np.minimum(i + near + 1, first[doc + 1])] - ran[np.maximum(i - near, first[doc])] > 0) if len(doc) else bad
    count = lambda mask: textscan.per_doc(doc, n, mask.astype(float))
    words = np.maximum(textscan.per_doc(doc, n), 1)
    byte = lambda table: (lambda c: c[at[1:]] - c[at[:-1]])(sums(table[data] if table.dtype == bool and len(table) == 256 else table))
    size, n_letters = np.maximum(np.diff(at), 1), np.maximum(byte(_LETTER), 1)
    marks = np.zeros(256, bool)
    marks[33] = True
    return np.stack([
        count(hit) / words, count(hidden) / words, count(taught) / words, np.log1p(count(bad)), count(you) / words, count(close) / words, byte(_UPPER) / n_letters, count(shouted) / words,
        byte(_PUNCT) / size, byte(marks) / size, count(obfuscated) / words, (lambda c: c[at[1:]] - c[at[:-1]])(sums(twice)) / size, np.log1p(textscan.per_doc(doc, n)),
    ], 1)


class Trees:
    """Boosted regression trees of fixed depth over quantile bins, stored as arrays."""

    def __init__(self, depth: int = 3, rounds: int = 60, rate: float = 0.2, bins: int = 32, l2: float = 1.0):
        self.depth, self.rounds, self.rate, self.bins, self.l2 = depth, rounds, rate, bins, l2

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], 1)
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base, self.trees = float(np.log(p / (1 - p))), []
        margin = np.full(len(y), self.base)
        for _ in range(self.rounds):
            q = 1 / (1 + np.exp(-margin))
            g, h = q - y, q * (1 - q)
            node, split = np.zeros(len(y), int), []
            for d in range(self.depth):
                level = []
                for j in range(1 << d):
                    rows = np.flatnonzero(node == j)
                    level.append(self._best(binned[rows], g[rows], h[rows], edges))
                split.append(level)
                f, t = np.array([s[0] for s in level])[node], np.array([s[1] for s in level])[node]
                node = node * 2 + (x[np.arange(len(y)), f] > t)
            leaves = 1 << self.depth
            value = -self.rate * np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + self.l2)
            margin = margin + value[node]
            self.trees.append((split, value))
        return self

    def _best(self, b: np.ndarray, g: np.ndarray, h: np.ndarray, edges) -> tuple[int, float]:
        best, out = 1e-9, (0, np.inf)
        if len(g) < 2:
            return out
        gs, hs = g.sum(), h.sum()
        for f, e in enumerate(edges):
            if not len(e):
                continue
            gl, hl = np.cumsum(np.bincount(b[:, f], g, len(e) + 1))[:-1], np.cumsum(np.bincount(b[:, f], h, len(e) + 1))[:-1]
            gain = gl**2 / (hl + self.l2) + (gs - gl) ** 2 / (hs - hl + self.l2) - gs**2 / (hs + self.l2)
            gain[(hl < 0.5) | (hs - hl < 0.5)] = 0
            k = int(gain.argmax())
            if gain[k] > best:
                best, out = gain[k], (f, float(e[k]))
        return out

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        i = np.arange(len(x))
        for split, value in self.trees:
            node = np.zeros(len(x), int)
            for level in split:
                node = node * 2 + (x[i, np.array([s[0] for s in level])[node]] > np.array([s[1] for s in level])[node])
            out += value[node]
        return out


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the rising step fit (pool adjacent violators), to be interpolated; ties are pooled first."""
    at, inverse = np.unique(margin, return_inverse=True)
    blocks: list[list[float]] = []
    for m, s, n in zip(at, np.bincount(inverse, y), np.bincount(inverse), strict=True):
        blocks.append([m, m, s, n])
        while len(blocks) > 1 and blocks[-2][2] / blocks[-2][3] >= blocks[-1][2] / blocks[-1][3]:
            lo, hi = blocks[-2], blocks.pop()
            blocks[-1] = [lo[0], hi[1], lo[2] + hi[2], lo[3] + hi[3]]
    x = np.array([v for b in blocks for v in (b[0], b[1])])
    return x, np.array([v for b in blocks for v in (b[2] / b[3],) * 2])


class Model:
    def __init__(self, learned: tuple[str, ...], x: np.ndarray, y: np.ndarray, part: np.ndarray):
        """``part`` (0 to 9) splits the rows: 0 to 6 fit the trees, 7 to 9 the calibration."""
        self.learned, self.trees, self.rate = learned, None, float(y.mean()) if len(y) else 0.0
        fit, rest = part < 7, part >= 7
        if len(set(y[fit])) > 1 and len(set(y[rest])) > 1:
            self.trees = Trees().fit(x[fit], y[fit])
            self.knots = isotonic(self.trees.margin(x[rest]), y[rest])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.rate)
        return np.clip(np.interp(self.trees.margin(x), *self.knots), 0, 1)


def _learn_words(rows: DataFrame, most: int) -> tuple[str, ...]:
    """Words whose share in toxic texts is far above that in others, at most ``most``."""
    low = F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = rows.select("toxic", F.explode(F.array_distinct(F.regexp_extract_all(low, F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]{2,40}"), F.lit(0)))).alias("word"))
    n = rows.agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).first()
    if not n["t"] or not n["c"]:
        return ()
    counted = words.groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    odds = F.log((F.col("t") + 0.5) / (n["t"] + 1.0)) - F.log((F.col("c") + 0.5) / (n["c"] + 1.0))
    strong = counted.where(F.col("t") >= max(3, 0.02 * n["t"])).withColumn("odds", odds).where("odds > 2.5")
    return tuple(r["word"] for r in strong.orderBy(F.desc("odds"), "word").limit(most).collect())


def _parts(batches, learned):
    for batch, data, at in textscan.blocks(batches):
        x = features(data, at, learned)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "toxic", "x"])


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, word_rows: int = 3_000, max_words: int = 100) -> Model:
    """Learns from at most ``max_rows`` labelled rows; words from at most ``word_rows`` of them."""
    spread = F.xxhash64("doc_id", F.lit("label"))
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
    chosen = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).orderBy(spread, "doc_id").limit(max_rows)
    # At most max_rows rows of two numbers: a proven bound for the broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")
    total = chosen.count()
    few = rows.where(F.pmod(F.xxhash64("doc_id", F.lit("word")), F.lit(total or 1)) < word_rows)
    learned = _learn_words(few.where("text is not null"), max_words)
    got = rows.mapInArrow(lambda b: _parts(b, learned), "doc_id long, toxic int, x array<double>").orderBy("doc_id").limit(max_rows).toArrow()
    x = np.array(got.column("x").to_pylist(), float).reshape(-1, len(NAMES))
    y = got.column("toxic").to_numpy().astype(float)
    part = (textscan.mix(got.column("doc_id").to_numpy().astype(np.uint64)) % np.uint64(10)).astype(int)
    return Model(learned, x, y, part)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for each document."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        for batch, data, at in textscan.blocks(batches):
            s = m.score(features(data, at, m.learned))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", "text", is_held_out(F.col("doc_id")).alias("held_out")).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
