"""Language ID by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary (and
for every byte). A word's probability is the sum over all its segmentations into
pieces, by the forward algorithm; a text's is the product over its words. Piece
probabilities are fitted by expectation maximisation over all segmentations, on a
bounded sample of labelled rows (``max_rows``, stratified by language, chosen by a
hash of the id), whose words of over ``FIT_STRETCH`` bytes are cut for fitting only.
All texts are scored whole, all words unbroken and with all pieces of the vocabulary.
Words repeat, so each block of texts scores its distinct words once.

Edge cases: null texts and texts without a letter are ``und`` with score 0; so is
everything where no labelled row exists; repeated rows give repeated results. The model takes
0.25 MB for each label; more than ``max_languages`` labels are an error, none is left out.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sieveline.llm import textscan
from sieveline.llm.common import is_held_out

FIT_STRETCH, SPACE = 32, 0x20
#: Numbers held at once by the forward sums, and steps between two rescalings.
CELLS, RESCALE = 4_000_000, 8


def vocabulary(path: str) -> list[bytes]:
    """The pieces of a sentencepiece model as bytes, the word mark as a space; and all single bytes."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    own = {sp.id_to_piece(i).replace("▁", " ").encode() for i in range(sp.get_piece_size()) if not sp.is_control(i) and not sp.is_byte(i) and not sp.is_unknown(i)}
    own = {textscan.LOWER[np.frombuffer(p, np.uint8)].tobytes() for p in own if p}
    # No word holds a space behind its first byte, so pieces that do can't occur.
    return sorted({bytes([b]) for b in range(256)} | {p for p in own if b" " not in p[1:]})


class Pieces:
    """Piece number of any byte range, by a table that hashes address directly."""

    BITS = 20

    def __init__(self, pieces: list[bytes]):
        at = np.cumsum([0, *map(len, pieces)])
        data = np.frombuffer(b"".join(pieces), np.uint8)
        self.hash = np.append(textscan.Rolling(data)(at[:-1], at[1:]), np.uint64(0))
        self.none, self.longest = len(pieces), max(map(len, pieces))
        self.tables, left = [], np.arange(len(pieces))
        for shift in (44, 24, 4):
            table = np.full(1 << self.BITS, self.none, np.int32)
            slot = self._slot(self.hash[left], shift)
            table[slot] = left
            self.tables.append((shift, table))
            left = left[table[slot] != left]
        if len(left):
            raise ValueError("the vocabulary doesn't fit its tables")

    def _slot(self, h: np.ndarray, shift: int) -> np.ndarray:
        return ((h >> np.uint64(shift)) & np.uint64((1 << self.BITS) - 1)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        shift, table = self.tables[0]
        out = table[self._slot(h, shift)]
        wrong = np.flatnonzero((self.hash[out] != h) & (out != self.none))
        for shift, table in self.tables[1:]:
            out[wrong] = table[self._slot(h[wrong], shift)]
            wrong = wrong[(self.hash[out[wrong]] != h[wrong]) & (out[wrong] != self.none)]
        out[wrong] = self.none
        return out


def stretches(data: np.ndarray, at: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, each behind a space, cut into stretches of ``most`` bytes if given: bytes, start, length; each occurrence's document and word; each stretch's word."""
    w = textscan.words(data, at)
    size = w.end - w.start
    h = textscan.Rolling(data)(w.start, w.end)
    _, some, which = np.unique(h, return_index=True, return_inverse=True)
    size, start = size[some], w.start[some]
    total = size + 1
    to = np.cumsum(total) - total
    flat = np.full(int(total.sum()), SPACE, np.uint8)
    i = np.arange(len(flat)) - np.repeat(to, total)
    real = i > 0
    flat[real] = textscan.LOWER[data[(np.repeat(start, total) + i - 1)[real]]]
    if most is None:
        return flat, to, total, w.doc, which, np.arange(len(total))
    parts = -(-total // most)
    of = np.repeat(np.arange(len(total)), parts)
    k = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
    return flat, to[of] + k * most, np.minimum(most, total[of] - k * most), w.doc, which, of


def _ids(pieces: Pieces, flat: np.ndarray, start: np.ndarray, size: np.ndarray):
    """For stretches sorted by falling length: per end position how many reach so far, and their piece numbers by piece length from 1."""
    roll = textscan.Rolling(flat)
    top, t = int(size[0]) if len(size) else 0, 1
    while t <= top:
        k = int(np.searchsorted(-size, -t, "right"))
        # Several positions at once where few stretches are left.
        steps = np.arange(t, min(top, t + max(0, 16_384 // (k * pieces.longest) - 1)) + 1)
        n = np.arange(1, min(int(steps[-1]), pieces.longest) + 1)
        end = np.minimum(start[:k] + steps[:, None, None], len(flat))
        begin = np.maximum(end - n[:, None], 0)
        ids = pieces.find(roll(begin.ravel(), np.broadcast_to(end, begin.shape).ravel())).reshape(begin.shape)
        for i, at in enumerate(steps):
            yield int(at), int(np.searchsorted(-size[:k], -at, "right")), ids[i, : min(int(at), pieces.longest)]
        t = int(steps[-1]) + 1


def _forward(pieces: Pieces, prob: np.ndarray, flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Log of the sum over all segmentations, for stretches sorted by falling length: only the last positions' sums are held, rescaled as they fall."""
    slots = pieces.longest + 1
    ring, scale = np.zeros((slots, len(size), prob.shape[1])), np.zeros((len(size), prob.shape[1]))
    ring[0] = 1
    out = np.zeros_like(scale)
    for t, k, found in _ids(pieces, flat, start, size):
        if k < 64:
            before = ring[(t - 1 - np.arange(len(found))) % slots, :k]
            now = np.einsum("nkj,nkj->kj", before, prob[found[:, :k]])
        else:
            now = ring[(t - 1) % slots, :k] * prob[found[0, :k]]
            for n, ids in enumerate(found[1:, :k], 2):
                hit = np.flatnonzero(ids != pieces.none)
                now[hit] += ring[(t - n) % slots, hit] * prob[ids[hit]]
        done = slice(int(np.searchsorted(-size, -t, "left")), k)
        out[done] = scale[done] + np.log(np.maximum(now[done], 1e-300))
        ring[t % slots, :k] = now
        if t % RESCALE == 0:
            by = np.where(now > 0, now, 1)
            ring[:, :k] /= by
            scale[:k] += np.log(by)
    return out


def log_likelihood(pieces: Pieces, prob: np.ndarray, flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Log of the sum over all segmentations, for each stretch and language; ``prob``: pieces (and none, 0) x languages."""
    order = np.argsort(-size, kind="stable")
    out = np.zeros((len(size), prob.shape[1]))
    most = max(1, CELLS // ((pieces.longest + 1) * prob.shape[1]))
    for i in range(0, len(order), most):
        o = order[i : i + most]
        out[o] = _forward(pieces, prob, flat, start[o], size[o])
    return out


def _expected(pieces: Pieces, prob: np.ndarray, flat, start, size, weight: np.ndarray) -> np.ndarray:
    """Expected piece counts over all segmentations, by forward and backward sums."""
    order = np.argsort(-size, kind="stable")
    start, size, weight = start[order], size[order], weight[order]
    n_pos, langs = int(size[0]) + 1, prob.shape[1]
    alpha, beta = np.zeros((n_pos, len(size), langs)), np.zeros((n_pos, len(size), langs))
    alpha[0] = 1
    found = list(_ids(pieces, flat, start, size))
    for t, k, lookups in found:
        for n, ids in enumerate(lookups[:, :k], 1):
            alpha[t, :k] += alpha[t - n, :k] * prob[ids]
    beta[size, np.arange(len(size))] = 1
    total = np.zeros_like(prob)
    z = np.maximum(alpha[size, np.arange(len(size))], 1e-300)
    for t, k, lookups in reversed(found):
        for n, ids in enumerate(lookups[:, :k], 1):
            p = prob[ids] * beta[t, :k]
            e = alpha[t - n, :k] * p / z[:k] * weight[:k]
            for j in range(langs):
                total[:, j] += np.bincount(ids, e[:, j], len(prob))
            beta[t - n, :k] += p
    total[pieces.none] = 0
    return total


def fit(texts: list[str], langs: list[str], pieces: list[bytes], rounds: int = 3) -> tuple[list[str], np.ndarray]:
    """Languages and their piece probabilities (pieces + none x languages)."""
    names = sorted(set(langs))
    table = Pieces(pieces)
    raw = [t.encode() for t in texts]
    data, at = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    flat, start, size, doc, which, of = stretches(data, at, FIT_STRETCH)
    lang = np.searchsorted(names, langs)[doc]
    uses = np.stack([np.bincount(which[lang == j], minlength=int(which.max()) + 1 if len(which) else 0) for j in range(len(names))], 1)[of].astype(float)
    length = np.array([len(p) for p in pieces] + [1])
    prob = np.repeat((0.05 ** np.minimum(length, 4) * 0.6 ** length)[:, None], len(names), 1)
    prob[table.none] = 0
    prob /= prob.sum(0)
    most = max(1, CELLS // (FIT_STRETCH * len(names)))
    for _ in range(rounds):
        count = np.zeros_like(prob)
        for i in range(0, len(start), most):
            s = slice(i, i + most)
            count += _expected(table, prob, flat, start[s], size[s], uses[s])
        count += 0.02
        count[table.none] = 0
        prob = count / count.sum(0)
    return names, prob


@cache
def _table(pieces: tuple[bytes, ...]) -> Pieces:
    return Pieces(list(pieces))


def quotas(counts: dict[str, int], max_rows: int) -> dict[str, int]:
    """Rows to take of each language: all of the small ones, the rest in equal parts, one at least."""
    out, left = {}, max_rows
    for i, (lang, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        out[lang] = max(1, min(n, left // (len(counts) - i)))
        left -= out[lang]
    return out


def training_rows(docs: DataFrame, max_rows: int, max_languages: int = 4000) -> list:
    """text, lang of at most ``max_rows`` labelled rows that aren't held out, about as many of each language."""
    known = docs.where(~is_held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = known.groupBy("lang").count().limit(max_languages + 1).collect()
    if len(counts) > max_languages:
        raise ValueError(f"more than {max_languages} labels to tell apart")
    if not counts:
        return []
    take = F.create_map(*[F.lit(x) for lang, n in quotas({r["lang"]: r["count"] for r in counts}, max_rows).items() for x in (lang, n)])
    most = max(max_rows, 1)
    known = known.select("doc_id", "lang", "text", F.xxhash64("doc_id", F.lit("train")).alias("spread"))
    # Each language's last hash without the texts first: no task keeps more than max_rows of a language.
    place = Window.partitionBy("lang").orderBy("spread")
    ranked = known.select("lang", "spread").withColumn("place", F.row_number().over(place)).where(F.col("place") <= most)
    ends = ranked.where(F.col("place") <= F.element_at(take, F.col("lang"))).groupBy("lang").agg(F.max("spread").alias("end")).collect()
    end = F.create_map(*[F.lit(x) for r in ends for x in (r["lang"], r["end"])])
    near = known.where(F.col("spread") <= F.element_at(end, F.col("lang")))
    # Rows that repeat the last id have its hash.
    place = Window.partitionBy("lang").orderBy("spread", "doc_id", F.xxhash64("text"))
    near = near.withColumn("place", F.row_number().over(place)).where(F.col("place") <= most)
    return near.where(F.col("place") <= F.element_at(take, F.col("lang"))).orderBy("lang", "place").select("text", "lang").collect()


def predict(docs: DataFrame, vocabulary_path: str, max_rows: int = 800, max_languages: int = 4000) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each document; ``max_rows`` bounds the rows learned from (one at least of each language)."""
    pieces = vocabulary(vocabulary_path)
    rows = training_rows(docs, max_rows, max_languages)
    names, prob = fit([r["text"] for r in rows], [r["lang"] for r in rows], pieces) if rows else ([], None)
    # As large as the vocabulary times the languages, whatever the input.
    model = docs.sparkSession.sparkContext.broadcast((tuple(pieces), names, prob))

    def run(batches):
        pieces, names, prob = model.value
        table = _table(pieces)
        for batch, data, at in textscan.blocks(batches):
            n = len(at) - 1
            best, score = np.array(["und"] * n, object), np.zeros(n)
            if names:
                flat, start, size, doc, which, _ = stretches(data, at)
                word = log_likelihood(table, prob, flat, start, size)
                total = np.stack([textscan.per_doc(doc, n, word[which, j]) for j in range(len(names))], 1)
                total -= total.max(1, keepdims=True)
                p = np.exp(total)
                p /= p.sum(1, keepdims=True)
                has = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
                best[has], score[has] = np.array(names, object)[p.argmax(1)[has]], p.max(1)[has]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), pa.array(best, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.select("doc_id", "text", letter.alias("letter"), is_held_out(F.col("doc_id")).alias("held_out")).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
