"""BPE encoding and decoding by speculating and verifying.

For each distinct word of a block of texts greedy longest match proposes tokens. By the
theory of merges a proposal is the word's encoding if each of its adjacent pairs is one by
itself; a pair is, unless some merge joins the left token's right edge to the right token's
left edge before either edge grows. That is tested for all new pairs of a block at once, by
numpy over the edges' merge trees. Only words with a pair that fails go through exact
merging. Words and pairs that were judged are remembered by the task, up to ``REMEMBERED``.

The vocabulary is a ``tokenizers`` file of the kind with word ends: its own normalizer and
splitting, merges by rank, no continuing prefix. Splitting texts of Latin letters alone
takes one regular expression of equal effect; all other texts go through the file's own
normalizer and splitter. Strings of added tokens inside a text are those tokens, as the
library has it.

Edge cases: null and empty texts have no tokens and decode to an empty string; rows with
the same id, or none, are encoded each for itself; very long texts and words are encoded
whole (merging takes n log n steps); an empty table gives an empty result; extra columns
are passed on, except that ``n_tokens``, ``packed`` and ``decoded`` are the operator's.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from sieveline.llm.common import reach_workers

#: Words and pairs that a task remembers; beyond that it forgets all and starts again.
REMEMBERED = 1 << 19
#: Characters of text whose words are judged together.
BLOCK = 1 << 20
#: Letters up to which a word's pairs are searched one by one.
SHORT = 48
_BASE = 1 << 20
_NEVER = np.int64(1) << 40
_NO = (1 << 40, -1)

#: White space of the splitter's regular expression engine, written out.
_WHITE = "\\t-\\r \\x85\\xa0"
_LATIN = re.compile("[\\x00-\\u024f]*")
_WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_WHITE}\p{{L}}\p{{N}}]+")


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if it prints, else one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(other)) for b in range(256)]


class Vocabulary:
    """Tokens, merges, and for each token that merging reaches its edges' merge trees."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or not model.get("end_of_word_suffix") or model.get("continuing_subword_prefix") or model.get("dropout"):
            raise ValueError("not a vocabulary with word ends")
        self.suffix = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = token_names(path)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        #: (left, right) to (rank, joined)
        self.merges = {(self.ids[a], self.ids[b]): (rank, self.ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        letters = _byte_letters()
        self.inner = [self.ids[c] for c in letters]
        self.final = [self.ids[c + self.suffix] for c in letters]
        self.letters = str.maketrans({chr(b): c for b, c in enumerate(letters)})
        self._trees()
        self.splitter = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.words: dict[str, bytes] = {}

    def _symbols(self, token: str) -> list[int]:
        ended = token.endswith(self.suffix) and len(token) > len(self.suffix)
        plain = token[: -len(self.suffix)] if ended else token
        out = [self.ids[c] for c in plain]
        if ended:
            out[-1] = self.ids[plain[-1] + self.suffix]
        return out

    def _trees(self) -> None:
        """Which tokens merging reaches from their letters, by which last merge, and the edges of each."""
        n = len(self.tokens)
        left, right, born = np.full(n, -1), np.full(n, -1), np.full(n, _NEVER)
        born[[*self.inner, *self.final]] = -1
        #: Whether each merge stands behind those that make its parts; else pairs are verified by merging.
        self.ordered = True
        for (a, b), (rank, made) in self.merges.items():
            if born[made] == _NEVER:
                left[made], right[made], born[made] = a, b, rank
            self.ordered &= bool(born[a] < rank and born[b] < rank)
        codes = np.array([a * _BASE + b for a, b in self.merges], np.int64)
        order = np.argsort(codes)
        self.codes, self.ranks = codes[order], np.array([r for r, _ in self.merges.values()], np.int64)[order]
        # Edges of a token: the token, its outer part, that one's outer part, and so on; with each the rank at which it grows into the former.
        self.right_edge, self.left_edge = self._edges(right, born), self._edges(left, born)
        made = np.flatnonzero(left >= 0)
        # A token is reached if its parts are and no earlier merge joins them otherwise.
        good = self.compatible(left[made], right[made], born[made]) if self.ordered else np.array([self.merge(self._symbols(self.tokens[t])) == [t] for t in made])
        reached = born == -1
        for t, ok in sorted(zip(made.tolist(), good.tolist(), strict=True), key=lambda x: born[x[0]]):
            reached[t] = ok and reached[left[t]] and reached[right[t]]
        self.spell = {self.tokens[t].removesuffix(self.suffix) + "\n" if self.tokens[t].endswith(self.suffix) and len(self.tokens[t]) > len(self.suffix) else self.tokens[t]: int(t) for t in np.flatnonzero(reached)}
        #: By their first four letters the lengths of longer tokens; by any four letters of a word the lengths to try there, longest first.
        self.heads: dict[str, set[int]] = {}
        for t in self.spell:
            if len(t) >= 4:
                self.heads.setdefault(t[:4], set()).add(len(t))
        self.lengths: dict[str, tuple[int, ...]] = {}
        self.known = np.zeros(0, np.int64)
        self.verdict = np.zeros(0, bool)

    @staticmethod
    def _edges(part: np.ndarray, born: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        node, grows = np.arange(len(part)), np.full(len(part), _NEVER)
        nodes, grown = [], []
        while (node >= 0).any():
            nodes.append(node)
            grown.append(grows)
            grows = np.where(node >= 0, born[node], -2)
            node = np.where(node >= 0, part[node], -1)
        return np.array(nodes), np.array(grown)

    def compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge joins ``a``'s right edge with ``b``'s left one (of a rank below ``before``, if given) before an edge grows."""
        ok = np.ones(len(a), bool)
        for node_a, grow_a in zip(*self.right_edge, strict=True):
            x, ga = node_a[a], grow_a[a]
            if not (x >= 0).any():
                break
            for node_b, grow_b in zip(*self.left_edge, strict=True):
                y, gb = node_b[b], grow_b[b]
                at = np.flatnonzero(ok & (x >= 0) & (y >= 0))
                if not len(at):
                    break
                code = x[at] * _BASE + y[at]
                i = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
                rank = np.where(self.codes[i] == code, self.ranks[i], _NEVER)
                # Of equal merges the one further left goes first: ``a``'s own, but not ``b``'s.
                joins = (rank < ga[at]) & (rank <= gb[at]) & (rank < _NEVER)
                if before is not None:
                    joins &= rank < before[at]
                ok[at[joins]] = False
        return ok

    def merge(self, symbols: list[int]) -> list[int]:
        """Exact merging: the lowest rank first, of equal ones the leftmost; long words by a heap over a linked list."""
        n, merges = len(symbols), self.merges
        if n <= SHORT:
            ids, get = [*symbols], merges.get
            ranks = [get(p, _NO)[0] for p in zip(ids, ids[1:])]  # noqa: B905
            while ranks and (rank := min(ranks)) < _NO[0]:
                i = ranks.index(rank)
                ids[i : i + 2] = [merges[ids[i], ids[i + 1]][1]]
                del ranks[i]
                if i:
                    ranks[i - 1] = get((ids[i - 1], ids[i]), _NO)[0]
                if i < len(ranks):
                    ranks[i] = get((ids[i], ids[i + 1]), _NO)[0]
            return ids
        ids, follow, before = [*symbols], [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(m[0], i, ids[i], ids[i + 1]) for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, x, y = heapq.heappop(heap)
            j = follow[i]
            if j < 0 or ids[i] != x or ids[j] != y:
                continue
            ids[i], ids[j] = merges[x, y][1], -1
            follow[i] = k = follow[j]
            if k >= 0:
                before[k] = i
                if m := merges.get((ids[i], ids[k])):
                    heapq.heappush(heap, (m[0], i, ids[i], ids[k]))
            if (h := before[i]) >= 0 and (m := merges.get((ids[h], ids[i]))):
                heapq.heappush(heap, (m[0], h, ids[h], ids[i]))
        return [t for t in ids if t >= 0]

    def propose(self, spelled: str) -> list[int]:
        """Greedy longest match over a word's letters and the mark ``\\n`` of its end; a token takes its last letter with the mark or neither."""
        spell, lengths, n, i, out = self.spell, self.lengths, len(spelled), 0, []
        while i < n:
            four = spelled[i : i + 4]
            sizes = lengths.get(four)
            if sizes is None:
                if len(lengths) > REMEMBERED:
                    lengths.clear()
                sizes = lengths[four] = (*sorted(self.heads.get(four, ()), reverse=True), *(k for k in (3, 2, 1) if four[:k] in spell and k <= len(four)))
            for size in sizes:
                j = i + size
                if j <= n and j != n - 1 and (t := spell.get(spelled[i:j])) is not None:
                    out.append(t)
                    i = j
                    break
            else:
                return []
        return out

    def _judged(self, pairs: np.ndarray) -> np.ndarray:
        """The verdict on each pair of ``pairs`` (codes); new ones are tested, together."""
        new = np.unique(pairs)
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, new), len(self.known) - 1)
            new = new[self.known[at] != new]
        if len(new):
            a, b = new // _BASE, new % _BASE
            good = self.compatible(a, b) if self.ordered else np.array([self.merge(self._symbols(self.tokens[x]) + self._symbols(self.tokens[y])) == [x, y] for x, y in zip(a.tolist(), b.tolist(), strict=True)], bool)
            if len(self.known) > REMEMBERED:
                here = np.unique(pairs)
                kept = np.isin(self.known, here, assume_unique=True)
                self.known, self.verdict = self.known[kept], self.verdict[kept]
            known, verdict = np.concatenate([self.known, new]), np.concatenate([self.verdict, good])
            order = np.argsort(known)
            self.known, self.verdict = known[order], verdict[order]
        return self.verdict[np.searchsorted(self.known, pairs)]

    def learn(self, spelled: list[str]) -> list[bytes]:
        """The packed ids of words in the vocabulary's letters: proposals, one test of all pairs, exact merging where it fails."""
        marked = [w + "\n" for w in spelled]
        proposals = [self.propose(w) for w in marked]
        size = np.array([len(p) for p in proposals], np.int64)
        flat = np.fromiter((t for p in proposals for t in p), np.int64, int(size.sum()))
        word = np.repeat(np.arange(len(size)), size)
        inside = np.flatnonzero(word[1:] == word[:-1]) if len(word) else np.zeros(0, np.int64)
        failed = size == 0
        if len(inside):
            failed[word[inside[~self._judged(flat[inside] * _BASE + flat[inside + 1])]]] = True
        ends = 4 * np.cumsum(size)
        packed = flat.astype("<u4").tobytes()
        out = [packed[a:b] for a, b in zip((ends - 4 * size).tolist(), ends.tolist(), strict=True)]
        for i in np.flatnonzero(failed).tolist():
            out[i] = np.array(self.merge(self._symbols(spelled[i] + self.suffix)), "<u4").tobytes()
        return out


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@cache
def token_names(path: str) -> list[str]:
    """The string of each id; all that decoding needs."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    named = [*spec["model"]["vocab"].items(), *((t["content"], t["id"]) for t in spec["added_tokens"])]
    out = [""] * (1 + max(i for _, i in named))
    for text, i in named:
        out[i] = text
    return out


@cache
def _library(path: str):
    """The file's own normalizer and splitter, for texts beyond Latin letters."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    return t.normalizer, t.pre_tokenizer


def split(vocab: Vocabulary, path: str, text: str) -> list[str]:
    """The words of a text, lower-cased; those of a text beyond Latin letters in the vocabulary's own letters, marked by a line feed before them."""
    parts = vocab.splitter.split(text) if vocab.splitter else [text]
    out: list[str] = []
    for k, part in enumerate(parts):
        if k % 2:
            out.append("\n\n" + part)
        elif _LATIN.fullmatch(part):
            out += _WORDS.findall(part.lower())
        else:
            normalizer, splitter = _library(path)
            out += ["\n" + w for w, _ in splitter.pre_tokenize_str(normalizer.normalize_str(part))]
    return out


def encode_texts(vocab: Vocabulary, path: str, texts: list[str]) -> list[bytes]:
    """The ids of each text as little-endian unsigned 32-bit integers."""
    of = [split(vocab, path, t) for t in texts]
    new = list({w for words in of for w in words if w not in vocab.words})
    if len(vocab.words) + len(new) > REMEMBERED:
        vocab.words.clear()
        new = list({w for words in of for w in words})
    plain = [w for w in new if not w.startswith("\n\n")]
    spelled = [w[1:] if w.startswith("\n") else w.encode().decode("latin-1").translate(vocab.letters) for w in plain]
    vocab.words.update(zip(plain, vocab.learn(spelled), strict=True))
    vocab.words.update((w, np.array([vocab.added[w[2:]]], "<u4").tobytes()) for w in new if w.startswith("\n\n"))
    get = vocab.words.__getitem__
    return [b"".join(map(get, words)) for words in of]


def _with(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    kept = [(n, batch.column(i)) for i, n in enumerate(batch.schema.names) if n.lower() not in columns]
    return pa.RecordBatch.from_arrays([c for _, c in kept] + list(columns.values()), [n for n, _ in kept] + list(columns))


def _schema(df: DataFrame, own: str):
    names = {f.split()[0] for f in own.split(", ")}
    return ", ".join([f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name.lower() not in names] + [own])


def _slices(batch: pa.RecordBatch, column: str):
    """Parts of the batch that hold about ``BLOCK`` bytes of the column (or one row), so that memory doesn't follow the rows of a batch."""
    size = np.cumsum(np.array(pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)))
    i = 0
    while i < len(batch):
        j = max(i + 1, int(np.searchsorted(size, (size[i - 1] if i else 0) + BLOCK, "right")))
        yield batch.slice(i, j - i)
        i = j


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """The columns of ``docs`` and n_tokens, packed: a text's ids as little-endian unsigned 32-bit integers, as token files hold them."""
    reach_workers(docs.sparkSession)

    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            for part in _slices(batch, text):
                packed = encode_texts(vocab, path, [t or "" for t in part.column(part.schema.get_field_index(text)).to_pylist()])
                yield _with(part, {"n_tokens": pa.array([len(p) // 4 for p in packed], pa.int64()), "packed": pa.array(packed, pa.binary())})

    return docs.mapInArrow(run, _schema(docs, "n_tokens bigint, packed binary"))


def decode(encoded: DataFrame, path: str, packed: str = "packed") -> DataFrame:
    """The columns of ``encoded`` and decoded: the tokens' strings, a blank between two, as the library decodes where a file names no decoder."""
    reach_workers(encoded.sparkSession)

    def run(batches):
        name = token_names(path).__getitem__
        for batch in batches:
            for part in _slices(batch, packed):
                ids = part.column(part.schema.get_field_index(packed)).to_pylist()
                yield _with(part, {"decoded": pa.array([" ".join(map(name, np.frombuffer(p or b"", "<u4").tolist())) for p in ids], pa.string())})

    return encoded.mapInArrow(run, _schema(encoded, "decoded string"))
