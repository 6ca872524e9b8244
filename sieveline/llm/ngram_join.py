"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures.

Texts become sets of hashed 5-word shingles; equal sets form one class, so copies
are never paired. The join is exact for classes:

1. All shingles are ordered by a hashed frequency table (fixed size, counted over
   all documents), rare ones first. Two linked sets share one of their first
   ``n - ceil(0.8 n) + 1`` shingles; only these prefixes are shuffled. Pairs that meet
   at rare shingles alone are counted: sets of like sizes have to share many of them.
2. A shared prefix shingle's classes, sorted by set size, are cut into blocks of
   ``BAND`` rows: size bands. Each pair of bands whose sizes are compatible is a tile.
3. In a tile the bit count of two bitmaps' difference bounds the overlap from above;
   bitmaps are as wide as their sets are large, and a wide one folds to half its width.
   From the pairs that pass, small tiles give all, larger ones a maximum spanning
   forest: links inside a forest's component can't change a component.
4. Each given pair is verified by intersecting the sorted arrays. Larger tiles that
   hold several components after that run once more and give all pairs between
   different components that pass the bound. No partner and no candidate is capped.

Set members are 64-bit hashes, and so are class names.

Edge cases: null, empty and blank texts have no shingles and are their own
component; fewer words than five are one shingle; repeated ids are separate rows;
ties in size or frequency fall to the hash order; an empty table gives no rows.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm import textscan
from sieveline.llm.common import components, cut

TABLE_BITS, BAND, SMALL = 18, 1024, 8
#: A bitmap has the smallest power of two of bits that is ``SPREAD`` times the set's size, at least ``NARROW``.
NARROW, SPREAD = 256, 2


def _sets(data: np.ndarray, at: np.ndarray, weight: np.ndarray | None = None):
    """Distinct shingles of each document, sorted by (document, weight, hash): hashes, documents, set sizes, first indexes."""
    w = textscan.words(data, at)
    h, doc = textscan.shingles(textscan.Rolling(data)(w.start, w.end), w)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[keep], doc[keep]
    if weight is not None:
        order = np.lexsort((h, weight[(h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)], doc))
        h = h[order]
    n = textscan.per_doc(doc, len(at) - 1).astype(np.int64)
    return h, doc, n, np.cumsum(n) - n


def _classes(h: np.ndarray, n: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A class name for each document's set (0 where it is empty)."""
    out = np.zeros(len(n), np.uint64)
    some = np.flatnonzero(n)
    if len(some):
        out[some] = textscan.mix(np.add.reduceat(textscan.mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), first[some]) + n[some].astype(np.uint64))
    return out


def _widths(n: np.ndarray) -> np.ndarray:
    """Bits of the bitmaps of sets of these sizes."""
    return 1 << np.ceil(np.log2(np.maximum(n * SPREAD, NARROW))).astype(np.int64)


def _bitmaps(h: np.ndarray, doc: np.ndarray, width: np.ndarray) -> pa.Array:
    """Parity bitmaps: the difference of two has at most one bit per element of the symmetric difference."""
    end = np.cumsum(width)
    bit = (end - width)[doc] + (h & (width[doc] - 1).astype(np.uint64)).astype(np.int64)
    parity = (np.bincount(bit, minlength=end[-1]) & 1).astype(bool)
    at = np.concatenate([[0], end // 8]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(width), [None, pa.py_buffer(at), pa.py_buffer(np.packbits(parity, bitorder="little"))])


def _half(bits: np.ndarray) -> np.ndarray:
    """The same sets' bitmaps of half the width."""
    k = bits.shape[-1] // 2
    return bits[..., :k] ^ bits[..., k:]


def _fresh(cls: np.ndarray, seen: set) -> np.ndarray:
    """Which documents bring a class that this task hasn't had."""
    out = np.zeros(len(cls), bool)
    for i, c in enumerate(cls.tolist()):
        if c and c not in seen:
            seen.add(c)
            out[i] = True
    return out


def _describe(batches):
    for batch, data, at in textscan.blocks(batches, most=textscan.BLOCK // 2):
        h, doc, n, first = _sets(data, at)
        cls = _classes(h, n, first)
        width = _widths(n)
        # Some 2 ** 22 bits at a time.
        ends = [*(np.flatnonzero(np.diff(np.cumsum(width) >> 22)) + 1).tolist(), len(n)]
        for i, j in zip([0, *ends[:-1]], ends, strict=True):
            if i < j:
                own = slice(int(first[i]), int(first[j - 1] + n[j - 1]))
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.array(n[i:j]), pa.array(cls[i:j].view(np.int64)), _bitmaps(h[own], doc[own] - i, width[i:j])], ["doc_id", "n", "cls", "bits"])


def _count(batches):
    total, seen = np.zeros(1 << TABLE_BITS, np.int64), set()
    for _, data, at in textscan.blocks(batches):
        h, doc, n, first = _sets(data, at)
        new = _fresh(_classes(h, n, first), seen)
        total += np.bincount((h[new[doc]] >> np.uint64(64 - TABLE_BITS)).astype(np.int64), minlength=1 << TABLE_BITS)
    if seen:
        parts = total.astype(np.int32 if total.max() < 2**31 else np.int64).reshape(32, -1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(32)), pa.array([p.astype(np.int64).tobytes() for p in parts], pa.binary())], ["part", "counts"])


def _add(key, table):
    return pa.table({"part": [key[0].as_py()], "counts": [sum(np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist()).tobytes()]})


def frequencies(docs: DataFrame) -> np.ndarray:
    """How often shingles of each hash prefix occur, over all documents: a table of fixed size."""
    parts = docs.select("text").mapInArrow(_count, "part long, counts binary").groupBy("part").applyInArrow(_add, "part long, counts binary").collect()
    out = np.zeros((32, (1 << TABLE_BITS) // 32), np.int64)
    for r in parts:
        out[r["part"]] = np.frombuffer(r["counts"], np.int64)
    return out.ravel()


def _ceil(a: np.ndarray, num: int, den: int) -> np.ndarray:
    return -(-a * num // den)


def _prefixes(batches, weight: np.ndarray):
    seen: set = set()
    for _, data, at in textscan.blocks(batches):
        h, doc, n, first = _sets(data, at, weight)
        # The class doesn't depend on the order: its sum is commutative.
        cls = _classes(h, n, first)
        new = _fresh(cls, seen)
        place = np.arange(len(h)) - first[doc]
        out = np.flatnonzero(new[doc] & (place < (n - _ceil(n, 4, 5) + 1)[doc]))
        d = doc[out]
        yield pa.RecordBatch.from_arrays([pa.array(h[out].view(np.int64)), pa.array(n[d].astype(np.int32)), pa.array(cls[d].view(np.int64))], ["key", "n", "cls"])


def _compatible(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 5 * np.minimum(a, b) >= 4 * np.maximum(a, b)


def _shared(batches):
    """From rows sorted by key, size and class, for each key of several classes: all pairs of compatible sizes of up
    to ``SMALL`` classes (``other`` is set; a pair once for each such key), or else the classes with their band."""
    names = ["key", "n", "cls"]
    # Rows whose key may go on; the key, rows given and last class of a long run that goes on.
    held: dict | None = None
    going, given, last = None, 0, None

    def give(c: dict) -> pa.RecordBatch:
        key, n = c["key"], c["n"].astype(np.int64)
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(key)))
        run = np.cumsum(new) - 1
        pos = np.arange(len(key)) - start[run]
        long = size[run] > SMALL
        if going is not None and len(key):
            own = key == going
            long |= own
            pos[own] += given
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for d in range(1, SMALL):
            x = np.arange(max(0, len(key) - d))
            y = x + d
            ok = (run[x] == run[y]) & ~long[x] & _compatible(n[x], n[y])
            a.append(x[ok])
            b.append(y[ok])
        a, b = np.concatenate(a), np.concatenate(b)
        swap = c["cls"][a] > c["cls"][b]
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        pair = np.stack([c["cls"][a], c["cls"][b], n[a], n[b]])
        rows = np.flatnonzero(long)
        none = pa.nulls(len(rows), pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([c["key"][rows], np.zeros(pair.shape[1], np.int64)])), pa.array(np.concatenate([n[rows], pair[2]])), pa.array(np.concatenate([c["cls"][rows], pair[0]])),
                pa.concat_arrays([none, pa.array(pair[1])]), pa.array(np.concatenate([n[rows], pair[3]])), pa.array(np.concatenate([pos[rows] // BAND, pair[2] * 0]).astype(np.int32)),
            ],
            ["key", "n", "cls", "other", "other_n", "band"],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        c = {x: batch.column(i).to_numpy(zero_copy_only=False) for i, x in enumerate(names)}
        if held is not None:
            c = {x: np.concatenate([held[x], c[x]]) for x in names}
        keep = np.ones(len(c["key"]), bool)
        keep[1:] = (c["key"][1:] != c["key"][:-1]) | (c["cls"][1:] != c["cls"][:-1])
        if going is not None:
            keep[0] &= (c["key"][0] != going) | (c["cls"][0] != last)
        c = {x: v[keep] for x, v in c.items()}
        if not len(c["key"]):
            held = None
            continue
        end = len(c["key"]) - int((c["key"] == c["key"][-1]).sum())
        if len(c["key"]) - end > SMALL or c["key"][-1] == going:
            end = len(c["key"])
        if end:
            done = {x: v[:end] for x, v in c.items()}
            yield give(done)
            tail = int((done["key"] == done["key"][-1]).sum())
            if end == len(c["key"]):
                given = given + tail if done["key"][-1] == going else tail
                going, last = done["key"][-1], done["cls"][-1]
            else:
                going = None
        held = {x: v[end:] for x, v in c.items()} if end < len(c["key"]) else None
    if held is not None:
        yield give(held)


def _possible(batches):
    """Of pairs with sizes and bitmaps those whose overlap bound passes."""
    for batch in batches:
        n, m = (batch.column(c).to_numpy() for c in ("n", "other_n"))
        apart = np.zeros(len(n), np.int64)
        for k, pair in enumerate(zip(batch.column("x"), batch.column("y"), strict=True)):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in pair)
            if len(x) != len(y):
                x, y = (_half(x), y) if len(x) > len(y) else (x, _half(y))
            apart[k] = np.bitwise_count(x ^ y).sum(dtype=np.int64)
        yield batch.select(["a", "b"]).filter(pa.array(9 * ((n + m - apart) // 2) >= 4 * (n + m)))


class _Tile:
    """Sets in order of size: their bitmaps by width. Compatible sizes have the same width or one the double of the other."""

    def __init__(self, n: np.ndarray, raw: list[bytes]):
        self.n = n
        self.lo, self.hi = np.searchsorted(5 * n, 4 * n), np.searchsorted(4 * n, 5 * n, "right")
        width = np.array([len(x) for x in raw])
        cuts = [0, *(np.flatnonzero(np.diff(width)) + 1).tolist(), len(n)]
        self.groups = []
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            bits = np.frombuffer(b"".join(raw[s:e]), np.uint64).reshape(e - s, -1)
            self.groups.append((s, e, bits, _half(bits)))

    def bounds(self, u: int, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Upper bounds of the overlaps of row u with rows lo to hi, as a share of both sizes; and whether they allow a link."""
        own, half = next((bits[u - s], halves[u - s]) for s, e, bits, halves in self.groups if s <= u < e)
        apart = np.zeros(hi - lo, np.int64)
        for s, e, bits, halves in self.groups:
            a, b = max(s, lo), min(e, hi)
            if a < b:
                wide = bits.shape[1]
                x, y = (bits, own) if wide == len(own) else (halves, own) if wide > len(own) else (bits, half)
                apart[a - lo : b - lo] = np.bitwise_count(x[a - s : b - s] ^ y).sum(1, dtype=np.int64)
        total = self.n[lo:hi] + self.n[u]
        bound = (total - apart) // 2
        return bound / total, 9 * bound >= 4 * total


def _forest(tile: _Tile) -> list[tuple[int, int]]:
    """A maximum spanning forest (Prim) of the pairs whose overlap bound passes."""
    m, out = len(tile.n), []
    best, parent, inside = np.full(m, -1.0), np.full(m, -1), np.zeros(m, bool)
    u = 0
    for _ in range(m):
        inside[u] = True
        if parent[u] >= 0:
            out.append((int(parent[u]), u))
        near = slice(int(tile.lo[u]), int(tile.hi[u]))
        share, passes = tile.bounds(u, near.start, near.stop)
        better = near.start + np.flatnonzero(passes & (share > best[near]) & ~inside[near])
        best[better], parent[better] = share[better - near.start], u
        u = int(np.where(inside, -2.0, best).argmax())
    return out


def _between(tile: _Tile, comp: np.ndarray) -> list[tuple[int, int]]:
    """All pairs of different components whose overlap bound passes."""
    out = []
    for u in range(len(tile.n) - 1):
        if u + 1 < (hi := int(tile.hi[u])):
            _, passes = tile.bounds(u, u + 1, hi)
            out += [(u, u + 1 + int(v)) for v in np.flatnonzero(passes & (comp[u + 1 : hi] != comp[u]))]
    return out


def _tiles(batches, again: bool):
    """Candidate pairs of each tile; rows sorted by tile, then size and class."""
    held: list[pa.RecordBatch] = []
    given: set = set()

    def pairs(t: pa.Table):
        tile = np.stack([t.column(c).to_numpy() for c in ("key", "i", "j")], 1)
        n, cls, comp = (t.column(c).to_numpy() for c in ("n", "cls", "comp"))
        bits = t.column("bits").to_pylist()
        begin = np.concatenate([[0], np.flatnonzero((tile[1:] != tile[:-1]).any(1)) + 1, [len(n)]])
        new = []
        for s, e in zip(begin[:-1], begin[1:], strict=True):
            own = slice(s, e)
            names = cls[own].tolist()
            rows = _Tile(n[own], bits[own])
            for u, v in _between(rows, comp[own]) if again else _forest(rows):
                p = (min(names[u], names[v]), max(names[u], names[v]))
                if p not in given:
                    given.add(p)
                    new.append(p)
        # The same pair comes from many tiles; a bounded memory of the last ones saves shuffling.
        if len(given) > 200_000:
            given.clear()
        arr = np.array(new, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(arr[:, 0]), pa.array(arr[:, 1])], ["a", "b"])

    def key(batch, i):
        return tuple(batch.column(c)[i].as_py() for c in range(3))

    for batch in batches:
        if not batch.num_rows:
            continue
        tail = batch.num_rows
        end = key(batch, batch.num_rows - 1)
        cols = np.stack([batch.column(c).to_numpy() for c in range(3)], 1)
        other = np.flatnonzero((cols != np.array(end)).any(1))
        tail = int(other[-1]) + 1 if len(other) else 0
        if tail or (held and key(held[-1], held[-1].num_rows - 1) != key(batch, 0)):
            yield pairs(pa.Table.from_batches([*held, batch.slice(0, tail)]))
            held = []
        held.append(batch.slice(tail))
    if held:
        yield pairs(pa.Table.from_batches(held))


def _verify(batches):
    for batch in batches:
        ok = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            common = len(np.intersect1d(p, q, assume_unique=True))
            ok.append(100 * common >= 80 * (len(p) + len(q) - common))
        yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


_FILTER_BITS = 24


def _slots(cls: np.ndarray) -> list[np.ndarray]:
    m = textscan.mix(cls.view(np.uint64))
    return [((m >> np.uint64(s)) & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64) for s in (0, 32)]


def _mark(batches):
    bits = None
    for batch in batches:
        bits = np.zeros(1 << _FILTER_BITS, bool) if bits is None else bits
        for s in _slots(batch.column(0).to_numpy()):
            bits[s] = True
    if bits is not None:
        parts = np.packbits(bits).reshape(16, -1)
        some = [i for i in range(16) if parts[i].any()]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([parts[i].tobytes() for i in some], pa.binary())], ["part", "bits"])


def _or(key, table):
    return pa.table({"part": [key[0].as_py()], "bits": [np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in table.column("bits").to_pylist()]).tobytes()]})


def _arrays(docs: DataFrame, involved: DataFrame) -> DataFrame:
    """Checkpointed cls, shingles of the classes of ``involved(cls)``; a Bloom filter of fixed size spares the shuffle most others."""
    parts = involved.select("cls").mapInArrow(_mark, "part long, bits binary").groupBy("part").applyInArrow(_or, "part long, bits binary").collect()
    bits = np.zeros((16, (1 << _FILTER_BITS) // 128), np.uint8)
    for r in parts:
        bits[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    held = docs.sparkSession.sparkContext.broadcast(bits.ravel())

    def run(batches):
        known, seen = held.value, set()
        for _, data, at in textscan.blocks(batches):
            h, _, n, first = _sets(data, at)
            cls = _classes(h, n, first)
            wanted = np.ones(len(cls), bool)
            for s in _slots(cls.view(np.int64)):
                wanted &= (known[s >> 3] >> (7 - (s & 7))) & 1 == 1
            take = np.flatnonzero(wanted & (n > 0))
            take = take[_fresh(cls[take], seen)]
            yield pa.RecordBatch.from_arrays([pa.array(cls[take].view(np.int64)), pa.array([h[first[i] : first[i] + n[i]].tobytes() for i in take], pa.binary())], ["cls", "shingles"])

    got = docs.select("text").mapInArrow(run, "cls long, shingles binary")
    return cut(got.join(involved, "cls", "left_semi").groupBy("cls").agg(F.min("shingles").alias("shingles")))


def ngram_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for each document: linked by 5-word shingles with a Jaccard similarity of 0.8."""
    spark = docs.sparkSession
    d = cut(docs.select("doc_id", "text").mapInArrow(_describe, "doc_id long, n long, cls long, bits binary"))
    # 2 ** TABLE_BITS numbers, whatever the input.
    held = spark.sparkContext.broadcast(frequencies(docs))
    prefix = docs.select("text").mapInArrow(lambda b: _prefixes(b, held.value), "key long, n int, cls long")
    rows = prefix.repartition("key").sortWithinPartitions("key", "n", "cls")
    shared = cut(rows.mapInArrow(_shared, "key long, n long, cls long, other long, other_n long, band int"))
    # Common members up to the smaller of two prefixes' last ones are in both prefixes, and at most ceil(0.8 n) - 1 follow, n of
    # the larger set. So a pair that shares too few prefix shingles can't reach ceil(4 (n + m) / 9) common ones, unless it shares one of a tile.
    first = shared.where("other is not null").groupBy(F.col("cls").alias("a"), F.col("other").alias("b"), "n", "other_n").agg(F.count("*").alias("k"))
    first = cut(first.where("k + (4 * greatest(n, other_n) + 4) div 5 - 1 >= (4 * (n + other_n) + 8) div 9").drop("k"))
    rows = shared.where("other is null").select("key", "n", "cls", "band")
    involved = first.select(F.explode(F.array("a", "b")).alias("cls")).unionByName(rows.select("cls")).distinct()
    bits = cut(d.where("n > 0").select("cls", "bits").join(involved, "cls", "left_semi").groupBy("cls").agg(F.first("bits").alias("bits")))
    first = first.join(bits.select(F.col("cls").alias("a"), F.col("bits").alias("x")), "a").join(bits.select(F.col("cls").alias("b"), F.col("bits").alias("y")), "b")
    first = first.select("a", "b", "n", "other_n", "x", "y").mapInArrow(_possible, "a long, b long")
    # Tiles: one for each key, but for keys of several bands one for each pair of bands of compatible sizes.
    bands = rows.groupBy("key", "band").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    wide = bands.where("band > 0").select("key").distinct()
    bands = bands.join(wide, "key", "left_semi")
    i, j = bands.select("key", F.col("band").alias("i"), F.col("hi")), bands.select("key", F.col("band").alias("j"), "lo")
    tiles = i.join(j, "key").where("i <= j and 5 * hi >= 4 * lo").select("key", "i", "j")
    ends = tiles.select("key", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("band"))
    narrow = rows.join(wide, "key", "left_anti").select("key", F.lit(0).alias("i"), F.lit(0).alias("j"), "n", "cls")
    tiled = narrow.unionByName(rows.join(ends, ["key", "band"]).select("key", "i", "j", "n", "cls"))

    def candidates(tiled: DataFrame, again: bool) -> DataFrame:
        t = tiled.select("key", "i", "j", "n", "cls", "comp").join(bits, "cls").select("key", "i", "j", "n", "cls", "bits", "comp")
        return t.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "n", "cls").mapInArrow(partial(_tiles, again=again), "a long, b long")

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = cut(pairs)
        if pairs.isEmpty():
            return pairs
        arrays = _arrays(docs, cut(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()))
        left, right = arrays.select(F.col("cls").alias("a"), F.col("shingles").alias("sa")), arrays.select(F.col("cls").alias("b"), F.col("shingles").alias("sb"))
        return cut(pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(_verify, "a long, b long"))

    links = verified(first.unionByName(candidates(tiled.withColumn("comp", F.col("cls")), False)).distinct())
    comp = components(links)
    # Pairs of short runs are all verified; a tile of one component has none left.
    c = comp.select(F.col("node").alias("cls"), F.col("component").alias("c"))
    known = tiled.join(c, "cls", "left").withColumn("comp", F.coalesce("c", "cls")).drop("c")
    several = known.groupBy("key", "i", "j").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("key", "i", "j")
    more = verified(candidates(known.join(several, ["key", "i", "j"], "left_semi"), True).distinct())
    if not more.isEmpty():
        comp = components(links.unionByName(more))
    classes = d.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("lo")).join(comp.select(F.col("node").alias("cls"), "component"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    lowest = classes.groupBy("component").agg(F.min("lo").alias("component_id"))
    named = classes.join(lowest, "component").select(F.col("cls").alias("k"), "component_id")
    out = d.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("cls")).alias("k"))
    return out.join(named, "k", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
