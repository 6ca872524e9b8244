"""Ranked search against scoring every document for every item."""

import collections
import math
import random
import re

import duckdb
import pytest

from sieveline.llm import queries, search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_force(docs, items, k=10):
    have = [(i, collections.Counter(words(t))) for i, t in docs]
    n, all_ = sum(bool(c) for _, c in have), sum(sum(c.values()) for _, c in have)
    df = collections.Counter(w for _, c in have for w in c)
    asked = collections.defaultdict(collections.Counter)
    for i, t in items:
        asked[i].update(words(t))
    out = set()
    for item, terms in asked.items():
        scored = []
        for i, c in have:
            m = 25 + (75 * sum(c.values()) * n) // all_ if all_ else 0
            s = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m)) for w, q in terms.items() if w in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out |= {(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)}
    return out


def table(seed, n, most=40):
    r = random.Random(seed)
    vocabulary = [f"w{min(int(r.paretovariate(0.7)), 400)}" for _ in range(3000)] + ["Été", "été", "x1", "naïve"]
    return [(i * 7 % n, r.choice([" ", "-", "\n"]).join(r.choice(vocabulary) for _ in range(r.randrange(most)))) for i in range(n)]


@pytest.mark.parametrize(("shard", "terms"), [(1 << 24, 1 << 20), (2000, 1 << 20), (500, 30)])
def test_equals_brute_force(spark, monkeypatch, shard, terms):
    monkeypatch.setattr(search, "SHARD", shard)
    monkeypatch.setattr(search, "BLOCK_TERMS", terms)
    docs, items = table(1, 700), table(2, 40, 25)
    # Copies that tie, across tasks and shards.
    docs += [(10_000 + i, docs[5][1]) for i in range(30)] + [(-i, docs[5][1]) for i in range(1, 15)]
    df, asked = spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string")
    if terms < 100:
        assert len(search.query_blocks(search.item_terms(asked))) > 3
    got = [(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in search.search(df, asked).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_force(docs, items)


def test_odd_and_empty_tables(spark):
    rows = [(1, None, 0), (2, "", 0), (3, " .,! ", 0), (4, "Alpha BETA gamma", 0), (4, "Alpha BETA gamma", 0), (5, "alpha " * 50_000, 0), (None, "alpha beta", 0), (6, "other", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    items = [("a", "alpha beta alpha", 1), ("b", None, 1), (None, "gamma", 1), (None, "beta", 1), ("c", "", 1), ("d", "nowhere", 1)]
    asked = spark.createDataFrame(items, "item_id string, text string, rank int")
    got = [(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in search.search(docs, asked).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute_force([r[:2] for r in rows], [r[:2] for r in items])))
    for d, i in ((docs.limit(0), asked), (docs, asked.limit(0)), (docs.where("doc_id < 4"), asked)):
        assert search.search(d, i).count() == 0


def test_documents_are_skipped(monkeypatch):
    """Rare words demand a score that common ones can't reach: most postings are never looked at."""
    import numpy as np

    n = 20_000
    common, rare = np.arange(n), np.arange(0, n, 500)
    shard = search.Shard(np.concatenate([np.zeros(n, np.int64), np.ones(len(rare), np.int64)]), np.concatenate([common, rare]), np.full(n, 30), n, 30 * n)
    looked = []
    shard.worth = type("Seen", (), {"__getitem__": lambda _, i, worth=shard.worth: looked.append(i) or worth[i]})()
    heap = []
    shard.wand([(0, 1), (1, 5000)], heap, 10, list(range(n)))
    # Until ten documents with the rare word are found, common ones are; after the tenth none is.
    assert sorted(-d for _, d in heap) == rare[:10].tolist() and len(looked) < rare[9] + 100 < n / 4


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    want = sorted(map(tuple, c.execute(queries.ORACLE_SQL["op11_ranked_search"]).fetchall()))
    assert sorted((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in queries.op11_ranked_search(spark, sf).collect()) == want
