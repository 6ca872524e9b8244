"""Entropy balancing ends on every histogram and meets its targets; features of a text don't depend on its neighbours."""

import random

import numpy as np
import pytest

from sieveline.llm import mixing, toxicity

SCHEMA = "doc_id long, text string, source string"


def histogram(r):
    """Sources of a few to many sizes with odd counts, and targets that sum to all words, none above three times its source."""
    sources = []
    for _ in range(r.choice([1, 2, 3, 5, 7])):
        sizes = np.array(sorted(r.sample(range(1, r.choice([4, 50, 5000])), r.choice([1, 2, 3]))), float)
        sources.append((sizes, np.array([r.choice([1, 2, 14, 300, 10**6]) for _ in sizes], float)))
    size = np.array([(a * b).sum() for a, b in sources])
    weight = np.array([1.0 + i % 3 for i in range(len(sources))])
    target, open_ = np.zeros(len(size)), np.ones(len(size), bool)
    while True:
        level = (size.sum() - target[~open_].sum()) / weight[open_].sum()
        over = open_ & (level * weight > 3 * size)
        if not over.any():
            target[open_] = level * weight[open_]
            return sources, target
        target[over], open_ = 3 * size[over], open_ & ~over


def test_ends_and_meets_targets_on_random_histograms():
    r, most = random.Random(1), 0
    for _ in range(10_000):
        sources, target = histogram(r)
        all_ = sum((a * b).sum() for a, b in sources)
        mean = sum((a * b * np.log(a)).sum() for a, b in sources) / all_
        parts = [(a * b / all_, np.log(a) - mean, t / all_) for (a, b), t in zip(sources, target, strict=True)]
        asked = []

        def sums(mu, parts=parts, asked=asked):
            asked.append(mu)
            return tuple(np.sum([mixing.source_sums(s, z, t, mu, 3.0) for s, z, t in parts], 0).tolist())

        mu = mixing.newton(sums)
        most = max(most, len(asked))
        for s, z, t in parts:
            rate, _ = mixing.source_rates(s, z, t, mu, 3.0)
            assert (rate <= 3).all() and (s * rate).sum() == pytest.approx(t, rel=1e-9)
    assert most < 80


def test_forty_documents(spark):
    """Sizes for which clipped steps on all multipliers at once never end."""
    sizes = [("a", 2)] * 14 + [("a", 66)] * 4 + [("a", 87)] * 19 + [("b", 43)] * 2 + [("b", 190)]
    docs = spark.createDataFrame([(i, " ".join(["w"] * n), s) for i, (s, n) in enumerate(sizes)], SCHEMA)
    out = mixing.mix(docs).toPandas()
    per = out.assign(of=[s for s, _ in (sizes[i] for i in out["doc_id"])]).groupby("of").agg(taken=("taken", "sum"), target=("target", "first"))
    assert (abs(per["taken"] - per["target"]) <= 100).all() and (out["taken"] <= 3 * out["size"]).all()


@pytest.mark.parametrize("sizes", [[("a", 7)], [("a", 7), (None, 7)], [("a", 0), ("b", 5)], [("a", 0)], [("a", 3)] * 50 + [("b", 1)]])
def test_small_tables(spark, sizes):
    docs = spark.createDataFrame([(i, " ".join(["w"] * n) or None, s) for i, (s, n) in enumerate(sizes)], SCHEMA)
    out = {r["doc_id"]: r for r in mixing.mix(docs).collect()}
    assert len(out) == len(sizes) and all(r["size"] == sizes[i][1] and r["taken"] <= 3 * r["size"] for i, r in out.items())


def test_features_of_a_block_are_those_of_its_texts():
    r = random.Random(5)
    texts = ["aab c d", "zzz aa", "", "a", "aa", "aaa", "You IDIOT!!", "m0r0n you", "é", "ééé x"] + ["".join(r.choices("aab !Zé1\n", k=r.randrange(9))) for _ in range(400)]
    r.shuffle(texts)
    raw = [t.encode() for t in texts]
    at = np.cumsum([0, *map(len, raw)])
    whole = toxicity.features(np.frombuffer(b"".join(raw), np.uint8), at)
    for i, x in enumerate(raw):
        assert np.array_equal(whole[i], toxicity.features(np.frombuffer(x, np.uint8), np.array([0, len(x)]))[0]), texts[i]


def test_scores_do_not_depend_on_order(spark):
    r = random.Random(6)
    docs = [(i, " ".join(r.choices(["you", "idiot", "aaah", "fine", "day", "moron", "b"], k=r.randrange(8)))) for i in range(300)]
    labels = spark.createDataFrame([(i, int("idiot" in t or "moron" in t)) for i, t in docs], "doc_id long, toxic int")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.fit(df, labels)
    a = {r["doc_id"]: r["score"] for r in toxicity.score(df.coalesce(1), model).collect()}
    b = {r["doc_id"]: r["score"] for r in toxicity.score(df.orderBy("text").repartition(7), model).collect()}
    assert a == b
