"""Encoding against the tokenizers library, proposals and verdicts against exact merging."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sieveline.llm import bpe, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def vocab():
    return bpe.vocabulary(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_ids_equal_the_library(vocab, library):
    r = random.Random(7)
    letters = ["abcdefghijklmnopqrstuvwxyz", "theaing's'll'VE 12,.", "aab", "éàÉñßİıſ\x85\xa0 \x1c\x1d\x00", "ΣΑΣς é́ é 日本語 ﬁ ½²٣", "".join(chr(c) for c in (r.randrange(1, 0x110000) for _ in range(2000)) if not 0xD800 <= c < 0xE000)]
    texts = ["".join(r.choice(a) for _ in range(r.randrange(70))) for a in letters for _ in range(400)]
    texts += ["".join(vocab.tokens[r.randrange(49_406)].replace("</w>", r.choice(["", " "])) for _ in range(r.randrange(1, 6))) for _ in range(1000)]
    texts += ["", " \n\t", "<|endoftext|>", "x<|startoftext|><|endoftext|> Y", "<|endof", "<|EndOfText|>", "a" * 5000, "ab" * 20_000, "é" * 3000, "日" * 3000, "!" * 4000, "7" * 3000]
    for text, packed, want in zip(texts, bpe.encode_texts(vocab, PATH, texts), library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids(packed) == want.ids, text[:80]


def test_verdicts_equal_exact_merging(vocab):
    r = random.Random(2)
    left = r.choices([t for t in vocab.spell.values() if not vocab.tokens[t].endswith("</w>")], k=20_000)
    right = r.choices(list(vocab.spell.values()), k=20_000)
    got = vocab.compatible(np.array(left), np.array(right)).tolist()
    want = [vocab.merge(vocab._symbols(vocab.tokens[a]) + vocab._symbols(vocab.tokens[b])) == [a, b] for a, b in zip(left, right, strict=True)]
    assert got == want and 0.1 < sum(got) / len(got) < 0.99


def test_all_tokens_are_reached_or_left_out(vocab):
    assert all(vocab.merge(vocab._symbols(vocab.tokens[t])) == [t] for t in vocab.spell.values())


def test_failing_words_only_are_merged(vocab, monkeypatch):
    """Speculation does its part: words whose pairs all hold never reach exact merging."""
    merged, merge = [], vocab.merge
    monkeypatch.setattr(vocab, "merge", lambda s: merged.append(s) or merge(s))
    words = [vocab.tokens[t].removesuffix("</w>") for t in list(vocab.spell.values())[1000:3000] if vocab.tokens[t].endswith("</w>")]
    vocab.learn(words)
    assert not merged
    vocab.learn(["".join(random.Random(i).choices("abcdefgh", k=9)) for i in range(200)])
    assert 0 < len(merged) < 200


def test_memory_is_bounded(vocab, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    r = random.Random(3)
    for _ in range(20):
        texts = [" ".join("".join(r.choices("abcdef", k=r.randrange(1, 9))) for _ in range(40)) for _ in range(3)]
        assert [ids(p) for p in bpe.encode_texts(vocab, PATH, texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert len(vocab.words) <= 50 + 120


def test_unordered_merges_are_verified_by_merging(tmp_path):
    """A vocabulary whose merge stands before those of its parts: pairs are checked by merging, and the library agrees."""
    import json

    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    base = list(spec["model"]["vocab"])[:512]
    merges = [["ab", "c</w>"], ["a", "b"], ["b", "c</w>"], ["b", "a"], ["ab", "a"], ["a", "a"]]
    spec["model"]["vocab"] = {t: i for i, t in enumerate([*base, *dict.fromkeys(a + b for a, b in merges)])}
    spec["model"]["merges"] = merges
    spec["added_tokens"] = [t | {"id": 600 + i} for i, t in enumerate(spec["added_tokens"])]
    path = str(tmp_path / "odd.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(spec, f)
    own, lib, r = bpe.Vocabulary(path), Tokenizer.from_file(path), random.Random(1)
    texts = ["".join(r.choices("abc", k=r.randrange(1, 12))) for _ in range(2000)]
    assert not own.ordered
    assert [ids(p) for p in bpe.encode_texts(own, path, texts)] == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]


def test_rows_and_columns(spark, library):
    rows = [(1, None, "x", "a"), (2, "", "y", "b"), (3, "Hello  World's", None, "c"), (3, "again", "z", "d"), (None, "x<|endoftext|>", "w", "e"), (4, "long " * 40_000, "v", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, packed string, `odd name` string")
    got = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert [r["odd name"] for r in sorted(got, key=lambda r: r["odd name"])] == list("abcdef")
    for r in got:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert ids(r["packed"]) == want and r["n_tokens"] == len(want) and r["decoded"] == library.decode(want, skip_special_tokens=False)
    assert bpe.decode(bpe.encode(docs.limit(0), PATH), PATH).count() == 0


def test_query_equals_the_library(spark, library):
    import hashlib

    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in queries.op12_bpe_round_trip(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    assert len(got) == len(docs)
    for d in docs:
        want = library.encode(d["text"], add_special_tokens=False).ids
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(want) and r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()
