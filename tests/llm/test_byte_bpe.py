"""Byte-level BPE: the ids of tiktoken, the bytes of the text, and the two tiers each against a plain version."""

import base64
import hashlib

import numpy as np
import public_tokenizers as tokenizers
import pytest
import tiktoken

from custos.llm import byte_bpe
from tests.conftest import SF_SMALL
from tests.llm import cases

HOW = tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    with open(HOW[0], "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(reference, i, text):
    ids = reference.encode_ordinary(text or "")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((text or "").encode())


def run(df):
    return byte_bpe.digest(byte_bpe.decode_documents(byte_bpe.encode_documents(df, *HOW), *HOW)).collect()


def test_whole_table(spark, reference):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert sorted(map(tuple, run(df))) == sorted(expected(reference, r["doc_id"], r["text"]) for r in df.collect())


def test_edges(spark, reference):
    df = cases.docs(spark)
    odd = ["a\x1c\x85  b", "  \n\n  x", "it's IT'S we'll", "<|endoftext|>", "\U0001f600\U0001f468‍\U0001f469 é é", "x" * 5000 + "ß" * 700, "漢字かな交じり文 ٣٤ ½", "\x00\x01 ﻿"]
    df = df.select("doc_id", "text", "score").union(spark.createDataFrame([(200 + i, t, 0.0) for i, t in enumerate(odd)], "doc_id long, text string, score double"))
    assert sorted(map(tuple, run(df)), key=str) == sorted((expected(reference, r["doc_id"], r["text"]) for r in df.collect()), key=str)
    assert run(cases.docs(spark, [])) == []


def test_decoding_unknown_ids(spark):
    df = spark.createDataFrame([(1, [0, 1]), (2, [10 ** 6]), (3, None), (4, []), (None, [220])], "doc_id long, ids array<int>")
    vocab = byte_bpe.vocabulary(*HOW)
    got = {r["doc_id"]: None if r["decoded"] is None else bytes(r["decoded"]) for r in byte_bpe.decode_documents(df, *HOW).collect()}
    assert got == {1: vocab.tokens[0] + vocab.tokens[1], 2: None, 3: None, 4: b"", None: b" "}


def test_texts_in_several_lists_of_pieces(reference, monkeypatch):
    vocab = byte_bpe.vocabulary(*HOW)
    monkeypatch.setattr(byte_bpe, "PIECES_AT_ONCE", 50)
    monkeypatch.setattr(byte_bpe, "CACHE_BYTES", 2000)
    texts = [cases.LONG[:3000], "", "short", "é" * 120 + "  ab\n" * 40]
    assert [np.frombuffer(b, "<i4").tolist() for b in vocab.encode(texts)] == [reference.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 20000])
def test_minimal_perfect_hash(n):
    rng = np.random.default_rng(n)
    keys = list({bytes(k) for k in rng.integers(0, 256, (n, 6), dtype=np.uint8)})
    index = byte_bpe.MinimalPerfectHash(keys)
    assert sorted(index.find(keys).tolist()) == list(range(len(keys)))
    others = [k + b"x" for k in keys] + [b"", b"other"]
    assert (index.find(others) == -1).all()


def test_hash_of_equal_keys_is_refused():
    with pytest.raises(ValueError):
        byte_bpe.MinimalPerfectHash([b"a", b"b", b"a"])


def plain_merge(ranks, piece):
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        i = min(found)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_heap_merges_like_a_scan_for_the_least_pair():
    vocab = byte_bpe.vocabulary(*HOW)
    rng = np.random.default_rng(3)
    for _ in range(300):
        piece = bytes(rng.choice(list(b"aaabenst \xc3\xa9"), rng.integers(1, 60)).astype(np.uint8))
        assert vocab.merged(piece) == plain_merge(vocab.ranks, piece)


def test_decoding_of_null_empty_and_unknown_ids(spark):
    rows = [(1, [64, 65]), (2, None), (3, []), (4, [64, None]), (5, [10 ** 9]), (6, [65])]
    ids = spark.createDataFrame(rows, "doc_id long, ids array<int>").coalesce(1)
    tokens = byte_bpe.vocabulary(*HOW).tokens
    got = {r["doc_id"]: r["decoded"] for r in byte_bpe.decode_documents(ids, *HOW).collect()}
    assert got == {1: tokens[64] + tokens[65], 2: None, 3: b"", 4: None, 5: None, 6: tokens[65]}
