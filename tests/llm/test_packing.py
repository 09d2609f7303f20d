"""Packing: exact token pieces, gapless sequences, few of them."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from custos.llm import packing
from custos.llm.queries import tokenizer_path
from tests.conftest import SF_SMALL
from tests.llm import cases


def check(rows, texts, size):
    tok = Tokenizer.from_file(tokenizer_path())
    want = []
    for i, t in texts:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        cuts = [0, *range(len(ids) % size or size, len(ids) + 1, size)]
        want += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=str) == sorted(want, key=str)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences), sum(w[3] for w in want)


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    n, total = check(packing.pack_documents(df, tokenizer_path()).collect(), [(r["doc_id"], r["text"]) for r in df.collect()], 2048)
    assert n <= -(-total // 2048) * 1.01 + 1


def test_edges(spark):
    df = cases.docs(spark)
    odd = [(100, "a  b \n c  d\t e  "), (101, " lead"), (102, "<|endoftext|> x"), (104, "a  <|endoftext|>  b <|endoftext|>c <|endoftext|"), (103, "it's  we'll 　 z \x1c q")]
    df = df.select("doc_id", "text", "piece").union(spark.createDataFrame([(*r, 1) for r in odd], "doc_id long, text string, piece int"))
    check(packing.pack_documents(df, tokenizer_path(), sequence=64).collect(), [(r["doc_id"], r["text"]) for r in df.collect()], 64)
    assert packing.pack_documents(cases.docs(spark, []), tokenizer_path()).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_tightest_open_bin(seed):
    rng = np.random.default_rng(seed)
    lengths = np.sort(rng.integers(1, 65, 400))[::-1]
    bins, offsets = packing.best_fit(lengths, 64)
    room = []
    for n, b, o in zip(lengths, bins, offsets):
        fits = [r for r in room if r >= n]
        if fits:
            assert b < len(room) and room[b] == min(fits)
        else:
            assert b == len(room)
            room.append(64)
        assert o == 64 - room[b]
        room[b] -= n


def test_literal_special_token_is_one_id(spark):
    row = packing.pieces(spark.createDataFrame([(1, "a <|endoftext|> b")], "doc_id long, text string"), tokenizer_path()).collect()
    assert [(r["length"], r["ids_crc32"]) for r in row] == [(5, zlib.crc32(np.array([64, 220, 50256, 275, 0], "<u4").tobytes()))]
