import os
import random

import pytest

from termloom.llm import bpe

pytestmark = pytest.mark.skipif(not os.path.exists(bpe.default_vocabulary()), reason="no vocabulary here")
ODD = ["", " ", "  \n\t ", "a" * 5000, "абв" * 2000, "xyz " * 3000, "don't we'll 'S", "x　y \xa0 z", "1½² ①", "\U0001f469‍\U0001f4bb", "<|endoftext|>", "\x1c\x1d", "漢字かな", "é é", "\x00"]


@pytest.fixture(scope="module")
def peer():
    import base64

    import tiktoken

    with open(bpe.default_vocabulary(), "rb") as f:
        data = f.read()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), bpe.Encoder(bpe.read_ranks(data))


def test_like_the_library(peer):
    other, own = peer
    rng = random.Random(4)
    texts = ODD + ["".join(rng.choices(["a", "б", " ", "\n", "1", ".", "'s", "́", "\U0001f600", "　", "​", "漢"], k=rng.randint(0, 30))) for _ in range(2000)]
    for t in texts:
        assert list(own.encode(t)) == other.encode_ordinary(t), t[:40]
    assert list(own.encode(None)) == []


def test_both_merges_agree(peer):
    own = peer[1]
    rng = random.Random(5)
    for _ in range(500):
        word = bytes(rng.choices(b"abcdethin \xd0\xb0\xff", k=rng.randint(2, 80)))
        assert bpe._merge_long(word, own.ranks) == bpe.merge_word(word, own.ranks)


def test_encode_table(spark, peer):
    rows = [(k, t, k) for k, t in enumerate(ODD)] + [(100, None, 1), (None, "a", 2), (1, " ", 3)]
    got = bpe.encode(spark.createDataFrame(rows, "doc_id long, text string, ids int"))
    assert got.columns == ["doc_id", "ids"]
    want = sorted((repr(i), list(peer[0].encode_ordinary(t or ""))) for i, t, _ in rows)
    assert sorted((repr(r.doc_id), list(r.ids)) for r in got.collect()) == want
    assert bpe.encode(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    n = bpe.with_token_count(spark.createDataFrame(rows, "doc_id long, text string, n_tokens int"))
    assert sorted((repr(r.doc_id), r.n_tokens) for r in n.collect()) == [(i, len(x)) for i, x in want]
