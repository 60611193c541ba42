"""Batches are encoded without an object for each piece, with the tokens of the plain encoder."""

import base64
import random

import numpy as np
import pyarrow as pa
import pytest

from statloom.llm import bpe


@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(bpe.read_vocabulary(bpe.VOCABULARY))


def test_batches_have_the_tokens_of_the_plain_encoder(coder, monkeypatch):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(bpe.VOCABULARY, "rb"))}
    plain = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(5)
    parts = ["'s", "'", "'re", "'ll", "'r", "’", " ", "  ", "\n", "\t", " ", "　", " ", "\x1c", "\x85", "a", "B", "é", "中", "1", "²", "٣", ".", "!?", "😀", "́", "s", "t", "ve", "​", "word", " the"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(3000)] + [None, "", "a" * 300, "é" * 200, " " * 100 + "x", "\n" * 90, "x" + " " * 70]
    monkeypatch.setattr(bpe.Coder, "encode_fragment", None)  # which makes objects of pieces
    for at_once in (bpe._AT_ONCE, 50):
        monkeypatch.setattr(bpe, "_AT_ONCE", at_once)
        token, begin = coder.encode_texts(pa.array(texts))
        assert [token[a:b].tolist() for a, b in zip(begin, begin[1:])] == [[] if t is None else plain.encode_ordinary(t) for t in texts]


def test_empty_batches(coder):
    for texts in ([], [None, None], [""]):
        token, begin = coder.encode_texts(pa.array(texts, pa.string()))
        assert not len(token) and begin.tolist() == [0] * (len(texts) + 1)


def test_other_patterns_and_vocabularies_keep_their_tokens(coder):
    few = bpe.Coder(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate((b"a", b"b", b"ab", b" "))))
    other = bpe.Coder(bpe.read_vocabulary(bpe.VOCABULARY), r"\s+|\S+")
    token, begin = few.encode_texts(pa.array(["ab ba", None]))
    assert token.tolist() == [2, 3, 1, 0] and begin.tolist() == [0, 4, 4]
    assert other.encode_texts(pa.array(["the cat's"]))[0].tolist() == np.frombuffer(other.encode("the cat's"), np.int32).tolist()
