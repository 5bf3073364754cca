"""Byte-level BPE against the tiktoken library."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from scriptmill.llm import bpe

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.Vocabulary(bpe.read_ranks(RANKS), P.PATTERN))


def texts():
    rng = random.Random(5)
    yield from ["", " ", "\n\n  \t x", "it's we'LL don't", "a" * 5000, "ab" * 3000, "<|endoftext|>", "日本語のテキスト 한국어", "é́ 👩‍👩‍👧 \U0001f600", "x\x1cy\x85z w\xa0 　", "0123456789" * 5, "!!!??  ...\r\n"]
    pool = [chr(c) for c in [*range(32, 127), *range(0xA0, 0x250), 0x0301, 0x0660, 0x4E00, 0x1F600, 9, 10, 13, 0x1D, 0x2028]]
    for _ in range(400):
        yield "".join(rng.choice(pool) for _ in range(rng.randint(1, 60)))


def test_same_ids_as_the_library(encoder, library):
    for t in texts():
        ids = encoder.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(t), repr(t)
        assert encoder.decode(ids) == t.encode()


def test_perfect_hash_is_minimal(encoder):
    h = encoder.v.hash
    assert sorted(h.slots) == list(range(len(encoder.v.tokens)))
    assert all(encoder.v.id_of(t) == i for i, t in enumerate(encoder.v.tokens[::97]) for i in [i * 97])
    assert encoder.v.id_of(b"no such token at all") == -1
    assert bpe.PerfectHash([]).index(b"x") == -1 and bpe.PerfectHash([b"x"]).index(b"x") == 0


def test_memo_turns_over(encoder, library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 3)
    e = bpe.Encoder(encoder.v)
    t = "several different unusualwords and several different otherwords again"
    assert np.frombuffer(e.encode(t), "<u4").tolist() == library.encode_ordinary(t)


def test_column(spark, library):
    rows = [(1, "Hello wörld"), (1, "Hello wörld"), (None, None), (3, "")]
    got = bpe.encode_decode(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS ids", "1 AS n_tokens"), RANKS, P.PATTERN, ["doc_id"]).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = np.array(library.encode_ordinary("Hello wörld"), "<u4")
    assert sorted(map(str, got)) == sorted(map(str, [*got[:0], *[type(got[0])(doc_id=i, n_tokens=n, ids_sha256=a, decoded_sha256=b) for i, n, a, b in [(1, len(want), sha(want.tobytes()), sha("Hello wörld".encode()))] * 2 + [(None, 0, sha(b""), sha(b"")), (3, 0, sha(b""), sha(b""))]]]))
    assert bpe.encode(spark.createDataFrame([], "doc_id long, text string"), RANKS, P.PATTERN, ["doc_id"]).count() == 0
