"""Byte-level BPE against the tiktoken library, exact round trips."""

import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from quarry.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def _texts():
    rng = random.Random(2)
    odd = [lambda: rng.randrange(32, 127), lambda: rng.randrange(0x500), lambda: rng.randrange(0xE000, 0x1FFFF),
           lambda: rng.choice([9, 10, 13, 32, 0x85, 0xA0, 0x1C, 0x1F, 0x200B, 0x2028, 0x3000])]
    texts = ["".join(chr(rng.choice(odd)()) for _ in range(rng.randrange(120))) for _ in range(250)]
    return texts + ["", " ", "a" * 30_000, "aaaa aaab " * 200, "it's I'll they've'd", "\r\n\r\n  x", "<|endoftext|>", "ſ K Ⅷ ①"]


def test_every_code_point_splits_alike(reference):
    encoder = bpe.Encoder(bpe.Merges(bpe.read_ranks(PATH)), P.PATTERN)
    texts = ["".join(f"a{chr(c)}1 {chr(c)}{chr(c)}\n" for c in range(lo, lo + 256) if not 0xD800 <= c < 0xE000)
             for lo in range(0, 0x20000, 256)]
    ids, counts = encoder.encode(texts)
    want = reference.encode_ordinary_batch(texts, num_threads=1)
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_equals_tiktoken(spark, docs_of, reference):
    texts = _texts() + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows = list(enumerate(texts)) + [(7, "again"), (7, "again"), (None, None), (90_000, None)]
    docs = docs_of(rows).selectExpr("*", "1 AS ids", "2 AS n_tokens")
    got = bpe.digests(docs, PATH, P.PATTERN)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t in rows:
        ids = reference.encode_ordinary(t or "")
        want.append((i if i is not None else -1, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert sorted((r[0] if r[0] is not None else -1, *r[1:]) for r in got.collect()) == sorted(want)


def test_empty_table_and_decode(spark, docs_of):
    assert bpe.digests(docs_of([]), PATH, P.PATTERN).count() == 0
    rows = spark.createDataFrame([(1, [31373, 995]), (2, []), (3, None)], "doc_id long, ids array<int>")
    got = {r.doc_id: (r.n_tokens, r.id_text, bytes(r.decoded)) for r in bpe.decode(rows, PATH).collect()}
    assert got == {1: (2, "31373 995", b"hello world"), 2: (0, "", b""), 3: (0, "", b"")}


def test_a_lower_rank_that_arises_goes_first():
    """Ranks as in no trained vocabulary: joining 'ab' makes 'abc' mergeable at a lower rank."""
    ranks = {bytes([b]): 100 + b for b in range(256)} | {b"abc": 400, b"ab": 500, b"cab": 600}
    enc = tiktoken.Encoding("t", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    merges = bpe.Merges(ranks)
    assert merges.unsafe
    words = ["ababcab", "cabcabx", "abab", "abcabcc", "aab", "abcabab"] * 5
    ids, counts = merges.replay([w.encode() for w in words])
    assert ids.tolist() == [i for w in words for i in enc.encode_ordinary(w)]
    assert counts.tolist() == [len(enc.encode_ordinary(w)) for w in words]


def test_memory_stays_bounded(monkeypatch, reference):
    monkeypatch.setattr(bpe, "KEPT_PIECES", 50)
    monkeypatch.setattr(bpe, "POOL_BYTES", 64)
    encoder = bpe.Encoder(bpe.Merges(bpe.read_ranks(PATH)), P.PATTERN)
    for t in _texts()[:60]:
        assert encoder.encode([t])[0].tolist() == reference.encode_ordinary(t)
