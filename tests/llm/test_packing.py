"""Packing against the tokenizer itself, and the plan against exhaustive search."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import cutting as C
from quarry.llm import packing as P
from quarry.llm import queries
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path(queries.WORD_VOCABULARY)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(rows, docs, tokenizer, size=2048):
    """Every id in one piece with its checksum, gapless sequences; returns (padding, pieces a document)."""
    want = Counter()
    for i, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        want[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    texts = {}
    for i, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        texts.setdefault((i, len(ids)), []).append(ids)
    assert by_doc.keys() == texts.keys()
    for key, pieces in by_doc.items():
        # rows of one id and length: every stretch must be there once for each row
        covered = Counter()
        for r in pieces:
            assert r.length > 0
            covered.update(range(r.start, r.start + r.length))
            assert r.ids_crc32 in {zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
                                   for ids in texts[key]}
        assert covered == Counter({k: len(texts[key]) for k in range(key[1])})
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding, len(rows) / max(len(docs), 1)


def test_documents(spark, tokenizer):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    rows = queries.q_op12_packing(spark, SF_SMALL).collect()
    padding, _ = check(rows, docs, tokenizer)
    assert padding <= 0.01 * sum({(r.doc_id): r.doc_tokens for r in rows}.values())


def test_odd_rows(spark, docs_of, tokenizer):
    rng = random.Random(5)
    words = ["don't", "l'été", "Á b", "x\x1cy", "日本語", "<|endoftext|>", "I'LL", "3.14", " ", "ΣΑΣ", "😀", "--"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 300)))) for i in range(150)]
    docs += [(200, None), (201, ""), (202, " \n\t"), (None, "no id"), (None, None), (7, docs[7][1]), (7, docs[7][1]),
             (203, "w " * 2047), (204, "w " * 4095), (205, "long text " * 20_000), (206, "y" * 5000)]
    df = docs_of(docs)
    padding, pieces = check(P.pack(df, PATH).collect(), docs, tokenizer)
    assert pieces < 1.9
    clash = df.select("*", *[F.lit("z").alias(c) for c in ("part", "row", "rest", "rank", "ids", "placed", "crcs", "tokens")])
    check(P.pack(clash, PATH).collect(), docs, tokenizer)
    check(P.pack(df, PATH, size=64).collect(), docs, tokenizer, 64)
    assert P.pack(docs_of([]), PATH).collect() == []


def test_same_lengths_in_many_partitions(spark, docs_of, tokenizer, monkeypatch):
    docs = [(i, "same words " * 30) for i in range(400)] + [(1000 + i, None) for i in range(300)]
    df = docs_of(docs).repartition(13)
    check(P.pack(df, PATH, size=128).collect(), docs, tokenizer, 128)
    monkeypatch.setattr(P, "BROADCAST_IDS", 0)
    check(P.pack(df, PATH, size=128).collect(), docs, tokenizer, 128)


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text, add_special_tokens=False).ids + [1], "<u2").tobytes()


def test_frequent_words_stay_remembered(tokenizer, monkeypatch):
    # a full memory was emptied, and the frequent words of all texts were encoded again
    asked = Counter()

    class Counting(P.WordEncoder):
        def _part(self, part):
            asked[part] += 1
            return super()._part(part)

    monkeypatch.setattr(P, "HELD_WORDS", 60)
    encoder = Counting(PATH)
    for i in range(60):
        rare = [f"{a}{b}" for a in "bcdfg" for b in ("x" * i, "y" * i)]
        text = " ".join(["The same, frequent été"] + rare)
        assert encoder.encode([text.encode()], 1) == [ids_of(tokenizer, text)]
    assert asked[b"frequent"] == 1 and asked["été".encode()] == 1 and asked[b"same,"] == 1
    assert len(encoder.parts) + len(encoder.parts.older) <= 2 * 60 + 30


def test_long_parts_are_encoded_but_not_remembered(tokenizer):
    encoder = P.WordEncoder(PATH)
    for text in ("a" * 500 + " " + "-" * 70, "É" * 40 + "x,y" * 30, "日" * 50 + " <|endoftext|>" + "z" * 90):
        assert encoder.encode([text.encode()] * 2, 1) == [ids_of(tokenizer, text)] * 2
    assert max(map(len, encoder.parts), default=0) <= P.HELD_BYTES


def test_a_worker_keeps_its_encoder(spark, docs_of, tokenizer):
    assert P._encoder(PATH) is P._encoder(PATH)
    docs = [(i, f"Word{i}'s l'ÉTÉ {i % 7}a-b {'AbC' * (i % 30)}") for i in range(300)]
    check(P.pack(docs_of(docs).repartition(20), PATH, size=64).collect(), docs, tokenizer, 64)


def test_knapsack_equals_enumeration():
    rng = np.random.default_rng(1)
    lengths = np.array([2, 3, 5, 7])
    for _ in range(20):
        values = rng.random(4)
        best, last = (k := C.Knapsack(lengths, 16)).solve(values)
        for s in range(17):
            sums = [np.dot(n, values) for n in itertools.product(range(9), range(6), range(4), range(3))
                    if np.dot(n, lengths) == s]
            assert best[s] == pytest.approx(max(sums, default=-np.inf))
            if sums:
                assert sum(lengths[i] * n for i, n in k.items(last, s).items()) == s


def test_program_is_feasible_and_finds_full_patterns():
    lengths, counts = np.array([3, 4, 6, 10]), np.array([40, 30, 20, 30])
    found = C.linear_program(lengths, counts, 16)
    used = np.zeros(4)
    for items, gap, x in found:
        for i, n in items.items():
            used[i] += n * x
    assert (used <= counts + 1e-6).all()
    # 10 + 6, 10 + 3 + 3, 4 x 4 and so on: everything fits without a gap
    assert sum(x for _, gap, x in found if gap) < 1 and used @ lengths > 0.97 * (counts @ lengths)


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_token_once(seed):
    rng = random.Random(seed)
    size = rng.choice([16, 64, 128])
    histogram = {x: rng.randrange(1, 200) for x in rng.sample(range(1, size), rng.randrange(1, size - 1))}
    p = C.plan(histogram, size)
    assert all(0 <= p.placed[x] <= n for x, n in histogram.items())
    cut = sum((n - int(p.placed[x])) * x for x, n in histogram.items())
    assert len(p.entry_from) == 0 or p.entry_from[0] == 0
    for items, times in C.exact_runs(histogram, size):
        assert sum(items) <= size and times > 0
    assert cut >= 0 and p.sequences * size >= sum(x * n for x, n in histogram.items()) - size
