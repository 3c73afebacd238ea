"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.llm import queries
from quarry.llm import variants as V
from tests.conftest import SF_SMALL


def brute_counts(docs):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def brute_force(docs):
    """Near words by deleting each letter: equal remainders at one place, or a remainder that is the other word."""
    words = brute_counts(docs)
    near = {w: set() for w in words}
    holes = {}
    for w in words:
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1:]), []).append(w)
            cut = w[:i] + w[i + 1:]
            if cut in words:
                near[w].add(cut)
                near[cut].add(w)
    for group in holes.values():
        for w in group:
            near[w].update(x for x in group if x != w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words.get(form[w]))
    return out


def _result(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def _noisy(rng, n):
    """Texts of words that lie one or two letters apart, frequent and rare ones, with letters of Latin-1."""
    base = ["".join(rng.choice("abcdeiortué×ÿ") for _ in range(rng.randrange(4, 10))) for _ in range(60)]
    pool = []
    for w in base:
        pool += [w] * rng.randrange(1, 40)
        for _ in range(25):
            i = rng.randrange(len(w))
            pool += [rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("abceé") + w[i:],
                                 w[:i] + rng.choice("abceé") + w[i + 1:], w.upper(), w[::-1]])] * rng.randrange(1, 7)
    rng.shuffle(pool)
    return [(i, rng.choice([" ", "-", "1", "ł", "’"]).join(pool[i::n])) for i in range(n)]


def test_equals_brute_force(spark, docs_of):
    rows = _noisy(random.Random(3), 50)
    rows += [(100, None), (101, ""), (None, "alphabet alphabet alphabet alphabbet " * 40), (102, "x" * 70_000 + " " + "short"),
             (103, "x" * 70_000), (104, "x" * 70_000 + "ÀÈÌÒÙ ÀÈÌÒÙ"), (105, "ÀÈÌÒÙ àèìòù"), (7, rows[7][1]), (7, rows[7][1])]
    want = brute_force(rows)
    assert sum(v[0] is not None for v in want.values()) > 100 and any(v[1] != v[0] for v in want.values() if v[0])
    docs = docs_of(rows)
    assert _result(V.spelling_variants(docs)) == want
    clash = docs.select("*", *[F.lit(1).alias(c) for c in ("word", "n", "near", "form", "root", "key", "letter", "best")])
    assert _result(V.spelling_variants(clash)) == want


def test_no_words(spark, docs_of):
    assert V.spelling_variants(docs_of([])).collect() == []
    assert V.spelling_variants(docs_of([(1, None), (2, ""), (3, "a b c 12345")])).collect() == []


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert _result(queries.q_op13_spelling_variants(spark, SF_SMALL)) == brute_force(docs)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keys_and_forms_are_never_broadcast(spark, docs_of, monkeypatch):
    """Spark sizes exploded keys and packed forms by their files, far below the rows they hold."""
    rows = _noisy(random.Random(5), 20)
    words = V.materialize(V.word_counts(docs_of(rows)), "words")
    pairs = V.near_pairs(words)
    assert len(pairs.collect()) > 100  # the plan below is also the one that ran
    assert "Broadcast" not in _plan(pairs) and "SortMergeJoin" in _plan(pairs)
    plans = []

    def told(df, name, real=V.materialize):
        plans.append((name, _plan(df)))
        return real(df, name)

    monkeypatch.setattr(V, "materialize", told)
    found = V.spelling_variants(docs_of(rows))
    assert _result(found) == brute_force(rows)
    forms = [plan for name, plan in plans if name == "forms" and "Join" in plan]
    assert forms and not any("Broadcast" in plan for plan in [*forms, _plan(found)])


@pytest.mark.parametrize("n1,n2,k", [(1, 4, 2), (2, 1, 1), (2, 3, 2), (3, 1, 2), (1, 3, 2), (2, 4, 3)])
def test_signatures_miss_no_vector_within_the_distance(n1, n2, k):
    rng = random.Random(n1 * 10 + n2)
    subsets = V.signature_subsets(n1, n2, k)
    for _ in range(2000):
        hit = {rng.randrange(n1 * n2) for _ in range(rng.randrange(k + 1))}  # parts with differences, k at most
        assert any(not hit & set(s) for s in subsets)


def test_checksums():
    joined = b"ab\xc3\xa9 " + b"z" * 100 + b" q\n"
    start, end = V._runs(joined)
    seeds = V.np.array([zlib.crc32(b"5:")] * len(start), V.np.uint32)
    assert [joined[s:e] for s, e in zip(start, end)] == V._RUN.findall(joined)
    assert V._checksums(joined, start, end, seeds, V._crc_table()).tolist() == [
        zlib.crc32(b"5:" + joined[s:e]) for s, e in zip(start, end)]
