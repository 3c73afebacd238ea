"""Greedy string tiling against a plain quadratic version; leaks against brute force."""

import random
import re

import numpy as np

from quarry.llm import decontaminate as D


def _plain_tiles(a, b, size):
    """The algorithm by definition: compare all positions in every round."""
    size = min(size, len(b))
    if not size:
        return []
    free_a, free_b, out = [True] * len(a), [True] * len(b), []
    while True:
        best, found = 0, []
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while (i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]):
                    n += 1
                if n >= size and n >= best:
                    if n > best:
                        best, found = n, []
                    found.append((i, j, n))
        if not found:
            return out
        for i, j, n in found:
            if all(free_a[i:i + n]) and all(free_b[j:j + n]):
                free_a[i:i + n] = [False] * n
                free_b[j:j + n] = [False] * n
                out.append((i, j, n))


def test_tiles_equal_the_plain_version():
    rng = random.Random(3)
    for _ in range(150):
        letters = rng.choice([2, 4, 12])
        a = [rng.randrange(letters) for _ in range(rng.randrange(0, 40))]
        b = [rng.randrange(letters) for _ in range(rng.randrange(0, 20))]
        size = rng.choice([1, 2, 3, 5])
        if rng.random() < 0.5 and b:
            cut = rng.randrange(len(b))
            a = a + b[cut:] + a[:3] + b[:cut]
        got = D.tiles(np.array(a, np.uint64), np.array(b, np.uint64), size)
        assert got == _plain_tiles(a, b, size), (a, b, size)


def _tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def test_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(80)
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").limit(12)
    planted = items.selectExpr("item_id + 5000 AS doc_id", "concat('Vorab. ', upper(text), ' end') AS text")
    rows = docs.select("doc_id", "text").unionAll(planted)
    got = {(r.doc_id, r.item_id): r.covered for r in D.contaminated(rows, items).collect()}
    want = {}
    for d in rows.collect():
        for i in items.collect():
            a, b = _tokens(d.text)[:1500], _tokens(i.text)
            seeds = {tuple(b[k:k + 5]) for k in range(len(b) - 4)}
            if any(tuple(a[k:k + 5]) in seeds for k in range(len(a) - 4)):
                covered = sum(n for _, _, n in _plain_tiles(a, b, 5))
                if covered >= 0.5 * len(b):
                    want[d.doc_id, i.item_id] = covered
    assert got == want and len(want) >= 12


def test_reordered_passage_and_clean_documents(spark, docs_of):
    item = " ".join(f"w{i}" for i in range(40))
    words = item.split()
    rows = [(1, "start " + " ".join(words[20:] + ["mid"] + words[:20]) + " stop"),  # reordered halves
            (2, " ".join(reversed(words))), (3, " ".join(words[:19])), (4, "W0, w1! " + " ".join(words[2:])),
            (5, None), (6, ""), (7, "x " * 50_000 + item), (None, item), (8, item), (8, item)]
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "tiny passage"), (None, item)],
                                  "item_id long, text string").selectExpr("*", "3 AS doc_id")
    got = sorted((r.doc_id or -1, r.item_id) for r in D.contaminated(docs_of(rows), items).collect())
    assert got == [(-1, 1), (1, 1), (4, 1), (7, 1), (8, 1), (8, 1)]
    kept = D.keep_clean(docs_of(rows), items)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 2, 3, 5, 6]


def test_short_items_blocks_and_empty_tables(spark, docs_of):
    items = spark.createDataFrame([(i, f"alpha{i} beta{i} gamma{i} delta{i} eps{i} zeta{i}") for i in range(30)]
                                  + [(99, "rare pair")], "item_id long, text string")
    docs = docs_of([(i, f"see alpha{i} beta{i} gamma{i} delta{i} eps{i} zeta{i}") for i in range(30)]
                   + [(50, "a rare pair here"), (51, "rare other pair")])
    pairs = lambda **o: sorted((r.doc_id, r.item_id) for r in D.contaminated(docs, items, **o).collect())
    assert pairs() == pairs(block_chars=100) == [(i, i) for i in range(30)] + [(50, 99)]
    assert D.contaminated(docs.limit(0), items).count() == D.contaminated(docs, items.limit(0)).count() == 0


def test_copies_with_other_punctuation_and_without_blanks(spark, docs_of):
    item = "Don't stop - it's what they'd say when we're late, isn't it? They're sure you'll \"wait\" for them."
    chinese = "自然语言处理是人工智能领域的一个重要方向"
    japanese = "データを処理するためのプログラムを書きます"
    curly = item.replace("'", "’").replace(" - ", "—").replace(' "', " “").replace('"', "”")
    copies = [(1, item.replace(" ", "\u00a0")), (2, curly), (3, "我们知道,今天" + chinese + "。谢谢大家"), (4, "はい、" + japanese + "。"),
              (5, "«voilà» " + curly + "…"), (6, "完全不同的一句话"), (7, "Café x")]
    items = spark.createDataFrame([(1, item), (2, chinese + "。"), (3, japanese)], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in D.contaminated(docs_of(copies), items).collect())
    assert got == [(1, 1), (2, 1), (3, 2), (4, 3), (5, 1)]
