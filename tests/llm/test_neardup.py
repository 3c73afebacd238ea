"""Near-duplicates against brute force over all pairs."""

import random

from quarry.llm import neardup
from quarry.llm.common import connected_components


def _shingles(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    if len(words) < size:
        return {tuple(words)}
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def _brute(rows, size, percent=80):
    """(n_shingles of each row, smallest reachable id of each id)."""
    sets = [(i, _shingles(t, size)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, (i, s) in enumerate(sets):
        for j, t in sets[a + 1:]:
            if i is None or j is None or not s or not t:
                continue
            common = len(s & t)
            if 100 * common >= percent * (len(s) + len(t) - common):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [len(s) for _, s in sets], {i: root(i) for i in parent}


def _check(df, rows, size):
    got = sorted((r.doc_id if r.doc_id is not None else -99, r.n_shingles, r.component_id, r.kept) for r in df.collect())
    sizes, comps = _brute(rows, size)
    want = sorted((i if i is not None else -99, n, comps.get(i), i is None or comps[i] == i)
                  for (i, _), n in zip(rows, sizes))
    assert got == want


def _corpus(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(60):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 4, 5, 12, 60, 200]))]
        for _ in range(rng.choice([1, 1, 2, 6])):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 3, 8])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(words)))
    return rows


def test_equals_brute_force(docs_of):
    rows = _corpus()
    _check(neardup.near_duplicates(docs_of(rows), size=4), rows, 4)


def test_large_group_of_near_copies(docs_of, monkeypatch):
    """A bucket far larger than the blocks: every link is still found, without making all pairs."""
    monkeypatch.setattr(neardup, "SMALL_BUCKET", 10)
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rng = random.Random(4)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 5])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10 ** 6)}"
        rows.append((i + 1000, " ".join(words)))
    _check(neardup.near_duplicates(docs_of(rows), size=4), rows, 4)


def test_edge_cases(docs_of):
    """Nulls, empty texts, case and blanks, short texts, repeated rows and ids, a very long text."""
    long = " ".join(f"t{i % 9000}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "ONE\ttwo"), (6, "one two three"), (7, long),
            (8, long), (9, "É b c d e"), (10, "é b c d e"), (10, "é b c d e"), (None, "one two"), (11, "p q r s t"),
            (12, "k l m n o"), (12, "p q r s t"), (13, "k l m n o"), (-5, "one two\x0b")]
    _check(neardup.near_duplicates(docs_of(rows).selectExpr("*", "1 AS key", "2 AS rep", "3 AS component"), size=4),
           rows, 4)


def test_empty_table(docs_of):
    assert neardup.near_duplicates(docs_of([])).count() == 0
    assert neardup.keep_first(docs_of([])).count() == 0


def test_keep_first(docs_of):
    rows = _corpus(9) + [(None, "a b c"), (None, "a b c")]
    _, comps = _brute(rows, 5)
    kept = neardup.keep_first(docs_of(rows))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(i for i in comps if comps[i] == i)
    assert kept.filter("doc_id IS NULL").count() == 2


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.id: r.component for r in connected_components(
        spark.createDataFrame(edges, "u long, v long")).distinct().collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
