"""Stems against published examples and plain counts; sparse factors against the dense fit."""

import collections
import re

import numpy as np
import pytest

from quarry.operators import text_nmf as N
from quarry.operators.decomposition import nnls_rows, solve_h
from quarry.operators.stemmer import doc_stems, stem

# Examples of the published algorithm, carried through all steps.
EXAMPLES = """caresses caress ponies poni ties ti caress caress cats cat feed feed agreed agre plastered plaster bled bled
motoring motor sing sing conflated conflat troubled troubl sized size hopping hop tanned tan falling fall hissing hiss
fizzed fizz failing fail filing file happy happi sky sky relational relat conditional condit rational ration valenci valenc
hesitanci hesit digitizer digit conformabli conform radicalli radic differentli differ vileli vile analogousli analog
vietnamization vietnam predication predic operator oper feudalism feudal decisiveness decis hopefulness hope
callousness callous formaliti formal sensitiviti sensit sensibiliti sensibl triplicate triplic formative form
formalize formal electriciti electr electrical electr hopeful hope goodness good revival reviv allowance allow inference infer
airliner airlin gyroscopic gyroscop adjustable adjust defensible defens irritant irrit replacement replac adjustment adjust
dependent depend adoption adopt homologou homolog communism commun activate activ angulariti angular homologous homolog
effective effect bowdlerize bowdler probate probat rate rate cease ceas controll control roll roll
generalizations gener oscillators oscil by by is is as as été été a1s a1s toy toi syzygy syzygi""".split()


def test_stems_of_published_examples():
    wrong = [(w, stem(w), s) for w, s in zip(EXAMPLES[::2], EXAMPLES[1::2]) if stem(w) != s]
    assert wrong == []


def test_stem_counts_equal_plain_python(spark):
    texts = [(1, "Running runs; the runner RAN, running!"), (2, None), (3, ""), (4, "Ponies " * 70000), (1, "runs again"),
             (None, "lost words"), (5, "... --- !!!"), (6, "Été café cats x")]
    df = spark.createDataFrame(texts, "doc_id int, text string").repartition(3)
    got = {(r.doc_id, r.term): r.tf for r in doc_stems(df, "doc_id", "text").collect()}
    want = collections.Counter()
    for i, t in texts:
        if i is not None:
            want.update((i, stem(w)) for w in re.findall(r"\w+", (t or "").lower()))
    assert got == dict(want) and got[4, "poni"] == 70000 and got[1, "run"] == 4
    assert doc_stems(df.limit(0), "doc_id", "text").count() == 0


def _corpus(n=120, seed=5):
    rng = np.random.default_rng(seed)
    topics = [["running", "races", "winners", "sports", "teams"], ["cooking", "recipes", "ovens", "flavours", "salted"],
              ["markets", "shares", "trading", "prices", "banks"]]
    out = []
    for i in range(n):
        words = list(rng.choice(topics[i % 3], 12)) + list(rng.choice(sum(topics, []), 2)) + ["common"]
        out.append((i, " ".join(words)))
    return out


def test_sparse_fit_equals_the_dense_one(spark):
    rows = _corpus()
    df = spark.createDataFrame(rows, "doc_id int, text string").repartition(4)
    m = N.fit_text_nmf(df, "doc_id", "text", k=3, max_features=50, max_iter=30, tol=1e-7)
    assert "common" in m.terms and len(m.terms) == 16  # in all documents: weight 0
    place = {t: i for i, t in enumerate(m.terms)}
    tf = np.zeros((len(rows), len(m.terms)))
    for i, t in rows:
        for w in t.split():
            tf[i, place[stem(w)]] += 1
    v = tf * np.log(len(rows) / (tf > 0).sum(0))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    h = np.random.default_rng(0).random((3, len(m.terms))) * (v.sum(0) / v.sum(0).max())
    errors = []
    for step in range(len(m.errors)):
        w = nnls_rows(v, h)
        errors.append(((v - w @ h) ** 2).sum())
        if step + 1 < len(m.errors):
            h = solve_h(h, w.T @ w, w.T @ v)
    assert np.allclose(m.errors, errors, rtol=1e-6) and np.allclose(m.h, h, atol=1e-5)
    assert all(b <= a + 1e-9 for a, b in zip(m.errors, m.errors[1:])) and m.errors[-1] < 0.7 * m.errors[0]
    values = {r.doc_id: r["values"] for r in m.feature_values(df, "doc_id", "text").collect()}
    assert np.allclose([values[i] for i, _ in rows], nnls_rows(v, m.h), atol=1e-9)
    found = {r.doc_id: r.feature_id for r in m.feature_id(df, "doc_id", "text").collect()}
    by_topic = [collections.Counter(found[i] for i in range(t, len(rows), 3)).most_common(1)[0] for t in range(3)]
    assert len({f for f, _ in by_topic}) == 3 and all(c >= 38 for _, c in by_topic)
    e = m.view("E").collect()
    assert {(r.feature_id, r.attribute_name) for r in e} == {(j + 1, t) for j in range(3) for t in m.terms if m.h[j, place[t]] > 0}


def test_documents_without_known_terms_and_bad_input(spark):
    rows = [*_corpus(60), (900, None), (901, ""), (902, "nowhere"), (None, "running races"), (0, "cooking")]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    m = N.fit_text_nmf(df, "doc_id", "text", k=2, max_features=10, max_iter=5, stems=False)
    assert len(m.terms) == 10 and not set(m.terms) & {"nowhere"} and len(m.errors) <= 6
    got = {r.doc_id: (r.feature_id, r.value) for r in m.feature_id(df, "doc_id", "text").collect()}
    assert len(got) == 63 and None not in got and got[900] == got[901] == got[902] == (None, 0.0)
    with pytest.raises(ValueError):
        N.fit_text_nmf(df.limit(0), "doc_id", "text")
    with pytest.raises(ValueError):
        N.fit_text_nmf(spark.createDataFrame([(1, "same"), (2, "same")], "doc_id int, text string"), "doc_id", "text", k=1)
    with pytest.raises(ValueError):
        N.fit_text_nmf(df, "doc_id", "text", k=0)


def test_stems_are_counted_in_slices(spark, monkeypatch):
    """A batch's words are counted slice by slice, so a worker's arrays do not grow with its rows."""
    import pyarrow as pa

    from quarry.operators import stemmer
    monkeypatch.setattr(stemmer, "SLICE_WORDS", 5)
    lists = pa.array([["a"] * 3, None, ["b"] * 4, [], ["c"] * 9, ["d"]], pa.list_(pa.string()))
    parts = list(stemmer.slices(pa.RecordBatch.from_arrays([pa.array(range(6)), lists], names=["doc_id", "words"])))
    assert [(i.to_pylist(), len(w.flatten())) for i, w in parts] == [([0, 1], 3), ([2, 3], 4), ([4], 9), ([5], 1)]
    df = spark.createDataFrame([(1, "cats run"), (2, None), (1, "cat runs running"), (3, "")], "doc_id int, text string").coalesce(1)
    got = {(r.doc_id, r.term): r.tf for r in stemmer.doc_stems(df, "doc_id", "text").collect()}
    assert got == {(1, "cat"): 2, (1, "run"): 3}
