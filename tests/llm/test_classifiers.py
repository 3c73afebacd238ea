"""Quality and toxicity: held-out accuracy, fold rules, edge cases, exact neighbours."""

import zlib

import numpy as np
import pytest

from quarry.llm import quality, toxicity
from quarry.llm.common import WordHasher, separator_mask
from quarry.llm.labelled import labelled_sample

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def _auc(score, label):
    rank = np.argsort(np.argsort(score, kind="stable"), kind="stable")
    ones = label == 1
    return (rank[ones].mean() - (ones.sum() - 1) / 2) / (~ones).sum()


@pytest.mark.parametrize("function,column,fold,threshold,floor", [
    (quality.quality_scores, "quality", (3, 1), 0.5, 0.95), (toxicity.toxicity_scores, "toxic", (4, 2), 0.3, 0.75)])
def test_held_out_accuracy(tables, function, column, fold, threshold, floor):
    docs, labels = tables
    got = function(docs, labels).toPandas()
    assert len(got) == docs.count()
    assert ((got.score >= 0) & (got.score <= 1)).all()
    assert (got.predicted == (got.score >= threshold)).all()
    assert [zlib.crc32(str(i).encode()) % fold[0] == fold[1] for i in got.doc_id] == got.held_out.tolist()
    held = got[got.held_out].merge(labels.toPandas(), on="doc_id")
    assert _auc(held.score.to_numpy(), held[column].to_numpy()) >= floor
    assert (held.predicted == held[column]).mean() >= 0.93


def test_sample_leaves_the_fold_out(tables):
    docs, labels = tables
    ids, texts, y, shares = labelled_sample(docs, labels, "toxic", 4, 2, per_class=30)
    assert all(zlib.crc32(str(i).encode()) % 4 != 2 for i in ids)
    assert len(ids) == len(texts) == len(y) and y.count(0) <= 30 and y.count(1) <= 30 and sum(shares) > 60


def test_held_out_labels_do_not_matter(tables):
    from pyspark.sql import functions as F
    docs, labels = tables
    turned = labels.withColumn("quality", F.when(F.expr("crc32(cast(cast(doc_id AS string) AS binary)) % 3 = 1"),
                                                 1 - F.col("quality")).otherwise(F.col("quality")))
    a = quality.quality_scores(docs, labels).toPandas().sort_values("doc_id")
    b = quality.quality_scores(docs, turned).toPandas().sort_values("doc_id")
    assert np.array_equal(a.score, b.score)


@pytest.mark.parametrize("function,column", [(quality.quality_scores, "quality"), (toxicity.toxicity_scores, "toxic")])
def test_edge_cases(spark, docs_of, function, column):
    """Nulls, empty and very long texts, repeated rows, odd labels, empty tables, clashing columns."""
    rows = [(i, f"good word{i} text" if i % 2 else f"bad bad bad{i} %%%") for i in range(60)]
    rows += [(100, None), (101, ""), (102, "bad " * 100_000), (None, "good"), (3, "good word3 text"), (3, "other")]
    docs = docs_of(rows).selectExpr("*", "1 AS score", "'x' AS held_out")
    labels = spark.createDataFrame(
        [(i, i % 2, i % 2) for i in range(60)] + [(None, 1, 1), (5, None, None), (7, 9, 9), (9999, 1, 1)],
        "doc_id long, quality int, toxic int")
    got = function(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    by = {r.doc_id: r.score for r in got}
    assert by[100] == by[101]
    assert function(docs.limit(0), labels).count() == 0
    for some in (labels.limit(0), labels.filter(f"{column} = 1")):  # no labels, one class
        assert function(docs, some).count() == len(rows)


def test_keep_good_returns_the_columns(tables):
    docs, labels = tables
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    want = {r.doc_id for r in quality.quality_scores(docs, labels).filter("predicted = 1").collect()}
    assert {r.doc_id for r in kept.collect()} == want


def test_neighbours_are_exact(tables):
    """Block-max search equals a dense search over all examples."""
    docs, labels = tables
    model = toxicity.ToxicityModel(*labelled_sample(docs, labels, "toxic", 4, 2))
    index = model.index
    dense = np.zeros((len(model.ids), len(index.terms)))
    dense[index.doc, np.repeat(np.repeat(np.arange(len(index.terms)), index.term_n), index.entry_n)] = index.weight
    hasher = WordHasher(separator_mask(toxicity._SEPARATORS))
    texts = [r.text.lower().encode() for r in docs.collect()]
    text, term, weight = index.vectors(*toxicity._terms(texts, hasher), len(texts))
    tried = 0
    for i in range(len(texts)):
        own = text == i
        if own.any():
            query = np.zeros(len(index.terms))
            query[term[own]] = weight[own]
            want = np.sort((dense @ query)[dense @ query > 0])[::-1][:7]
            assert np.allclose(index.nearest(term[own], weight[own], 7)[1], want)
            tried += 1
    assert tried > 50


def test_rare_toxic_words_have_neighbours():
    """A word of 24 toxic examples and of no clean one counts, though its chi-squared is below 25."""
    n = 2000
    toxic = [f"filthword{i % 40} common{i % 7} plain{i % 11}" if i >= 24 else f"grimword common{i % 7} plain{i % 11}" for i in range(n)]
    clean = [f"nice{i % 40} common{i % 7} plain{i % 11}" for i in range(n)]
    model = toxicity.ToxicityModel(list(range(2 * n)), toxic + clean, [1] * n + [0] * n, (19 * n, n))
    hasher = WordHasher(separator_mask(toxicity._SEPARATORS))
    scores, near, _ = model.score([b"grimword unheard", b"nice3 unheard", b"unheard"], hasher)
    assert set(near[0]) <= set(range(24)) and near[0] and scores[0] >= 0.3 > scores[1]
    assert near[2] == [] and scores[2] == model.bare


def test_words_that_do_not_depend_on_the_label():
    """Such a word is no term: a text of nothing else has the bare score and no neighbour, never NaN."""
    texts = [f"{'vile' if i < 100 else 'kind'} common{i % 5}" + (" zebra" if i % 25 == 0 else "") for i in range(200)]
    model = toxicity.ToxicityModel(list(range(200)), texts, [int(i < 100) for i in range(200)], (100, 100))
    hasher = WordHasher(separator_mask(toxicity._SEPARATORS))
    scores, near, _ = model.score([b"zebra", b"zebra vile", b""], hasher)
    assert not np.isnan(scores).any() and scores[0] == scores[2] == model.bare and near[0] == []
    assert scores[1] > 0.5


def test_weights_votes_and_calibration_from_their_definitions(tables):
    """TF-IDF weights, neighbours and left-out votes in plain Python dictionaries."""
    import math
    docs, labels = tables
    ids, texts, y, shares = labelled_sample(docs, labels, "toxic", 4, 2, per_class=40)
    model = toxicity.ToxicityModel(ids, texts, y, shares, k=5)
    separators = set(map(chr, toxicity._SEPARATORS))

    def terms(text):
        counts, word = {}, b""
        words = "".join(" " if c in separators else c for c in text.lower()).split(" ")
        for word in filter(None, words):
            raw = word.encode()
            for t in [("word", raw)] + [("prefix", raw[:n]) for n in toxicity.PREFIXES if len(raw) > n]:
                counts[t] = counts.get(t, 0) + 1
        return counts

    bags, n, ones = [terms(t) for t in texts], len(y), sum(y)
    weight = {}
    for t in set().union(*bags):
        df = sum(t in b for b in bags)
        df1 = sum(t in b for b, label in zip(bags, y) if label)
        cross = df1 * (n - ones - (df - df1)) - (df - df1) * (ones - df1)
        chi2 = 0 if df == n else n * cross ** 2 / (ones * (n - ones) * df * (n - df))
        w = math.log((1 + n) / (1 + df)) * chi2 / (chi2 + toxicity.HALF_CHI2)
        if df >= toxicity.MIN_EXAMPLES and w > 0:
            weight[t] = w

    def vector(bag):
        v = {t: (1 + math.log(c)) * weight[t] for t, c in bag.items() if t in weight}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()}

    assert len(model.index.terms) == len(weight)
    vectors = [vector(b) for b in bags]

    def vote(v, leave=-1):
        sims = sorted(((sum(x * e.get(t, 0.0) for t, x in v.items()), label) for j, (e, label) in enumerate(zip(vectors, y))
                       if j != leave), key=lambda p: -p[0])[:5]
        total = sum(s * s for s, _ in sims if s > 0)
        return sum(s * s * label for s, label in sims if s > 0) / total if total else None

    hasher = WordHasher(separator_mask(toxicity._SEPARATORS))
    some = [r.text for r in docs.limit(40).collect()]
    scores, _, _ = model.score([t.lower().encode() for t in some], hasher)
    for text, score in zip(some, scores):
        v = vote(vector(terms(text)))
        if v is None:
            assert score == model.bare
        else:
            v = min(max(v, 0.005), 0.995)
            want = 1 / (1 + math.exp(-(model.slope * math.log(v / (1 - v)) + model.offset)))
            assert score == pytest.approx(want, abs=1e-6)
    # the curve is the best one for the left-out votes under its light ridge
    votes = [vote(v, i) for i, v in enumerate(vectors)]
    have = [n - ones, ones]
    case = [(math.log(min(max(v, .005), .995) / (1 - min(max(v, .005), .995))), label, shares[label] / have[label])
            for v, label in zip(votes, y) if v is not None]
    scale = len(case) / sum(w for _, _, w in case)
    p = [1 / (1 + math.exp(-(model.slope * x + model.offset))) for x, _, _ in case]
    slope = sum(scale * w * (label - q) * x for (x, label, w), q in zip(case, p)) - 1e-3 * (model.slope - 1)
    offset = sum(scale * w * (label - q) for (_, label, w), q in zip(case, p)) - 1e-3 * model.offset
    assert abs(slope) < 1e-4 and abs(offset) < 1e-4
