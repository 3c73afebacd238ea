"""Non-negative factors of a document-term table, V ~ W H, on sparse rows.

V holds the L2-normalized TF-IDF weights of at most ``max_features`` terms; a document is one row of
(place, weight) pairs and is never made dense.  W is a function of a row for given H, so a step is one
pass that adds up W'W, W'V and the error; the driver keeps H, features x terms, which the settings
bound.  Both halves solve their least squares problem, so the error never rises.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.decomposition import nnls_cross, solve_h
from quarry.operators.sparse_kmeans import MAX_NUMBERS, sum_batches
from quarry.operators.stemmer import doc_stems
from quarry.operators.text import doc_terms, l2_normalize, vocabulary
from quarry.plans.model import MiningModel
from quarry.session import hold

MAX_TERMS = 100_000


def _sparse(batch: pa.RecordBatch):
    """(row, place, weight) of a batch of columns places and weights."""
    places, weights = batch.column("places"), batch.column("weights")
    row = np.repeat(np.arange(batch.num_rows), np.diff(places.offsets.to_numpy()))
    return row, places.flatten().to_numpy(zero_copy_only=False), weights.flatten().to_numpy(zero_copy_only=False)


def _cross(row, place, weight, n: int, h: np.ndarray) -> np.ndarray:
    """V H' of sparse rows."""
    return np.stack([np.bincount(row, weight * hj[place], minlength=n) for hj in h], axis=1)


@dataclass
class TextNMFModel(MiningModel):
    h: np.ndarray | None = None              # features x terms
    terms: list = field(default_factory=list)
    vocab: DataFrame | None = None           # term, place, idf
    stems: bool = True
    errors: list = field(default_factory=list)
    converged: bool = False

    def rows(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """(doc_id, places, weights): the documents that hold a term of the vocabulary."""
        counts = (doc_stems if self.stems else doc_terms)(df, id_col, text_col).filter(F.col("doc_id").isNotNull())
        return sparse_rows(counts, self.vocab)

    def feature_values(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """(doc_id, values): FEATURE_VALUE of every feature, an array; 0s for a document without known terms.

        One row per distinct id; rows without id are left out.
        """
        h = self.h
        gram = h @ h.T
        rows = self.rows(df, id_col, text_col)

        def score(batches):
            for batch in batches:
                if batch.num_rows:
                    row, place, weight = _sparse(batch)
                    w = nnls_cross(gram, _cross(row, place, weight, batch.num_rows, h))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id"), pa.ListArray.from_arrays(
                            pa.array(np.arange(0, w.size + 1, w.shape[1], dtype=np.int32)), pa.array(w.ravel()))],
                        names=["doc_id", "values"])

        schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, values array<double>"
        ids = df.select(F.col(id_col).alias("doc_id")).filter("doc_id IS NOT NULL").distinct()
        return ids.join(rows.mapInArrow(score, schema), "doc_id", "left").select(
            "doc_id", F.coalesce("values", F.array_repeat(F.lit(0.0), len(h))).alias("values"))

    def feature_id(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """(doc_id, feature_id, value): the feature of largest value, ties to the smaller id; NULL if all are 0."""
        v = self.feature_values(df, id_col, text_col).withColumn("value", F.array_max("values"))
        return v.select("doc_id", F.when(F.col("value") > 0, F.array_position("values", F.col("value")).cast("int"))
                        .alias("feature_id"), "value")

    def coefficients_df(self, spark: SparkSession) -> DataFrame:
        """View E: feature, term, coefficient; coefficients of 0 are left out."""
        rows = [(j + 1, t, float(c)) for j in range(len(self.h)) for t, c in zip(self.terms, self.h[j]) if c > 0]
        return spark.createDataFrame(rows, "feature_id int, attribute_name string, coefficient double")

    def errors_df(self, spark: SparkSession) -> DataFrame:
        """Squared error |V - W H|^2 before the first and after every step."""
        return spark.createDataFrame([(i, float(e)) for i, e in enumerate(self.errors)], "iteration int, error double")


def sparse_rows(counts: DataFrame, vocab: DataFrame) -> DataFrame:
    """(doc_id, places, weights) of (doc_id, term, tf) rows: TF-IDF over ``vocab``, length 1 by document.

    ``vocab`` has MAX_TERMS rows at most, so it is broadcast and a document's row is bounded.
    """
    known = counts.join(F.broadcast(vocab), "term").withColumn("raw", F.col("tf") * F.col("idf")).filter(F.col("raw") > 0)
    weighted = l2_normalize(known, "doc_id", "raw", "weight")
    pairs = weighted.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("place", "weight"))).alias("pairs"))
    return pairs.select("doc_id", F.col("pairs.place").alias("places"), F.col("pairs.weight").alias("weights"))


def fit_text_nmf(df: DataFrame, id_col: str, text_col: str, k: int = 10, max_features: int = 3000, min_docs: int = 2,
                 stems: bool = True, max_iter: int = 200, tol: float = 1e-5, seed: int = 0,
                 name: str = "text_nmf") -> TextNMFModel:
    """``k`` non-negative features of the texts' (stemmed) words.

    Terms are those of ``min_docs`` documents and more, the ``max_features`` of highest document frequency
    (ties by term); a term of every document has weight 0.  Fitting ends when a step lowers the error by
    less than ``tol`` of it.  No documents or no such terms: ValueError.
    """
    if k < 1 or k * max_features > MAX_NUMBERS or max_features > MAX_TERMS:
        raise ValueError(f"k must be above 0, max_features at most {MAX_TERMS} and their product at most {MAX_NUMBERS}")
    spark = df.sparkSession
    counts = (doc_stems if stems else doc_terms)(df, id_col, text_col).filter(F.col("doc_id").isNotNull()).persist(
        StorageLevel.MEMORY_AND_DISK)
    try:
        found = sorted((r.term, r.idf) for r in vocabulary(counts, min_docs, max_features).collect())  # max_features rows
        if not found:
            raise ValueError(f"no term occurs in {min_docs} documents")
        vocab = spark.createDataFrame([(t, i, float(idf)) for i, (t, idf) in enumerate(found)],
                                      "term string, place int, idf double")
        rows = hold(sparse_rows(counts, vocab))
        try:
            model = TextNMFModel(name=name, function="FEATURE_EXTRACTION", algorithm="ALGO_NONNEGATIVE_MATRIX_FACTOR",
                                 terms=[t for t, _ in found], vocab=vocab, stems=stems, case_id=id_col,
                                 settings={"FEAT_NUM_FEATURES": k, "NMFS_NUM_ITERATIONS": max_iter, "NMFS_CONV_TOLERANCE": tol,
                                           "ODMS_TEXT_MAX_FEATURES": max_features, "ODMS_TEXT_MIN_DOCUMENTS": min_docs})
            _fit(rows.select("places", "weights"), model, k, max_iter, tol, seed)
        finally:
            rows.unpersist()
    finally:
        counts.unpersist()
    model.signature = [(text_col, "TEXT")]
    model.add_view("E", lambda: model.coefficients_df(spark), "NMF H matrix")
    return model


def _fit(rows: DataFrame, model: TextNMFModel, k: int, max_iter: int, tol: float, seed: int) -> None:
    m = len(model.terms)

    def sums(h):
        gram = h @ h.T

        def block(batch):
            row, place, weight = _sparse(batch)
            cross = _cross(row, place, weight, batch.num_rows, h)
            w = nnls_cross(gram, cross)
            ww = w.T @ w
            wv = np.concatenate([np.bincount(place, weight * wj[row], minlength=m) for wj in w.T])
            return np.concatenate((ww.ravel(), wv, [weight @ weight - 2 * (w * cross).sum() + (ww * gram).sum()]))

        flat = sum_batches(rows, block, k * k + k * m + 1)
        if flat is None:
            raise ValueError("every term occurs in all documents")
        return flat[:k * k].reshape(k, k), flat[k * k:-1].reshape(k, m), float(flat[-1])

    mean = sum_batches(rows, lambda b: np.bincount(_sparse(b)[1], _sparse(b)[2], minlength=m) / 1.0, m)
    if mean is None:
        raise ValueError("every term occurs in all documents")
    h = np.random.default_rng(seed).random((k, m)) * (mean / max(mean.max(), 1e-300))
    ww, wv, error = sums(h)
    model.errors.append(error)
    for _ in range(max_iter):
        h = solve_h(h, ww, wv)
        ww, wv, now = sums(h)
        model.errors.append(now)
        model.converged, error = error - now <= tol * max(error, 1e-12), now
        if model.converged:
            break
    model.h = h
