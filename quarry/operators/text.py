"""Text features: term extraction, TF-IDF, vocabulary, ESA.

Documents are dealt once by id, a bounded number to a task, and tokenized
whole (no prefixes) with a JVM regex split, so their terms are counted,
weighted and scored where they are;
everything after that is a long ``(doc_id, term, value)`` table built
with ``explode`` + ``groupBy`` - the representation the reference calls a
nested numerical column, kept long so it joins and aggregates.

ESA (explicit semantic analysis): the *training documents are the
features*.  The model is an inverted index ``(feature_id, term, weight)``
of L2-normalized TF-IDF vectors.  Scoring a text is a sparse product:
join its weighted terms with the index on ``term`` and sum per
(text, feature).  Hot terms are handled by AQE's skew-join splitting on
that join; the per-(text, feature) sum is partially aggregated map-side.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.scalar import tokenize, with_totals
from quarry.plans.model import MiningModel
from quarry.session import PARTITIONS_A_CORE

DOCS_A_TASK = 4000
MAX_BROADCAST_ROWS = 1_000_000


def doc_terms(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, term, tf): term counts of whole documents, partitioned by doc_id.

    The texts are shuffled, not their terms; a task has some ``DOCS_A_TASK`` rows, however many there are.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    cores = max(df.sparkSession.sparkContext.defaultParallelism, 1)
    parts = max(PARTITIONS_A_CORE * cores, -(-rows.count() // DOCS_A_TASK))
    return (rows.repartition(parts, "doc_id").select("doc_id", F.explode(tokenize("text")).alias("term"))
            .groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf")))


def _small(table: DataFrame, rows: int) -> DataFrame:
    """``table`` marked for broadcast if it has at most ``MAX_BROADCAST_ROWS`` rows."""
    return F.broadcast(table) if rows <= MAX_BROADCAST_ROWS else table


def l2_normalize(df: DataFrame, key: str, value: str, out: str = "value") -> DataFrame:
    """Divide ``value`` by the L2 norm of its ``key`` group.

    A window over ``key``: one shuffle by the key instead of an aggregate
    plus a join back.  A group is one document's distinct terms - bounded by
    the vocabulary of a single text, not by the corpus.
    """
    w = Window.partitionBy(key)
    return df.withColumn(out, F.col(value) / F.sqrt(F.sum(F.col(value) * F.col(value)).over(w)))


def term_extract(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Term extraction: (doc_id, term, value) with L2-normalized term frequency per document."""
    tc = doc_terms(df, id_col, text_col)
    return l2_normalize(tc, "doc_id", "tf").select("doc_id", "term", "value")


def vocabulary(tc: DataFrame, min_docs: int = 1, max_features: int | None = None) -> DataFrame:
    """(term, df, idf) over a (doc_id, term, tf) table; idf = ln(N / df).

    ``max_features`` keeps the terms of highest document frequency (ties by
    term) - a parameter-bounded top-N.
    """
    n_docs = tc.agg(F.countDistinct("doc_id").alias("n_docs"))
    v = tc.groupBy("term").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") >= min_docs)
    if max_features:
        v = v.orderBy(F.col("df").desc(), F.col("term").asc()).limit(max_features)
    return with_totals(v, n_docs).select(
        "term", "df", F.log(F.col("n_docs") / F.col("df")).alias("idf"))


def tfidf(tc: DataFrame, vocab: DataFrame, drop_below: float = 0.0) -> DataFrame:
    """(doc_id, term, weight): tf * idf over the vocabulary, L2-normalized per document.

    ``vocab`` is counted first, so it should be persisted; up to ``MAX_BROADCAST_ROWS`` terms are broadcast
    and the terms stay with their document.
    """
    w = tc.join(_small(vocab.select("term", "idf"), vocab.count()), "term").withColumn("raw", F.col("tf") * F.col("idf")) \
        .filter(F.col("raw") > 0)
    out = l2_normalize(w, "doc_id", "raw", "weight").select("doc_id", "term", "weight")
    if drop_below > 0:
        out = out.filter(F.col("weight") >= drop_below)
    return out


@dataclass
class ESAModel(MiningModel):
    index: DataFrame | None = None  # feature_id, term, weight
    vocab: DataFrame | None = None  # term, df, idf
    n_features: int = 0
    settings_used: dict = field(default_factory=dict)

    def vectors(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """(id, feature_id, value): full ESA vector of each text (sparse product)."""
        tc = doc_terms(df, id_col, text_col)
        w = tfidf(tc, self.vocab)  # model idf, vocabulary terms only
        index = _small(self.index.withColumnRenamed("weight", "fw"), self.index.count())
        return (w.join(index, "term")
                .groupBy(F.col("doc_id").alias("id"), "feature_id")
                .agg(F.sum(F.col("weight") * F.col("fw")).alias("value")))

    def top_features(self, df: DataFrame, id_col: str, text_col: str, top_n: int = 5) -> DataFrame:
        """FEATURE_SET(model, top_n): best features per text (value desc, feature id asc)."""
        v = self.vectors(df, id_col, text_col)
        # a text's vector has at most as many rows as the model has features, and lies in one partition
        w = Window.partitionBy("id").orderBy(F.col("value").desc(), F.col("feature_id").asc())
        return v.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_n)

    def compare(self, pairs: DataFrame, a_text: str, b_text: str, pair_key: list[str]) -> DataFrame:
        """FEATURE_COMPARE: 1 - cosine of the two ESA vectors of each pair (a distance)."""
        ka = F.to_json(F.struct(*[F.col(k) for k in pair_key]))
        a = self.vectors(pairs.select(ka.alias("__k"), a_text), "__k", a_text)
        b = self.vectors(pairs.select(ka.alias("__k"), b_text), "__k", b_text)
        dot = a.join(b.withColumnRenamed("value", "vb"), ["id", "feature_id"]) \
            .groupBy("id").agg(F.sum(F.col("value") * F.col("vb")).alias("dot"))
        na = a.groupBy("id").agg(F.sqrt(F.sum(F.col("value") ** 2)).alias("na"))
        nb = b.groupBy("id").agg(F.sqrt(F.sum(F.col("value") ** 2)).alias("nb"))
        keys = pairs.select(ka.alias("id"), *pair_key)
        sim = keys.join(dot, "id", "left").join(na, "id", "left").join(nb, "id", "left").select(
            *pair_key,
            (F.lit(1.0) - F.coalesce(F.col("dot") / (F.col("na") * F.col("nb")), F.lit(0.0))).alias("compare"))
        return sim


class ESA:
    """Explicit semantic analysis.  Settings follow the reference's names:
    ESAS_MIN_ITEMS (terms per training document), ODMS_TEXT_MIN_DOCUMENTS
    (documents per term), ESAS_VALUE_THRESHOLD (weight floor)."""

    DEFAULTS = {"ESAS_MIN_ITEMS": 5, "ODMS_TEXT_MIN_DOCUMENTS": 1, "ESAS_VALUE_THRESHOLD": 1e-8,
                "ESAS_TOPN_FEATURES": 1000}

    def __init__(self, min_items: int = 5, min_docs: int = 2, value_threshold: float = 1e-8,
                 max_features: int | None = None, name: str = "esa_model"):
        self.min_items = min_items
        self.min_docs = min_docs
        self.value_threshold = value_threshold
        self.max_features = max_features
        self.name = name

    def fit(self, df: DataFrame, id_col: str, text_col: str) -> ESAModel:
        tc = doc_terms(df, id_col, text_col)
        sizes = tc.groupBy("doc_id").agg(F.count(F.lit(1)).alias("items")) \
            .filter(F.col("items") >= self.min_items).select("doc_id")
        tc = tc.join(sizes, "doc_id")
        vocab = vocabulary(tc, self.min_docs, self.max_features).cache()
        idx = tfidf(tc, vocab, drop_below=self.value_threshold) \
            .select(F.col("doc_id").alias("feature_id"), "term", "weight").cache()
        m = ESAModel(name=self.name, function="FEATURE_EXTRACTION", algorithm="ALGO_EXPLICIT_SEMANTIC_ANALYS",
                     settings={"ESAS_MIN_ITEMS": self.min_items, "ODMS_TEXT_MIN_DOCUMENTS": self.min_docs,
                               "ESAS_VALUE_THRESHOLD": self.value_threshold},
                     default_settings=dict(self.DEFAULTS), index=idx, vocab=vocab)
        m.add_view("A", lambda: idx, "ESA attribute weights per feature")
        m.add_view("F", lambda: idx.select("feature_id").distinct(), "ESA features")
        return m
