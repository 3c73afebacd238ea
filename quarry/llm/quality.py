"""Quality classifier: supervised subword embeddings averaged per document.

Words and character n-grams are hashed into one table of learned vectors; a document is the mean
of its features' vectors, followed by a softmax over the two classes.  Training is plain
stochastic gradient descent in numpy on a bounded labelled sample.  The output layer is linear,
so scoring needs only one number per bucket: the bucket's vector times the difference of the two
class vectors.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import BLANKS, WordHasher, bound_batches, byte_list, mix, separator_mask, slices, tidy
from quarry.llm.labelled import PER_CLASS, in_fold, labelled_sample

BUCKET_BITS = 17
HALF = 1 << 19  # bytes of texts whose features are held at once
GRAMS = (3, 4)
REPEATS = (1, 2, 3)
DIMENSIONS = 8
EPOCHS = 10
RATE = 0.2
TABLE_RATE = 20.0  # a feature's share of a document is small, so the vectors take larger steps
FOLD = (3, 1)  # crc32(doc_id) mod 3 = 1 is held out


def _features(texts: list[bytes], hasher: WordHasher):
    """(bucket, text index) of every word and every character n-gram of 3 and 4 bytes.

    n-grams lie inside one word with at most one blank at either end, as word-edge marks.  A word
    that equals the word 1, 2 or 3 places before it adds one of three mark features.
    """
    buf, start, end, h, owner = hasher.words(texts)
    shift = np.uint64(64 - BUCKET_BITS)
    buckets, owners = [h >> shift], [owner]
    for back in REPEATS:
        same = owner[back:][(h[back:] == h[:-back]) & (owner[back:] == owner[:-back])]
        buckets.append(np.full(len(same), mix(np.array([back], np.uint64))[0] >> shift))
        owners.append(same)
    n = len(buf)
    blank = hasher.separators[buf]
    bounds = np.cumsum([len(t) + 1 for t in texts])
    whose = np.repeat(np.arange(len(texts)), np.diff(np.concatenate(([0], bounds))))
    code = np.where(blank, np.uint64(32), buf.astype(np.uint64))
    for size in GRAMS:
        m = n - size + 1
        if m <= 0:
            continue
        inner = np.zeros(m, bool)
        for j in range(1, size - 1):
            inner |= blank[j:j + m]
        ok = ~inner & (whose[:m] == whose[size - 1:])
        x = np.full(m, size, np.uint64)
        for j in range(size):
            x = (x << np.uint64(8)) | code[j:j + m]
        buckets.append(mix(x[ok]) >> shift)
        owners.append(whose[:m][ok])
    return np.concatenate(buckets).astype(np.int64), np.concatenate(owners)


def train(texts: list[str], labels: list[int], shares: tuple[int, int], dimensions: int = DIMENSIONS,
          epochs: int = EPOCHS, rate: float = RATE, seed: int = 5) -> tuple[np.ndarray, float]:
    """(weight of each bucket, bias) of the log odds of label 1.

    ``shares`` are the class sizes among all labels; the sample's class sizes are corrected to
    them in the bias.  With one class or none in the sample, all weights are 0 and the bias
    follows the shares.
    """
    size = 1 << BUCKET_BITS
    prior = float(np.log(shares[1] + 1) - np.log(shares[0] + 1))
    y = np.array(labels, int)
    if len(set(labels)) < 2:
        return np.zeros(size, np.float32), prior
    hasher = WordHasher(separator_mask(BLANKS))
    docs = []
    for t in texts:
        bucket, _ = _features([t.encode("utf-8", "replace")], hasher)
        ids, counts = np.unique(bucket, return_counts=True)
        docs.append((ids, (counts / max(1, counts.sum())).astype(np.float32)))
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / dimensions, 1 / dimensions, (size, dimensions)).astype(np.float32)
    output = np.zeros((dimensions, 2), np.float32)
    bias = np.zeros(2, np.float32)
    # each class weighs the same in training
    weight = len(y) / (2 * np.bincount(y, minlength=2))
    steps, done = epochs * len(docs), 0
    for _ in range(epochs):
        for i in rng.permutation(len(docs)):
            ids, share = docs[i]
            lr = rate * (1 - done / steps)
            done += 1
            hidden = share @ table[ids]
            z = hidden @ output + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            p *= weight[y[i]]
            back = output @ p
            output -= lr * np.outer(hidden, p)
            bias -= lr * p
            table[ids] -= (lr * TABLE_RATE * share)[:, None] * back
    weights = table @ (output[:, 1] - output[:, 0])
    return weights.astype(np.float32), float(bias[1] - bias[0]) + prior


def _score(batches, model, carry: str):
    weights, bias = model.value
    hasher = WordHasher(separator_mask(BLANKS))
    for batch in batches:
        for part in slices(batch, "text", HALF):
            bucket, owner = _features(byte_list(part.column("text")), hasher)
            n = part.num_rows
            total = np.bincount(owner, weights[bucket], minlength=n)
            odds = total / np.maximum(1, np.bincount(owner, minlength=n)) + bias
            score = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
            yield pa.RecordBatch.from_arrays([part.column(carry), pa.array(score)], names=[carry, "score"])
    tidy()


def quality_scores(docs: DataFrame, labels: DataFrame, fold: tuple[int, int] = FOLD, column: str = "quality",
                   threshold: float = 0.5, per_class: int = PER_CLASS) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Fitted on a sample of at most ``per_class`` labelled rows of each class outside the fold
    (see :func:`labelled_sample`); every row's whole text is scored.  A null or empty text has no
    features and gets the share of label 1 as its score, moved by the trained bias.  Null doc_id:
    held_out is false.  Without labels every score is 0.5.  Extra columns are ignored.
    """
    bound_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(  # 2**BUCKET_BITS floats, whatever the data
        train(*labelled_sample(docs, labels, column, *fold, per_class=per_class)[1:]))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(partial(_score, model=model, carry="doc_id"), "doc_id long, score double")
    return scored.select("doc_id", in_fold(F.col("doc_id"), *fold).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def _keep(batches, model, threshold: float):
    weights, bias = model.value
    hasher = WordHasher(separator_mask(BLANKS))
    for batch in batches:
        for part in slices(batch, "text", HALF):
            bucket, owner = _features(byte_list(part.column("text")), hasher)
            n = part.num_rows
            total = np.bincount(owner, weights[bucket], minlength=n)
            odds = total / np.maximum(1, np.bincount(owner, minlength=n)) + bias
            yield part.filter(pa.array(1 / (1 + np.exp(-np.clip(odds, -40, 40))) >= threshold))
    tidy()


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """The rows of ``docs`` that :func:`quality_scores` would predict as 1, all columns kept."""
    bound_batches(docs.sparkSession)
    fold = options.pop("fold", FOLD)
    model = docs.sparkSession.sparkContext.broadcast(
        train(*labelled_sample(docs, labels, options.pop("column", "quality"), *fold, **options)[1:]))
    return docs.mapInArrow(partial(_keep, model=model, threshold=threshold), docs.schema)
