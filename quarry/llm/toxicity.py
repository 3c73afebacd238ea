"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

The examples form an inverted index cut into blocks; every term keeps its largest weight in each
block.  Rare terms have few postings, which a document adds up first.  Its bound for a block is then
the block's best sum and the block's largest weights of its common terms; it evaluates the common
terms in the best blocks, and then only in the blocks whose bound can still reach its k-th best
similarity, so the neighbours are exact.  Their votes, weighted by squared similarity, are calibrated on the
examples themselves, each left out of its own vote.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import (SLICE_BYTES, WordHasher, bound_batches, byte_list, mix, separator_mask, share, shared,
                               slices)
from quarry.llm.labelled import PER_CLASS, in_fold, labelled_sample

NEIGHBOURS = 30
BLOCK = 32
COMMON = 16                 # terms of one example in so many are evaluated block by block
TEXTS = 256                 # texts searched at once
LEADING = 18                # bits of a hash that lead to its place among the terms
PREFIXES = (4, 5, 6, 7, 8)  # bytes; stand for word stems
MIN_EXAMPLES = 3            # a term must occur in so many examples
HALF_CHI2 = 25.0            # a term of this chi-squared on the label has half of its weight
FOLD = (4, 2)               # crc32(doc_id) mod 4 = 2 is held out

#: All ASCII bytes but letters and digits end a word.
_SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())


def _terms(texts: list[bytes], hasher: WordHasher):
    """(term hash, text index): words, and the prefixes of longer words."""
    buf, start, end, h, owner = hasher.words(texts)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(hasher.table[buf] * hasher.powers[:len(buf)], out=total[1:])
    hashes, owners = [h], [owner]
    for size in PREFIXES:
        s = start[end - start > size]
        hashes.append(mix((total[s + size] - total[s]) * hasher.inverse[s] + np.uint64(size * 1_000_003)))
        owners.append(owner[end - start > size])
    return np.concatenate(hashes), np.concatenate(owners)


def _parts(texts: list[bytes]):
    """(place of the first, texts) of slices of about ``SLICE_BYTES``, one text at least."""
    first, held = 0, 0
    for i, t in enumerate(texts):
        if i > first and held + len(t) > SLICE_BYTES:
            yield first, texts[first:i]
            first, held = i, 0
        held += len(t)
    if texts:
        yield first, texts[first:]


def _counted(texts: list[bytes], hasher: WordHasher):
    """(term hash, text index, occurrences) of all terms of all texts, in order of hash and index."""
    found = []
    for first, part in _parts(texts):
        h, owner = _terms(part, hasher)
        order = np.lexsort((owner, h))
        h, owner = h[order], owner[order]
        new = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1]))))[:len(h)]
        found.append((h[new], (owner[new] + first).astype(np.int32), np.diff(np.append(new, len(h))).astype(np.int32)))
    h, owner, tf = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((owner, h))
    return h[order], owner[order], tf[order]


def _ranges(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """lo[0], ..., lo[0] + n[0] - 1, lo[1], ..."""
    return np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())


class BlockMaxIndex:
    """Postings of the examples by term, cut into blocks of ``BLOCK`` examples."""

    def __init__(self, hashes: np.ndarray, owner: np.ndarray, tf: np.ndarray, labels: np.ndarray):
        n, ones = len(labels), int(labels.sum())
        vocabulary, term, df = np.unique(hashes, return_inverse=True, return_counts=True)
        df1 = np.bincount(term, labels[owner], minlength=len(vocabulary))
        cross = df1 * (n - ones - (df - df1)) - (df - df1) * (ones - df1)
        with np.errstate(divide="ignore", invalid="ignore"):
            chi2 = np.nan_to_num(n * cross ** 2 / (ones * (n - ones) * df * (n - df)))
        # terms that hardly depend on the label count little; those of weight 0 are no terms
        idf = np.log((1 + n) / (1 + df)) * (chi2 / (chi2 + HALF_CHI2))
        good = (df >= MIN_EXAMPLES) & (idf > 0)
        self.terms, self.idf = vocabulary[good], idf[good]
        number = np.cumsum(good) - 1
        keep = good[term]
        term, doc, tf = number[term[keep]], owner[keep], tf[keep]
        weight = (1 + np.log(tf)) * self.idf[term]
        norm = np.sqrt(np.bincount(doc, weight * weight, minlength=n))
        weight = weight / norm[doc]
        # examples with the same strongest term stand together, so that blocks differ
        strongest = np.full(n, -1)
        by_weight = np.argsort(weight, kind="stable")
        strongest[doc[by_weight]] = term[by_weight]
        self.order = np.lexsort((np.arange(n), strongest))
        place = np.empty(n, np.int64)
        place[self.order] = np.arange(n)
        doc = place[doc]
        self.labels = labels[self.order].astype(float)
        self.blocks = -(-n // BLOCK)
        by = np.lexsort((doc, term))
        term, self.doc, self.weight = term[by], doc[by].astype(np.int32), weight[by]
        # one entry for each term and block it occurs in
        entry = np.flatnonzero(np.concatenate(([True], (np.diff(term) != 0) | (np.diff(self.doc // BLOCK) != 0)))
                               ) if len(term) else np.zeros(0, np.int64)
        self.entry_n = np.diff(np.append(entry, len(term))).astype(np.int32)
        self.entry_block = self.doc[entry] // BLOCK
        self.entry_max = np.maximum.reduceat(self.weight, entry) if len(term) else np.zeros(0)
        self.term_lo = np.searchsorted(term[entry], np.arange(len(self.terms)))
        self.term_n = np.diff(np.append(self.term_lo, len(entry)))
        self.post_lo = np.searchsorted(term, np.arange(len(self.terms)))
        self.post_n = df[good]
        self.row = np.full(len(self.terms), -1)
        self.common = np.flatnonzero(self.post_n * COMMON >= n)
        self.row[self.common] = np.arange(len(self.common))
        self.rows = self.most = self.starts = None

    def __getstate__(self):
        return {**self.__dict__, "rows": None, "most": None, "starts": None}

    def _spread(self) -> None:
        """Weights of the common terms by block, and their maxima."""
        self.rows = np.zeros((self.blocks, len(self.common), BLOCK))
        self.most = np.zeros((len(self.common), self.blocks))
        for r, t in enumerate(self.common):
            post = slice(self.post_lo[t], self.post_lo[t] + self.post_n[t])
            self.rows[self.doc[post] // BLOCK, r, self.doc[post] % BLOCK] = self.weight[post]
            entry = slice(self.term_lo[t], self.term_lo[t] + self.term_n[t])
            self.most[r, self.entry_block[entry]] = self.entry_max[entry]

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        """Index of every hash among the sorted terms, -1 for unknown ones; the leading bits say where to look."""
        if self.starts is None:
            self.starts = np.searchsorted(self.terms >> np.uint64(64 - LEADING), np.arange((1 << LEADING) + 1)).astype(np.int32)
        lead = (hashes >> np.uint64(64 - LEADING)).astype(np.int64)
        at, end = self.starts[lead], self.starts[lead + 1]
        found = np.full(len(hashes), -1)
        left = np.flatnonzero(at < end)
        at, end, wanted = at[left], end[left], hashes[left]
        while len(left):
            hit = self.terms[at] == wanted
            found[left[hit]] = at[hit]
            at = at + 1
            more = ~hit & (at < end)
            left, at, end, wanted = left[more], at[more], end[more], wanted[more]
        return found

    def vectors(self, hashes: np.ndarray, owner: np.ndarray, n_texts: int):
        """(text index, term, weight) of all known terms, unit length for each text."""
        if not len(self.terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        at = self._places(hashes)
        hit = at >= 0
        key, tf = np.unique(owner[hit] * len(self.terms) + at[hit], return_counts=True)
        text, term = key // len(self.terms), key % len(self.terms)
        weight = (1 + np.log(tf)) * self.idf[term]
        norm = np.sqrt(np.bincount(text, weight * weight, minlength=n_texts))
        return text, term, weight / norm[text]

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int, skip: int = -1):
        """:meth:`search` for one text."""
        return self.search(np.zeros(len(term), np.int64), term, weight, 1, k, np.array([skip]))[0]

    def search(self, text: np.ndarray, term: np.ndarray, weight: np.ndarray, n_texts: int, k: int,
               skip: np.ndarray | None = None):
        """Places and similarities of the k nearest examples of similarity over 0 of every text, nearest first.

        ``skip`` is a place for each text that takes no part, -1 for none.  Ties go to the smaller place.
        """
        if self.rows is None:
            self._spread()
        width, row = self.blocks * BLOCK, self.row[term]
        rare = row < 0
        n = self.post_n[term[rare]]
        post = _ranges(self.post_lo[term[rare]], n)
        score = np.bincount(np.repeat(text[rare] * width, n) + self.doc[post], np.repeat(weight[rare], n) * self.weight[post],
                            minlength=n_texts * width).reshape(n_texts, width)
        common = np.zeros((n_texts, len(self.common)))
        common[text[~rare], row[~rare]] = weight[~rare]
        bound = score.reshape(n_texts, self.blocks, BLOCK).max(2) + common @ self.most
        known = np.full((n_texts, width), -np.inf)
        first = np.zeros((n_texts, self.blocks), bool)
        most = min(-(-(k + 1) // BLOCK) + 1, self.blocks)
        np.put_along_axis(first, np.argpartition(-bound, most - 1, axis=1)[:, :most], True, 1)
        self._evaluate(known, score, common, first, skip)
        at = max(width - k, 0)
        floor = np.maximum(np.partition(known, at, axis=1)[:, at], 0)[:, None]
        self._evaluate(known, score, common, ~first & (bound >= floor - 1e-9) & (bound > 0), skip)
        floor = np.partition(known, at, axis=1)[:, at]
        found = []
        for own, low in zip(known, floor):
            places = np.flatnonzero((own >= low) & (own > 0))
            places = places[np.lexsort((places, -own[places]))[:k]]
            found.append((places, own[places]))
        return found

    def _evaluate(self, known, score, common, wanted, skip) -> None:
        """Fill ``known`` with the exact similarities in the wanted blocks of every text."""
        for block in np.flatnonzero(wanted.any(0)):
            who, span = np.flatnonzero(wanted[:, block]), slice(block * BLOCK, (block + 1) * BLOCK)
            known[who, span] = score[who, span] + common[who] @ self.rows[block]
        if skip is not None:
            known[np.flatnonzero(skip >= 0), skip[skip >= 0]] = -np.inf

    def vote(self, places, scores) -> float:
        s = scores * scores
        return float((s * self.labels[places]).sum() / s.sum())


def _split(text: np.ndarray, n_texts: int):
    return np.searchsorted(text, np.arange(n_texts)), np.searchsorted(text, np.arange(n_texts), "right")


class ToxicityModel:
    """Index and calibration, fitted on a bounded labelled sample."""

    def __init__(self, ids: list[int], texts: list[str], labels: list[int], shares: tuple[int, int],
                 k: int = NEIGHBOURS):
        self.k = k
        y = np.array(labels, int)
        have = np.bincount(y, minlength=2)[:2]
        self.bare = (shares[1] + 1) / (sum(shares) + 2)
        self.slope, self.offset, self.index = 1.0, 0.0, None
        if not have.all():
            return
        hasher = WordHasher(separator_mask(_SEPARATORS))
        lowered = [t.lower().encode("utf-8", "replace") for t in texts]
        self.index = BlockMaxIndex(*_counted(lowered, hasher), y)
        self.ids = np.array(ids)[self.index.order]
        place = np.empty(len(y), np.int64)
        place[self.index.order] = np.arange(len(y))
        votes = np.full(len(y), np.nan)
        for first, part in _parts(lowered):
            text, term, weight = self.index.vectors(*_terms(part, hasher), len(part))
            for i, p, s in self._found(text, term, weight, len(part), place[first:first + len(part)]):
                if len(p):
                    votes[first + i] = self.index.vote(p, s)
        weight = np.array(shares)[y] / have[y]  # the sample's classes at their share of all labels
        none = np.isnan(votes)
        self.bare = (weight[none & (y == 1)].sum() + self.bare) / (weight[none].sum() + 1)
        self._calibrate(votes[~none], y[~none], weight[~none])

    def _found(self, text, term, weight, n_texts: int, skip=None):
        """(text index, places, similarities) of every text's nearest examples."""
        lo, hi = _split(text, n_texts)
        for a in range(0, n_texts, TEXTS):
            b = min(a + TEXTS, n_texts)
            own = slice(lo[a], hi[b - 1])
            near = self.index.search(text[own] - a, term[own], weight[own], b - a, self.k,
                                     None if skip is None else skip[a:b])
            for i, (p, s) in enumerate(near, a):
                yield i, p, s

    def _calibrate(self, votes, y, weight) -> None:
        """Logistic curve over the votes' log odds, by weighted Newton steps with a light ridge."""
        x = np.stack((self._odds(votes), np.ones(len(votes))), 1)
        weight = weight / max(weight.sum(), 1e-9) * len(y)
        beta = np.array([1.0, 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            grad = x.T @ (weight * (y - p)) - 1e-3 * (beta - [1, 0])
            hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
            step = np.linalg.solve(hess, grad)
            beta = beta + np.clip(step, -1, 1)
            if np.abs(step).max() < 1e-8:
                break
        self.slope, self.offset = float(max(beta[0], 1e-3)), float(beta[1])

    @staticmethod
    def _odds(vote):
        v = np.clip(vote, 0.005, 0.995)
        return np.log(v / (1 - v))

    def score(self, texts: list[bytes], hasher: WordHasher):
        """(score, ids of the nearest examples, their similarities) of each lower-cased text."""
        scores, near, sims = np.full(len(texts), self.bare), [[]] * len(texts), [[]] * len(texts)
        if self.index is None:
            return scores, near, sims
        text, term, weight = self.index.vectors(*_terms(texts, hasher), len(texts))
        for i, p, s in self._found(text, term, weight, len(texts)):
            if len(p):
                odds = self.slope * self._odds(self.index.vote(p, s)) + self.offset
                scores[i] = 1 / (1 + np.exp(-odds))
                near[i], sims[i] = self.ids[p[:EVIDENCE]].tolist(), s[:EVIDENCE].tolist()
        return scores, near, sims


EVIDENCE = 3


def _score(batches, model):
    hasher, model = WordHasher(separator_mask(_SEPARATORS)), shared(model)
    for batch in batches:
        for part in slices(batch, "text"):
            scores, near, sims = model.score(byte_list(part.column("text")), hasher)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(scores), pa.array(near, pa.list_(pa.int64())),
                 pa.array(sims, pa.list_(pa.float64()))], names=["doc_id", "score", "evidence", "similarity"])


def toxicity_scores(docs: DataFrame, labels: DataFrame, fold: tuple[int, int] = FOLD, column: str = "toxic",
                    threshold: float = 0.3, per_class: int = PER_CLASS) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted, evidence, similarity.

    ``evidence`` are the doc_ids of the nearest labelled examples, nearest first.  The index is
    fitted on a sample of at most ``per_class`` labelled rows of each class outside the fold;
    terms are all words and word prefixes of ``MIN_EXAMPLES`` examples, weighted by how much they
    depend on the label.  Every row's whole text is scored.  A text without known terms (null and empty ones too) gets the share of label 1
    among such examples.  Null doc_id: held_out is false.  Without labels of both classes every
    score is the share of label 1.  Extra columns are ignored.
    """
    bound_batches(docs.sparkSession)
    model = share(docs.sparkSession,  # bounded by the sample
                  ToxicityModel(*labelled_sample(docs, labels, column, *fold, per_class=per_class)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.col("text").cast("string")).alias("text"))
    scored = rows.mapInArrow(partial(_score, model=model),
                             "doc_id long, score double, evidence array<long>, similarity array<double>")
    return scored.select("doc_id", in_fold(F.col("doc_id"), *fold).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence", "similarity")
