"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items that share a run of ``SEED`` tokens meet.  Such a pair is tiled:
running Karp-Rabin hashes find all equal runs of unmarked tokens, the longest are marked in both
texts, and this repeats until no run of ``SEED`` tokens is left.  The share of an item's tokens
under tiles is its coverage; since tiles may lie in any order, reordered passages are caught.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import WordHasher, bound_batches, by_id, byte_list, separator_mask, slices, spaced, tidy

SEED = 5
HALF = 1 << 19  # bytes of texts held at once
COVERAGE = 0.5
BLOCK_CHARS = 4_000_000  # characters of benchmark items that one pass over the documents holds

#: All ASCII bytes but letters and digits separate tokens; other separators become blanks first.
_SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
_BASE = np.uint64(0x9E3779B97F4A7C15)


def rolling(tokens: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``size`` tokens."""
    m = len(tokens) - size + 1
    x = np.zeros(max(m, 0), np.uint64)
    if m > 0:
        for j in range(size):
            x = x * _BASE + tokens[j:j + m]
    return x


def _runs(doc: np.ndarray, item: np.ndarray, free_doc: np.ndarray, free_item: np.ndarray, size: int):
    """(start in doc, start in item, length) of all maximal runs of at least ``size`` equal free tokens."""
    def windows(tokens, free):
        blocked = np.concatenate(([0], np.cumsum(~free)))
        m = len(tokens) - size + 1
        at = np.flatnonzero(blocked[size:size + m] == blocked[:m])
        return at, rolling(tokens, size)[at]

    at_item, h_item = windows(item, free_item)
    at_doc, h_doc = windows(doc, free_doc)
    order = np.argsort(h_item, kind="stable")
    at_item, h_item = at_item[order], h_item[order]
    lo, hi = np.searchsorted(h_item, h_doc, "left"), np.searchsorted(h_item, h_doc, "right")
    n = hi - lo
    i = at_item[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    d = np.repeat(at_doc, n)
    equal = np.ones(len(d), bool)  # a hash match is confirmed token by token
    for j in range(size):
        equal &= doc[d + j] == item[i + j]
    d, i = d[equal], i[equal]
    if not len(d):
        return d, i, d
    order = np.lexsort((d, d - i))
    d, i = d[order], i[order]
    first = np.concatenate(([True], (np.diff(d) != 1) | (np.diff(i) != 1)))
    start = np.flatnonzero(first)
    length = np.diff(np.append(start, len(d))) + size - 1
    return d[start], i[start], length


def tiles(doc: np.ndarray, item: np.ndarray, size: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (start in doc, start in item, length) of the marked runs.

    Longest first; of equally long runs the one that starts first in ``doc``, then in ``item``.  An
    item shorter than ``size`` is looked for as a whole.
    """
    size = min(size, len(item))
    if not size or len(doc) < size:
        return []
    free_doc, free_item = np.ones(len(doc), bool), np.ones(len(item), bool)
    out = []
    while True:
        d, i, n = _runs(doc, item, free_doc, free_item, size)
        if not len(d):
            return out
        longest = n.max()
        for k in np.lexsort((i, d, -n)):
            if n[k] < longest:
                break
            a, b = slice(d[k], d[k] + longest), slice(i[k], i[k] + longest)
            if free_doc[a].all() and free_item[b].all():  # not under a tile of this round
                free_doc[a] = False
                free_item[b] = False
                out.append((int(d[k]), int(i[k]), int(longest)))


class Items:
    """Tokens of some benchmark items, and all their seeds in order of hash."""

    def __init__(self, ids: list[int], texts: list[bytes], size: int):
        hasher = WordHasher(separator_mask(_SEPARATORS))
        _, _, _, h, owner = hasher.words(texts)
        cut = np.cumsum(np.bincount(owner, minlength=len(texts)))[:-1]
        self.ids, self.size = ids, size
        self.tokens = np.split(h, cut)
        # one table for each length of seed; items shorter than the seed give one of their own length
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        by_size: dict[int, list] = {}
        for k, t in enumerate(self.tokens):
            if len(t):
                by_size.setdefault(min(size, len(t)), []).append(k)
        for n, members in by_size.items():
            windows = [np.unique(rolling(self.tokens[k], n)) for k in members]
            values = np.concatenate(windows)
            whose = np.repeat(members, [len(w) for w in windows])
            order = np.argsort(values, kind="stable")
            self.seeds[n] = values[order], whose[order]

    def candidates(self, tokens: np.ndarray, text: np.ndarray):
        """(text index, item place) of all pairs that share a seed."""
        found = []
        for n, (values, whose) in self.seeds.items():
            if len(tokens) < n:
                continue
            h = rolling(tokens, n)
            inside = text[:len(h)] == text[n - 1:]
            lo = np.searchsorted(values, h, "left")
            hit = np.flatnonzero(inside & (values[np.minimum(lo, len(values) - 1)] == h))
            hi = np.searchsorted(values, h[hit], "right")
            count = hi - lo[hit]
            at = np.repeat(lo[hit] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            found.append(np.unique(np.repeat(text[hit], count) * len(self.ids) + whose[at]))
        key = np.concatenate(found) if found else np.zeros(0, np.int64)
        return key // len(self.ids), key % len(self.ids)


def _match(batches, held, size: int, coverage: float):
    ids, texts = held.value
    items = Items(ids, texts, size)
    hasher = WordHasher(separator_mask(_SEPARATORS))
    for batch in batches:
        for part in slices(batch, "text", HALF):
            docs = byte_list(part.column("text"))
            _, start, end, tokens, owner = hasher.words(docs)
            who, which = items.candidates(tokens, owner)
            lo = np.searchsorted(owner, np.arange(len(docs)))
            hi = np.searchsorted(owner, np.arange(len(docs)), "right")
            out = []
            for w, k in zip(who.tolist(), which.tolist()):
                own = tokens[lo[w]:hi[w]]
                found = tiles(own, items.tokens[k], size)
                covered = sum(n for _, _, n in found)
                if covered >= coverage * len(items.tokens[k]) - 1e-9:
                    out.append((w, items.ids[k], covered, len(items.tokens[k]),
                                [{"doc": a, "item": b, "tokens": n} for a, b, n in sorted(found)]))
            doc_ids = part.column("doc_id").take(pa.array([o[0] for o in out], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.int64()),
                 pa.array([o[3] for o in out], pa.int64()), pa.array([o[4] for o in out], _TILES)],
                names=["doc_id", "item_id", "covered", "tokens", "tiles"])
    tidy()


_TILES = pa.list_(pa.struct([("doc", pa.int64()), ("item", pa.int64()), ("tokens", pa.int64())]))


def contaminated(docs: DataFrame, benchmark: DataFrame, size: int = SEED, coverage: float = COVERAGE,
                 block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, covered, tokens, tiles) of all pairs whose item is covered enough.

    ``covered`` of the item's ``tokens`` lie under tiles of at least ``size`` tokens; pairs below
    ``coverage`` are left out.  Tokens are lower-cased runs of letters, digits and marks;
    of scripts written without blanks (Chinese, Japanese, Thai, ...) every sign is a token.
    The benchmark is held in blocks of about ``block_chars`` characters (one item at least), one pass
    over the documents for each block, so neither driver nor tasks hold a benchmark that grows.
    Items without tokens and null or empty texts match nothing; an item shorter than ``size`` must
    occur as a whole.  Rows without item_id are left out; repeated rows of an item count once.
    Documents are taken row by row, so a repeated row gives a repeated pair; null doc_ids stay null.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), spaced(F.lower(F.col("text").cast("string"))).alias("text"))
    items = (benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                              spaced(F.lower(F.col("text").cast("string"))).alias("text"))
             .filter("item_id IS NOT NULL AND text IS NOT NULL").distinct())
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = int(-(-total // block_chars)) or 1
    schema = ("doc_id long, item_id long, covered long, tokens long, "
              "tiles array<struct<doc: long, item: long, tokens: long>>")
    out = None
    for b in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        held = spark.sparkContext.broadcast(([r.item_id for r in own], [r.text.encode() for r in own]))
        found = rows.mapInArrow(partial(_match, held=held, size=size, coverage=coverage), schema)
        out = found if out is None else out.unionAll(found)
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that cover no benchmark item; rows without doc_id stay."""
    return by_id(docs, contaminated(docs, benchmark, **options), "left_anti")
