"""Byte-level BPE encoding by merge replay, and decoding.

All pieces that a batch of documents adds to the vocabulary are laid out as one row of symbols.
An inverted index leads from every mergeable pair's rank to its positions; the ranks are taken in
order from a heap, each merge is applied at all its positions, and only the two neighbours of a
position that changed are looked up again.  A worker keeps the pieces it has encoded, up to a
fixed number.
"""

from __future__ import annotations

import base64
import heapq
from functools import partial
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import bound_batches, slices, tidy

POOL_BYTES = 3 << 18    # new pieces are replayed in pools of about so many bytes
POOL_PIECES = 1 << 21   # or when so many pieces of texts wait for one
KEPT_PIECES = 150_000   # pieces a worker remembers before it starts anew
FEW = 12                # a merge at so few positions is cheaper one by one
_SHIFT = 32


class Merges:
    """Token bytes by id, and for every pair of ids whose bytes join to a token that token's id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ids = ranks
        self.pairs: dict[int, int] = {}
        self.unsafe = set()  # ranks after whose merge a pair of lower rank can arise
        get = ranks.get
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a = get(token[:cut])
                if a is not None and (b := get(token[cut:])) is not None:
                    self.pairs[a << _SHIFT | b] = rank
                    self.unsafe.update(x for x in (a, b) if rank < x)
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks the single bytes {missing[:5]}")
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)])
        self.first = np.array([[get(bytes((a, b)), -1) for b in range(256)] for a in range(256)])
        keys = np.fromiter(self.pairs, np.int64, len(self.pairs))
        values = np.fromiter(self.pairs.values(), np.int64, len(self.pairs))
        left, right = keys >> _SHIFT, keys & (1 << _SHIFT) - 1
        size = max(ranks.values()) + 2
        by = np.lexsort((right, left))  # the partners of every left id, and of every right id
        self.after = np.searchsorted(left[by], np.arange(size)).tolist(), right[by], values[by]
        by = np.lexsort((left, right))
        self.before = np.searchsorted(right[by], np.arange(size)).tolist(), left[by], values[by]

    @staticmethod
    def _lookup(table, fixed: int, others: np.ndarray) -> np.ndarray:
        """The ranks of the pairs of ``fixed`` with ``others``, -1 where there is none."""
        start, partner, rank = table
        lo, hi = start[fixed], start[fixed + 1]
        if lo == hi:
            return np.full(len(others), -1)
        at = np.minimum(np.searchsorted(partner[lo:hi], others), hi - lo - 1)
        return np.where(partner[lo:hi][at] == others, rank[lo:hi][at], -1)

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in one row, number of ids of each), replaying the merges over all words at once."""
        joined = np.frombuffer(b"".join(words), np.uint8)
        length = np.array([len(w) for w in words], np.int64)
        n = len(joined)
        if not n:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        last = np.cumsum(length)[length > 0] - 1
        word = np.repeat(np.arange(len(words)), length)
        nxt = np.arange(1, n + 1)
        nxt[last] = -1
        prv = np.arange(-1, n - 1)
        prv[np.concatenate(([0], last[:-1] + 1))] = -1
        sym = self.byte_ids[joined]
        rank = np.full(n, -1)  # of the pair that starts at a position
        rank[:-1] = self.first[joined[:-1], joined[1:]]
        rank[last] = -1
        index: dict[int, list] = {}
        heap: list[int] = []

        def enter(places: np.ndarray, ranks: np.ndarray) -> None:
            """Add positions to the inverted index under the ranks of their pairs."""
            by = np.argsort(ranks, kind="stable")
            places, ranks = places[by], ranks[by]
            cut = np.flatnonzero(np.diff(ranks)) + 1
            bounds = [0, *cut.tolist(), len(ranks)]
            for q, lo, hi in zip(ranks[[0, *cut]].tolist(), bounds, bounds[1:]):
                if q in index:
                    index[q].append(places[lo:hi])
                else:
                    index[q] = [places[lo:hi]]
                    heapq.heappush(heap, q)

        at = np.flatnonzero(rank >= 0)
        if len(at):
            enter(at, rank[at])
        views = [memoryview(x) for x in (sym, nxt, prv, rank, word)]
        while heap:
            r = heapq.heappop(heap)
            chunks = index.pop(r)
            places = chunks[0] if len(chunks) == 1 else np.concatenate(chunks)
            places = np.unique(places) if len(places) > FEW else places
            if len(places) > FEW:
                places = places[rank[places] == r]  # else the pair has gone meanwhile
                slow = np.zeros(len(places), bool)  # overlapping pairs, or two in a word where ranks can fall
                if r in self.unsafe:
                    same = word[places][1:] == word[places][:-1]
                    slow[1:] |= same
                    slow[:-1] |= same
                overlap = nxt[places][:-1] == places[1:]
                if overlap.any():
                    slow |= np.isin(word[places], word[places[1:][overlap]])
                if slow.any():
                    self._one_by_one(r, places[slow].tolist(), views, index, heap)
                    places = places[~slow]
                self._all_at_once(r, places, (sym, nxt, prv, rank), enter)
            else:
                self._one_by_one(r, sorted(set(places.tolist())), views, index, heap)
        alive = sym >= 0
        return sym[alive], np.bincount(word[alive], minlength=len(words))

    def _all_at_once(self, r: int, places: np.ndarray, arrays, enter) -> None:
        """Merge positions that do not touch one another's order."""
        sym, nxt, prv, rank = arrays
        second = nxt[places]
        third = nxt[second]
        sym[places], nxt[places], rank[second] = r, third, -1
        sym[second] = -1
        right = third >= 0
        prv[third[right]] = places[right]
        rank[places] = -1
        for table, at, other in ((self.after, places[right], third[right]), (self.before, prv[places], None)):
            if other is None:
                at = other = at[at >= 0]
            if len(at):
                q = self._lookup(table, r, sym[other])
                rank[at] = q
                good = q >= 0
                if good.any():
                    enter(at[good], q[good])

    def _one_by_one(self, r: int, places: list[int], views, index, heap) -> None:
        """Merge from left to right: few positions, overlapping pairs, or ranks that can fall."""
        sym, nxt, prv, rank, word = views
        pair = self.pairs.get
        hold, again = set(), []

        def put(i, q):
            rank[i] = -1 if q is None else q
            if q is not None:
                if q in index:
                    index[q].append(np.array([i]))
                else:
                    index[q] = [np.array([i])]
                    heapq.heappush(heap, q)
                if q < r:
                    hold.add(word[i])

        for i in places:
            if rank[i] != r:
                continue
            if hold and word[i] in hold:
                again.append(i)  # a merge of lower rank arose in this word and goes first
                continue
            j = nxt[i]
            k = nxt[j]
            sym[i], nxt[i], sym[j], rank[j] = r, k, -1, -1
            if k >= 0:
                prv[k] = i
                put(i, pair(r << _SHIFT | sym[k]))
            else:
                rank[i] = -1
            h = prv[i]
            if h >= 0:
                put(h, pair(sym[h] << _SHIFT | r))
        if again:
            if r not in index:
                heapq.heappush(heap, r)
            index.setdefault(r, []).append(np.array(again))


class _Numbers(dict):
    """Numbers pieces in order of first sight."""

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self)
        return n


class Encoder:
    """Encodes texts slice by slice and remembers up to about ``KEPT_PIECES`` pieces."""

    def __init__(self, merges: Merges, pattern: str):
        self.merges, self.pattern = merges, regex.compile(pattern)
        self._reset([])

    def _reset(self, pieces) -> None:
        self.numbers = _Numbers()
        self.ids, self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for p in pieces:
            self.numbers[p]
        self.learn()

    def number(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(piece numbers of all texts in one row, number of pieces of each text)."""
        number, find = self.numbers.__getitem__, self.pattern.findall
        rows = [np.fromiter(map(number, find(t)), np.int32) for t in texts]
        return np.concatenate(rows) if rows else np.zeros(0, np.int32), np.array([len(r) for r in rows], np.int64)

    def unknown(self) -> int:
        return len(self.numbers) - len(self.start)

    def learn(self) -> None:
        """Find the ids of all pieces that were numbered since the last time."""
        raws = [p.encode("utf-8", "replace") for p in islice(self.numbers, len(self.start), None)]
        if not raws:
            return
        whole = np.array([self.merges.ids.get(raw, -1) for raw in raws])
        parts = np.flatnonzero(whole < 0)
        ids, counts = self.merges.replay([raws[i] for i in parts])
        count = np.ones(len(raws), np.int64)
        count[parts] = counts
        flat = np.repeat(whole, count)
        flat[flat < 0] = ids
        self.start = np.concatenate((self.start, len(self.ids) + np.cumsum(count) - count))
        self.count = np.concatenate((self.count, count))
        self.ids = np.concatenate((self.ids, flat))

    def look_up(self, numbers: np.ndarray, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids in one row, number of ids of each text) of what :meth:`number` gave."""
        n = self.count[numbers]
        ends = np.concatenate(([0], np.cumsum(n)))
        at = np.repeat(self.start[numbers] - ends[:-1], n) + np.arange(ends[-1])
        return self.ids[at], np.diff(ends[np.concatenate(([0], np.cumsum(pieces)))])

    def stream(self, slices_of_texts):
        """Yields (key, ids, counts) for every (key, texts), in order."""
        waiting, size, chars = [], 0, 0

        def flush():
            self.learn()
            for key, numbers, pieces in waiting:
                yield key, *self.look_up(numbers, pieces)

        for key, texts in slices_of_texts:
            known = len(self.numbers)
            waiting.append((key, *self.number(texts)))
            size += len(waiting[-1][1])
            chars += sum(map(len, islice(self.numbers, known, None))) if len(self.numbers) > known else 0
            if chars >= POOL_BYTES or size >= POOL_PIECES:
                yield from flush()
                waiting, size, chars = [], 0, 0
                if len(self.numbers) > KEPT_PIECES:  # start anew with what this slice shares
                    self._reset(set().union(*map(self.pattern.findall, texts)))
        yield from flush()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in one row, number of ids of each text)."""
        _, ids, counts = next(iter([*self.stream([(None, texts)])]))
        return ids, counts


class Pieces:
    """A table of byte strings by number; joins any sequence of them without a Python loop."""

    def __init__(self, strings: list[bytes]):
        self.blob = np.frombuffer(b"".join(strings) or b"\0", np.uint8)
        self.length = np.array([len(s) for s in strings], np.int64)
        self.start = np.cumsum(self.length) - self.length

    def join(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each run of ``counts`` ids."""
        n = self.length[ids]
        ends = np.cumsum(n)
        at = np.repeat(self.start[ids] - (ends - n), n) + np.arange(n.sum())
        joined = self.blob[at].tobytes()
        cut = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))]
        return [joined[a:b] for a, b in zip(cut[:-1], cut[1:])]


def _encode(batches, merges, pattern: str):
    held = merges.value
    if "merges" not in held:  # the tables stay with the worker, across tasks
        held["merges"] = Merges(held["ranks"])
    encoder = Encoder(held["merges"], pattern)  # the pieces do not
    parts = ((part.column("doc_id"), [t or "" for t in part.column("text").to_pylist()])
             for batch in batches for part in slices(batch, "text"))
    for doc_id, ids, counts in encoder.stream(parts):
        offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [doc_id, pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))],
            names=["doc_id", "ids"])
    del encoder, parts
    tidy()


FIELDS = {"doc_id": "long", "ids": "array<int>", "n_tokens": "long", "id_text": "string", "decoded": "binary"}


def _decode(batches, ranks, columns=tuple(FIELDS)):
    held = ranks.value
    if "pieces" not in held:
        by_id = [b""] * (max(held["ranks"].values()) + 1)
        for token, rank in held["ranks"].items():
            by_id[rank] = token
        held["pieces"] = Pieces(by_id)
        held["digits"] = Pieces([b"%d " % i for i in range(len(by_id))])
    for batch in batches:
        size = max(1, batch.num_rows * (1 << 18) // max(1, len(batch.column("ids").flatten())))
        for lo in range(0, batch.num_rows, size):
            part = batch.slice(lo, size)
            column = part.column("ids").fill_null([])
            ids = column.flatten().to_numpy().astype(np.int64)
            counts = np.diff(column.offsets.to_numpy())
            made = {"doc_id": lambda: part.column("doc_id"), "ids": lambda: column,
                    "n_tokens": lambda: pa.array(counts.astype(np.int64)),
                    "id_text": lambda: pa.array(
                        [t[:-1].decode() for t in held["digits"].join(ids, counts)], pa.string()),
                    "decoded": lambda: pa.array(held["pieces"].join(ids, counts), pa.binary())}
            yield pa.RecordBatch.from_arrays([made[c]() for c in columns], names=list(columns))


def _round_trip(batches, ranks, pattern: str, columns):
    """Decode what is encoded, batch by batch in one worker."""
    return _decode(_encode(batches, ranks, pattern), ranks, columns)


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a file of lines ``base64(token) rank``."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _ranks(docs: DataFrame, path: str):
    """The vocabulary file as a broadcast table; its size is that of the file, whatever the data."""
    return docs.sparkSession.sparkContext.broadcast({"ranks": read_ranks(path)})


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per input row: doc_id, ids (array of int).

    Each match of ``pattern`` is encoded on its own: a piece that is a token gets its id, any other
    is merged byte by byte in rank order, the leftmost of equal ranks first.  No special tokens.
    Null or empty text: no ids.  Null doc_id stays null; repeated rows are encoded one by one;
    extra columns are ignored.  A worker holds one slice of texts of about 512 kB (one text at
    least) and a bounded memory of pieces.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(partial(_encode, merges=_ranks(docs, path), pattern=pattern),
                           "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """One row per row of ``encoded(doc_id, ids)``: doc_id, ids, n_tokens, id_text, decoded.

    ``id_text`` are the ids in decimal, joined by one space; ``decoded`` the bytes of the tokens.
    """
    return encoded.mapInArrow(partial(_decode, ranks=_ranks(encoded, path)), _schema(FIELDS))


def _schema(columns) -> str:
    return ", ".join(f"{c} {FIELDS[c]}" for c in columns)


def round_trip(docs: DataFrame, path: str, pattern: str, columns=tuple(FIELDS)) -> DataFrame:
    """:func:`decode` of :func:`encode` with the chosen columns; the ids need not leave the worker in between."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(partial(_round_trip, ranks=_ranks(docs, path), pattern=pattern, columns=columns),
                           _schema(columns))


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row after a round trip."""
    return round_trip(docs, path, pattern, ("doc_id", "n_tokens", "id_text", "decoded")).select(
        "doc_id", "n_tokens", F.sha2(F.col("id_text").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
