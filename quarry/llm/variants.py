"""Spelling variants of words by PartEnum signatures over letter multisets.

A word's letters are a binary vector with one dimension for each letter and occurrence.  One replaced
letter moves the vector by a Hamming distance of two, one inserted letter by one.  The dimensions are
partitioned, and every subset of parts that must agree somewhere within the distance is a signature:
words within the distance share one exactly.  Words are joined on equal signatures and verified by
their edit distance.  One edit also leaves the first or the last half of the shorter word in place;
that half is part of the join key, so that a signature of few letters has no large group.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import bound_batches, byte_list, discard, materialize, slices

MODULUS = 97
MIN_LENGTH = 5
MIN_COUNT = 3
HELD_WORDS = 1 << 17  # distinct words a task counts before it hands them on

#: (first-level parts, second-level parts, distance) of words of one length and of lengths one apart.
REPLACED = (1, 4, 2)
INSERTED = (2, 1, 1)

_RUN = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_LONG_RUN = 64  # bytes; the checksum of longer runs is taken one by one


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


def _checksums(joined: bytes, start: np.ndarray, end: np.ndarray, seeds: np.ndarray, table: np.ndarray) -> np.ndarray:
    """crc32 of every run, each continued from its seed; one byte of all runs at a time."""
    buf = np.frombuffer(joined, np.uint8)
    state = seeds ^ np.uint32(0xFFFFFFFF)
    length = end - start
    left = np.flatnonzero(length <= _LONG_RUN)
    for k in range(_LONG_RUN):
        left = left[length[left] > k]
        if not len(left):
            break
        s = state[left]
        state[left] = table[(s ^ buf[start[left] + k]) & np.uint32(255)] ^ (s >> np.uint32(8))
    out = state ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(length > _LONG_RUN):
        out[i] = zlib.crc32(joined[start[i]:end[i]], int(seeds[i]))
    return out


def _runs(joined: bytes):
    """Starts and ends of all runs of letters, found on the bytes of lower-cased UTF-8."""
    buf = np.frombuffer(joined, np.uint8)
    inside = (buf >= 97) & (buf <= 122)
    lead = np.flatnonzero(buf[:-1] == 0xC3)
    inside[lead] = inside[lead + 1] = True
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    return edge[0::2], edge[1::2]


def _count(batches):
    """(word, n) of every batch's texts after the deletions; a word may come several times."""
    table, counts = _crc_table(), Counter()

    def given():
        words = [w for w, n in counts.items() if n]
        for at in range(0, len(words), 1 << 15):
            some = words[at:at + (1 << 15)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.binary()).cast(pa.string()), pa.array([counts[w] for w in some], pa.int64())],
                names=["word", "n"])
        counts.clear()

    for batch in batches:
        for part in slices(batch, "text"):
            texts = [t.translate(_LOWER) for t in byte_list(part.column("text"))]
            joined = b"\n".join(texts) + b"\n"
            words = _RUN.findall(joined)
            counts.update(words)
            start, end = _runs(joined)
            ids = part.column("doc_id").to_pylist()
            bounds = np.cumsum([len(t) + 1 for t in texts])
            owner = np.searchsorted(bounds, start, side="right")
            seeds = np.array([0 if i is None else zlib.crc32(b"%d:" % i) for i in ids], np.uint32)
            named = np.array([i is not None for i in ids])
            h = _checksums(joined, start, end, seeds[owner], table)
            for at in np.flatnonzero((h % MODULUS == 0) & named[owner]).tolist():
                word = words[at].decode()
                k = int(h[at]) % len(word)
                counts[words[at]] -= 1
                counts[(word[:k] + word[k + 1:]).encode()] += 1
            if len(counts) > HELD_WORDS:
                yield from given()
    yield from given()


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) over all texts: runs of letters, A-Z lower-cased, one letter deleted where crc32 says so.

    The checksum is that of ``<doc_id>:<run>``; in rows without doc_id nothing is deleted.  Null texts
    have no words.  Every task counts before the shuffle.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (rows.mapInArrow(_count, "word string, n long").filter(F.length("word") >= min_length)
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count))


def letter_parts(words: DataFrame, parts: int) -> list[str]:
    """The letters dealt into ``parts`` of about equal occurrence; there are 90 letters at most."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).filter("letter <> ''")
    found = sorted(letters.groupBy("letter").count().collect(), key=lambda r: (-r["count"], r.letter))
    dealt, load = [""] * parts, [0] * parts
    for r in found:
        i = load.index(min(load))
        dealt[i] += r.letter
        load[i] += r["count"]
    return dealt


def signature_subsets(n1: int, n2: int, k: int) -> list[tuple[int, ...]]:
    """PartEnum's parts that agree: some first-level part holds at most ceil((k + 1) / n1) - 1 of k differences,
    so all but that many of its ``n2`` second-level parts are equal."""
    inner = -(-(k + 1) // n1) - 1
    if inner >= n2:
        raise ValueError("too few second-level parts for the distance")
    return [tuple(i * n2 + j for j in subset) for i in range(n1) for subset in combinations(range(n2), n2 - inner)]


def _projection(word: Column, letters: str) -> Column:
    """The multiset of a word's letters outside ``letters``, as a sorted array."""
    return F.array_sort(F.split(F.translate(word, letters, ""), ""))


def _keys(word: Column, parts: list[str], scheme: tuple[int, int, int], length: Column) -> Column:
    """All join keys of a word, as of a shorter word of ``length``: signatures by half in place."""
    half = F.floor(length / 2).cast("int")
    first = F.concat(F.lit("<"), F.substring(word, F.lit(1), half))
    last = F.concat(F.lit(">"), F.right(word, length - half))
    keys = []
    for number, subset in enumerate(signature_subsets(*scheme)):
        outside = "".join(p for i, p in enumerate(parts) if i not in subset)
        held = _projection(word, outside)
        keys += [F.xxhash64(F.lit(number), length, part, held) for part in (first, last)]
    return F.explode(F.array_distinct(F.array(*keys))).alias("key")


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): all ordered pairs of words at edit distance one, each once.

    Only verified pairs leave the join; no list of a signature's words is built.  The join is told to
    merge: Spark takes the exploded keys for no larger than the file of words and would broadcast them.
    """
    length = F.length("word")
    n1, n2, _ = REPLACED
    parts = letter_parts(words, n1 * n2)
    same = words.select("word", "n", _keys(F.col("word"), parts, REPLACED, length))
    n1, n2, _ = INSERTED
    parts = letter_parts(words, n1 * n2)
    short = words.select("word", "n", _keys(F.col("word"), parts, INSERTED, length))
    longer = words.select("word", "n", _keys(F.col("word"), parts, INSERTED, length - 1))

    def verified(left: DataFrame, right: DataFrame, apart: Column) -> DataFrame:
        found = left.alias("l").join(right.alias("r").hint("merge"), (F.col("l.key") == F.col("r.key")) & apart & (
            F.levenshtein("l.word", "r.word", 1) == 1))
        return found.select(F.col("l.word").alias("word"), F.col("l.n").alias("n"),
                            F.col("r.word").alias("near"), F.col("r.n").alias("near_n"))

    gap = F.length("r.word") - F.length("l.word")
    found = verified(same, same, (F.col("l.word") < F.col("r.word")) & (gap == 0)).unionAll(
        verified(short, longer, gap == 1))
    both = found.unionAll(found.select(F.col("near").alias("word"), F.col("near_n").alias("n"),
                                       F.col("word").alias("near"), F.col("n").alias("near_n")))
    return both.repartition("word").dropDuplicates(["word", "near"])


def follow(forms: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(word, root) for each row of ``forms(word, form)``: the last word that forms lead to.

    Every round doubles the steps taken, so the rounds are logarithmic in the longest chain.  Joins of
    forms merge too: their file, with each root once, is far smaller than the rows in memory.
    """
    cur = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    for _ in range(max_rounds):
        ahead = cur.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        step = cur.join(ahead.hint("merge"), "root", "left").select(
            "word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved"))
        nxt = materialize(step, "forms")
        discard(cur)
        cur = nxt.select("word", "root")
        cur.scratch_path = nxt.scratch_path
        if nxt.filter("moved").isEmpty():
            return cur
    raise RuntimeError(f"forms did not settle in {max_rounds} rounds")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word; see :func:`word_counts` for what a word is.

    ``form`` is the near word (one code point inserted, deleted or replaced) of largest ``n``, the
    smallest in code-point order of equal ones, if it has at least twice the word's ``n``; else null.
    ``root`` follows forms to the last, and is the word itself without one.  No documents, null or
    empty texts give no words.  Repeated rows count each time.  Extra columns are ignored.
    """
    words = materialize(word_counts(docs), "words")
    near = near_pairs(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("low"), "near")).alias("best"))
    judged = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(-F.col("best.low") >= 2 * F.col("n"), F.col("best")).alias("best"))
    judged = materialize(judged.select("word", "n", "n_near", F.col("best.near").alias("form"),
                                       (-F.col("best.low")).alias("form_n")), "variants")
    discard(words)
    roots = follow(judged.filter("form IS NOT NULL"))
    return judged.join(roots.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
